"""Properties of estimators, clusters and components."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from saltmarsh.operators import aggregates as agg, clusters as cl, density as dn, models as ml, retrieval as rt, stats as st
from saltmarsh.plans import QUERIES
from saltmarsh.plans.tables import profile


def brute_density(x, eps, min_points):
    near = ((x[:, None] - x[None]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= min_points
    label = np.where(core, np.arange(len(x)), -1)
    while True:
        new = np.array([min(label[j] for j in np.flatnonzero(near[i] & core)) if core[i] else -1 for i in range(len(x))])
        if (new == label).all():
            break
        label = new
    for i in np.flatnonzero(~core):
        hit = label[np.flatnonzero(near[i] & core)]
        label[i] = hit.min() if len(hit) else -1
    return label


@pytest.mark.parametrize("d,eps,part", [(2, 0.35, 4096), (3, 0.7, 60), (7, 1.3, 40)])
def test_density_clusters_match_brute_force(spark, d, eps, part):
    rng = np.random.default_rng(d)
    x = np.vstack([rng.normal(0, 0.4, (120, d)), rng.normal(2.2, 0.5, (90, d)), rng.uniform(-4, 5, (60, d)), np.zeros((40, d)), 0.9 * eps + rng.normal(0, eps / 20, (50, d))])
    pdf = pd.DataFrame(x, columns=[f"c{i}" for i in range(d)]).assign(id=np.arange(len(x)))
    out = dn.density_clusters(spark.createDataFrame(pdf), "id", [f"c{i}" for i in range(d)], eps, 6, part).toPandas().sort_values("id")
    assert (out["cluster"].to_numpy() == brute_density(x, eps, 6)).all()


def test_connected_groups(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(40, 41), (50, 40)], "a bigint, b bigint")
    nodes = spark.createDataFrame([(i,) for i in [*range(31), 40, 41, 50, 60]], "node bigint")
    got = {r["node"]: r["group"] for r in cl.connected_groups(nodes, links).collect()}
    assert all(got[i] == 0 for i in range(31)) and got[41] == got[50] == 40 and got[60] == 60


def test_joint_use_counts(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"u": rng.integers(0, 80, 900), "f": [f"f{i}" for i in rng.integers(0, 12, 900)]})
    got = {(r["a"], r["b"]): r["both"] for r in agg.joint_use(spark.createDataFrame(pdf), "u", "f").collect()}
    sets = pdf.groupby("u").f.agg(set)
    names = sorted(pdf.f.unique())
    want = {(a, b): sum(a in s and b in s for s in sets) for i, a in enumerate(names) for b in names[i + 1 :]}
    assert got == {k: v for k, v in want.items() if v}
    least = 0.3
    odd = spark.createDataFrame(pdf).unionByName(spark.createDataFrame([(500, None), (0, None)], "u bigint, f string"))
    got = {(r["a"], r["b"]): (r["both"], round(r["lift"], 9)) for r in agg.joint_use(odd, "u", "f", least).collect()}
    n, held = len(sets) + 1, {a: sum(a in s for s in sets) for a in names}
    assert got == {(a, b): (v, round(v * n / held[a] / held[b], 9)) for (a, b), v in want.items() if v >= least * n} and 0 < len(got) < len(want)


def test_pair_counts_in_pieces(monkeypatch):
    rng = np.random.default_rng(6)
    baskets = [sorted({f"i{k}" for k in rng.integers(0, 40, size)}) for size in rng.integers(1, 30, 60)]
    want = {}
    for b in baskets:
        for i, x in enumerate(b):
            for y in b[i + 1 :]:
                want[x, y] = want.get((x, y), 0) + 1
    for at_once in (1 << 21, 7):
        monkeypatch.setattr(agg, "PAIRS_AT_ONCE", at_once)
        parts = list(agg._pair_counts([pd.DataFrame({"basket": baskets[:25]}), pd.DataFrame({"basket": baskets[25:]}), pd.DataFrame({"basket": [["i1"]]})]))
        assert max(len(p) for p in parts) <= at_once
        assert pd.concat(parts).groupby(["a", "b"]).n.sum().to_dict() == want


@pytest.mark.parametrize("batch", [4096, 3])
def test_similarity_search_matches_brute_force(spark, batch):
    rng = np.random.default_rng(1)
    x, q = rng.normal(size=(300, 8)), rng.normal(size=(7, 8))
    vec = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>").repartition(5)
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "query_id bigint, query array<double>")
    got = rt.similarity_search(vec, queries, 4, batch=batch).toPandas()
    cos = (q / np.linalg.norm(q, axis=1)[:, None]) @ (x / np.linalg.norm(x, axis=1)[:, None]).T
    for i in range(len(q)):
        assert got[got.query_id == i].sort_values("rank")["id"].tolist() == np.argsort(-cos[i])[:4].tolist()


def test_folds_are_balanced(spark, small):
    frame = st.stratified_folds(profile(spark, small), "churned", "user_id").groupBy("churned", "fold").count().toPandas()
    assert (frame.groupby("churned")["count"].agg(lambda c: c.max() - c.min()) <= 1).all()
    assert frame["count"].sum() == profile(spark, small).count()


def test_scaling_uses_train_rows_only(spark, small):
    frame, names = ml.feature_frame(profile(spark, small))
    train = frame.where("split = 'train'").agg(F.avg("mrr_z"), F.stddev_pop("mrr_z")).first()
    assert train[0] == pytest.approx(0, abs=1e-9) and train[1] == pytest.approx(1, abs=1e-9)
    assert len(names) == len(ml.NUMERIC) + 4


def test_linear_regression_recovers_weights(spark):
    from pyspark.ml.feature import VectorAssembler

    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"a": rng.normal(size=200), "b": rng.normal(size=200)})
    pdf["label"] = 3 * pdf.a - 2 * pdf.b + 1
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame(pdf))
    assert ml.linear().fit(rows).coefficients.toArray() == pytest.approx([3, -2], abs=1e-6)
    x = pdf[["a", "b"]].to_numpy() - pdf[["a", "b"]].to_numpy().mean(0)
    want = np.linalg.solve(x.T @ x + np.eye(2), x.T @ (pdf.label - pdf.label.mean()))
    assert ml.ridge(1.0, rows).fit(rows).coefficients.toArray() == pytest.approx(want, abs=1e-4)


def test_components(spark, small):
    rows = cl.scaled_vectors(profile(spark, small), ["tenure_days", "mrr", "total_usage", "feature_count"])
    m = cl.fit_pca(rows, 3)
    w = m.pc.toArray()
    assert w.T @ w == pytest.approx(np.eye(3), abs=1e-9)
    errors = [cl.reconstruct(rows, cl.fit_pca(rows, k), 4).agg(F.avg("error")).first()[0] for k in (1, 2, 4)]
    assert errors[0] >= errors[1] >= errors[2] and errors[2] == pytest.approx(0, abs=1e-9)
    assert cl.explained(rows, 4).agg(F.sum("share")).first()[0] == pytest.approx(1.0)


def test_clusters_are_partitions(spark, small):
    users = profile(spark, small).count()
    for key in ("kmeans", "dbscan", "cluster_by_cohort"):
        out = QUERIES[key](spark, small)
        assert out.count() == users and out.select("user_id").distinct().count() == users


def test_votes_and_bands(spark, small):
    out = QUERIES["voting_soft"](spark, small).toPandas()
    assert np.allclose(out[["p0", "p1", "p2"]].mean(axis=1), out["p"], atol=1e-5) and out["p"].between(0, 1).all()
    assert set(QUERIES["intervention_value"](spark, small).toPandas()["band"]) <= {"low", "medium", "high"}


def test_saved_model_has_manifest(spark, small):
    row = QUERIES["sink_model"](spark, small).first()
    assert row["version"] == "1" and "auc" in row["metrics"]


def test_p_values(spark, small):
    out = QUERIES["significance_p_values"](spark, small).toPandas()
    assert out["p_value"].between(0, 1).all() and len(out) == 12


def test_kmeans_by_group_settles_with_all_clusters(spark):
    rng = np.random.default_rng(8)
    rows = [("blobs", float(x + rng.normal() * 0.1), float(y + rng.normal() * 0.1)) for x, y in ((0, 0), (9, 0), (0, 9)) for _ in range(40)]
    rows += [("noise", float(x), float(y)) for x, y in rng.normal(size=(200, 2))] + [("two", 1.0, 1.0)] * 30 + [("two", 2.0, 1.0)] * 3 + [("one", 5.0, 5.0)]
    rows += [(None, 1.0, None), (None, 2.0, 3.0), (None, None, 3.0), ("same", 4.0, 4.0), ("same", 4.0, 4.0)]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "id long, g string, x double, y double").repartition(4)
    got = cl.kmeans_by_group(df, "g", ["x", "y"], 3, tol=0.0, rounds=100).toPandas()
    assert len(got) == len(rows) and list(got.columns) == ["id", "g", "x", "y", "cluster"]
    assert got.groupby(got.g.fillna("-")).cluster.nunique().to_dict() == {"blobs": 3, "noise": 3, "two": 2, "one": 1, "same": 1, "-": 3}
    blobs = got[got.g == "blobs"].sort_values("id").cluster.to_numpy().reshape(3, 40)
    assert (blobs == blobs[:, :1]).all()
    noise = got[got.g == "noise"]
    z = ((noise[["x", "y"]] - noise[["x", "y"]].mean()) / noise[["x", "y"]].std(ddof=0)).to_numpy()
    means = np.stack([z[noise.cluster == j].mean(axis=0) for j in range(3)])
    assert (((z[:, None] - means) ** 2).sum(axis=2).argmin(axis=1) == noise.cluster).all()
    early = cl.kmeans_by_group(df, "g", ["x", "y"], 3, rounds=100).toPandas()
    assert early.groupby(early.g.fillna("-")).cluster.nunique().to_dict() == got.groupby(got.g.fillna("-")).cluster.nunique().to_dict()
    assert cl.kmeans_by_group(df.limit(0), "g", ["x", "y"], 3).count() == 0


def lloyd(x, centres, rounds):
    for _ in range(rounds):
        near = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        centres = np.array([x[near == j].mean(0) if (near == j).any() else centres[j] for j in range(len(centres))])
    return ((x[:, None] - centres[None]) ** 2).sum(2).min(1).sum()


def test_kmeans_runs_are_separate_fits(spark):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector

    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(m, 0.3, (150, 3)) for m in (0, 2, 4, 9)] + [np.full((40, 3), 1.0)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i int, v array<double>").select("i", array_to_vector("v").alias("features"))
    runs = [(2, 1), (4, 1), (4, 2), (6, 5)]
    fits = cl.kmeans_runs(df, runs, rounds=40, tol=0.0)
    assert [len(f.points) for f in fits] == [2, 4, 4, 6]
    again = cl.kmeans_runs(df.repartition(7), [runs[2]], rounds=40, tol=0.0)[0]
    assert np.allclose(again.points, fits[2].points) and abs(again.cost - fits[2].cost) < 1e-6
    for f in fits:  # at rest, and its cost is the cost of its centres
        assert abs(lloyd(x, f.points, 5) - f.cost) < 1e-4 * f.cost
        pred = f.transform(df).orderBy("i").toPandas()["prediction"].to_numpy()
        assert (pred == ((x[:, None] - f.points[None]) ** 2).sum(2).argmin(1)).all()
    best = cl.best_kmeans(df, 4)
    assert best.cost <= 1.001 * KMeans(k=4, seed=7).fit(df).summary.trainingCost
    for f, s in zip(fits, cl.silhouettes(df, fits)):
        assert abs(s - ClusteringEvaluator().evaluate(f.transform(df))) < 1e-9
    same = df.where("i >= 600")
    assert [len(f.points) for f in cl.kmeans_runs(same, [(3, 1)])] == [1] and cl.silhouettes(same, cl.kmeans_runs(same, [(3, 1)])) == [0.0]
    assert cl.kmeans_runs(df.limit(0), [(3, 1)])[0].cost == 0.0


def test_level_vectors_are_the_dense_columns(spark, small):
    rows = profile(spark, small).select("user_id", "plan_tier")
    levels = st.LevelVectors(rows, "plan_tier")
    dense = st.one_hot(rows, "plan_tier", "t").select("user_id", *[f"t_{v}" for v in levels.names]).toPandas().set_index("user_id")
    sparse = {r["user_id"]: r["v"].toArray().tolist() for r in levels.transform(rows, "v").collect()}
    assert sorted(levels.names) == sorted(levels.levels)[1:] and len(levels.names) == 4
    assert sparse == {u: [float(x) for x in dense.loc[u]] for u in sparse} and len(sparse) == len(dense)
    odd = spark.createDataFrame([(1, None), (2, "never seen"), (3, levels.names[0])], "user_id int, plan_tier string")
    got = levels.transform(odd, "v")
    assert got.columns == ["user_id", "plan_tier", "v"]
    assert {r["user_id"]: r["v"].numNonzeros() for r in got.collect()} == {1: 0, 2: 0, 3: 1}
    for few in (rows.limit(0), rows.where("plan_tier = 'BUILDING'").limit(3), odd.where("user_id = 1")):
        one = st.LevelVectors(few, "plan_tier")
        assert one.names == [] and {r["v"].size for r in one.transform(odd, "v").collect()} == {0}
    with pytest.raises(ValueError):
        st.one_hot(spark.range(3000), "id", "l")


def test_a_feature_of_many_levels(spark):
    many = spark.range(200_000).select(F.col("id").alias("user_id"), F.concat(F.lit("l"), "id").alias("plan"), (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 2 == 0).alias("churned"))
    frame, names = ml.feature_frame(many, ["x"], "plan")
    sizes = frame.select(F.expr("user_id")).count(), frame.where("split = 'train'").count()
    assert sizes[0] == 200_000 and len(names) == sizes[1]  # every train row is its own level, the base has no entry
    assert {r["features"].size for r in frame.limit(20).collect()} == {len(names)}


def test_fits_use_all_cores(spark):
    few = spark.range(30_000).coalesce(1).withColumn("split", F.lit("train")).withColumn("label", F.col("id") * 1.0)
    frame = few.withColumn("features", ml.array_to_vector(F.array("label")))
    seen = {}

    class Estimator:
        def fit(self, train):
            seen["tasks"], seen["rows"] = train.select(F.spark_partition_id()).distinct().count(), train.distinct().count()

    ml.fit_on_train(frame, Estimator())
    assert seen == {"tasks": min(3, spark.sparkContext.defaultParallelism), "rows": 30_000}
    ml.fit_on_train(frame.limit(2_000), Estimator())
    assert seen == {"tasks": 1, "rows": 2_000}
