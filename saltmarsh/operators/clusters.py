"""Segmentation and dimension reduction."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scale import quantile_scalars
from ..session import cut_lineage
from .models import SEED, held
from .stats import standard_scale
from .windows import cumulative_share


def scaled_vectors(df: DataFrame, columns: list[str]) -> DataFrame:
    rows = standard_scale(df, columns)
    return cut_lineage(VectorAssembler(inputCols=[f"{c}_z" for c in columns], outputCol="features").transform(rows))


@dataclass(frozen=True)
class Centres:
    """A k-means fit: centres, one row each, and the sum of squared distances to them."""

    points: np.ndarray
    cost: float

    def transform(self, rows: DataFrame, features: str = "features") -> DataFrame:
        """``rows`` with the number of the nearest centre (ties: the smaller) as ``prediction``."""
        x = vector_to_array(features)
        square = [F.struct(reduce(lambda u, v: u + v, [F.pow(F.get("_x", i) - float(m), 2) for i, m in enumerate(c)]).alias("d"), F.lit(j).alias("j")) for j, c in enumerate(self.points)]
        return rows.withColumn("_x", x).withColumn("prediction", F.array_min(F.array(*square))["j"]).drop("_x")


PIECE = 4096  # points multiplied with all centres at a time


def _pieces(batches):
    """Points of Arrow batches (x, h) as matrices of bounded size, with their hashes."""
    for batch in batches:
        n = len(batch)
        if n:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            h = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            for a in range(0, n, PIECE):
                yield x[a : a + PIECE], h[a : a + PIECE]


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (centres * centres).sum(1)[None, :] - 2 * (x @ centres.T), 0)


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    """A uniform number in (0, 1) for each hash and salt."""
    z = h + np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2**53 + 2**-54


def _draws(centres: dict[int, np.ndarray], salts: dict[int, int]):
    """Per run the point with the least exponential draw at the rate of its squared distance to the run's centres."""

    def run(batches):
        best: dict[int, tuple] = {}
        for x, h in _pieces(batches):
            for r, c in centres.items():
                rate = _squares(x, c).min(1) if len(c) else np.ones(len(x))
                wait = np.divide(-np.log(_mixed(h, salts[r])), rate, out=np.full(len(x), np.inf), where=rate > 1e-12)
                k = int(wait.argmin())
                if np.isfinite(wait[k]) and (r not in best or wait[k] < best[r][0]):
                    best[r] = (float(wait[k]), x[k].tolist())
        rows = [(r, w, v) for r, (w, v) in best.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([t[0] for t in rows], pa.int32()), pa.array([t[1] for t in rows], pa.float64()), pa.array([t[2] for t in rows], pa.list_(pa.float64()))], ["run", "wait", "x"]
        )

    return run


COUNT, COST, NORM = -1, -2, -3  # what is added up beside the coordinates


def _sums(centres: dict[int, np.ndarray]):
    """Per run, cluster and coordinate the sum; and the number of points, their cost and their squared norms."""

    def run(batches):
        total = {r: np.zeros((len(c), c.shape[1] + 3)) for r, c in centres.items()}
        order = list(centres)
        every = np.vstack([centres[r] for r in order])
        at = np.append(0, np.cumsum([len(centres[r]) for r in order]))
        for x, _ in _pieces(batches):
            far = _squares(x, every)
            norm = (x * x).sum(1)
            for k, r in enumerate(order):
                part = far[:, at[k] : at[k + 1]]
                near = part.argmin(1)
                own = np.column_stack([x, norm, part[np.arange(len(x)), near], np.ones(len(x))])
                member = np.zeros((part.shape[1], len(x)))
                member[near, np.arange(len(x))] = 1
                total[r] += member @ own
        for r, t in total.items():
            d = t.shape[1] - 3
            j, i = np.divmod(np.arange(t.size), t.shape[1])
            i = np.where(i < d, i, i - t.shape[1])  # norms, cost and count are -3, -2, -1
            yield pa.RecordBatch.from_arrays([pa.array(np.full(t.size, r, np.int32)), pa.array(j.astype(np.int32)), pa.array(i.astype(np.int32)), pa.array(t.ravel())], ["run", "j", "i", "s"])

    return run


def _added(x: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """One scan: the sums of every run, a row per cluster: coordinates, then norms, cost and count."""
    rows = x.mapInArrow(_sums(centres), "run int, j int, i int, s double").groupBy("run", "j", "i").agg(F.sum("s").alias("s")).collect()
    out = {r: np.zeros((len(c), c.shape[1] + 3)) for r, c in centres.items()}
    for r in rows:  # runs * k * (columns + 3) numbers
        out[r["run"]][r["j"], r["i"]] = r["s"]
    return out


def _as_points(rows: DataFrame, features: str) -> DataFrame:
    x = rows.select(vector_to_array(features).alias("x"))
    return x.select("x", F.xxhash64("x").alias("h"))


def kmeans_runs(rows: DataFrame, runs: list[tuple[int, int]], features: str = "features", rounds: int = 30, tol: float = 1e-4, starting: list[np.ndarray] | None = None) -> list[Centres]:
    """k-means fits for every (k, seed) of ``runs``, all advanced in the same scans of the points.

    Starting centres are drawn one at a time with probability in proportion to the squared distance to those
    a run already has; the draw is a hash of the point, the seed and the step, so it does not depend on partitions (equal
    points draw as one). Then all runs that still move take a round together. Runs stop when no centre moves more than
    ``tol``, or after ``rounds``. ``starting`` gives k centres for each run in place of the drawn ones. A cluster without points keeps its centre; a run gets fewer than k centres if there are fewer distinct
    points. Only centres and sums, runs * k * columns numbers, come to the driver. Vectors are dense, finite and not null; no rows give no centres.
    """
    points = cut_lineage(_as_points(rows, features))
    first = points.first()
    if first is None:
        return [Centres(np.zeros((0, 0)), 0.0) for _ in runs]
    dims = len(first["x"])
    centres = dict(enumerate(starting)) if starting else {r: np.zeros((0, dims)) for r in range(len(runs))}
    for step in range(max(k for k, _ in runs)):
        short = {r: centres[r] for r, (k, _) in enumerate(runs) if len(centres[r]) == step < k}
        if not short:
            break
        salts = {r: runs[r][1] * 1_000_003 + step for r in short}
        drawn = points.mapInArrow(_draws(short, salts), "run int, wait double, x array<double>").groupBy("run").agg(F.min(F.struct("wait", "x")).alias("b"))
        for row in drawn.collect():  # one point per run
            centres[row["run"]] = np.vstack([centres[row["run"]], row["b"]["x"]])
    moving, cost = set(centres), {}
    for turn in range(rounds + 1):
        sums = _added(points, {r: centres[r] for r in sorted(moving)})
        for r in sorted(moving):
            cost[r] = float(sums[r][:, COST].sum())
            n = sums[r][:, COUNT][:, None]
            mean = np.where(n > 0, np.round(sums[r][:, :dims] / np.maximum(n, 1), 9), centres[r])
            if turn == rounds or ((mean - centres[r]) ** 2).sum(1).max() <= tol * tol:
                moving.discard(r)
            else:
                centres[r] = mean
        if not moving:
            break
    return [Centres(centres[r], cost[r]) for r in range(len(runs))]


def silhouettes(rows: DataFrame, fits: list[Centres], features: str = "features") -> list[float]:
    """Mean silhouette on squared distances of every fit, in two scans for all; 0 with fewer than two clusters in use."""
    points = _as_points(rows, features)
    centres = {r: f.points for r, f in enumerate(fits) if len(f.points)}
    if not centres:
        return [0.0] * len(fits)
    sums = _added(points, centres)

    def run(batches):
        total = dict.fromkeys(centres, 0.0)
        for x, _ in _pieces(batches):
            norm = (x * x).sum(1)[:, None]
            for r, c in centres.items():
                t = sums[r]
                n = t[:, COUNT]
                if (n > 0).sum() < 2:
                    continue
                near = _squares(x, c).argmin(1)
                mean = norm + (t[:, NORM] / np.maximum(n, 1))[None, :] - 2 * (x @ (t[:, : x.shape[1]] / np.maximum(n, 1)[:, None]).T)
                mean = np.where(n[None, :] > 0, np.maximum(mean, 0), np.inf)
                at = np.arange(len(x))
                own = mean[at, near] * n[near] / np.maximum(n[near] - 1, 1)
                mean[at, near] = np.inf
                other = mean.min(1)
                most = np.maximum(own, other)
                s = np.divide(other - own, most, out=np.zeros(len(x)), where=most > 0)
                total[r] += float(s[n[near] > 1].sum())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.float64())], ["run", "s"])

    found = {r["run"]: r["s"] for r in points.mapInArrow(run, "run int, s double").groupBy("run").agg(F.sum("s").alias("s")).collect()}
    return [found[r] / sums[r][:, COUNT].sum() if r in found and sums[r][:, COUNT].sum() else 0.0 for r in range(len(fits))]


STARTS = 10


def best_kmeans(rows: DataFrame, k: int, seeds: int = STARTS) -> Centres:
    """The fit of least cost from several starts, made together."""
    return min(kmeans_runs(rows, [(k, SEED + i) for i in range(seeds)]), key=lambda f: f.cost)


def silhouette(rows: DataFrame, prediction: str = "prediction") -> float:
    """Mean silhouette on squared distances; 0 with fewer than two clusters."""
    if rows.select(prediction).distinct().limit(2).count() < 2:
        return 0.0
    return ClusteringEvaluator(predictionCol=prediction).evaluate(rows)


def k_selection(rows: DataFrame, ks: range, starts: int = STARTS) -> DataFrame:
    """Inertia and silhouette of the best start per k, and the k with the best silhouette; all k and starts advance together."""
    runs = [(k, SEED + i) for k in ks for i in range(starts)]
    fits = kmeans_runs(rows, runs, rounds=20)
    best = [min(fits[i : i + starts], key=lambda f: f.cost) for i in range(0, len(fits), starts)]
    out = [(k, f.cost, float(s)) for k, f, s in zip(ks, best, silhouettes(rows, best))]
    top = max(out, key=lambda r: r[2])[0]
    df = rows.sparkSession.createDataFrame(out, "k int, inertia double, silhouette double")
    return df.withColumn("is_best", F.col("k") == top)


def bisecting(rows: DataFrame, k: int):
    with held(rows.select("features")) as x:
        return BisectingKMeans(k=k, seed=SEED).fit(x)


def kmeans_by_group(df: DataFrame, group: str, columns: list[str], k: int, tol: float = 1e-4, rounds: int = 20) -> DataFrame:
    """k-means on columns scaled within their group, inside every group at once, until centres rest.

    A group starts with its mean as the one centre. A round gives points to the nearest centre (ties: the smaller number),
    moves centres to the means and, while there are fewer than ``k``, sets one more on the point that is farthest from its
    own; this also refills a cluster that lost its points. So a group ends with ``k`` clusters, or with one for each distinct
    point if those are fewer (points closer than 1e-6 count as one). Centres are one small row per group, points are
    stored once and never gathered. A group rests, and takes no part in further rounds, when the squared moves of its centres
    sum to ``tol`` or less; it keeps the centres under which every cluster had points. NULL is a group of its own; NULL
    values stand at the mean. After ``rounds`` rounds the centres stand as they are.
    """
    coords = [f"_{c}" for c in columns]
    keyed = df.withColumn("_g", F.struct(group))
    stats = keyed.groupBy("_g").agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.coalesce(F.stddev_pop(c), F.lit(0.0)).alias(f"s_{c}") for c in columns])
    scaled = [F.coalesce(F.try_divide(F.col(c) - F.col(f"m_{c}"), F.col(f"s_{c}")), F.lit(0.0)).alias(f"_{c}") for c in columns]
    rows = cut_lineage(keyed.join(stats, "_g").select("_g", *[keyed[c] for c in df.columns], *scaled))

    def assign(points, centres):
        def cost(c):
            return F.round(reduce(lambda a, b: a + b, [F.pow(F.col(x) - c[x], 2) for x in coords]), 12)

        near = F.array_min(F.transform("centres", lambda c: F.struct(cost(c).alias("d"), c["j"].alias("j"))))
        return points.join(centres, "_g").withColumn("_near", near)

    def entry(j, values):
        return F.struct(j.cast("int").alias("j"), *[F.round(v, 9).alias(x) for x, v in zip(coords, values)])

    first = F.array(entry(F.lit(0), [F.lit(0.0)] * len(coords)))
    state = cut_lineage(rows.select("_g").distinct().select("_g", first.alias("centres"), F.lit(True).alias("moved")))
    for _ in range(rounds):
        near = assign(rows.select("_g", *coords), state.where("moved").select("_g", "centres"))
        per = near.groupBy("_g", F.col("_near.j").alias("j")).agg(
            F.first("centres").alias("old"), *[F.avg(x).alias(x) for x in coords], F.max(F.struct(F.col("_near.d").alias("d"), *coords)).alias("far")
        )
        new = per.groupBy("_g").agg(F.first("old").alias("old"), F.collect_list(entry(F.col("j"), [F.col(x) for x in coords])).alias("c"), F.max("far").alias("far"))
        free = F.array_min(F.array_except(F.sequence(F.lit(0), F.lit(k - 1)), F.col("c.j")))
        grown = F.when((F.size("c") < k) & (F.col("far.d") > 0), F.array_append("c", entry(free, [F.col(f"far.{x}") for x in coords]))).otherwise(F.col("c"))
        new = new.select("_g", F.array_sort(grown).alias("c"), "old")
        shift = F.aggregate(F.zip_with("c", "old", lambda a, b: reduce(lambda u, v: u + v, [F.pow(a[x] - b[x], 2) for x in coords])), F.lit(0.0), lambda u, v: u + v)
        moved = (F.col("c.j") != F.col("old.j")) | (shift > tol)
        new = new.withColumn("moved", moved).select("_g", F.when(F.col("moved"), F.col("c")).otherwise(F.col("old")).alias("centres"), "moved")
        state = cut_lineage(new.unionByName(state.where("NOT moved")))
        if state.where("moved").isEmpty():
            break
    return assign(rows, state.select("_g", "centres")).select(*df.columns, F.col("_near.j").alias("cluster"))


# ---- connected groups


def connected_groups(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Smallest reachable node as ``group``: labels pass along links and then jump to their own label."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = cut_lineage(both)
    labels = cut_lineage(nodes.select("node", F.col("node").alias("group")))
    while True:
        heard = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("group").alias("heard"))
        least = labels.join(heard, "node", "left").select("node", F.col("group").alias("was"), F.least("group", F.coalesce("heard", "group")).alias("group"))
        least = cut_lineage(least)
        jump = least.select(F.col("node").alias("group"), F.col("group").alias("up"))
        stepped = cut_lineage(least.join(jump, "group").select("node", "was", F.least("group", "up").alias("group")))
        labels = stepped.select("node", "group")
        if stepped.where(~F.col("was").eqNullSafe(F.col("group"))).isEmpty():
            return labels


# ---- principal components


def fit_pca(rows: DataFrame, k: int):
    with held(rows.select("features")) as x:
        return PCA(k=k, inputCol="features", outputCol="scores").fit(x)


def explained(rows: DataFrame, d: int, target: float = 0.95) -> DataFrame:
    """Variance share per component, running share, and how many reach ``target``."""
    model = fit_pca(rows, d)
    parts = rows.sparkSession.createDataFrame([(i + 1, float(v)) for i, v in enumerate(model.explainedVariance)], "component int, variance double")
    return cumulative_share(parts, "component", "variance", target)


def scree_elbow(shares: DataFrame) -> DataFrame:
    """Component after which the marginal share drops most; one row per component bounds the order."""
    from pyspark.sql import Window as W

    w = W.orderBy("rank")
    drops = shares.select("component", "rank", "share", (F.lag("share").over(w) - F.col("share")).alias("drop"))
    elbow = F.max_by(F.col("component"), F.col("drop")).over(W.orderBy("rank").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return drops.withColumn("is_elbow", F.col("component") == elbow)


def loadings(model, columns: list[str], spark) -> DataFrame:
    m = model.pc.toArray()
    rows = [(columns[i], j + 1, float(m[i, j])) for i in range(m.shape[0]) for j in range(m.shape[1])]
    return spark.createDataFrame(rows, "feature string, component int, loading double")


def reconstruct(rows: DataFrame, model, d: int) -> DataFrame:
    """Squared reconstruction error per row from the kept components; the component matrix is d by k numbers."""
    m = model.pc.toArray()
    scored = model.transform(rows).withColumn("_x", vector_to_array("features")).withColumn("_s", vector_to_array("scores"))
    back = [reduce(lambda a, b: a + b, [F.col("_s")[j] * float(m[i, j]) for j in range(m.shape[1])]) for i in range(d)]
    err = reduce(lambda a, b: a + b, [F.pow(F.col("_x")[i] - back[i], 2) for i in range(d)]) / d
    return scored.withColumn("error", err).drop("_x", "_s")


def anomalies(errors: DataFrame, p: float = 0.95) -> DataFrame:
    limit = quantile_scalars(errors, "error", {"q": p})["q"]
    return errors.withColumn("is_anomaly", F.col("error") > limit)
