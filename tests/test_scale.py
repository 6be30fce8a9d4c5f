"""The scale helpers against brute force, with hot keys and forced brackets."""

import json
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from saltmarsh.functions import scale as sc
from saltmarsh.sources import tables


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    key = np.where(rng.random(6000) < 0.4, 0, rng.integers(1, 20, 6000))
    pdf = pd.DataFrame({"k": key, "t": np.arange(6000), "v": np.round(rng.gamma(2.0, 10.0, 6000), 1)})
    return pdf, spark.createDataFrame(pdf.sample(frac=1, random_state=1)).repartition(6).cache()


@pytest.mark.parametrize("buckets", [1 << 16, 5])
def test_quantiles_match_numpy(skewed, buckets):
    pdf, df = skewed
    probs = {"a": 0.05, "b": 0.5, "c": 0.9, "d": 0.99}
    row = sc.quantiles(df, "v", probs, buckets=buckets).first()
    for n, p in probs.items():
        assert row[n] == pytest.approx(np.quantile(pdf.v, p), abs=1e-9)
    for r in sc.quantiles(df, "v", probs, ["k"], buckets=buckets).collect():
        v = pdf[pdf.k == r["k"]].v
        assert r["n"] == len(v)
        for n, p in probs.items():
            assert r[n] == pytest.approx(np.quantile(v, p), abs=1e-9)


def test_index_quantile(skewed):
    pdf, df = skewed
    got = sc.quantiles(df, "v", {"q": 0.95}, index=True).first()["q"]
    assert got == sorted(pdf.v)[int(len(pdf) * 0.95)]


@pytest.mark.parametrize("values", [[3.0], [1.0, 2.0], [5.0] * 7, [1.0, 1.0, 9.0]])
def test_tiny_groups(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = sc.quantiles(df, "v", {"q1": 0.25, "q9": 0.9}).first()
    assert row["q1"] == pytest.approx(np.quantile(values, 0.25)) and row["q9"] == pytest.approx(np.quantile(values, 0.9))


def test_quantiles_of_every_size_and_null_keys(spark):
    rng = np.random.default_rng(11)
    v = np.concatenate([rng.normal(0, 1, 300) * 10.0 ** rng.integers(-300, 300, 300), [0.0, -0.0, 5e-324, -5e-324, np.inf, -np.inf], np.full(50, 7.5), 1 + rng.random(200) * 1e-15])
    key = [None if i % 3 == 0 else int(i % 3) for i in range(len(v))]
    df = spark.createDataFrame(list(zip(key, ["x"] * len(v), v.tolist())) + [(None, "x", None), (9, "x", None)], "k int, j string, v double").repartition(3)
    probs = {f"p{i}": i / 10 for i in range(11)}
    got = {r["k"]: r for r in sc.quantiles(df, "v", probs, ["k", "j"], index=True).collect()}
    assert set(got) == {None, 1, 2}
    for k, r in got.items():
        mine = sorted(x for x, y in zip(v, key) if y == k)
        assert [r[n] for n in probs] == [mine[min(int(len(mine) * p), len(mine) - 1)] for p in probs.values()]


def test_quantile_plans_order_no_rows(skewed):
    plan = sc.quantiles(skewed[1], "v", {"a": 0.5}, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_quantiles_of_nothing(spark):
    assert sc.quantiles(spark.createDataFrame([], "v double"), "v", {"q": 0.5}).first()["q"] is None


def test_running_and_previous(skewed):
    pdf, df = skewed
    got = sc.running(df, ["k"], ["t"], F.floor(F.col("t") / 500), total=F.col("t")).toPandas().sort_values("t")
    want = pdf.sort_values("t").groupby("k")["t"].cumsum()
    assert (got.set_index("t")["total"].to_numpy() == want.to_numpy()).all()
    prev = sc.previous(df, ["k"], ["t"], F.floor(F.col("t") / 500), ["v"]).toPandas().sort_values("t")
    assert np.array_equal(prev["prev_v"].to_numpy(), pdf.sort_values("t").groupby("k")["v"].shift().to_numpy(), equal_nan=True)


def test_top_and_newest(skewed):
    pdf, df = skewed
    top = sc.top_per_key(df, ["k"], [F.col("v").desc(), "t"], 3).toPandas()
    want = pdf.sort_values(["v", "t"], ascending=[False, True]).groupby("k").head(3)
    assert set(top.t) == set(want.t)
    new = sc.newest(df, ["k"], F.col("t"), ["v"]).toPandas().set_index("k")["v"]
    assert new.to_dict() == pdf.loc[pdf.groupby("k").t.idxmax()].set_index("k")["v"].to_dict()


def test_auc_counts_ties_half(spark):
    from saltmarsh.operators.stats import roc_auc

    rng = np.random.default_rng(3)
    s, y = np.round(rng.random(400), 2), rng.integers(0, 2, 400)
    pairs = [(a > b) + 0.5 * (a == b) for a in s[y == 1] for b in s[y == 0]]
    df = spark.createDataFrame(pd.DataFrame({"s": s, "y": y}))
    assert roc_auc(df, "y", "s").first()["auc"] == pytest.approx(np.mean(pairs))
    moved = df.withColumn("s", F.pow("s", 3))  # a monotone change leaves it as it is
    assert roc_auc(moved, "y", "s").first()["auc"] == pytest.approx(np.mean(pairs))


def test_json_array_is_read_by_many_tasks(spark, tmp_path):
    rng = random.Random(3)
    odd = ["", "}", "{", '"', "\\", '\\"}', "[{", "]}", "\n", "\u00e9\U0001f600", "a,b", '{"k": "}"}']

    def word():
        return "".join(rng.choice(odd) for _ in range(rng.choice([0, 1, 3, 9])))

    rows = [{"id": k, "text": word(), "deep": {"a": [{"b": word()}, {"b": None}], "c": {}}} for k in range(400)]
    (tmp_path / "a.json").write_text(json.dumps(rows[:300], indent=2), encoding="utf-8")
    (tmp_path / "b.json").write_text(json.dumps(rows[300:], ensure_ascii=False) + "\n[]\n", encoding="utf-8")
    (tmp_path / "c.json").write_text("[]")
    (tmp_path / "d.json").write_text("")
    (tmp_path / "e.json").write_text('[{"id": 900, "text": "x", "deep": {"c": {}}}, {"id": 901, "text": "open')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 10
        got = tables.read_json_array(spark, str(tmp_path), "id long, text string, deep struct<a: array<struct<b: string>>>").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = {r["id"]: (r["text"], [x["b"] for x in r["deep"]["a"]]) for r in rows} | {900: ("x", None)}
    assert len(got) == 401
    assert {r["id"]: (r["text"], r["deep"]["a"] and [x["b"] for x in r["deep"]["a"]]) for r in got} == want
