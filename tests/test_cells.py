"""The cell index against exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from saltmarsh.operators import cells as ce, retrieval as rt


def vectors(spark, x, name, key):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"{key} bigint, {name} array<double>").repartition(5)


@pytest.fixture(scope="module")
def space(spark):
    rng = np.random.default_rng(11)
    means = rng.normal(size=(60, 16))
    x = means[rng.integers(0, 60, 6000)] + 0.4 * rng.normal(size=(6000, 16))
    x[:700] = x[0] + 1e-3 * rng.normal(size=(700, 16))  # one crowded place
    q = x[rng.integers(0, 6000, 900)] + 0.1 * rng.normal(size=(900, 16))
    return vectors(spark, x, "embedding", "vec_id"), vectors(spark, q, "query", "query_id")


def rows_of(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "id", "score").collect())


def test_recall_of_probed_cells(space):
    x, q = space
    index = ce.build_cells(x, 40)
    assert index.rows.count() == 6000 == index.cells.agg(F.sum("n")).first()[0]
    exact = rt.similarity_search(x, q, 10)
    some = ce.search_cells(index, q, 10, 8)
    got = ce.recall(some, exact).first()
    assert got["queries"] == 900 and 0.95 <= got["recall"] <= 1
    scores = {(r["query_id"], r["id"]): r["score"] for r in exact.collect()}
    assert all(abs(scores[r["query_id"], r["id"]] - r["score"]) < 1e-8 for r in some.collect() if (r["query_id"], r["id"]) in scores)


def test_all_cells_are_exact_in_any_blocks(space, monkeypatch):
    x, q = space
    want = [r[:3] for r in rows_of(rt.similarity_search(x, q.where("query_id < 60"), 5))]
    monkeypatch.setattr(ce, "BLOCK", 50)
    index = ce.build_cells(x, 6)
    assert index.cells.agg(F.max("blocks")).first()[0] > 10
    got = ce.search_cells(index, q.where("query_id < 60"), 5, 6)
    assert [r[:3] for r in rows_of(got)] == want


def test_odd_vectors(spark):
    odd = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (None, [1.0, 1.0]), (5, [1.0, 0.0]), (6, []), (7, [None, 1.0])]
    x = spark.createDataFrame(odd, "vec_id bigint, embedding array<double>").withColumn("cell", F.lit("clash")).withColumn("v", F.lit(1))
    index = ce.build_cells(x, 3)
    asked = x.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"), "cell")
    got = rows_of(ce.search_cells(index, asked, 2, 3))
    assert got == [(1, 1, 1, 1.0), (1, 2, 5, 1.0), (2, 1, 1, 0.0), (2, 2, 2, 0.0), (5, 1, 1, 1.0), (5, 2, 5, 1.0)]
    assert ce.search_cells(ce.build_cells(x.limit(0), 3), asked, 2, 3).count() == 0
    assert ce.search_cells(index, asked.limit(0), 2, 3).count() == 0
