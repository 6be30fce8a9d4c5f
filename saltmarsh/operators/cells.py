"""A cell index for many vector queries: coarse centres, probed cells, exact scores inside them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scale import top_per_key
from ..session import cut_lineage
from .clusters import kmeans_runs
from .models import SEED

BLOCK = 4096  # vectors, and queries, on either side of one product
SAMPLE = 64  # vectors per cell that the centres are fitted on


@dataclass(frozen=True)
class CellIndex:
    """Unit centres, one row per cell; every vector with its cell and block; vectors and blocks per cell."""

    centres: np.ndarray
    rows: DataFrame
    cells: DataFrame


def _doubles(vector: Column) -> Column:
    return F.transform(vector, lambda x: x.cast("double"))


def _usable(vector: str) -> Column:
    """Neither null nor empty, and every component finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~odd


def _matrix(batch, column: int) -> np.ndarray:
    """The vectors of a batch at length one; zero vectors stay zero."""
    x = batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def _nearest(df: DataFrame, centres: np.ndarray, probes: int) -> DataFrame:
    """Rows (id, v), at length one, once for each of their ``probes`` nearest cells."""
    shared = df.sparkSession.sparkContext.broadcast(centres)

    def run(batches):
        c = shared.value
        step = max(1, min(BLOCK, (1 << 22) // (probes * c.shape[1])))  # numbers that leave at a time
        for whole in batches:
            for a in range(0, len(whole), step):
                batch = whole.slice(a, step)
                x = _matrix(batch, 1)
                near = np.argsort(-np.round(x @ c.T, 12), axis=1, kind="stable")[:, :probes]
                at = np.repeat(np.arange(len(x)), near.shape[1])
                place = np.arange(0, len(at) * x.shape[1] + 1, x.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), pa.ListArray.from_arrays(pa.array(place), pa.array(x[at].ravel())), pa.array(near.ravel().astype(np.int32))],
                    ["id", "v", "cell"],
                )

    return df.mapInArrow(run, "id bigint, v array<double>, cell int")


def build_cells(vectors: DataFrame, cells: int, id_col: str = "vec_id", vector: str = "embedding") -> CellIndex:
    """Index of all ``vectors`` in ``cells`` cells by cosine.

    Only the centres are fitted on a sample: about ``SAMPLE`` vectors per cell, chosen by a hash of the id; every vector is indexed.
    A cell with more than ``BLOCK`` vectors is kept in blocks, so no cell has to fit one task. Rows with a null id
    or a null, empty or non-finite vector are left out; zero vectors score 0. Vectors are of one length.
    """
    rows = vectors.where(F.col(id_col).isNotNull() & _usable(vector)).select(F.col(id_col).cast("bigint").alias("id"), _doubles(F.col(vector)).alias("v"))
    rows = cut_lineage(rows)
    count = rows.count()
    if not count:
        empty = rows.sparkSession.createDataFrame([], "cell int, n bigint, blocks int")
        return CellIndex(np.zeros((0, 0)), rows.select("id", "v", F.lit(0).alias("cell"), F.lit(0).alias("block")), empty)
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 32))
    share = min(1.0, 2 * SAMPLE * cells / count)  # twice, for chance; about half is cut off again
    sample = rows.where(draw <= int(share * (1 << 32))).orderBy(draw, "id").limit(SAMPLE * cells)
    flat = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    sample = cut_lineage(sample.select("id", array_to_vector(F.transform("v", lambda x: F.coalesce(F.try_divide(x, flat), F.lit(0.0)))).alias("features")))
    first = np.array([r["features"].toArray() for r in sample.orderBy(F.xxhash64("id", F.lit(SEED))).limit(cells).collect()])
    centres = kmeans_runs(sample, [(len(first), SEED)], rounds=12, starting=[first])[0].points
    norm = np.linalg.norm(centres, axis=1, keepdims=True)
    centres = np.divide(centres, norm, out=np.zeros_like(centres), where=norm > 0)
    placed = cut_lineage(_nearest(rows, centres, 1))
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n"))
    sizes = cut_lineage(sizes.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")))  # at most ``cells`` rows
    blocked = placed.join(F.broadcast(sizes), "cell").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    return CellIndex(centres, cut_lineage(blocked.select("id", "v", "cell", "block")), sizes)


def _best(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        kind = [pa.int64(), pa.int64(), pa.float64()]
        if not len(left) or not len(right):
            return pa.table([pa.array([], t) for t in kind], ["query_id", "id", "score"])
        x, q = (t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(t), -1) for t in (left, right))
        ids, qids = left.column("id").to_numpy(), right.column("query_id").to_numpy()
        out = []
        for a in range(0, len(q), 512):
            score = np.round(q[a : a + 512] @ x.T, 9)
            order = np.lexsort((np.broadcast_to(ids, score.shape), -score), axis=1)[:, :k]
            out.append((np.repeat(qids[a : a + 512], order.shape[1]), ids[order].ravel(), np.take_along_axis(score, order, 1).ravel()))
        return pa.table([pa.array(np.concatenate([o[i] for o in out]), kind[i]) for i in range(3)], ["query_id", "id", "score"])

    return run


def search_cells(index: CellIndex, queries: DataFrame, k: int, probes: int) -> DataFrame:
    """(query_id, id, score, rank): the ``k`` best vectors by cosine among the ``probes`` nearest cells of every query.

    Scores are exact; what may be missing are neighbours in cells that were not probed (``recall`` measures it;
    with all cells probed the result is exact). Queries are never collected: each goes to the blocks of
    its cells, and the queries of a cell are dealt into slices of about ``BLOCK``, so both sides of a product are bounded. ``k`` rows per query
    and block are shuffled. Query ids are distinct; queries with a null id or a null, empty or non-finite vector give no rows.
    """
    rows = queries.where(F.col("query_id").isNotNull() & _usable("query")).select(F.col("query_id").cast("bigint").alias("id"), _doubles(F.col("query")).alias("v"))
    if not len(index.centres):
        return rows.sparkSession.createDataFrame([], "query_id bigint, id bigint, score double, rank int")
    asked = cut_lineage(_nearest(rows, index.centres, probes).withColumnRenamed("id", "query_id"))
    slices = asked.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("slices"))
    slices = cut_lineage(slices)  # at most as many rows as cells
    dealt = asked.join(F.broadcast(index.cells), "cell").join(F.broadcast(slices), "cell")
    dealt = dealt.withColumn("slice", F.pmod(F.xxhash64("query_id"), "slices").cast("int"))
    dealt = dealt.select("query_id", "v", "cell", "slice", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    held = index.rows.join(F.broadcast(slices), "cell").select("id", "v", "cell", "block", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    job = ["cell", "block", "slice"]
    found = held.groupBy(*job).cogroup(dealt.groupBy(*job)).applyInArrow(_best(k), "query_id bigint, id bigint, score double")
    return top_per_key(found, ["query_id"], [F.col("score").desc(), F.col("id")], k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: queries and the mean share of each query's exact results that were found."""
    hit = found.select("query_id", "id", F.lit(1).alias("hit"))
    per = exact.select("query_id", "id").join(hit, ["query_id", "id"], "left").groupBy("query_id").agg((F.count("hit") / F.count("*")).alias("share"))
    return per.agg(F.count("*").alias("queries"), F.avg("share").alias("recall"))
