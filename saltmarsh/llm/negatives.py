"""Hard negatives: scores of an anchor are bounded through its parent in a spanning tree of the anchors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saltmarsh.functions.scale import top_per_key
from saltmarsh.session import cut_lineage

ANCHORS = 512  # anchors of one spanning tree
ROWS = 4096  # rows that are scored together
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # per cent of the positive's score
_EXACT = float(1 << 53)


def _matrix(vectors: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of whole numbers, floor(256 x) in double precision; short ones end in zeros."""
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    if isinstance(flat, pa.ChunkedArray):
        flat = pa.concat_arrays(flat.chunks)
    size = flat.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = np.floor(flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * 256.0)
    out = np.zeros((len(size), width))
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)] = values
    return out


def spanning_tree(x: np.ndarray) -> tuple[list[int], list[int], list[float]]:
    """A least spanning tree of the rows: an order in which parents come first, each one's parent (its place in that
    order, -1 for the root) and the length of the edge."""
    n = len(x)
    near, by, left = np.full(n, np.inf), np.full(n, -1), np.ones(n, bool)
    order, parent, edge, place = [], [], [], {}
    k = 0
    for _ in range(n):
        left[k] = False
        place[k] = len(order)
        order.append(k)
        parent.append(place[int(by[k])] if by[k] >= 0 else -1)
        edge.append(float(near[k]) if by[k] >= 0 else 0.0)
        if not left.any():
            break
        d = np.sqrt(((x - x[k]) ** 2).sum(axis=1))
        closer = left & (d < near)
        near[closer], by[closer] = d[closer], k
        k = int(np.argmin(np.where(left, near, np.inf)))
    return order, parent, edge


def _span(width: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        order, parent, edge = spanning_tree(_matrix(table.column("vec"), width))
        table = table.take(pa.array(order, pa.int64()))
        for name, values in (("place", pa.array(range(len(order)), pa.int32())), ("parent", pa.array(parent, pa.int32())), ("edge", pa.array(edge, pa.float64()))):
            table = table.append_column(name, values)
        return table

    return run


class Bounds:
    """Scores of a chunk of rows under the anchors of a tree, from the root down.

    Under the root all rows are scored. A child's score of a row is its parent's, plus or minus the length of the
    edge times the norm of the row; a row whose score was computed goes on from that, another from its bounds.
    """

    def __init__(self, rows: np.ndarray, anchors: np.ndarray, parents: list[int], edges: list[float]):
        self.rows, self.anchors, self.parents, self.edges = rows, anchors, parents, edges
        self.norm = np.sqrt((rows**2).sum(axis=1))
        most = (np.abs(rows).max(initial=0.0) * np.abs(anchors).max(initial=0.0)) * max(rows.shape[1], 1)
        self.exact = most < _EXACT
        self.waiting = np.bincount(np.array([p for p in parents if p >= 0], np.int64), minlength=len(parents))
        self.low, self.high = {}, {}
        self.scored = 0

    def score(self, k: int, which: np.ndarray) -> np.ndarray:
        """Exact scores of the rows ``which``; they become the bounds of anchor k."""
        self.scored += len(which)
        if self.exact:
            s = self.rows[which] @ self.anchors[k]
        else:
            a = [int(v) for v in self.anchors[k]]
            s = np.array([sum(int(p) * q for p, q in zip(self.rows[i], a)) for i in which], dtype=object)
        self.low[k][which] = self.high[k][which] = s.astype(np.float64)
        return s

    def enter(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of all rows under anchor k."""
        p = self.parents[k]
        if p < 0:
            self.low[k], self.high[k] = np.zeros(len(self.rows)), np.zeros(len(self.rows))
            self.score(k, np.arange(len(self.rows)))
        else:
            reach = self.edges[k] * self.norm * (1 + 1e-9)
            self.low[k] = self.low[p] - reach - 1e-9 * np.abs(self.low[p])
            self.high[k] = self.high[p] + reach + 1e-9 * np.abs(self.high[p])
            self.waiting[p] -= 1
            if not self.waiting[p]:
                del self.low[p], self.high[p]
        return self.low[k], self.high[k]

    def leave(self, k: int) -> None:
        if not self.waiting[k]:
            del self.low[k], self.high[k]


def _least_of(values: np.ndarray, k: int) -> float:
    """The k-th largest value, if there are more than k."""
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) > k else -np.inf


def _opened(rows: pa.Table, anchors: pa.Table, width: int):
    rows, anchors = rows.sort_by("id"), anchors.sort_by("place")
    bounds = Bounds(_matrix(rows.column("vec"), width), _matrix(anchors.column("vec"), width), anchors.column("parent").to_pylist(), anchors.column("edge").to_pylist())
    return rows.column("id").to_numpy(), rows.column("label").to_numpy(), anchors.column("id").to_pylist(), anchors.column("label").to_pylist(), anchors, bounds


def _result(names: list[str], columns: list[list]) -> pa.Table:
    return pa.table([pa.array([int(v) for v in c], pa.int64()) for c in columns], names)


def _best_positives(width: int, k: int):
    names = ["anchor_id", "positive_id", "positive_score"]

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = [[], [], []]
        if len(rows) and len(anchors):
            ids, labels, anchor_ids, anchor_labels, _, bounds = _opened(rows, anchors, width)
            for a in range(len(anchor_ids)):
                low, high = bounds.enter(a)
                mine = (labels == anchor_labels[a]) & (ids != anchor_ids[a])
                which = np.flatnonzero(mine & (high >= _least_of(low[mine], k)))
                s = bounds.score(a, which)
                best = np.argsort(-s, kind="stable")[:k]  # rows stand in order of their ids
                out[0] += [anchor_ids[a]] * len(best)
                out[1] += ids[which[best]].tolist()
                out[2] += s[best].tolist()
                bounds.leave(a)
        return _result(names, out)

    return run


def _windows(positives: list[dict], low: int, high: int) -> list[tuple[int, int, int, int]]:
    """(positive, its score, least and largest score of a negative) of each positive whose window is not empty."""
    out = []
    for p in positives or []:
        s = p["positive_score"]
        first, last = -((-low * s) // 100), (high * s) // 100
        if first <= last:
            out.append((p["positive_id"], s, first, last))
    return out


def _best_negatives(width: int, k: int, low_part: int, high_part: int):
    names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = [[], [], [], [], []]
        if len(rows) and len(anchors):
            ids, labels, anchor_ids, anchor_labels, table, bounds = _opened(rows, anchors, width)
            given = table.column("positives").to_pylist()
            for a in range(len(anchor_ids)):
                low, high = bounds.enter(a)
                other = labels != anchor_labels[a]
                wanted = _windows(given[a], low_part, high_part)
                need = np.zeros(len(ids), bool)
                for _, _, first, last in wanted:
                    inside = other & (low >= first) & (high <= last)
                    need |= other & (low <= last) & (high >= max(first, _least_of(low[inside], k)))
                which = np.flatnonzero(need)
                s = bounds.score(a, which)
                for positive, score, first, last in wanted:
                    fit = np.flatnonzero((s >= first) & (s <= last))
                    best = fit[np.argsort(-s[fit], kind="stable")[:k]]
                    out[0] += [anchor_ids[a]] * len(best)
                    out[1] += [positive] * len(best)
                    out[2] += [score] * len(best)
                    out[3] += ids[which[best]].tolist()
                    out[4] += s[best].tolist()
                bounds.leave(a)
        return _result(names, out)

    return run


def usable_rows(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, label, vec) of the rows that take part: no null id, label, vector or component, all components finite. Of
    rows that share an id the one of the least label, then least vector."""
    inf = float("inf")
    sound = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < inf))
    rows = df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()).where(sound)
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vec"))
    again = rows.groupBy("id").count().where("count > 1").select("id")
    if again.isEmpty():
        return rows
    again = cut_lineage(again)
    one = rows.join(again, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "vec")).alias("r")).select("id", "r.label", "r.vec")
    return rows.join(again, "id", "left_anti").unionByName(one)


def hard_negatives(
    rows: DataFrame, is_anchor, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, anchors: int = ANCHORS, chunk: int = ROWS
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) over rows of :func:`usable_rows`.

    Components become floor(256 x); a score is the integer inner product. Of each anchor (a row for which
    ``is_anchor`` holds) the ``positives`` best other rows of its label are positives, ties by smaller id; for each
    of them the ``negatives`` best rows of another label are returned whose score is between ``low`` and ``high``
    per cent of the positive's. A vector that is shorter than others is taken to go on with zeros. An anchor
    without another row of its label, or without rows in the window, gives no rows, and so does an empty table. Scores beyond
    53 bits are computed in whole numbers; one beyond a long raises an error.

    Anchors are a stated query set against all rows. They are dealt into blocks of about ``anchors``, each with its
    spanning tree, and rows into chunks of about ``chunk``; every task takes one block and one chunk, first for the
    positives and, when all of those are known, for the negatives in their windows. Only rows whose bounds
    overlap a window, and reach the best ones that are sure to be inside, are scored. A task hands on the best
    of its chunk, so what is shuffled after scoring is bounded by anchors times chunks.
    """
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("width"), F.count_if(is_anchor).alias("anchors")).first()
    width = max(size["width"] or 0, 0)
    blocks, chunks = max(1, -(-size["anchors"] // anchors)), max(1, -(-size["n"] // chunk))
    kind = dict(rows.dtypes)["vec"]
    heads = rows.where(is_anchor).withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    tree = cut_lineage(heads.groupBy("block").applyInArrow(_span(width), f"id long, label long, vec {kind}, block int, place int, parent int, edge double"))
    every = rows.withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(chunks)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def scored(tree, fn, fields):
        jobs = tree.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        return every.groupBy("block", "chunk").cogroup(jobs.groupBy("block", "chunk")).applyInArrow(fn, fields)

    first = scored(tree, _best_positives(width, positives), "anchor_id long, positive_id long, positive_score long")
    best = top_per_key(first, ["anchor_id"], [F.desc("positive_score"), "positive_id"], positives)
    given = best.groupBy(F.col("anchor_id").alias("id")).agg(F.sort_array(F.collect_list(F.struct("positive_id", "positive_score"))).alias("positives"))  # a few each
    aimed = cut_lineage(tree.join(given, "id", "left"))
    second = scored(aimed, _best_negatives(width, negatives, low, high), "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    ranked = top_per_key(second, ["anchor_id", "positive_id"], [F.desc("negative_score"), "negative_id"], negatives)
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
