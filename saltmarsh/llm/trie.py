"""A trie of conversation prefixes; subtree totals by time-forward processing."""

from __future__ import annotations

import hashlib
import heapq
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saltmarsh.llm.skew import join_keyed, running_sums, wrapped
from saltmarsh.session import cut_lineage

HEAVY = 20_000  # a node that more than one in so many (conversation, turn) rows pass through is heavy: there are at most so many
QUEUE = 200_000  # messages of a queue in memory
CHUNK = 1 << 20  # bytes of joined ids in one row
FAMILY = 5  # conversations that begin like the first of them
PREFIX = 9  # the shared prefix is shorter than this
NODE = ["depth", "k1", "k2"]
ABOVE = ["above", "u1", "u2"]


def rebuilt_turns(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, plan): the rebuilt turns (conv_id, p, mark, bytes) and a row per conversation with its number of rebuilt turns.

    Turns are ordered by ``turn``, nulls first, ties by the SHA-256 of role and text, which is also their ``mark``; a null
    role or text is empty and rows without a conv_id take no part. Conversation c gets the first h turns of c - c % 5
    and its own after its first h, h = crc32(c) % 9. A conversation of any length is numbered in ranges.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = df.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("mark"),
        F.octet_length(text).cast("long").alias("bytes"),
        F.lit(1).cast("long").alias("one"),
    )
    numbered = running_sums(rows, "conv_id", [F.col("turn").asc_nulls_first(), F.col("mark")], ["one"])
    numbered = numbered.select("conv_id", (F.col("sum_one") - 1).alias("pos"), "mark", "bytes")

    def prefix(c):
        return F.crc32(F.col(c).cast("string")) % PREFIX

    sizes = cut_lineage(numbered.groupBy("conv_id").agg(F.count("*").alias("n")))
    own = sizes.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("first"), prefix("conv_id").alias("h"))
    plan = own.join(sizes.select(F.col("conv_id").alias("first"), F.col("n").alias("there")), "first", "left")
    plan = plan.withColumn("held", F.least("h", F.coalesce("there", F.lit(0))))
    plan = cut_lineage(plan.withColumn("total", F.col("held") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    front = numbered.where(F.col("pos") < PREFIX - 1).withColumnRenamed("conv_id", "first")
    front = front.join(plan.select("conv_id", "first", "h"), "first").where("pos < h").select("conv_id", F.col("pos").alias("p"), "mark", "bytes")
    moved = plan.where("held < h AND n > h").select("conv_id", (F.col("h") - F.col("held")).alias("back"), "n")
    rest = join_keyed(numbered.where(F.col("pos") >= prefix("conv_id")), cut_lineage(moved), ["conv_id"], "n")
    rest = rest.select("conv_id", (F.col("pos") - F.coalesce("back", F.lit(0))).alias("p"), "mark", "bytes")
    return front.unionByName(rest), plan


class SpillingQueue:
    """A priority queue of (key, children, leaves, saved), smallest key first; beyond ``most`` entries sorted runs go to
    unnamed files of the task, as a sort would spill them."""

    def __init__(self, most: int = QUEUE):
        self.most, self.heap, self.heads, self.runs = most, [], [], 0

    def push(self, entry: tuple) -> None:
        heapq.heappush(self.heap, entry)
        if len(self.heap) > self.most:
            self._spill()

    def _spill(self) -> None:
        file = tempfile.TemporaryFile()
        np.array([(*e[0], *e[1:]) for e in sorted(self.heap)], dtype=np.int64).tofile(file)
        file.seek(0)
        self.heap = []
        self.runs += 1
        self._next(self.runs, self._entries(file))

    @staticmethod
    def _entries(file):
        while len(block := np.fromfile(file, dtype=np.int64, count=6 * 4096)):
            for a, b, c, *rest in block.reshape(-1, 6).tolist():
                yield ((a, b, c), *rest)
        file.close()

    def _next(self, number: int, run) -> None:
        if (entry := next(run, None)) is not None:
            heapq.heappush(self.heads, (entry, number, run))

    def take(self, key: tuple) -> tuple[int, int, int]:
        """Remove all entries of ``key``, which no smaller one may precede, and return their sums."""
        children = leaves = saved = 0
        while True:
            if self.heap and self.heap[0][0] == key:
                entry = heapq.heappop(self.heap)
            elif self.heads and self.heads[0][0][0] == key:
                entry, number, run = heapq.heappop(self.heads)
                self._next(number, run)
            else:
                return children, leaves, saved
            children, leaves, saved = children + entry[1], leaves + entry[2], saved + entry[3]


def _forward(most: int):
    """Totals of nodes that come in order of descending depth, then key: each takes what its children sent and sends its sums on."""

    def run(batches):
        queue = SpillingQueue(most)
        for batch in batches:
            out = []
            for depth, k1, k2, u1, u2, own, c, n, s, top in zip(*[x.to_pylist() for x in batch.columns]):
                children, leaves, saved = queue.take((-depth, k1, k2))
                children, saved = children + c, saved + s + own
                leaves = leaves + n if children else 1
                if not top:
                    queue.push(((1 - depth, u1, u2), 1, leaves, saved))
                out.append((depth, k1, k2, u1, u2, children, leaves, saved, top))
            columns = list(zip(*out)) if out else [()] * 9
            kinds = [pa.int64()] * 8 + [pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds)], ["depth", "k1", "k2", "u1", "u2", "children", "leaves", "saved", "top"])

    return run


_TOTALS = "depth long, k1 long, k2 long, u1 long, u2 long, children long, leaves long, saved long, top boolean"


def _packed(batches):
    """Joined ids of the rows (depth, k1, k2, conv_id) of each node in a sorted range."""
    from pyspark import TaskContext

    pid, at, held, size, seq = TaskContext.get().partitionId(), None, [], 0, 0
    for batch in batches:
        out = []
        for *key, conv in zip(*[x.to_pylist() for x in batch.columns]):
            if held and (key != at or size >= CHUNK):
                out.append((*at, pid, seq, len(held), ",".join(held).encode()))
                held, size, seq = [], 0, seq + 1
            at = key
            held.append(str(conv))
            size += len(held[-1]) + 1
        yield _ids(out)
    yield _ids([(*at, pid, seq, len(held), ",".join(held).encode())] if held else [])


def _ids(rows: list) -> pa.RecordBatch:
    kinds = [pa.int64()] * 6 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], [*NODE, "pid", "seq", "ends", "ids"])


def _digests(batches):
    at, ends, sha = None, 0, None

    def done():
        return [(*at, ends, sha.hexdigest())] if at is not None else []

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate([pa.int64()] * 4 + [pa.string()])], [*NODE, "ends", "sha"])

    for batch in batches:
        out = []
        for *key, _, _, n, ids in zip(*[x.to_pylist() for x in batch.columns]):
            if key != at:
                out += done()
                at, ends, sha = key, n, hashlib.sha256(ids)
            else:
                ends += n
                sha.update(b",")
                sha.update(ids)
        yield table(out)
    yield table(done())


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends, sha): number and SHA-256 of the ascending, comma-joined conv_ids of each node.

    Ids are sorted and joined in ranges, so the one task that hashes the ids of a hot node reads few and long rows.
    """
    ranged = ends.select(*NODE, "conv_id").repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    packed = ranged.mapInArrow(_packed, "depth long, k1 long, k2 long, pid long, seq long, ends long, ids binary")
    return packed.repartition(*NODE).sortWithinPartitions(*NODE, "pid", "seq").mapInArrow(_digests, "depth long, k1 long, k2 long, ends long, sha string")


def prefix_trie(df: DataFrame, heavy: int = HEAVY, queue: int = QUEUE) -> DataFrame:
    """The nodes of the trie of rebuilt conversations (:func:`rebuilt_turns`), a row each:

    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens (over
    the subtree, (n_convs - 1) * bytes of a node's last text) and ends_sha256 (of the ascending comma-joined ids of
    the members that end in the node). Equal sequences are equal conversations, repeated rows are turns of their
    own, and other columns are not read. An empty table has no conversations and gives no rows.

    A node's key is the sum, modulo 2^128, of hashes of its turns with their places; all rows of a key must agree on the
    last turn and on the parent's key, or the query fails. Nodes with one member are the tail of one conversation:
    their totals are known and only a tail's top sends a message. Shared nodes that few conversations pass through are
    dealt into shards by their shard root, the highest such node above them; every shard goes through its nodes in
    reverse level order with a spilling priority queue of messages to parents. What the shard roots pass on is summed
    by parent, and one more such pass goes over the heavy nodes above them, at most ``heavy`` and the root.
    """
    turns, plan = rebuilt_turns(df)
    rows = turns.withColumn("v1", F.xxhash64("p", "mark")).withColumn("v2", F.xxhash64("mark", "p", F.lit(7)))
    keyed = running_sums(rows, "conv_id", [F.col("p")], ["v1", "v2"])
    keyed = cut_lineage(
        keyed.select(
            "conv_id", (F.col("p") + 1).alias("depth"), F.col("sum_v1").alias("k1"), F.col("sum_v2").alias("k2"),
            wrapped(F.col("sum_v1"), F.col("v1"), True).alias("u1"), wrapped(F.col("sum_v2"), F.col("v2"), True).alias("u2"), "mark", "bytes",
        )
    )
    same = F.struct("u1", "u2", "mark")
    found = keyed.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min(same).alias("is"), F.max(same).alias("to"), F.max("bytes").alias("bytes"))
    u1 = F.when(F.col("is") == F.col("to"), F.col("is.u1")).otherwise(F.raise_error("two prefixes share a key").cast("long"))
    zero = F.lit(0).cast("long")
    root = plan.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(*[zero.alias(c) for c in NODE], "conv_id", "n_convs", zero.alias("u1"), zero.alias("u2"), zero.alias("own"))
    own = ((F.col("n_convs") - 1) * F.col("bytes")).alias("own")
    nodes = cut_lineage(found.select(*NODE, "conv_id", "n_convs", u1.alias("u1"), F.col("is.u2").alias("u2"), own).unionByName(root))

    shared = nodes.where("n_convs > 1 OR depth = 0")
    parents = cut_lineage(shared.select(F.col("depth").alias("above"), F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("conv_id").alias("parent"), "n_convs"))
    linked = cut_lineage(join_keyed(nodes.withColumn("above", F.col("depth") - 1), parents, ABOVE, "n_convs"))
    total = nodes.agg(F.sum("n_convs")).first()[0] or 0
    big = cut_lineage(linked.where((F.col("depth") == 0) | (F.col("n_convs") > F.greatest(F.lit(1), F.lit(total / heavy)))))  # at most `heavy`, and the root
    names = F.broadcast(big.select(*NODE))
    over = F.broadcast(big.select(F.col("depth").alias("above"), F.col("k1").alias("u1"), F.col("k2").alias("u2")))

    def summed(sent):
        to = [F.col("above").alias("depth"), F.col("u1").alias("k1"), F.col("u2").alias("k2")]
        return sent.groupBy(*to).agg(F.count("*").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))

    def received(nodes, sent, *more):
        start = [F.coalesce(c, zero).alias(c) for c in ("children", "leaves", "saved")]
        return nodes.join(sent, NODE, "left").select(*NODE, "u1", "u2", "own", *start, "top", *more)

    def in_order(shards):
        return shards.sortWithinPartitions(F.desc("depth"), "k1", "k2").mapInArrow(_forward(queue), _TOTALS)

    tops = linked.where("n_convs = 1 AND depth > 0 AND parent IS NOT NULL").select(*ABOVE, F.lit(1).cast("long").alias("leaves"), zero.alias("saved"))
    from_tops = cut_lineage(summed(tops))
    roots = keyed.withColumn("above", F.col("depth") - 1).join(over, ABOVE, "left_semi").join(names, NODE, "left_anti")
    roots = roots.select("conv_id", F.col("depth").alias("r0"), F.col("k1").alias("r1"), F.col("k2").alias("r2"))
    light = linked.where("n_convs > 1").join(names, NODE, "left_anti").join(roots, "conv_id")
    light = received(light.withColumn("top", F.col("depth") == F.col("r0")), from_tops, "r0", "r1", "r2")
    done = cut_lineage(in_order(light.repartition("r0", "r1", "r2").drop("r0", "r1", "r2")))
    sent = summed(done.where("top").withColumn("above", F.col("depth") - 1)).unionByName(from_tops.join(names, NODE, "left_semi"))
    sent = sent.groupBy(*NODE).agg(*[F.sum(c).alias(c) for c in ("children", "leaves", "saved")])
    last = in_order(received(big.withColumn("top", F.col("depth") == 0), sent).repartition(1))
    totals = done.unionByName(last).select(*NODE, "children", "leaves", "saved")

    at_end = keyed.join(plan.select("conv_id", F.col("total").alias("depth")), ["conv_id", "depth"]).select(*NODE, "conv_id")
    none = plan.where("total = 0").select(*[zero.alias(c) for c in NODE], "conv_id")
    digests = end_digests(at_end.unionByName(none))
    out = linked.join(totals, NODE, "left").join(digests, NODE, "left")
    return out.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.coalesce("children", 1 - F.coalesce("ends", zero)).alias("n_children"),
        F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce("saved", zero).alias("saved_tokens"),
        F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
