"""Near-duplicate documents: circulant MinHash, bands, exact Jaccard."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from saltmarsh.llm.graph import components
from saltmarsh.llm.hashing import groups_of, mix, shingle_sets
from saltmarsh.llm.skew import join_keyed
from saltmarsh.session import cut_lineage

SLOTS = 1 << 21  # size of the permuted universe
BLOCK = 96  # documents on either side of one exact comparison
WEIGHT = 1 << 20  # shingles on either side, about
PIECE = 1 << 20  # bytes of text hashed at once, if a single text is not longer
_U = np.uint64


@lru_cache(2)
def _permutation(coordinates: int) -> np.ndarray:
    """All ``coordinates`` circular shifts of one permutation: row p holds its entries at p, p + 1, ..."""
    ranks = np.random.default_rng(7).permutation(SLOTS).astype(np.int32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([ranks, ranks[:coordinates]]), coordinates)


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash of a set of 64-bit hashes.

    The first permutation scatters the shingles over the slots; coordinate k is the least rank
    that the second permutation, shifted by k, gives to one of them. Very large sets are
    worked through in pieces.
    """
    shifted = _permutation(coordinates)
    slot = ((shingles * _U(0xD6E8FEB86659FD93)) >> _U(64 - 21)).astype(np.int64)
    low = np.full(coordinates, SLOTS, np.int32)
    for a in range(0, len(slot), 4096):
        np.minimum(low, shifted[slot[a : a + 4096]].min(axis=0), out=low)
    return low


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` coordinates; the band's number is part of it."""
    h = np.arange(1, bands + 1, dtype=np.uint64)
    for column in sig.reshape(bands, rows).T:
        h = mix(h * _U(0x9E3779B97F4A7C15) + column.astype(np.uint64))
    return h.view(np.int64)


def _sketch(width: int, bands: int, rows: int):
    def run(batches):
        from hashlib import blake2b

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            known: dict = {}  # of this batch
            for a, b in groups_of(texts, PIECE):
                sets = shingle_sets(texts[a:b], width)
                marks, keys = [], []
                for s in sets:
                    if not len(s):
                        marks.append(None)
                        keys.append(None)
                        continue
                    m = blake2b(s.tobytes(), digest_size=16).digest()
                    if m not in known:
                        known[m] = band_keys(signature(s, bands * rows), bands, rows)
                    marks.append(m)
                    keys.append(known[m])
                yield pa.RecordBatch.from_arrays(
                    [ids[a:b], pa.array([len(s) for s in sets], pa.int64()), pa.array(marks, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    ["id", "n", "mark", "bands"],
                )

    return run


def _linked(sets: list, other: list, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with ``100 * intersection >= percent * union``, from products of 0/1 matrices over slices of the shingles."""
    every = np.concatenate([*sets, *other])
    size = np.array([len(s) for s in sets]), np.array([len(s) for s in other])
    shared, count = np.unique(every, return_counts=True)
    shared = shared[count > 1]
    both = np.zeros((len(sets), len(other)), np.int64)
    for a in range(0, len(shared), 1 << 15):
        cut = shared[a : a + (1 << 15)]
        flat = []
        for side in (sets, other):
            m = np.zeros((len(side), len(cut)), np.float32)
            for k, s in enumerate(side):
                own = s[np.searchsorted(s, cut[0]) : np.searchsorted(s, cut[-1], side="right")]
                where = np.searchsorted(cut, own)
                m[k, where[cut[where] == own]] = 1
            flat.append(m)
        both += (flat[0] @ flat[1].T).astype(np.int64)
    union = size[0][:, None] + size[1][None, :] - both
    return np.nonzero((100 * both >= percent * union) & (both > 0))


def _compare(width: int, percent: int):
    def run(table: pa.Table) -> pa.Table:
        ids = np.array(table.column("id").to_pylist(), dtype=object)
        left = np.array(table.column("left_side").to_pylist(), dtype=bool)
        texts = table.column("text").combine_chunks()
        sets = [s for a, b in groups_of(texts, PIECE) for s in shingle_sets(texts[a:b], width)]
        first = np.flatnonzero(left)
        second = np.flatnonzero(~left)
        if not len(second):
            second = first
        parent = list(range(len(ids)))

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        if len(first):
            for i, j in zip(*_linked([sets[k] for k in first], [sets[k] for k in second], percent)):
                a, b = root(first[i]), root(second[j])
                if a != b:
                    parent[max(a, b)] = min(a, b)
        links = [(ids[k], ids[root(k)]) for k in range(len(ids)) if root(k) != k]
        return pa.table([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

    return run


def _links(texts: DataFrame, sides: DataFrame, width: int, percent: int) -> DataFrame:
    """Links of each comparison (job) of ``sides`` (id, job, left_side): enough of them to connect what is linked."""
    rows = sides.join(texts, "id").select("job", "id", "text", "left_side")
    return rows.groupBy("job").applyInArrow(_compare(width, percent), "a long, b long")


def _blocks_of(n, width):
    return F.greatest(F.lit(1), F.ceil(n / width)).cast("int")


def _neighbourhoods(keys: DataFrame) -> DataFrame:
    """(id, grp, members, blocks): documents that share a band key with the document ``grp``, the smallest of that band.

    ``keys`` holds (id, n, key). A neighbourhood whose documents all belong to one of a smaller name adds no pair and is left out.
    ``blocks`` is the number of blocks it is compared in, by documents and by shingles.
    """
    bands = cut_lineage(keys.groupBy("key").agg(F.min("id").alias("grp"), F.max("id").alias("last"), F.count("*").alias("met")).where("grp < last"))
    near = join_keyed(keys, bands.drop("last"), ["key"], "met").where("grp IS NOT NULL")
    near = near.groupBy("id", "grp").agg(F.max("n").alias("n"))
    home = F.min("grp").over(W.partitionBy("id"))  # a document has no more rows than bands
    near = cut_lineage(near.withColumn("home", home))
    sizes = near.groupBy("grp").agg(F.count("*").alias("members"), F.sum("n").alias("weight"), F.min("home").alias("low"), F.max("home").alias("high"))
    sizes = sizes.where("NOT (low = high AND low <> grp)")
    blocks = F.greatest(_blocks_of(F.col("members"), F.lit(BLOCK)), _blocks_of(F.col("weight"), F.lit(WEIGHT)))
    sizes = cut_lineage(sizes.select("grp", "members", blocks.alias("blocks"), F.col("members").alias("met")))
    return cut_lineage(join_keyed(near.select("id", "grp"), sizes, ["grp"], "met").where("members IS NOT NULL"))


def _first_sides(placed: DataFrame) -> DataFrame:
    """Every block against itself and against block 0 of its neighbourhood."""
    cut = placed.withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    own = cut.select("id", F.concat_ws(":", "grp", "block", "block").alias("job"), F.lit(True).alias("left_side"))
    other = cut.where("block > 0").select("id", F.concat_ws(":", "grp", F.lit(0), "block").alias("job"), F.lit(False).alias("left_side"))
    zero = cut.where("block = 0 AND blocks > 1").select("id", "grp", F.explode(F.sequence(F.lit(1), F.col("blocks") - 1)).alias("k"))
    return own.union(other).union(zero.select("id", F.concat_ws(":", "grp", F.lit(0), "k").alias("job"), F.lit(True).alias("left_side")))


def _rest_sides(large: DataFrame, found: DataFrame) -> DataFrame:
    """All pairs of blocks of the larger neighbourhoods but those that lie wholly in one component of ``found``."""
    wide = (F.col("members") / F.col("blocks")).alias("wide")
    rows = large.join(found, large.id == found.node, "left").select("id", "grp", wide, F.coalesce("component", "id").alias("comp"))
    rows = cut_lineage(rows)
    parts = rows.groupBy("grp", "comp").agg(F.count("*").alias("m"), F.first("wide").alias("wide"))
    parts = cut_lineage(parts.withColumn("pure", F.col("m") >= F.col("wide") / 2).withColumn("met", F.col("m")))
    small = parts.where("NOT pure").groupBy("grp").agg(F.sum("m").alias("small"))
    small = cut_lineage(small.withColumn("met", F.col("small")))
    lay = join_keyed(join_keyed(rows, parts.drop("wide"), ["grp", "comp"], "met"), small, ["grp"], "met")
    name = F.when(F.col("pure"), F.concat_ws("/", "comp", F.pmod(F.xxhash64("id"), _blocks_of(F.col("m"), F.col("wide"))))).otherwise(
        F.concat_ws("/", F.lit("rest"), F.pmod(F.xxhash64("id"), _blocks_of(F.col("small"), F.col("wide"))))
    )
    lay = cut_lineage(lay.select("id", "grp", F.when(F.col("pure"), F.col("comp")).alias("whole"), name.alias("block")))
    blocks = cut_lineage(lay.select("grp", "whole", "block").distinct())
    one = blocks.select("grp", F.col("whole").alias("w1"), F.col("block").alias("b1"))
    two = blocks.select("grp", F.col("whole").alias("w2"), F.col("block").alias("b2"))
    jobs = one.join(two, "grp").where("b1 <= b2 AND NOT coalesce(w1 = w2, false)")
    jobs = jobs.select("grp", "b1", "b2", F.concat_ws(":", "grp", "b1", "b2").alias("job"))
    ends = jobs.select("grp", F.col("b1").alias("block"), "job", F.lit(True).alias("left_side")).union(
        jobs.where("b1 < b2").select("grp", F.col("b2").alias("block"), "job", F.lit(False).alias("left_side"))
    )
    return lay.join(ends, ["grp", "block"]).select("id", "job", "left_side")


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, bands: int = 30, rows: int = 6
) -> DataFrame:
    """(id, n_shingles, component_id, kept) per row: components of documents whose sets of ``width``-word shingles
    have ``100 * intersection >= percent * union``.

    Documents of one and the same set form a class and are represented by its smallest id.
    Representatives that share a band key with the smallest document of that band form its neighbourhood, so only
    documents of one band, or of two bands with the same smallest document, are ever compared; chains of collisions are not
    followed. In a neighbourhood they are compared on their full sets, in jobs of two blocks of about ``BLOCK`` documents
    or ``WEIGHT`` shingles. Those of more than one block are first compared block by block and with one block in common;
    afterwards, blocks that are wholly in one component are not compared with each other again.
    At 85 % a pair misses all 30 bands of 6 coordinates with probability below 1e-6.

    Null text: empty, no shingles, linked with nothing. Null id: the row gets ``component_id`` null
    (or its class's, if a copy has an id) and ``kept`` false. Rows with the same id are one document.
    Other columns are not read. An empty table gives an empty table.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be in (0, 100]")
    base = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    kind = "id long, n long, mark binary, bands array<bigint>"
    sketch = cut_lineage(base.mapInArrow(_sketch(width, bands, rows), kind))
    classes = sketch.where("mark IS NOT NULL AND id IS NOT NULL").groupBy("mark").agg(F.min("id").alias("rep"))
    classes = cut_lineage(classes)
    own = sketch.join(classes, (sketch.mark == classes.mark) & (sketch.id == classes.rep)).select("rep", "n", "bands")
    keys = cut_lineage(own.select(F.col("rep").alias("id"), "n", F.explode("bands").alias("key")))
    placed = _neighbourhoods(keys)
    texts = base.join(placed.select("id"), "id", "left_semi")
    texts = cut_lineage(texts.dropDuplicates(["id", "text"]))
    links = cut_lineage(_links(texts, _first_sides(placed), width, percent))
    large = placed.where("blocks > 1")
    if not large.isEmpty():
        rest = _rest_sides(large, components(links))
        links = links.union(cut_lineage(_links(texts, rest, width, percent)))
    joined = components(links)
    of_class = classes.join(joined, classes.rep == joined.node, "left").select("mark", F.coalesce("component", "rep").alias("component_id"))
    result = sketch.select("id", "n", "mark").join(of_class, "mark", "left")
    component = F.when(F.col("mark").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return result.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept")
    )
