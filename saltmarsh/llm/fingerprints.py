"""Document fingerprints: one-permutation MinHash with optimal densification and packed low-order bits."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saltmarsh.llm.hashing import groups_of, mix, shingle_sets
from saltmarsh.llm.tokens import slot_of, slots_of

BINS = 512
LOW_BITS = 4  # kept of each bin's least hash
WIDTH = 5  # words of a shingle
_U = np.uint64


@lru_cache(2)
def first_named(bins: int) -> np.ndarray:
    """For every bin (row) the attempt in which its hashes of (bin, attempt) first name each other bin (column)."""
    out = np.zeros((bins, bins), np.int32)
    every, attempt = np.arange(bins), 0
    while not out.all():
        attempt += 1
        source = (mix(every.astype(np.uint64) * _U(0x9E3779B97F4A7C15) + _U(attempt)) & _U(bins - 1)).astype(np.int64)
        new = out[every, source] == 0
        out[every[new], source[new]] = attempt
    return out


def sketch(shingles: np.ndarray, bins: int = BINS, bits: int = LOW_BITS) -> np.ndarray | None:
    """Low-order bits of the least hash in each bin; None for an empty set.

    Every shingle is hashed once. An empty bin takes the value of the first filled one among bins
    that hashes of (bin, attempt) name, the same for every set. The bits kept are those of a hash of value
    and bin, so that bins which share a value agree by chance each for itself.
    """
    if not len(shingles):
        return None
    keys = mix(shingles * _U(0xD1342543DE82EF95) + _U(1))
    at = (keys >> _U(64 - (bins.bit_length() - 1))).astype(np.int64)
    least = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, at, keys)  # repeated shingles change nothing
    filled = np.bincount(at, minlength=bins) > 0
    empty, full = np.flatnonzero(~filled), np.flatnonzero(filled)
    least[empty] = least[full[first_named(bins)[np.ix_(empty, full)].argmin(axis=1)]]
    own = np.arange(bins, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)
    return (mix(least ^ own) & _U((1 << bits) - 1)).astype(np.uint8)


def packed(value: np.ndarray | None) -> str:
    """Two bins of four bits to a byte, in hex; the empty set's fingerprint is the empty string."""
    return "" if value is None else ((value[0::2] << 4) | value[1::2]).tobytes().hex()


def unpacked(fingerprint: str) -> np.ndarray | None:
    if not fingerprint:
        return None
    raw = np.frombuffer(bytes.fromhex(fingerprint), np.uint8)
    return np.column_stack([raw >> 4, raw & 15]).ravel()


def likeness(a: np.ndarray | None, b: np.ndarray | None, bits: int = LOW_BITS) -> float:
    """Estimated Jaccard similarity: the share of equal bins, freed of the 2 ** -bits that are equal by chance; 1 for two empty sets, 0 for one."""
    if a is None or b is None:
        return float(a is None and b is None)
    by_chance = 2.0**-bits
    return float(min(1.0, max(0.0, ((a == b).mean() - by_chance) / (1 - by_chance))))


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n / 2) code points replaced by the first as many (or all) of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _sketches(texts: list[str]) -> list:
    array = pa.array(texts, pa.large_string())
    return [sketch(s) for a, b in groups_of(array) for s in shingle_sets(array[a:b], WIDTH, distinct=False)]


def _rows(batches):
    """Rows come by (slot, tail, id); a slot's last row is followed by its tail, the first row of the next slot."""
    held = None
    for batch in batches:
        for a, b in groups_of(batch.column(3)):
            slot, tail, ids = (batch.column(k)[a:b].to_pylist() for k in range(3))
            texts = [t or "" for t in batch.column(3)[a:b].to_pylist()]
            rows = list(zip(slot, tail, ids, texts, _sketches(texts)))
            if held:
                rows.insert(0, held)
            held = rows[-1]
            pairs = [(x, y) for x, y in zip(rows, rows[1:]) if not x[1] and x[0] == y[0]]
            changed = [edited(x[3], y[3]) for x, y in pairs]
            prints = _sketches(changed)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[2] for x, _ in pairs], pa.int64()),
                    pa.array([len(x[3]) for x, _ in pairs], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
                    pa.array([packed(x[4]) for x, _ in pairs], pa.string()),
                    pa.array([packed(p) for p in prints], pa.string()),
                    pa.array([likeness(x[4], p) for (x, _), p in zip(pairs, prints)], pa.float64()),
                    pa.array([likeness(x[4], y[4]) for x, y in pairs], pa.float64()),
                ],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: fingerprint of its whole text and of the text edited with the next document's, and their likeness.

    The next document is the one next in ascending id, the first one's after the last. Ids are
    dealt into ranges; each range also gets the first document of the next, so texts are shuffled once.

    Null text: empty. Rows with a null id come first. Rows of equal id follow each other in order of
    their texts. Other columns are not read. A single row is its own next. An empty table gives an empty table.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    slots = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = slots_of(rows, "id", slots)
    rows = rows.withColumn("slot", slot_of("id", bounds))
    first = rows.select("slot", "id").groupBy("slot").agg(F.min(F.struct(F.col("id").isNotNull().alias("set"), "id")).alias("f"))
    heads = sorted((r["slot"], r["f"]["id"]) for r in first.collect())  # one row per slot
    before = [(heads[k - 1][0], head) for k, (_, head) in enumerate(heads)]
    tails = F.broadcast(spark.createDataFrame(before, "before int, head long"))
    both = F.array(F.struct("slot", F.lit(0).alias("tail")), F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("slot"), F.lit(1).alias("tail"))))
    dealt = rows.join(tails, F.col("id").eqNullSafe(F.col("head")), "left").withColumn("to", F.explode(F.filter(both, lambda x: x.isNotNull())))
    dealt = dealt.select(F.col("to.slot").alias("slot"), F.col("to.tail").alias("tail"), "id", "text")
    ordered = dealt.repartition(slots // 2, "slot").sortWithinPartitions("slot", "tail", "id", "text")
    kind = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered.mapInArrow(_rows, kind).withColumnRenamed("doc_id", id_col)
