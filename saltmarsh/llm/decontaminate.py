"""Benchmark passages in documents: SimHash of item-sized windows, Hamming blocks, weighted shingles. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saltmarsh.session import cut_lineage

SHINGLE = 5
RADIUS = 20  # bits of 64 in which the fingerprints of a window and its item may differ
SMALL = 2_000_000  # item shingles, or keys of documents that hold one, that may be broadcast (16 and 8 bytes each)


def words(text: Column | str) -> Column:
    """Lower-cased runs of letters and digits."""
    text = F.col(text) if isinstance(text, str) else text
    flat = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " "))


def shingles(tokens: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` tokens, in order."""
    count = F.size(tokens) - width + 1
    spans = F.transform(F.sequence(F.lit(1), count), lambda i: F.xxhash64(F.slice(tokens, i, width)))
    return F.when(count > 0, spans).otherwise(F.array().cast("array<bigint>"))


def simhash(tokens: Column) -> Column:
    """64 bits: in each, whether more than half of the tokens' hashes have it set."""
    hashes = F.transform(tokens, lambda t: F.xxhash64(t))

    def bit(i: int) -> Column:
        ones = F.aggregate(hashes, F.lit(0), lambda n, h: n + F.shiftrightunsigned(h, i).bitwiseAND(F.lit(1)).cast("int"))
        return F.when(ones * 2 > F.size(tokens), F.lit(1 if i < 63 else -1).cast("long") * F.lit(1 << min(i, 62)) * (1 if i < 63 else 2)).otherwise(F.lit(0).cast("long"))

    total = bit(0)
    for i in range(1, 64):
        total = total.bitwiseOR(bit(i))
    return total


def blocks(print_: Column, radius: int) -> Column:
    """The fingerprint in radius + 1 numbered blocks: two fingerprints within the radius agree in one of them."""
    n = radius + 1
    cut = [i * 64 // n for i in range(n + 1)]
    parts = [
        F.lit(i << 32).cast("long") + F.shiftrightunsigned(print_, cut[i]).bitwiseAND(F.lit((1 << (cut[i + 1] - cut[i])) - 1)) for i in range(n)
    ]
    return F.array(*parts)


def benchmark_matches(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = SHINGLE,
    similarity: float = 0.8,
    radius: int = RADIUS,
) -> DataFrame:
    """(doc_id, item_id, start, n_words, distance, similarity): the best window of each document for each item that it holds.

    A window has as many words as the item. It starts where a shingle that both hold puts the item's
    first word; any window with a similarity above 0 overlaps one that does, so documents without a
    shingle of any item drop out after one semi-join. Windows and items get SimHash fingerprints over
    their words. The fingerprints' blocks are joined, which finds every window within ``radius`` of its
    item; those are held to the exact similarity: the weight of the shingles in common over the weight of
    all, where a shingle weighs 1 + ln(items / items with it) and one that the item lacks 1 + ln(items).
    ``start`` counts words from 0.

    Null texts are empty. Items of fewer than ``width`` words and items with a null id match nothing. Documents with
    a null id are matched and returned with a null id. Repeated rows give one row; equal scores
    give the earliest window. Other columns are not read. Empty tables give an empty table.
    """
    it = items.select(F.col(item_col).alias("item"), words(item_text_col).alias("iw")).where("item IS NOT NULL").dropDuplicates(["item", "iw"])
    it = it.select("item", "iw", shingles(F.col("iw"), width).alias("ish")).where(F.size("ish") > 0)
    it = cut_lineage(it.select("item", F.size("iw").alias("m"), "ish", simhash(F.col("iw")).alias("iprint")))
    spots = it.select("item", "m", F.posexplode("ish").alias("ipos", "h"))
    small = spots.count() <= SMALL
    hint = F.broadcast if small else (lambda x: x)

    d = docs.select(F.col(id_col).alias("doc"), F.xxhash64(id_col, text_col).alias("row"), words(text_col).alias("dw"))
    found = d.select("doc", "row", F.posexplode(shingles(F.col("dw"), width)).alias("pos", "h"))
    found = cut_lineage(found.join(hint(spots.select("h").distinct()), "h", "left_semi"))
    starts = found.join(hint(spots), "h").select("doc", "row", "item", "m", F.greatest(F.col("pos") - F.col("ipos"), F.lit(0)).alias("start")).distinct()

    held_rows = cut_lineage(found.select("row").distinct())
    held_rows = F.broadcast(held_rows) if held_rows.count() <= SMALL else held_rows
    texts = docs.select(F.xxhash64(id_col, text_col).alias("row"), F.col(text_col).alias("t")).join(held_rows, "row", "left_semi")
    texts = texts.dropDuplicates(["row"]).select("row", words("t").alias("dw"))
    window = F.slice("dw", F.col("start") + 1, F.col("m"))
    held = starts.join(texts, "row").select("doc", "row", "item", "m", "start", window.alias("win"))
    held = held.select("doc", "row", "item", "m", "start", shingles(F.col("win"), width).alias("wsh"), simhash(F.col("win")).alias("wprint"))
    held = cut_lineage(held)

    index = it.select("item", "m", "iprint", F.explode(blocks(F.col("iprint"), radius)).alias("block"))
    probes = held.select("doc", "row", "item", "m", "start", "wprint", F.explode(blocks(F.col("wprint"), radius)).alias("block"))
    near = probes.join(index, ["item", "m", "block"]).withColumn("distance", F.bit_count(F.col("wprint").bitwiseXOR(F.col("iprint"))))
    near = near.where(F.col("distance") <= radius).select("row", "item", "m", "start", "iprint", "distance").distinct()

    total = it.agg(F.count("*").cast("double").alias("n")).scalar()
    rarity = spots.select("item", "h").distinct().groupBy("h").agg(F.count("*").alias("df"))
    weights = spots.select("item", "m", "h").distinct().join(rarity, "h").select("item", "m", "h", (1 + F.log(total / F.col("df"))).alias("w"))
    weighed = weights.groupBy("item", "m").agg(F.collect_list(F.struct("h", "w")).alias("iws"), F.sum("w").alias("iall"))
    pairs = held.drop("wprint").join(near, ["row", "item", "m", "start"]).join(weighed, ["item", "m"])
    both = F.aggregate("iws", F.lit(0.0), lambda a, f: a + F.when(F.array_contains("wsh", f["h"]), f["w"]).otherwise(0.0))
    own = F.array_distinct("wsh")
    shared = F.size(F.filter("iws", lambda f: F.array_contains("wsh", f["h"])))
    union = F.col("iall") + (F.size(own) - shared) * (1 + F.log(total))
    scored = pairs.select("doc", "item", "m", "start", "distance", F.round(both / union, 9).alias("similarity")).where(F.col("similarity") >= similarity)
    best = scored.groupBy("doc", "item").agg(F.max(F.struct("similarity", (-F.col("start")).alias("s"), "m", (-F.col("distance")).alias("d"))).alias("b"))
    return best.select(
        F.col("doc").alias(id_col), F.col("item").alias(item_col), (-F.col("b.s")).alias("start"), F.col("b.m").alias("n_words"),
        (-F.col("b.d")).cast("int").alias("distance"), F.col("b.similarity").alias("similarity"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs``, all columns, whose document holds no item. Rows with a null id are kept."""
    hit = benchmark_matches(docs, items, id_col, **options).select(F.col(id_col).alias("_hit")).distinct()
    return docs.join(hit, docs[id_col] == hit["_hit"], "left_anti")
