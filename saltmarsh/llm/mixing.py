"""Mixing sources to target weights with hash thresholds instead of sorting. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from saltmarsh.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
LEVELS = (12, 16, 16, 16)  # bits of the hash that each histogram resolves, 60 in all
BITS = sum(LEVELS)


def word_count(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def place(key: Column | str) -> Column:
    """60 bits of md5 of the key as text; a null key counts as empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = 3) -> DataFrame:
    """Adds ``target`` to (source, source_size): the sum of all sizes shared by weight, none above ``most`` times its size.

    Sources take the weights in turn, by code point, null last. What a source cannot take is shared
    among the others by weight: with sources in the order of the level at which they are full,
    the level follows from running sums. This orders one row per source, not documents.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * most)
    full = W.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("_cap").over(full.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("_w").over(full.rowsBetween(0, W.unboundedFollowing))
    every = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    s = s.withColumn("_level", (F.sum("source_size").over(every) - before).cast("double") / rest)
    s = s.withColumn("_rank", F.row_number().over(full)).withColumn("_open", F.col("_cap") >= F.col("_w") * F.col("_level"))
    first = F.min(F.when(F.col("_open"), F.struct("_rank", "_level"))).over(every)
    s = s.withColumn("_first", first)
    target = F.when(F.col("_rank") < F.col("_first._rank"), F.col("_cap").cast("double")).otherwise(F.col("_w") * F.col("_first._level"))
    return s.select("source", "source_size", target.alias("target"))


def _bits(h: str, level: int) -> Column:
    low = BITS - sum(LEVELS[: level + 1])
    return F.shiftright(F.col(h), low).bitwiseAND(F.lit((1 << LEVELS[level]) - 1)).cast("int")


def _key(source: Column | str) -> Column:
    source = F.col(source) if isinstance(source, str) else source
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def _narrow(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    rows = df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"), place(id_col).alias("h"))
    return cut_lineage(rows.withColumn("s", _key("source")))


def thresholds(rows: DataFrame, weights: tuple = WEIGHTS, most: int = 3) -> DataFrame:
    """Per source of ``rows`` (s, source, size, h): size, target, whole copies, and the hash up to which documents are
    taken once more, with what the documents at that very hash have and may give."""
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most).withColumn("s", _key("source"))
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    sources = cut_lineage(sources.withColumn("copies", copies).withColumn("left", F.floor("target").cast("long") - F.col("copies") * F.col("source_size")))
    open_ = sources.where("left > 0").select("s", "left")
    inside, keys = rows.where("size > 0"), ["s"]
    for level in range(len(LEVELS)):
        bucket = f"b{level}"
        inside = inside.withColumn(bucket, _bits("h", level))
        hist = inside.groupBy(*keys, bucket).agg(F.sum("size").alias("words"))
        upto = W.partitionBy("s").orderBy(bucket).rowsBetween(W.unboundedPreceding, 0)
        hist = hist.join(open_, keys).withColumn("end", F.sum("words").over(upto))
        edge = hist.where("end > left AND end - words <= left").select(*keys, bucket, "words", (F.col("left") - (F.col("end") - F.col("words"))).alias("left"))
        edge = cut_lineage(edge)  # a row per source
        keys = [*keys, bucket]
        open_ = edge.select(*keys, "left")
        if level < len(LEVELS) - 1:
            inside = inside.join(edge.select(*keys), keys)
    value = F.lit(0).cast("long")
    for level, width in enumerate(LEVELS):
        value = value * F.lit(1 << width) + F.col(f"b{level}")
    edge = edge.select("s", value.alias("edge"), F.col("left").alias("edge_left"), F.col("words").alias("edge_words"))
    plan = sources.join(edge, "s", "left").select("s", "source_size", "target", "copies", "edge", "edge_left", "edge_words")
    return cut_lineage(plan)  # its size is known then: a small one is broadcast, and documents stay where they are


def _taken(size: str, h: str) -> Column:
    part = F.floor(F.col("edge_left").cast("decimal(38,0)") * F.col(size) / F.col("edge_words")).cast("long")
    extra = F.when(F.col(h) < F.col("edge"), F.col(size)).when(F.col(h) == F.col("edge"), part).otherwise(0)
    return F.col("copies") * F.col(size) + extra


def mix(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = WEIGHTS, most: int = 3
) -> DataFrame:
    """(id, size, source_size, target, taken) per row of ``df``: the words that the mix takes of each document.

    A source with target t and size S is taken floor(t / S) times as a whole. The rest is the
    documents below a threshold of their ids' hash, found by histograms: words per source and hash
    bucket, then only the bucket that holds the budget, bit range by bit range. Documents whose hash
    is the threshold share what is left in proportion to their sizes, rounded down; with distinct ids
    that is one document and the source's taken words are floor(t). Thresholds are nested: a larger
    budget takes what a smaller one takes, and reruns agree.

    Null text: size 0. Null source: a source of its own, last. Null id: hashed as empty text.
    Repeated rows count each. Other columns are not read. An empty table gives an empty table.
    """
    rows = _narrow(df, id_col, text_col, source_col)
    placed = rows.join(thresholds(rows, weights, most), "s")
    return placed.select(F.col("id").alias(id_col), "size", "source_size", "target", _taken("size", "h").alias("taken"))


def mixed_documents(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = WEIGHTS, most: int = 3
) -> DataFrame:
    """The mix as rows of ``df``, all columns: a document taken q times and p words over gives q rows and one with its first p words.

    The words of that last one are joined by one space. Cases as in :func:`mix`; columns that hold lengths are not changed.
    Column names that begin with ``_mix_`` are taken.
    """
    plan = thresholds(_narrow(df, id_col, text_col, source_col), weights, most)
    own = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.select(own.alias("_mix_row"), F.col(text_col).alias("_mix_text"), word_count(text_col).alias("_mix_size"), place(id_col).alias("_mix_h"), _key(source_col).alias("s"))
    rows = rows.join(plan, "s").withColumn("_mix_taken", _taken("_mix_size", "_mix_h")).where("_mix_taken > 0")
    times = F.ceil(F.col("_mix_taken") / F.col("_mix_size")).cast("int")
    rows = rows.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), times)))
    over = F.col("_mix_taken") - (F.col("_mix_copy") - 1).cast("long") * F.col("_mix_size")
    words = F.regexp_extract_all(F.col("_mix_text"), F.lit(f"({WORD})"))
    cut = F.array_join(F.slice(words, F.lit(1), F.greatest(over, F.lit(1)).cast("int")), " ")
    text = F.when(over >= F.col("_mix_size"), F.col("_mix_text")).otherwise(cut)
    return rows.select(*[text.alias(c) if c == text_col else F.col("_mix_row")[c].alias(c) for c in df.columns])
