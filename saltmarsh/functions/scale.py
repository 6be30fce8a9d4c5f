"""Building blocks that hold when one key owns a large part of all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage


def totals(df: DataFrame, **aggs: Column) -> dict[str, Column]:
    """Whole-table aggregates as columns of one scalar subquery (no cross join, no driver trip)."""
    one = df.agg(F.struct(*[c.alias(k) for k, c in aggs.items()]).alias("one")).scalar()
    return {k: one[k] for k in aggs}


def attach(target: DataFrame, source: DataFrame, name: str = "_s", **aggs: Column) -> DataFrame:
    """``target`` with whole-table aggregates of ``source`` as one struct column; for many references to them."""
    return target.withColumn(name, source.agg(F.struct(*[c.alias(k) for k, c in aggs.items()]).alias("one")).scalar())


def attach_quantiles(target: DataFrame, source: DataFrame, value: str, probs: dict[str, float], name: str = "_q") -> DataFrame:
    """``target`` with exact quantiles of ``source`` as one struct column."""
    return target.withColumn(name, quantiles(source, value, probs).select(F.struct(*probs).alias("one")).scalar())


def null_safe_join(left: DataFrame, right: DataFrame, keys: list, how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL equals NULL; the keys come from the left."""
    if not keys:
        raise ValueError("no keys to join on")
    own = [f"_right{i}" for i in range(len(keys))]
    other = right.select(*[F.col(k).alias(n) for k, n in zip(keys, own)], *[c for c in right.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, own)])
    return left.join(other, same, how).drop(*own)


def _coarse(v: Column) -> Column:
    """A bucket that does not decrease with ``v``: sixteen to each power of two, on both sides of zero."""
    far = F.lit(1 << 20)
    size = F.floor((F.log2(F.abs(v)) + 1100) * 16)
    return (
        F.when(F.isnan(v), far + 1).when(F.abs(v) == float("inf"), F.signum(v) * far).when(v == 0, F.lit(0)).otherwise(F.signum(v) * size).cast("int")
    )


def quantiles(df: DataFrame, value: str, probs: dict[str, float], keys: tuple | list = (), index: bool = False, buckets: int = 1 << 16) -> DataFrame:
    """Exact linearly interpolated quantiles, one row per key: keys, ``n`` and one column per name.

    With ``index`` the value at sorted position ``int(n * p)`` is taken instead. NULL is a key of its own, NULL values are left
    out, NaN is the largest value, and without rows and keys the result is one row of NULLs.

    Values are selected by counting, never by ordering rows. Keys and values are written once. The first pass
    counts values in buckets of a sixteenth of a power of two; each wanted rank falls into one of them, and
    the next passes count that bucket's range, from its least to its largest value, in ``buckets`` equal parts, until the
    part holds one value. A range of doubles is down to one value after at most five passes. Only bucket counts
    are shuffled, at most ``buckets`` per rank and task, so a key with most of the rows is no obstacle.
    """
    keys = list(keys)
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("_all"))
    rows = df.select(key.alias("_k"), (F.col(value).cast("double") + 0.0).alias("_v"))
    rows = cut_lineage(rows.where(F.col("_v").isNotNull()))
    wanted = []
    for p in probs.values():
        if index:
            wanted.append([F.least(F.floor(F.col("_n") * F.lit(float(p))), F.col("_n") - 1)])
        else:
            pos = (F.col("_n") - 1) * F.lit(float(p))
            wanted.append([F.floor(pos), F.ceil(pos)])
    ranks = F.array(*[F.struct(F.lit(i).alias("at"), F.lit(j).alias("side"), r.cast("bigint").alias("rank")) for i, two in enumerate(wanted) for j, r in enumerate(two)])
    counts = [F.count("*").alias("_c"), F.min("_v").alias("_min"), F.max("_v").alias("_max")]

    def placed(counted, group):
        upto = W.partitionBy(*group).orderBy("_b").rowsBetween(W.unboundedPreceding, 0)
        return counted.withColumn("_end", F.sum("_c").over(upto)).withColumn("_start", F.col("_end") - F.col("_c"))

    first = placed(rows.groupBy("_k", _coarse(F.col("_v")).alias("_b")).agg(*counts), ["_k"])
    first = first.withColumn("_n", F.sum("_c").over(W.partitionBy("_k")))
    inside = F.filter(ranks, lambda r: (F.col("_start") <= r["rank"]) & (r["rank"] < F.col("_end")))
    found = first.select("_k", "_n", "_start", F.col("_min").alias("_lo"), F.col("_max").alias("_hi"), F.explode(inside).alias("_r"))
    found = cut_lineage(found.select("_k", "_n", "_r.at", "_r.side", (F.col("_r.rank") - F.col("_start")).alias("_rank"), "_lo", "_hi"))
    while True:
        narrow = found.where("_lo < _hi")
        if narrow.isEmpty():
            break
        ranges = narrow.groupBy("_k").agg(F.collect_set(F.struct("_lo", "_hi")).alias("_ranges"))  # at most two for each name
        if not keys:
            ranges = F.broadcast(ranges)  # one row
        hit = F.filter("_ranges", lambda r: (F.col("_v") >= r["_lo"]) & (F.col("_v") <= r["_hi"]))
        met = rows.join(ranges, "_k").select("_k", "_v", F.explode(hit).alias("_r")).select("_k", "_v", "_r.*")
        part = F.least(F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * buckets), F.lit(buckets - 1)).cast("int")
        counted = placed(met.groupBy("_k", "_lo", "_hi", part.alias("_b")).agg(*counts), ["_k", "_lo", "_hi"])
        step = narrow.join(counted, ["_k", "_lo", "_hi"]).where("_start <= _rank AND _rank < _end")
        step = step.select("_k", "_n", "at", "side", (F.col("_rank") - F.col("_start")).alias("_rank"), F.col("_min").alias("_lo"), F.col("_max").alias("_hi"))
        found = cut_lineage(found.where("NOT _lo < _hi").unionByName(step))

    out = []
    for i, (name, p) in enumerate(probs.items()):
        lo, hi = [F.max(F.when((F.col("at") == i) & (F.col("side") == j), F.col("_lo"))) for j in (0, 0 if index else 1)]
        pos = (F.max("_n") - 1) * F.lit(float(p))
        out.append(lo.alias(name) if index else (lo + (hi - lo) * (pos - F.floor(pos))).alias(name))
    result = found.groupBy(*(["_k"] if keys else [])).agg(F.max("_n").alias("n"), *out)
    return result.select("_k.*", "n", *probs) if keys else result


def column_quantiles(df: DataFrame, wanted: dict[str, tuple[str, float]]) -> Column:
    """Exact quantiles of several columns, ``{name: (column, p)}``, as one struct scalar."""
    columns = sorted({c for c, _ in wanted.values()})
    probs = {f"p{i}": p for i, p in enumerate(sorted({p for _, p in wanted.values()}))}
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "_column", "_value")
    q = quantiles(long, "_value", probs, ["_column"])
    name_of = {p: n for n, p in probs.items()}
    picks = [F.max(F.when(F.col("_column") == c, F.col(name_of[p]))).alias(n) for n, (c, p) in wanted.items()]
    return q.agg(*picks).select(F.struct(*wanted).alias("one")).scalar()


def quantile_scalars(df: DataFrame, value: str, probs: dict[str, float]) -> dict[str, Column]:
    """Whole-table exact quantiles as columns of one scalar subquery."""
    names = list(probs)
    one = quantiles(df, value, probs).select(F.struct(*names).alias("one")).scalar()
    return {k: one[k] for k in names}


def running(df: DataFrame, keys: list, order: list, block: Column, **sums: Column) -> DataFrame:
    """Running sums per key in two levels; NULL is a key of its own.

    Rows are summed inside (key, block); block totals, far fewer, are summed per key and
    added. ``block`` must not decrease along ``order``. A key with most of the rows is thus
    spread over its blocks. The keys are packed into one struct, in which NULL equals NULL, so the join back uses
    the partitioning of the window.
    """
    work = df.withColumn("_k", F.struct(*keys)).withColumn("_block", F.struct(block.alias("block")))
    for name, c in sums.items():
        work = work.withColumn(f"_in_{name}", c)
    inside = W.partitionBy("_k", "_block").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy("_k").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = work.groupBy("_k", "_block").agg(*[F.sum(f"_in_{n}").alias(f"_t_{n}") for n in sums])
    offsets = offsets.select("_k", "_block", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums])
    for name in sums:
        work = work.withColumn(f"_l_{name}", F.sum(f"_in_{name}").over(inside))
    work = work.join(offsets, ["_k", "_block"])
    for name in sums:
        work = work.withColumn(name, F.col(f"_l_{name}") + F.col(f"_o_{name}"))
    spare = ["_k", "_block"] + [f"{p}{n}" for n in sums for p in ("_in_", "_l_", "_o_")]
    return work.drop(*spare)


def previous(df: DataFrame, keys: list, order: list, block: Column, values: list, prefix: str = "prev_") -> DataFrame:
    """The values of the row before, per key, in two levels like :func:`running`."""
    work = df.withColumn("_k", F.struct(*keys)).withColumn("_block", F.struct(block.alias("block")))
    inside = W.partitionBy("_k", "_block").orderBy(*order)
    row = F.struct(*values)
    tails = work.groupBy("_k", "_block").agg(F.max(F.struct(*order, row.alias("_row"))).alias("_t"))
    tails = tails.select("_k", "_block", F.lag(F.col("_t._row")).over(W.partitionBy("_k").orderBy("_block")).alias("_tail"))
    work = work.withColumn("_lag", F.lag(row).over(inside))
    work = work.join(tails, ["_k", "_block"])
    before = F.coalesce("_lag", "_tail")
    return work.select(*df.columns, *[before[v].alias(f"{prefix}{v}") for v in values])


def top_per_key(df: DataFrame, keys: list, order: list, k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per key; the rank filter also prunes every partition before the shuffle."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def newest(df: DataFrame, keys: list, order: Column, values: list) -> DataFrame:
    """The values of the last row per key by one partial aggregation."""
    kept = F.max_by(F.struct(*values), order).alias("_row")
    return df.groupBy(*keys).agg(kept).select(*keys, *[F.col("_row")[v].alias(v) for v in values])


def micros(ts: Column | str) -> Column:
    """Microseconds since 1970 of a zoneless timestamp, whatever the session zone."""
    c = F.col(ts) if isinstance(ts, str) else ts
    whole = F.datediff(c, F.lit("1970-01-01").cast("date")).cast("bigint") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60
    return whole * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
