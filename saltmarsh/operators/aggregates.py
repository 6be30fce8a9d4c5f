"""Grouped and whole-table aggregation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scale import previous, quantile_scalars, quantiles, totals
from ..session import cut_lineage


def value_stats(df: DataFrame, value: str) -> DataFrame:
    """count, mean, median, population std, min, max and P95 of one column."""
    df = cut_lineage(df.select(value))  # the passes below read this one column, not the joins behind it
    q = quantile_scalars(df, value, {"median": 0.5, "p95": 0.95})
    return df.agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"),
    ).select("*", q["median"].alias("median"), q["p95"].alias("p95"))


def at_or_above(df: DataFrame, value: str, p: float) -> DataFrame:
    """Rows whose value reaches the ``p`` quantile, with that threshold."""
    level = quantile_scalars(df, value, {"q": p})["q"]
    return df.withColumn("threshold", level).where(F.col(value) >= F.col("threshold"))


def per_user_usage(usage: DataFrame) -> DataFrame:
    return usage.groupBy("user_id").agg(
        F.sum("usage_count").alias("total_usage"), F.avg("usage_count").alias("avg_usage"), F.count("*").alias("usage_rows")
    )


def zscores(df: DataFrame, value: str) -> DataFrame:
    s = totals(df, mean=F.avg(value), std=F.stddev_pop(value))
    return df.withColumn("z", F.try_divide(F.col(value) - s["mean"], s["std"]))


def ranked_sum(df: DataFrame, group: str, value: str, k: int) -> DataFrame:
    total = df.groupBy(group).agg(F.sum(value).alias("total"))
    return total.orderBy(F.col("total").desc(), group).limit(k)


def event_profile(events: DataFrame) -> DataFrame:
    """Per user: events, first and last, mean value, events per active day."""
    base = events.groupBy("user_id").agg(
        F.count("*").alias("events"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.avg("value").alias("avg_value")
    )
    return base.withColumn("events_per_day", F.col("events") / (F.datediff("last_ts", "first_ts") + 1))


def churn_rates(df: DataFrame, *groups: str | Column) -> DataFrame:
    return df.groupBy(*groups).agg(
        F.count("*").alias("users"), F.sum("churned").alias("churned"), F.avg("churned").alias("churn_rate")
    )


def churn_cube(df: DataFrame, a: str, b: str) -> DataFrame:
    """Churn per (a, b) with all subtotals; 'ALL' marks a summed-over column."""
    out = df.cube(a, b).agg(
        F.grouping(a).alias("_ga"), F.grouping(b).alias("_gb"), F.count("*").alias("users"), F.sum("churned").alias("churned"),
        F.avg("churned").alias("churn_rate"),
    )
    return out.select(
        F.when(F.col("_ga") == 1, "ALL").otherwise(F.col(a)).alias(a), F.when(F.col("_gb") == 1, "ALL").otherwise(F.col(b)).alias(b),
        "users", "churned", "churn_rate",
    )


def modal_value(df: DataFrame, group: str, value: str) -> DataFrame:
    """Commonest value per group, the smallest on ties, from counts per (group, value)."""
    counts = df.groupBy(group, value).agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col(value).alias("v"))).alias("b")
    return counts.groupBy(group).agg(best).select(group, F.col("b.v").alias(f"modal_{value}"))


def lift_above(df: DataFrame, score: str, label: str, p: float = 0.8) -> DataFrame:
    """Size and positive rate of the rows at or above the ``p`` quantile, and lift over all rows."""
    level = quantile_scalars(df, score, {"q": p})["q"]
    rows = df.withColumn("_top", F.col(score) >= level)
    out = rows.agg(
        F.count_if("_top").alias("bucket_size"), F.avg(F.when(F.col("_top"), F.col(label))).alias("bucket_rate"), F.avg(label).alias("overall_rate")
    )
    return out.withColumn("lift", F.try_divide("bucket_rate", "overall_rate"))


def shares_by_day(counts: DataFrame, value: str = "users") -> DataFrame:
    """Each (day, region) count with the day's total and its share; a day has one row per region."""
    w = W.partitionBy("day")
    return counts.withColumn("day_total", F.sum(value).over(w)).withColumn("share", F.col(value) / F.col("day_total"))


def period_change(df: DataFrame, group: str, date: str, value: str, as_of: Column, days: int) -> DataFrame:
    """Sum in the last ``days`` against the ``days`` before, per group."""
    age = F.datediff(as_of, date)
    out = df.groupBy(group).agg(
        F.sum(F.when((age > 0) & (age <= days), F.col(value))).alias("recent"),
        F.sum(F.when((age > days) & (age <= 2 * days), F.col(value))).alias("before"),
    )
    return out.withColumn("change", F.try_divide("recent", "before") - 1)


def plan_moves(df: DataFrame, user: str, order: list[str], plan: str, block: Column) -> DataFrame:
    """How often users went from one plan to another between consecutive rows."""
    steps = previous(df, [user], order, block, [plan])
    moved = F.col(f"prev_{plan}").isNotNull() & (F.col(f"prev_{plan}") != F.col(plan))
    return steps.where(moved).groupBy(F.col(f"prev_{plan}").alias("from_plan"), F.col(plan).alias("to_plan")).agg(
        F.count("*").alias("moves"), F.countDistinct(user).alias("users")
    )


PAIRS_AT_ONCE = 1 << 21


def _pair_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Joint counts of the pairs of sorted baskets, sparsely: the pairs themselves are listed, at most ``PAIRS_AT_ONCE`` at a time.

    Item k of a basket of n leads n - 1 - k pairs, so a piece may begin and end inside a basket. Memory hangs on the
    piece and the batch, not on the number of items.
    """
    for pdf in batches:
        baskets = pdf["basket"].tolist()
        names, idx = np.unique(np.concatenate([np.asarray(b, dtype=object) for b in baskets]).astype(str), return_inverse=True)
        sizes = np.array([len(b) for b in baskets])
        last = np.repeat(np.cumsum(sizes), sizes)
        begin = np.concatenate([[0], np.cumsum(last - np.arange(len(idx)) - 1)])  # pairs led by the items before
        for lo in range(0, int(begin[-1]), PAIRS_AT_ONCE):
            pair = np.arange(lo, min(lo + PAIRS_AT_ONCE, int(begin[-1])))
            lead = np.searchsorted(begin, pair, side="right") - 1
            follow = lead + 1 + pair - begin[lead]
            code, n = np.unique(idx[lead].astype("int64") * len(names) + idx[follow], return_counts=True)
            yield pd.DataFrame({"a": names[code // len(names)], "b": names[code % len(names)], "n": n.astype("int64")})


def joint_use(df: DataFrame, user: str, item: str, min_support: float = 0.0) -> DataFrame:
    """Pairs of different items used by the same users, ``a`` before ``b`` in order: count, support and lift.

    A pair is in no more baskets than either item, so items below ``min_support`` (a share of all users) leave
    before baskets are formed; with 0 every pair that occurs is returned. Then pairs below it leave. Tasks turn batches of
    baskets into joint counts, and only those counts are shuffled. A basket holds each item once; a NULL item is no item, a
    NULL user is a user as any other.
    """
    rows = cut_lineage(df.select(F.struct(user).alias("_user"), F.col(item).alias("_item")).distinct())
    users = totals(rows, n=F.countDistinct("_user"))["n"]
    used = rows.where(F.col("_item").isNotNull())
    single = cut_lineage(used.groupBy("_item").agg(F.count("*").alias("n")))
    if min_support > 0:
        single = single.where(F.col("n") >= users * min_support)
        used = used.join(single.select("_item"), "_item")
    baskets = used.groupBy("_user").agg(F.array_sort(F.collect_list("_item")).alias("basket")).where(F.size("basket") > 1)
    counts = baskets.select("basket").mapInPandas(_pair_counts, "a string, b string, n bigint")
    pairs = counts.groupBy("a", "b").agg(F.sum("n").alias("both")).withColumn("users", users)
    if min_support > 0:
        pairs = pairs.where(F.col("both") >= F.col("users") * min_support)
    out = pairs.join(single.select(F.col("_item").alias("a"), F.col("n").alias("n_a")), "a")
    out = out.join(single.select(F.col("_item").alias("b"), F.col("n").alias("n_b")), "b")
    return out.select(
        "a", "b", "both", (F.col("both") / F.col("users")).alias("support"),
        (F.col("both") * F.col("users") / (F.col("n_a") * F.col("n_b"))).alias("lift"),
    )


def group_median(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    return quantiles(df, value, {name: 0.5}, [group]).drop("n")
