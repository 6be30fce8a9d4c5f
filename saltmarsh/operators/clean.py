"""Projections, filters and cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scale import column_quantiles, quantile_scalars, quantiles, totals


def churn_flag(df: DataFrame) -> DataFrame:
    """``is_churned`` and its 0/1 form, taken before any filling."""
    flag = F.col("churn_date").isNotNull()
    return df.withColumn("is_churned", flag).withColumn("churned", flag.cast("int"))


def lifetime_days(df: DataFrame, as_of: Column) -> DataFrame:
    return df.withColumn("lifetime_days", F.datediff(F.coalesce("churn_date", as_of), "signup_date"))


def lifetime_value(df: DataFrame) -> DataFrame:
    return df.withColumn("clv", F.col("mrr") * (F.col("lifetime_days") / 30.0))


def calendar_parts(df: DataFrame, date: str) -> DataFrame:
    return (
        df.withColumn("signup_month", F.trunc(date, "MM"))
        .withColumn("month_number", F.month(date))
        .withColumn("quarter", F.quarter(date))
    )


def months_active(df: DataFrame, date: str, as_of: Column, recent_months: int = 12) -> DataFrame:
    """Calendar months since ``date`` and whether that is recent."""
    months = (F.year(as_of) - F.year(date)) * 12 + F.month(as_of) - F.month(date)
    return df.withColumn("months_active", months).withColumn("is_recent", F.col("months_active") <= recent_months)


def active_vs_churned(df: DataFrame, measures: list[str]) -> DataFrame:
    """Mean of each measure for active and for churned rows, in one pass."""
    aggs = []
    for m in measures:
        aggs.append(F.avg(F.when(~F.col("is_churned"), F.col(m))).alias(f"active_{m}"))
        aggs.append(F.avg(F.when(F.col("is_churned"), F.col(m))).alias(f"churned_{m}"))
    return df.agg(F.count_if(~F.col("is_churned")).alias("active"), F.count_if("is_churned").alias("churned"), *aggs)


def fill_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.fillna(0, subset=columns)


def impute(df: DataFrame, mean_of: list[str], median_of: list[str], mode_of: list[str]) -> DataFrame:
    """Fill with the mean, the median or the commonest value, keeping a missing-indicator per column."""
    out = df
    means = totals(df, **{c: F.avg(c) for c in mean_of}) if mean_of else {}
    for c in [*mean_of, *median_of, *mode_of]:
        out = out.withColumn(f"{c}_missing", F.col(c).isNull().cast("int"))
    for c in mean_of:
        out = out.withColumn(c, F.coalesce(F.col(c), means[c]))
    for c in median_of:
        out = out.withColumn(c, F.coalesce(F.col(c).cast("double"), quantile_scalars(df, c, {"m": 0.5})["m"]))
    for c in mode_of:
        counts = df.where(F.col(c).isNotNull()).groupBy(c).count()
        # the commonest value, the smallest one on ties
        best = counts.agg(F.min(F.struct((-F.col("count")).alias("n"), F.col(c).alias("v")))["v"].alias("v")).scalar()
        out = out.withColumn(c, F.coalesce(F.col(c), best, F.lit("Unknown")))
    return out


def null_rates(df: DataFrame) -> DataFrame:
    """One row per column: its type, how many NULLs, and their share."""
    one = df.agg(
        F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    long = one.unpivot(["_n"], df.columns, "column_name", "null_count")
    types = F.create_map(*[F.lit(x) for name, t in df.dtypes for x in (name, t)])
    return long.select(
        "column_name",
        types[F.col("column_name")].alias("data_type"),
        "null_count",
        F.try_divide("null_count", "_n").alias("null_share"),
    )


def rows_with_null(df: DataFrame) -> Column:
    """Count of rows with a NULL in any column, as an aggregate."""
    any_null = F.lit(False)
    for c in df.columns:
        any_null = any_null | F.col(c).isNull()
    return F.count_if(any_null)


def drop_sparse_columns(df: DataFrame, limit: float = 0.5) -> DataFrame:
    """Keep the columns whose share of NULLs is at most ``limit`` (one small row decides)."""
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if row[c] is not None and row[c] <= limit])


def drop_duplicates(df: DataFrame, keys: list[str], keep_first_by: list[str]) -> DataFrame:
    """One row per key, the smallest by ``keep_first_by``; combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys and c not in keep_first_by]
    row = F.min(F.struct(*keep_first_by, *rest)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, *[F.col("_row")[c].alias(c) for c in keep_first_by + rest])


def per_day(df: DataFrame, columns: dict[str, str], tenure: str = "tenure_days") -> DataFrame:
    """``x / (tenure + 1)`` under the given names."""
    for name, c in columns.items():
        df = df.withColumn(name, F.col(c) / (F.col(tenure) + 1))
    return df


def bin_cut(value: Column, edges: list[float], labels: list[str]) -> Column:
    """Right-closed bins; outside all of them NULL."""
    out = F.lit(None).cast("string")
    for lo, hi, label in reversed(list(zip(edges, edges[1:], labels))):
        out = F.when((value > lo) & (value <= hi), label).otherwise(out)
    return out


# Segment names in the order the rules are tried.
SEGMENTS = ["Power Users", "High Payers", "Active Users", "New Customers", "Low Value", "Steady Users"]


def segment_names(df: DataFrame, group: str) -> DataFrame:
    """Name each group by its averages against the quartiles of all rows; the first rule wins."""
    q = column_quantiles(
        df,
        {"mrr25": ("mrr", 0.25), "mrr75": ("mrr", 0.75), "usage75": ("usage_per_day", 0.75), "tenure25": ("tenure_days", 0.25)},
    )
    means = df.groupBy(group).agg(
        F.avg("mrr").alias("avg_mrr"), F.avg("usage_per_day").alias("avg_usage"), F.avg("tenure_days").alias("avg_tenure")
    )
    pays, uses = F.col("avg_mrr") > F.col("_q.mrr75"), F.col("avg_usage") > F.col("_q.usage75")
    rules = [
        pays & uses, pays, uses, F.col("avg_tenure") < F.col("_q.tenure25"), F.col("avg_mrr") < F.col("_q.mrr25"), F.lit(True),
    ]
    name = F.coalesce(*[F.when(rule, label) for rule, label in zip(rules, SEGMENTS)])
    return means.withColumn("_q", q).withColumn("segment", name).drop("_q")


def interactions(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Product of two numbers, or the joined text of two names."""
    kinds = dict(df.dtypes)
    for a, b in pairs:
        c = F.concat_ws("_", a, b) if kinds[a] == "string" else F.col(a) * F.col(b)
        df = df.withColumn(f"{a}_x_{b}", c)
    return df


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max, one row per column."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column_name", "x")
    long = long.where(F.col("x").isNotNull())
    basic = long.groupBy("column_name").agg(
        F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev("x").alias("std"),
        F.min("x").alias("min"), F.max("x").alias("max"),
    )
    q = quantiles(long, "x", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, ["column_name"]).drop("n")
    return basic.join(q, "column_name")
