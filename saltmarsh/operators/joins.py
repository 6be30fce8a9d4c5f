"""Enrichment joins: the many side is reduced to one row per key before it is joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scale import quantile_scalars
from .clean import churn_flag, per_day


def event_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id").agg(F.count("*").alias("total_events"))


def usage_rollup(usage: DataFrame) -> DataFrame:
    """Total usage and distinct features per user, summed per (user, feature) first."""
    per_feature = usage.groupBy("user_id", "feature_name").agg(F.sum("usage_count").alias("feature_usage"))
    return per_feature.groupBy("user_id").agg(
        F.sum("feature_usage").alias("total_usage"), F.count("*").alias("feature_count")
    )


def left_enrich(base: DataFrame, *sides: DataFrame, key: str = "user_id") -> DataFrame:
    for side in sides:
        base = base.join(side, key, "left")
    return base


def profile(subs: DataFrame, events: DataFrame, usage: DataFrame) -> DataFrame:
    """Subscriptions with engagement totals, zero where a user has none."""
    df = left_enrich(churn_flag(subs), event_counts(events), usage_rollup(usage))
    df = df.fillna(0, subset=["tenure_days", "mrr", "total_events", "total_usage", "feature_count"])
    return per_day(df, {"usage_per_day": "total_usage", "events_per_day": "total_events"})


def customer_360(subs: DataFrame, events: DataFrame, usage: DataFrame, feedback: DataFrame) -> DataFrame:
    notes = feedback.groupBy("user_id").agg(
        F.count("*").alias("feedback_count"), F.avg("score").alias("avg_sentiment")
    )
    return left_enrich(profile(subs, events, usage), notes).fillna(0, subset=["feedback_count"])


def satisfied_but_at_risk(full: DataFrame, idle_days: Column | int = 180, share: float = 0.5) -> DataFrame:
    """Engaged above the given quantile and content, yet churned or idle for long."""
    level = quantile_scalars(full, "usage_per_day", {"q": share})["q"]
    return full.where(
        (F.col("usage_per_day") >= level)
        & (F.col("avg_sentiment") > 0)
        & (F.col("is_churned") | (F.col("idle_days") > idle_days))
    )


def join_report(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """What a left join on ``key`` would do, from key counts alone (no joined rows are produced)."""
    a = left.groupBy(key).agg(F.count("*").alias("_l"))
    b = right.groupBy(key).agg(F.count("*").alias("_r"))
    both = a.join(b, key, "full_outer")
    hit = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    return both.agg(
        F.coalesce(F.sum("_l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("_r"), F.lit(0)).alias("right_rows"),
        F.coalesce(F.sum(F.col("_l") * F.coalesce("_r", F.lit(1))), F.lit(0)).alias("joined_rows"),
        F.coalesce(F.sum(F.when(F.col("_r").isNull(), F.col("_l"))), F.lit(0)).alias("unmatched_left_rows"),
        F.coalesce(F.sum(F.when(F.col("_l").isNull(), F.col("_r"))), F.lit(0)).alias("unmatched_right_rows"),
        F.count_if(F.col("_r") > 1).alias("duplicate_right_keys"),
        F.count_if(hit).alias("matched_keys"),
    )


def not_done(planned: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Planned steps with no completed row."""
    return planned.join(done.select(*keys).distinct(), keys, "left_anti")
