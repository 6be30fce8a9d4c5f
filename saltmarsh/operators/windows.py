"""Ordered and windowed metrics, written so that a hot key does not end in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scale import micros, newest, previous, quantiles, running
from ..session import cut_lineage


def against_group(df: DataFrame, group: str, value: str) -> DataFrame:
    """Ratio to, deviation from and z-score against the group's own mean."""
    rows = df.withColumn("_k", F.struct(group))  # in a struct NULL equals NULL
    base = rows.groupBy("_k").agg(F.avg(value).alias("base_mean"), F.stddev_pop(value).alias("base_std"))
    x = F.col(value)
    return (
        rows.join(base, "_k")
        .drop("_k")
        .withColumn("ratio", F.try_divide(x, "base_mean"))
        .withColumn("deviation", x - F.col("base_mean"))
        .withColumn("z", F.try_divide(x - F.col("base_mean"), "base_std"))
    )


def growth(df: DataFrame, group: str, day: str, value: str) -> DataFrame:
    """Change of each row against the row before in its group."""
    steps = previous(df, [group], [day], F.trunc(day, "YEAR"), [value])
    return steps.withColumn("growth", F.try_divide(F.col(value), f"prev_{value}") - 1)


def retention(df: DataFrame, as_of: Column, days: list[int]) -> DataFrame:
    """Share of each signup month still there after N days; NULL for months not old enough."""
    age = F.datediff(as_of, F.last_day("signup_month"))
    out = df.withColumn("signup_month", F.trunc("signup_date", "MM")).groupBy("signup_month").agg(
        F.count("*").alias("users"), *[F.avg((F.col("lifetime_days") >= n).cast("double")).alias(f"d{n}") for n in days]
    )
    for n in days:
        out = out.withColumn(f"d{n}", F.when(age >= n, F.col(f"d{n}")))
    return out


def cumulative_first_uses(usage: DataFrame, subs: DataFrame, segment: str, step_days: int = 90) -> DataFrame:
    """Features newly taken up per step of a user's life, and their running sum, per segment."""
    first = usage.groupBy("user_id", "feature_name").agg(F.min("date").alias("first_use"))
    first = first.join(subs.select("user_id", segment, "signup_date"), "user_id")
    step = F.floor(F.datediff("first_use", "signup_date") / step_days).alias("step")
    new = first.groupBy(segment, step).agg(F.count("*").alias("new_uses"))
    w = W.partitionBy(segment).orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    return new.withColumn("cumulative_uses", F.sum("new_uses").over(w))


def velocity(usage: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Usage in the last ``days``, in the ``days`` before, and their difference."""
    age = F.datediff(as_of, "date")
    out = usage.groupBy("user_id").agg(
        F.coalesce(F.sum(F.when((age >= 0) & (age < days), F.col("usage_count"))), F.lit(0.0)).alias("recent"),
        F.coalesce(F.sum(F.when((age >= days) & (age < 2 * days), F.col("usage_count"))), F.lit(0.0)).alias("before"),
    )
    return out.withColumn("velocity", F.col("recent") - F.col("before"))


def recent_vs_history(usage: DataFrame, as_of: Column, days: int) -> DataFrame:
    """Mean use of the last ``days`` over the mean before them."""
    recent = F.datediff(as_of, "date") < days
    out = usage.groupBy("user_id").agg(
        F.avg(F.when(recent, F.col("usage_count"))).alias("recent_avg"), F.avg(F.when(~recent, F.col("usage_count"))).alias("history_avg")
    )
    ratio = F.try_divide("recent_avg", "history_avg")
    return out.withColumn("ratio", ratio).withColumn("is_declining", F.col("ratio") < 1)


def funnel(events: DataFrame, steps: list[str]) -> DataFrame:
    """Users whose first times of the steps follow each other, with rates to the step before and to the first."""
    first = events.groupBy("user_id").agg(*[F.min(F.when(F.col("event_type") == s, F.col("ts"))).alias(f"t{i}") for i, s in enumerate(steps)])
    reached = [F.col("t0").isNotNull()]
    for i in range(1, len(steps)):
        reached.append(reached[-1] & (F.col(f"t{i}") >= F.col(f"t{i - 1}")))
    counts = first.agg(*[F.count_if(F.coalesce(r, F.lit(False))).alias(f"n{i}") for i, r in enumerate(reached)])
    rows = F.array(*[
        F.struct(F.lit(i + 1).alias("step_no"), F.lit(s).alias("step"), F.col(f"n{i}").alias("users"),
                 F.try_divide(F.col(f"n{i}"), F.col(f"n{max(i - 1, 0)}")).alias("step_rate"), F.try_divide(F.col(f"n{i}"), F.col("n0")).alias("total_rate"))
        for i, s in enumerate(steps)
    ])
    return counts.select(F.inline(rows))


def sessions(events: DataFrame, gap_seconds: int) -> DataFrame:
    """Sessions per user: a new one starts after ``gap_seconds`` without an event."""
    rows = events.select("user_id", "event_id", "ts", micros("ts").alias("us"))
    steps = previous(rows, ["user_id"], ["ts", "event_id"], F.to_date("ts"), ["us"])
    starts = (F.col("prev_us").isNull() | (F.col("us") - F.col("prev_us") > gap_seconds * 1_000_000)).cast("bigint")
    steps = cut_lineage(steps.select("user_id", "event_id", "ts", "us", starts.alias("starts")))
    marked = running(steps, ["user_id"], ["ts", "event_id"], F.to_date("ts"), session_no=F.col("starts"))
    return marked.groupBy("user_id", "session_no").agg(
        F.count("*").alias("events"), F.min("ts").alias("started"), ((F.max("us") - F.min("us")) / 1_000_000).alias("seconds")
    )


def cumulative_share(parts: DataFrame, name: str, value: str, target: float = 0.95) -> DataFrame:
    """Parts by falling size with share, running share, and the first rank that reaches ``target``.

    ``parts`` has one row per component or dimension, which bounds the ordering.
    """
    order = W.orderBy(F.col(value).desc(), name)
    upto = order.rowsBetween(W.unboundedPreceding, 0)
    everything = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    out = parts.select(
        name, F.row_number().over(order).cast("bigint").alias("rank"), (F.col(value) / F.sum(value).over(everything)).alias("share"),
        (F.sum(value).over(upto) / F.sum(value).over(everything)).alias("cumulative"),
    )
    hit = F.min(F.when(F.col("cumulative") >= target, F.col("rank"))).over(W.orderBy("rank").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return out.withColumn("needed", hit)


def latest_checkpoints(log: DataFrame, keys: list[str]) -> DataFrame:
    values = [c for c in ("seq", "node", "state", "ts") if c not in keys]
    return newest(log, keys, F.col("seq"), values)


def checkpoint_trail(log: DataFrame) -> DataFrame:
    """Every checkpoint with its step number and the names in its state."""
    steps = running(log, ["workflow_id"], ["seq"], F.floor(F.col("seq") / 10_000), step=F.lit(1).cast("bigint"))
    return steps.withColumn("state_keys", F.array_join(F.json_object_keys("state"), ","))


def replay_point(log: DataFrame, node: str) -> DataFrame:
    """Newest checkpoint at ``node`` per workflow: the state to replay and how the log splits there."""
    at = F.col("node") == node
    point = log.groupBy("workflow_id").agg(
        F.max(F.when(at, F.col("seq"))).alias("replay_seq"), F.max_by(F.when(at, F.col("state")), F.when(at, F.col("seq"))).alias("state")
    )
    point = point.where(F.col("replay_seq").isNotNull())
    kept = F.col("seq") <= F.col("replay_seq")
    return log.join(point.drop("state"), "workflow_id").groupBy("workflow_id", "replay_seq").agg(
        F.count_if(kept).alias("kept"), F.count_if(~kept).alias("dropped")
    ).join(point.select("workflow_id", "state"), "workflow_id")


def cache_hits(requests: DataFrame, key: str = "message") -> DataFrame:
    """Flag requests whose key was seen before; only the first request ids are joined, never the keys."""
    first = requests.groupBy(key).agg(F.min_by("request_id", F.struct("ts", "request_id")).alias("request_id"))
    first = first.select("request_id", F.lit(False).alias("_hit"))
    return requests.join(first, "request_id", "left").withColumn("is_hit", F.coalesce("_hit", F.lit(True))).drop("_hit")


def p95_by_index(df: DataFrame, value: str, keys: list[str] | tuple = ()) -> DataFrame:
    """The value at sorted position ``int(0.95 n)``."""
    return quantiles(df, value, {"p95": 0.95}, list(keys), index=True)
