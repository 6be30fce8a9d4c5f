"""Evaluation runs, request and trace logs, approvals, votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scale import micros, quantile_scalars, quantiles
from .textops import lookup, overlap, parse_money, pending_text
from .windows import p95_by_index

# Next step per approval status.
NEXT_STEP = {"approved": "execute_action", "rejected": "cancel_and_notify", "needs_info": "request_more_info"}


def score_runs(golden: DataFrame, runs: DataFrame, key: str = "case_id") -> DataFrame:
    """Accuracy, tool and latency checks per run, with the verdict."""
    df = golden.join(runs, key)
    accuracy = overlap(F.col("expected_output"), F.col("actual_output"))
    df = df.withColumn("accuracy", accuracy)
    df = df.withColumn("tool_ok", F.lower("expected_tool") == F.lower("actual_tool"))
    df = df.withColumn("latency_ok", F.col("latency_ms") <= F.col("max_latency_ms"))
    verdict = (
        F.when(F.col("tool_ok") & (F.col("accuracy") > 0.8) & F.col("latency_ok"), "pass")
        .when(F.col("tool_ok") | (F.col("accuracy") > 0.6), "partial").otherwise("fail")
    )
    return df.withColumn("result", verdict).withColumn("latency_score", F.when(F.col("latency_ok"), 1.0).otherwise(0.5))


def summarise_runs(scored: DataFrame) -> DataFrame:
    kinds = {"passed": "pass", "partial": "partial", "failed": "fail"}
    return scored.agg(
        F.count("*").alias("total_tests"), *[F.count_if(F.col("result") == v).alias(k) for k, v in kinds.items()],
        F.avg((F.col("result") == "pass").cast("double")).alias("pass_rate"), F.avg("accuracy").alias("avg_accuracy"), F.avg("latency_ms").alias("avg_latency_ms"),
    )


def failure_reasons(scored: DataFrame) -> DataFrame:
    """Runs that did not pass, counted by each reason they have."""
    reasons = F.filter(F.array(
        F.when(F.col("accuracy") <= 0.8, "low accuracy"), F.when(~F.col("tool_ok"), "wrong tool"), F.when(~F.col("latency_ok"), "too slow")
    ), lambda r: r.isNotNull())
    missed = scored.where(F.col("result") != "pass").select("result", F.explode(reasons).alias("reason"))
    return missed.groupBy("reason").agg(F.count("*").alias("runs"), F.count_if(F.col("result") == "fail").alias("failed"))


def unsupported(pairs: DataFrame, output: str, facts: str, threshold: float) -> DataFrame:
    """Outputs whose words are mostly absent from the facts."""
    return pairs.withColumn("support", overlap(F.col(output), F.col(facts))).withColumn("escalate", F.col("support") < threshold)


def trace_shares(spans: DataFrame, trace: str, step: str, value: str, limit: float) -> DataFrame:
    """Latency per trace and step, the step's share, and whether the whole trace stays within ``limit``."""
    steps = spans.groupBy(trace, step).agg(F.count("*").alias("spans"), F.sum(value).alias("step_ms"))
    whole = steps.groupBy(trace).agg(F.sum("step_ms").alias("total_ms"))
    out = steps.join(whole, trace)
    return out.withColumn("share", F.try_divide("step_ms", "total_ms")).withColumn("within_sla", F.col("total_ms") <= limit)


def request_stats(requests: DataFrame) -> DataFrame:
    """Requests, mean and index-method p95 per instance, and for all ('ALL')."""
    per = requests.groupBy("instance").agg(F.count("*").alias("requests"), F.avg("latency_ms").alias("avg_latency_ms"))
    per = per.join(p95_by_index(requests, "latency_ms", ["instance"]).select("instance", "p95"), "instance")
    p95 = p95_by_index(requests, "latency_ms").select("p95").scalar()
    every = requests.agg(F.count("*").alias("requests"), F.avg("latency_ms").alias("avg_latency_ms"))
    return per.unionByName(every.select(F.lit("ALL").alias("instance"), "requests", "avg_latency_ms", p95.alias("p95")))


def slo_report(requests: DataFrame, targets: dict[str, tuple[float, bool]], cost_per_token: float) -> DataFrame:
    """Measured service figures beside their targets; ``True`` in a target means lower is better."""
    q = quantile_scalars(requests, "latency_ms", {"p50": 0.5, "p95": 0.95, "p99": 0.99})
    span = (F.max(micros("ts")) - F.min(micros("ts"))) / 1_000_000
    one = requests.agg(
        (1 - F.avg(F.col("is_error").cast("double"))).alias("uptime"), F.avg(F.col("is_error").cast("double")).alias("error_rate"),
        F.try_divide(F.count("*"), span).alias("requests_per_second"), (F.avg("tokens_used") * cost_per_token).alias("cost_per_request"),
    ).select("*", q["p50"].alias("p50_ms"), q["p95"].alias("p95_ms"), q["p99"].alias("p99_ms"))
    long = one.unpivot([], one.columns, "metric", "value")
    target = lookup(F.col("metric"), {k: v[0] for k, v in targets.items()})
    lower = lookup(F.col("metric"), {k: v[1] for k, v in targets.items()})
    met = F.when(lower, F.col("value") <= F.col("target")).otherwise(F.col("value") >= F.col("target"))
    return long.withColumn("target", target).withColumn("met", met)


def slow_instances(requests: DataFrame, limit_ms: float) -> DataFrame:
    out = requests.groupBy("instance").agg(F.avg("latency_ms").alias("avg_latency_ms"))
    return out.withColumn("scale_up", F.col("avg_latency_ms") > limit_ms)


def task_stats(tasks: DataFrame, as_of: Column) -> DataFrame:
    """Tasks and mean duration per status; open tasks run to ``as_of``."""
    seconds = (micros(F.coalesce("decided_at", as_of)) - micros("created_at")) / 1_000_000
    return tasks.groupBy("status").agg(F.count("*").alias("tasks"), F.avg(seconds).alias("mean_seconds"))


# ---- approvals


def escalations(approvals: DataFrame, risk_above: float = 0.8, amount_above: float = 100_000) -> DataFrame:
    """High risk, or a dollar amount above the limit; the first reason is kept."""
    worth = F.when(F.col("amount").contains("$"), parse_money(F.col("amount")))
    reason = F.when(F.col("risk_score") > risk_above, "risk").when(worth > amount_above, "amount")
    return approvals.withColumn("escalation", reason).withColumn("is_escalated", reason.isNotNull())


def next_step(status: Column) -> Column:
    return F.coalesce(lookup(status, NEXT_STEP), F.lit("wait_for_decision"))


def sla(approvals: DataFrame, as_of: Column, hours: int) -> DataFrame:
    """Deadline, breach and waiting time; open requests past the deadline are stale."""
    deadline = F.col("created_at") + F.expr(f"INTERVAL {hours} HOURS")
    ended = F.coalesce("decided_at", as_of)
    minutes = (micros(ended) - micros("created_at")) / 60_000_000
    return (
        approvals.withColumn("sla_deadline", deadline).withColumn("is_breached", ended > deadline)
        .withColumn("pending_for", pending_text(minutes))
        .withColumn("is_stale", (F.col("status") == "pending") & (as_of > deadline))
    )


def approval_metrics(approvals: DataFrame) -> DataFrame:
    hours = ((micros("decided_at") - micros("created_at")) / 3_600_000_000).alias("hours")
    decided = approvals.where(F.col("decided_at").isNotNull()).select(hours)
    p95 = quantile_scalars(decided, "hours", {"p95": 0.95})["p95"]
    closed = F.col("status") != "pending"
    rows = escalations(approvals)
    appeal = (F.col("status") == "rejected") & (F.col("risk_score") < 0.5)
    out = rows.agg(
        F.count("*").alias("requests"), F.avg((micros("decided_at") - micros("created_at")) / 3_600_000_000).alias("mean_hours"),
        F.try_divide(F.count_if(F.col("status") == "approved"), F.count_if(closed)).alias("approval_rate"),
        F.avg(F.col("is_escalated").cast("double")).alias("escalation_rate"), F.avg(appeal.cast("double")).alias("appeal_rate"),
    )
    return out.withColumn("p95_hours", p95)


def audit_trail(approvals: DataFrame) -> DataFrame:
    """Submitted, escalated and decided entries per request in order; built inside the row."""
    rows = escalations(approvals)
    entry = F.struct
    trail = F.filter(F.array(
        entry(F.col("created_at").alias("at"), F.lit("submitted").alias("action"), F.col("amount").alias("note")),
        F.when(F.col("is_escalated"), entry(F.col("created_at").alias("at"), F.lit("escalated").alias("action"), F.col("escalation").alias("note"))),
        F.when(F.col("status") != "pending", entry(F.col("decided_at").alias("at"), F.col("status").alias("action"), next_step(F.col("status")).alias("note"))),
    ), lambda e: e.isNotNull())
    return rows.select("id", F.posexplode(trail).alias("step", "e")).select("id", "step", "e.at", "e.action", "e.note")


def expense_decisions(approvals: DataFrame, limit: float, review_above: float, risk_above: float) -> DataFrame:
    """Policy errors per expense row and the desk it goes to."""
    worth = parse_money(F.col("amount"))
    errors = F.filter(F.array(
        F.when(worth.isNull(), "amount unreadable"), F.when(worth > limit, "over limit"), F.when(F.dayofweek("created_at").isin(1, 7), "weekend")
    ), lambda e: e.isNotNull())
    df = approvals.withColumn("worth", worth).withColumn("policy_errors", errors)
    desk = (
        F.when((F.col("worth") > review_above) | (F.col("risk_score") > risk_above), "director")
        .when(F.size("policy_errors") > 0, "manager").otherwise("payment")
    )
    return df.withColumn("desk", desk)


def consensus(votes: DataFrame, proposal: str, vote: str, yes: str, no: str) -> DataFrame:
    out = votes.groupBy(proposal).agg(
        F.count("*").alias("votes"), F.count_if(F.col(vote) == yes).alias("agree"), F.count_if(F.col(vote) == no).alias("objections")
    )
    return out.withColumn("outcome", F.when(F.col("agree") * 2 > F.col("votes"), "consensus").otherwise("escalate"))


def region_ranking(sales: DataFrame, region: str, quarter: str, value: str) -> DataFrame:
    """Revenue, rank, deal size and quarter growth; windows run over the (region, quarter) totals."""
    cells = sales.groupBy(region, quarter).agg(F.sum(F.col(value).cast("decimal(18,2)")).alias("r"), F.count("*").alias("deals"))
    steps = cells.withColumn("before", F.lag("r").over(W.partitionBy(region).orderBy(quarter)))
    steps = steps.withColumn("growth", F.try_divide(F.col("r").cast("double"), F.col("before").cast("double")) - 1)
    out = steps.groupBy(region).agg(
        F.sum("r").cast("double").alias("revenue"), F.sum("deals").alias("deals"), F.avg("growth").alias("mean_growth"),
        F.count_if(F.abs("growth") > 0.5).alias("unusual_quarters"),
    )
    out = out.withColumn("avg_deal", F.try_divide("revenue", "deals"))
    return out.withColumn("rank", F.dense_rank().over(W.orderBy(F.col("revenue").desc())))


def readability(df: DataFrame, text: str = "text", words_per_minute: int = 200) -> DataFrame:
    sentences = F.size(F.filter(F.split(text, r"[.!?]+"), lambda s: F.trim(F.regexp_replace(s, r"\s+", " ")) != ""))
    words = F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))
    return df.withColumn("sentences", sentences).withColumn("words", words).withColumn(
        "words_per_sentence", F.try_divide("words", "sentences")
    ).withColumn("read_minutes", F.col("words") / words_per_minute)


def latency_quantiles(requests: DataFrame, keys: list[str]) -> DataFrame:
    return quantiles(requests, "latency_ms", {"p50": 0.5, "p95": 0.95, "p99": 0.99}, keys)
