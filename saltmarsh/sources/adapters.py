"""The subject tables (subscriptions, usage, requests, ...) read from the input tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table

AS_OF = "2001-08-02"  # day after the last order
EVENTS_AS_OF = "2024-01-31"  # day after the last event
CHURN_AFTER_DAYS = 365


def day(text: str) -> Column:
    return F.lit(text).cast("date")


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", F.col("r_name").alias("region"))


def subscriptions(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    """One row per customer; churned when the last order is over a year old."""
    per_user = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("user_id"))
        .agg(
            F.min("o_orderdate").cast("date").alias("signup_date"),
            F.max("o_orderdate").cast("date").alias("last_date"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("spend"),
        )
    )
    users = table(spark, sf_dir, "customer").join(
        regions(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")
    )
    users = users.select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("plan_tier"), "region"
    ).join(per_user, "user_id", "left")
    churn = F.when(F.col("last_date") < F.date_sub(day(as_of), CHURN_AFTER_DAYS), F.col("last_date"))
    tenure = F.datediff(F.coalesce("churn_date", day(as_of)), "signup_date")
    return (
        users.withColumn("churn_date", churn)
        .withColumn("tenure_days", tenure)
        .withColumn("mrr", F.col("spend") / F.greatest(F.col("tenure_days") / 30.0, F.lit(1.0)))
        .select("user_id", "plan_tier", "region", "signup_date", "churn_date", "tenure_days", "mrr")
    )


def feature_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage rows (user, feature, amount, day) from order lines."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_custkey").alias("user_id"),
            F.col("p_brand").alias("feature_name"),
            F.col("l_quantity").alias("usage_count"),
            F.col("l_shipdate").cast("date").alias("date"),
        )
    )


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as feedback; sentiment (-1, 0, 1) only where a label exists."""
    score = F.col("quality") - F.col("toxic")
    return (
        table(spark, sf_dir, "documents")
        .join(table(spark, sf_dir, "labels"), "doc_id", "left")
        .select(
            F.col("doc_id").alias("feedback_id"),
            (F.col("doc_id") % 150).alias("user_id"),
            F.col("source").alias("category"),
            score.alias("score"),
            F.when(score > 0, "positive").when(score < 0, "negative").when(score == 0, "neutral").alias("sentiment"),
            "text",
        )
    )


def product_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("feature_id"),
        F.col("p_brand").alias("feature_name"),
        F.col("p_type").alias("tier"),
        F.date_add(day("1994-01-01"), F.col("p_size") * 7).alias("release_date"),
        F.element_at(F.split("p_name", " "), -1).alias("owner_team"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as service requests, dealt to three instances in turn."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"),
        F.concat(F.lit("instance-"), (F.col("event_id") % 3).cast("string")).alias("instance"),
        F.col("event_type").alias("endpoint"),
        F.col("props").alias("message"),
        "ts",
        "user_id",
        (F.col("value") * 10).alias("latency_ms"),
        F.floor("value").alias("tokens_used"),
        (F.col("event_type") == "error").alias("is_error"),
    )


def checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("workflow_id"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("node"),
        F.col("props").alias("state"),
        "ts",
    )


def approvals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as approval requests; decided at the first ship day not before creation."""
    orders = table(spark, sf_dir, "orders")
    shipped = (
        table(spark, sf_dir, "lineitem")
        .select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
        .join(orders.select("o_orderkey", F.col("o_orderdate").alias("placed")), "o_orderkey")
        .where(F.col("l_shipdate") >= F.col("placed"))
        .groupBy("o_orderkey")
        .agg(F.min("l_shipdate").alias("first_ship"))
    )
    status = (
        F.when(F.col("o_orderstatus") == "F", "approved").when(F.col("o_orderstatus") == "O", "rejected").otherwise("pending")
    )
    return orders.join(shipped, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("requester"),
        F.concat(F.lit("$"), F.format_number("o_totalprice", 2)).alias("amount"),
        ((6 - F.substring("o_orderpriority", 1, 1).cast("int")) / 5).alias("risk_score"),
        status.alias("status"),
        F.col("o_orderdate").alias("created_at"),
        F.when(status != "pending", F.col("first_ship")).alias("decided_at"),
    )


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in turn order; where a turn occurs twice, role and text decide."""
    return table(spark, sf_dir, "conversations")


def paperwork(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, plus one rendered business paper per order."""
    orders = table(spark, sf_dir, "orders")
    users = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    segment = F.concat(F.substring("c_mktsegment", 1, 1), F.lower(F.expr("substring(c_mktsegment, 2)")))
    money = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))
    invoice = F.concat(
        F.lit("INVOICE "), F.col("o_orderkey").cast("string"),
        F.lit("\nDate: "), F.date_format("o_orderdate", "MM/dd/yyyy"),
        F.lit("\nSold by Harbor Supplies to "), segment, F.lit(" Holdings\nAmount due: "),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("on request")).otherwise(money),
    )
    contract = F.concat(
        F.lit("This contract of "), F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.lit(" binds "), segment, F.lit(" Holdings"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(" alone")).otherwise(F.lit(" and Harbor Supplies")),
        F.lit(". They hereby agree to pay "), money, F.lit("."),
    )
    report = F.concat(
        F.lit("Quarter findings for "), segment, F.lit(" buyers: order "),
        F.col("o_orderkey").cast("string"), F.lit(" brought "), money, F.lit("."),
    )
    papers = orders.join(users, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("document_id"),
        F.when(F.col("o_orderstatus") == "F", invoice).when(F.col("o_orderstatus") == "O", contract).otherwise(report).alias("text"),
        F.lit("orders").alias("source"),
    )
    texts = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("document_id"), "text", "source"
    )
    return texts.unionByName(papers)


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rendered support mail per event."""
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k")
    sender = F.concat(F.lit("\nuser_"), F.col("user_id").cast("string"), F.lit("@example.com"))
    body = (
        F.when(kind == "error", F.concat(F.lit("The export fails with ERR_EXPORT_"), k, F.lit(".\n1. Open reports\n2. Click export "), k, F.lit("\nPlease help ASAP, needed by 8pm")))
        .when(kind == "click", F.concat(F.lit("Please add a dark mode, feature request "), k))
        .when(kind == "purchase", F.concat(F.lit("My invoice shows $"), F.format_number("value", 2), F.lit(" and I want a refund by tomorrow")))
        .when(kind == "view", F.lit("How do I open the dashboard?"))
        .otherwise(F.concat(F.lit("50% OFF for "), k, F.lit(" days! Buy now! Click here!")))
    )
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("ticket_id"), "user_id", F.concat(body, sender).alias("text"))
