"""Streaming forms (inventory 2.11), each checked against its batch meaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.tables import table
from ..streaming import streams as sm
from .documents import KIND_SQL
from .registry import query


def hour(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm").alias(c)


@query("stream_moderation", f"SELECT doc_id, {KIND_SQL} AS content_type, CASE {KIND_SQL} WHEN 'spam' THEN 'rejected' WHEN 'toxic' THEN 'needs_review' ELSE 'approved' END AS decision FROM documents")
def stream_moderation(spark, d):
    return sm.drain(sm.moderation(sm.read_stream(spark, d, "documents")).select("doc_id", "content_type", "decision"), "moderation")


@query("stream_event_counts", """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS started, event_type, count(*) AS events FROM events GROUP BY ALL""")
def stream_event_counts(spark, d):
    out = sm.drain_upserts(sm.event_counts(sm.read_stream(spark, d, "events")), "counts", ["started", "event_type"])
    return out.select(hour("started"), "event_type", "events")


@query("stream_event_counts_sliding", """WITH s AS (SELECT event_type, unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS started FROM events)
SELECT strftime(started, '%Y-%m-%d %H:%M') AS started, event_type, count(*) AS events FROM s GROUP BY ALL""")
def stream_event_counts_sliding(spark, d):
    out = sm.drain_upserts(sm.event_counts(sm.read_stream(spark, d, "events"), "2 hours", "1 hour"), "sliding", ["started", "event_type"])
    return out.select(hour("started"), "event_type", "events")


@query("stream_sessions", """WITH l AS (SELECT user_id, event_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
m AS (SELECT user_id, ts, sum(CASE WHEN prev IS NULL OR ts >= prev + INTERVAL 6 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM l)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M') AS started, count(*) AS events FROM m GROUP BY user_id, n""")
def stream_sessions(spark, d):
    out = sm.drain_upserts(sm.user_sessions(sm.read_stream(spark, d, "events")), "sessions", ["user_id", "first"])
    return out.withColumn("started", F.timestamp_millis("first")).select("user_id", hour("started"), "events")


@query("stream_sla_breach", """SELECT o_orderkey AS id, strftime(o_orderdate + INTERVAL 48 HOUR, '%Y-%m-%d %H:%M') AS deadline FROM orders
WHERE o_orderstatus = 'P' AND o_orderdate + INTERVAL 48 HOUR <= (SELECT max(o_orderdate) FROM orders)""")
def stream_sla_breach(spark, d):
    requests = sm.drain_upserts(sm.request_deadlines(sm.read_stream(spark, d, "orders")), "sla", ["id"])
    clock = table(spark, d, "orders").select(F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("at"))
    out = sm.sla_breaches(requests, clock)
    return out.withColumn("deadline", F.timestamp_millis("deadline")).select("id", hour("deadline"))


@query("stream_dedupe", "SELECT DISTINCT props AS message FROM events")
def stream_dedupe(spark, d):
    return sm.drain(sm.distinct_requests(sm.read_stream(spark, d, "events")).select(F.col("props").alias("message")), "dedupe")
