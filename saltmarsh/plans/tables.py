"""Scans, sinks, cleaning and joins (inventory 2.1 to 2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scale import quantile_scalars, totals
from ..operators import clean, joins
from ..operators import sessions as ses
from ..session import cut_lineage, scratch_path
from ..sources import adapters as ad
from ..sources import tables as src
from .oracle import with_
from .registry import query, rnd, text


def today():
    return ad.day(ad.AS_OF)


def profile(spark, d):
    return joins.profile(ad.subscriptions(spark, d), ad.user_events(spark, d), ad.feature_usage(spark, d))


def stored_subscriptions(spark, d):
    """Subscriptions as a written table, likewise."""
    return cut_lineage(ad.subscriptions(spark, d))


def stored_profile(spark, d):
    """The profile as a written table, for queries that pass over it several times."""
    return cut_lineage(profile(spark, d))


# ---- 2.1 scans, sources, sinks


@query("scan_csv", with_("subs") + "SELECT user_id, plan_tier, CAST(signup_date AS VARCHAR) AS signup_date, "
       "CAST(churn_date AS VARCHAR) AS churn_date, round(mrr, 6) AS mrr FROM subs")
def scan_csv(spark, d):
    path = scratch_path(spark, "csv")
    subs = ad.subscriptions(spark, d).select("user_id", "plan_tier", "signup_date", "churn_date", "mrr")
    subs.write.option("header", True).csv(path)
    back = src.read_csv(spark, path, "user_id BIGINT, plan_tier STRING, signup_date DATE, churn_date DATE, mrr DOUBLE")
    return back.select("user_id", "plan_tier", text("signup_date").alias("signup_date"), text("churn_date").alias("churn_date"), rnd("mrr").alias("mrr"))


@query("scan_json", with_("feedback") + "SELECT feedback_id, user_id, category, sentiment, CAST(length(text) AS BIGINT) AS n_chars FROM feedback")
def scan_json(spark, d):
    path = scratch_path(spark, "json")
    ad.feedback(spark, d).write.json(path)
    back = src.read_json(spark, path, "feedback_id BIGINT, user_id BIGINT, category STRING, sentiment STRING, text STRING")
    return back.select("feedback_id", "user_id", "category", "sentiment", F.length("text").cast("bigint").alias("n_chars"))


@query("scan_json_array", with_("feedback") + "SELECT feedback_id, user_id, category, sentiment, CAST(length(text) AS BIGINT) AS n_chars FROM feedback")
def scan_json_array(spark, d):
    """The same rows through files of arrays, a thousand objects to an array."""
    path = scratch_path(spark, "json-array")
    rows = ad.feedback(spark, d).select(F.floor(F.col("feedback_id") / 1000).alias("page"), F.to_json(F.struct("feedback_id", "user_id", "category", "sentiment", "text")).alias("o"))
    rows.groupBy("page").agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("o"), ",\n"), F.lit("\n]")).alias("value")).select("value").write.text(path)
    back = src.read_json_array(spark, path, "feedback_id BIGINT, user_id BIGINT, category STRING, sentiment STRING, text STRING")
    return back.select("feedback_id", "user_id", "category", "sentiment", F.length("text").cast("bigint").alias("n_chars"))


@query("scan_sql", "SELECT c_mktsegment AS plan_tier, count(*) AS n, round(avg(c_acctbal), 4) AS avg_balance FROM customer WHERE c_acctbal > 0 GROUP BY 1")
def scan_sql(spark, d):
    return src.read_sql(
        spark,
        "SELECT c_mktsegment AS plan_tier, count(*) AS n, round(avg(c_acctbal), 4) AS avg_balance "
        "FROM {users} WHERE c_acctbal > 0 GROUP BY c_mktsegment",
        users=src.table(spark, d, "customer"),
    )


@query("scan_parquet", "SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem WHERE l_shipdate >= DATE '1998-01-01' GROUP BY 1, 2")
def scan_parquet(spark, d):
    lines = src.table(spark, d, "lineitem").where(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return lines.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@query("scan_text_docs", "SELECT source, count(*) AS documents, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY 1")
def scan_text_docs(spark, d):
    docs = src.table(spark, d, "documents").select("source", "text")
    return docs.groupBy("source").agg(F.count("*").alias("documents"), F.sum(F.length("text")).alias("chars"))


@query("table_overview", with_("usage") + """SELECT count(*) AS row_count, CAST(4 AS BIGINT) AS column_count, CAST(min(date) AS VARCHAR) AS first_date,
 CAST(max(date) AS VARCHAR) AS last_date, count(DISTINCT user_id) AS users, count(DISTINCT feature_name) AS features FROM usage""")
def table_overview(spark, d):
    usage = ad.feature_usage(spark, d)
    return usage.agg(
        F.count("*").alias("row_count"),
        F.lit(len(usage.columns)).cast("bigint").alias("column_count"),
        text(F.min("date")).alias("first_date"),
        text(F.max("date")).alias("last_date"),
        F.countDistinct("user_id").alias("users"),
        F.countDistinct("feature_name").alias("features"),
    )


@query("schema_null_audit", with_("feedback") + """, one AS (SELECT count(*) AS n, count(*) FILTER (WHERE score IS NULL OR sentiment IS NULL OR text IS NULL OR category IS NULL) AS any_null,
 count(*) FILTER (WHERE feedback_id IS NULL) a, count(*) FILTER (WHERE user_id IS NULL) b, count(*) FILTER (WHERE category IS NULL) c,
 count(*) FILTER (WHERE score IS NULL) s, count(*) FILTER (WHERE sentiment IS NULL) e, count(*) FILTER (WHERE text IS NULL) t FROM feedback)
SELECT u.column_name, u.data_type, u.null_count, round(u.null_count / CAST(n AS DOUBLE), 6) AS null_share, any_null AS rows_with_null
FROM one, LATERAL (VALUES ('feedback_id', 'bigint', a), ('user_id', 'bigint', b), ('category', 'string', c), ('score', 'int', s), ('sentiment', 'string', e), ('text', 'string', t)) u(column_name, data_type, null_count)""")
def schema_null_audit(spark, d):
    df = ad.feedback(spark, d)
    any_null = totals(df, n=clean.rows_with_null(df))["n"]
    return clean.null_rates(df).select(
        "column_name", "data_type", "null_count", rnd("null_share").alias("null_share"), any_null.alias("rows_with_null")
    )


@query("describe_table", with_("subs") + """, long AS (SELECT 'mrr' AS column_name, CAST(mrr AS DOUBLE) AS x FROM subs UNION ALL SELECT 'tenure_days', CAST(tenure_days AS DOUBLE) FROM subs)
SELECT column_name, count(x) AS count, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std, round(min(x), 4) AS min, round(quantile_cont(x, 0.25), 4) AS q25,
 round(quantile_cont(x, 0.5), 4) AS q50, round(quantile_cont(x, 0.75), 4) AS q75, round(max(x), 4) AS max FROM long GROUP BY 1""")
def describe_table(spark, d):
    out = clean.describe(stored_subscriptions(spark, d), ["mrr", "tenure_days"])
    return out.select("column_name", "count", *[rnd(c, 4).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])


SESSION_SQL = """WITH pos AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS p FROM conversations)
"""


@query("sink_json_sessions", SESSION_SQL + """SELECT conv_id AS user_id, p // 1000 AS page, count(*) AS messages,
 md5(string_agg((CASE WHEN role = 'user' THEN 'human' ELSE 'ai' END) || ':' || text, chr(10) ORDER BY p)) AS digest FROM pos GROUP BY 1, 2""")
def sink_json_sessions(spark, d):
    path = scratch_path(spark, "sessions")
    ses.write_sessions(ad.conversations(spark, d), path)
    page = src.read_json(spark, path, ses.SESSION_SCHEMA)
    lines = F.transform("messages", lambda m: F.concat(m["type"], F.lit(":"), m["content"]))
    return page.select("user_id", "page", F.size("messages").cast("bigint").alias("messages"), F.md5(F.array_join(lines, "\n")).alias("digest"))


@query("load_json_sessions", SESSION_SQL + """SELECT conv_id AS user_id, p // 2 AS interaction, md5(max(CASE WHEN p % 2 = 0 THEN text END)) AS input_digest,
 md5(max(CASE WHEN p % 2 = 1 THEN text END)) AS output_digest FROM pos GROUP BY 1, 2 HAVING count(*) = 2""")
def load_json_sessions(spark, d):
    path = scratch_path(spark, "sessions")
    ses.write_sessions(ad.conversations(spark, d), path)
    pairs = ses.load_sessions(src.read_json(spark, path, ses.SESSION_SCHEMA))
    return pairs.select("user_id", "interaction", F.md5("input").alias("input_digest"), F.md5("output").alias("output_digest"))


@query("load_stage_output", with_("subs") + "SELECT region, count(*) AS users, round(sum(mrr), 2) AS mrr FROM subs GROUP BY 1")
def load_stage_output(spark, d):
    path = scratch_path(spark, "stage")
    src_rows = ad.subscriptions(spark, d).repartition("region", F.pmod(F.hash("user_id"), F.lit(16)))
    src_rows.write.mode("overwrite").partitionBy("region").parquet(path)
    back = spark.read.schema(src_rows.schema).parquet(path)
    return back.groupBy("region").agg(F.count("*").alias("users"), rnd(F.sum("mrr"), 2).alias("mrr"))


# ---- 2.2 projections, filters, cleaning


@query("churn_flag", with_("subs") + "SELECT user_id, churn_date IS NOT NULL AS is_churned, CAST(churn_date IS NOT NULL AS INT) AS churned FROM subs")
def churn_flag(spark, d):
    return clean.churn_flag(ad.subscriptions(spark, d)).select("user_id", "is_churned", "churned")


@query("lifetime_days", with_("subs") + "SELECT user_id, date_diff('day', signup_date, coalesce(churn_date, DATE '2001-08-02')) AS lifetime_days FROM subs")
def lifetime_days(spark, d):
    out = clean.lifetime_days(ad.subscriptions(spark, d), today())
    return out.select("user_id", F.col("lifetime_days").cast("bigint").alias("lifetime_days"))


@query("lifetime_value", with_("subs") + "SELECT user_id, round(mrr * (tenure_days / 30.0::DOUBLE), 4) AS clv FROM subs")
def lifetime_value(spark, d):
    out = clean.lifetime_value(clean.lifetime_days(ad.subscriptions(spark, d), today()))
    return out.select("user_id", rnd("clv", 4).alias("clv"))


@query("lifetime_edge_cases", """SELECT l_returnflag, count(*) AS n, count(*) FILTER (WHERE l_shipdate < o_orderdate) AS negative_lifetimes,
 CAST(min(date_diff('day', o_orderdate, l_shipdate)) AS BIGINT) AS shortest,
 count(*) FILTER (WHERE try_cast('2000-' || lpad(CAST(l_orderkey % 14 + 1 AS VARCHAR), 2, '0') || '-15' AS DATE) IS NULL) AS invalid_dates
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def lifetime_edge_cases(spark, d):
    lines = src.table(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_shipdate")
    orders = src.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    days = F.datediff("l_shipdate", "o_orderdate")
    # month numbers run past 12 here, so some of these texts are no dates
    written = F.concat(F.lit("2000-"), F.lpad((F.col("l_orderkey") % 14 + 1).cast("string"), 2, "0"), F.lit("-15"))
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_returnflag")
        .agg(
            F.count("*").alias("n"),
            F.count_if(days < 0).alias("negative_lifetimes"),
            F.min(days).cast("bigint").alias("shortest"),
            F.count_if(written.try_cast("date").isNull()).alias("invalid_dates"),
        )
    )


@query("calendar_parts", with_("subs") + """SELECT user_id, CAST(CAST(date_trunc('month', signup_date) AS DATE) AS VARCHAR) AS signup_month,
 CAST(month(signup_date) AS INT) AS month_number, CAST(quarter(signup_date) AS INT) AS quarter FROM subs""")
def calendar_parts(spark, d):
    out = clean.calendar_parts(ad.subscriptions(spark, d), "signup_date")
    return out.select("user_id", text("signup_month").alias("signup_month"), "month_number", "quarter")


@query("is_recent_flag", with_("subs") + """SELECT user_id, CAST((2001 - year(signup_date)) * 12 + 8 - month(signup_date) AS INT) AS months_active,
 (2001 - year(signup_date)) * 12 + 8 - month(signup_date) <= 70 AS is_recent FROM subs""")
def is_recent_flag(spark, d):
    return clean.months_active(ad.subscriptions(spark, d), "signup_date", today(), 70).select("user_id", "months_active", "is_recent")


@query("filter_date_from", "SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-01'")
def filter_date_from(spark, d):
    orders = src.table(spark, d, "orders").where(F.col("o_orderdate") >= F.lit("2001-07-01").cast("timestamp_ntz"))
    return orders.select("o_orderkey", rnd("o_totalprice", 2).alias("o_totalprice"))


@query("filter_active_churned", with_("profile") + """SELECT count(*) FILTER (WHERE NOT is_churned) AS active, count(*) FILTER (WHERE is_churned) AS churned,
 round(avg(total_events) FILTER (WHERE NOT is_churned), 6) AS active_total_events, round(avg(total_events) FILTER (WHERE is_churned), 6) AS churned_total_events,
 round(avg(total_usage) FILTER (WHERE NOT is_churned), 6) AS active_total_usage, round(avg(total_usage) FILTER (WHERE is_churned), 6) AS churned_total_usage,
 round(avg(feature_count) FILTER (WHERE NOT is_churned), 6) AS active_feature_count, round(avg(feature_count) FILTER (WHERE is_churned), 6) AS churned_feature_count FROM profile""")
def filter_active_churned(spark, d):
    measures = ["total_events", "total_usage", "feature_count"]
    out = clean.active_vs_churned(profile(spark, d), measures)
    return out.select("active", "churned", *[rnd(f"{s}_{m}").alias(f"{s}_{m}") for m in measures for s in ("active", "churned")])


@query("fill_zero", with_("profile") + "SELECT user_id, total_events, total_usage, feature_count FROM profile")
def fill_zero(spark, d):
    subs, ev, us = ad.subscriptions(spark, d), ad.user_events(spark, d), ad.feature_usage(spark, d)
    df = joins.left_enrich(subs, joins.event_counts(ev), joins.usage_rollup(us))
    df = clean.fill_zero(df, ["total_events", "total_usage", "feature_count"])
    return df.select("user_id", "total_events", "total_usage", "feature_count")


@query("impute_mean_median_mode", with_("feedback") + """, m AS (SELECT avg(score) AS mean_score, (SELECT sentiment FROM feedback WHERE sentiment IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mode_s,
 (SELECT median(CAST(n_chars AS DOUBLE)) FROM documents d JOIN labels l ON d.doc_id = l.doc_id) AS med FROM feedback)
SELECT f.feedback_id, round(coalesce(f.score, m.mean_score), 6) AS score, CAST(f.score IS NULL AS INT) AS score_missing,
 coalesce(f.sentiment, m.mode_s) AS sentiment, CAST(f.sentiment IS NULL AS INT) AS sentiment_missing,
 round(CASE WHEN f.score IS NOT NULL THEN CAST(length(f.text) AS DOUBLE) ELSE m2.med END, 6) AS size, CAST(f.score IS NULL AS INT) AS size_missing
FROM feedback f, m, (SELECT median(CAST(length(text) AS DOUBLE)) AS med FROM feedback WHERE score IS NOT NULL) m2""")
def impute_mean_median_mode(spark, d):
    df = ad.feedback(spark, d).select(
        "feedback_id", "score", "sentiment", F.when(F.col("score").isNotNull(), F.length("text")).alias("size")
    )
    out = clean.impute(df, ["score"], ["size"], ["sentiment"])
    return out.withColumn("score", rnd("score")).withColumn("size", rnd("size"))


@query("drop_sparse_columns", with_("subs") + "SELECT user_id, plan_tier, region, CAST(signup_date AS VARCHAR) AS signup_date, tenure_days, round(mrr, 6) AS mrr FROM subs")
def drop_sparse_columns(spark, d):
    out = clean.drop_sparse_columns(ad.subscriptions(spark, d), 0.5)
    fixed = {"signup_date": text("signup_date"), "churn_date": text("churn_date"), "mrr": rnd("mrr"), "tenure_days": F.col("tenure_days").cast("bigint")}
    return out.select(*[fixed.get(c, F.col(c)).alias(c) for c in out.columns])


@query("drop_dupes", """SELECT md5(text) AS digest, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source, arg_min(lang, doc_id) AS lang FROM documents
 WHERE text IS NOT NULL GROUP BY 1""")
def drop_dupes(spark, d):
    docs = src.table(spark, d, "documents").dropna(subset=["text"])
    docs = docs.select(F.md5("text").alias("digest"), "doc_id", "source", "lang")
    return clean.drop_duplicates(docs, ["digest"], ["doc_id"])


@query("cast_types", """SELECT o_orderkey, CAST(o_totalprice AS BIGINT) AS whole, CAST(o_orderkey AS VARCHAR) AS key_text, try_cast(substr(o_orderpriority, 1, 1) AS INT) AS priority,
 try_cast(o_orderpriority AS INT) AS bad FROM (SELECT o_orderkey, floor(o_totalprice) AS o_totalprice, o_orderpriority FROM orders)""")
def cast_types(spark, d):
    return src.table(spark, d, "orders").select(
        "o_orderkey",
        F.floor("o_totalprice").cast("bigint").alias("whole"),
        text("o_orderkey").alias("key_text"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("priority"),
        F.col("o_orderpriority").try_cast("int").alias("bad"),
    )


@query("derived_ratios", with_("profile") + "SELECT user_id, round(usage_per_day, 8) AS usage_per_day, round(events_per_day, 8) AS events_per_day FROM profile")
def derived_ratios(spark, d):
    return profile(spark, d).select("user_id", rnd("usage_per_day", 8).alias("usage_per_day"), rnd("events_per_day", 8).alias("events_per_day"))


@query("engagement_ratios", with_("profile") + """SELECT user_id, round(feature_count / CAST((SELECT count(DISTINCT feature_name) FROM usage) AS DOUBLE), 6) AS feature_diversity,
 round(CASE WHEN total_events > 0 THEN mrr / total_events END, 4) AS mrr_per_event,
 CAST((2001 - year(signup_date)) * 12 + 8 - month(signup_date) AS INT) AS cohort_age_months FROM profile""")
def engagement_ratios(spark, d):
    features = totals(ad.feature_usage(spark, d), n=F.countDistinct("feature_name"))["n"]
    df = clean.months_active(profile(spark, d), "signup_date", today())
    return df.select(
        "user_id",
        rnd(F.col("feature_count") / features).alias("feature_diversity"),
        rnd(F.try_divide(F.col("mrr"), F.col("total_events")), 4).alias("mrr_per_event"),
        F.col("months_active").alias("cohort_age_months"),
    )


BANDS = ([0.0, 25_000.0, 40_000.0, 1_000_000.0], ["Low", "Medium", "High"])
BAND_SQL = "CASE WHEN mrr > 0 AND mrr <= 25000 THEN 'Low' WHEN mrr > 25000 AND mrr <= 40000 THEN 'Medium' WHEN mrr > 40000 AND mrr <= 1000000 THEN 'High' END"


@query("bin_cut", with_("subs") + """SELECT user_id, CASE WHEN mrr * (tenure_days / 30.0::DOUBLE) > 0 AND mrr * (tenure_days / 30.0::DOUBLE) <= 5000 THEN 'Low'
 WHEN mrr * (tenure_days / 30.0::DOUBLE) > 5000 AND mrr * (tenure_days / 30.0::DOUBLE) <= 15000 THEN 'Medium'
 WHEN mrr * (tenure_days / 30.0::DOUBLE) > 15000 AND mrr * (tenure_days / 30.0::DOUBLE) <= 100000 THEN 'High' END AS clv_segment, """ + BAND_SQL + " AS mrr_band FROM subs")
def bin_cut(spark, d):
    df = clean.lifetime_value(clean.lifetime_days(ad.subscriptions(spark, d), today()))
    return df.select(
        "user_id",
        clean.bin_cut(F.col("clv"), [0, 5000, 15000, 100000], ["Low", "Medium", "High"]).alias("clv_segment"),
        clean.bin_cut(F.col("mrr"), *BANDS).alias("mrr_band"),
    )


SEGMENT_SQL = with_("profile") + ", grouped AS (SELECT *, coalesce(" + BAND_SQL + """, 'None') || '-' || churned AS cluster FROM profile),
q AS (SELECT quantile_cont(mrr, 0.25) m25, quantile_cont(mrr, 0.75) m75, quantile_cont(usage_per_day, 0.75) u75, quantile_cont(CAST(tenure_days AS DOUBLE), 0.25) t25 FROM grouped),
g AS (SELECT cluster, avg(mrr) am, avg(usage_per_day) au, avg(tenure_days) av_t FROM grouped GROUP BY 1),
named AS (SELECT cluster, am, au, av_t, CASE WHEN am > m75 AND au > u75 THEN 'Power Users' WHEN am > m75 THEN 'High Payers' WHEN au > u75 THEN 'Active Users'
 WHEN av_t < t25 THEN 'New Customers' WHEN am < m25 THEN 'Low Value' ELSE 'Steady Users' END AS segment FROM g, q)
"""


def clustered(spark, d):
    band = F.coalesce(clean.bin_cut(F.col("mrr"), *BANDS), F.lit("None"))
    return stored_profile(spark, d).withColumn("cluster", F.concat(band, F.lit("-"), F.col("churned").cast("string")))


@query("segment_by_quartile_rules", SEGMENT_SQL + "SELECT cluster, round(am, 4) AS avg_mrr, round(au, 8) AS avg_usage, round(av_t, 4) AS avg_tenure, segment FROM named")
def segment_by_quartile_rules(spark, d):
    out = clean.segment_names(clustered(spark, d), "cluster")
    return out.select("cluster", rnd("avg_mrr", 4).alias("avg_mrr"), rnd("avg_usage", 8).alias("avg_usage"), rnd("avg_tenure", 4).alias("avg_tenure"), "segment")


@query("map_lookup", SEGMENT_SQL + "SELECT user_id, g.cluster, segment FROM grouped g JOIN named n ON g.cluster = n.cluster")
def map_lookup(spark, d):
    rows = clustered(spark, d)
    names = clean.segment_names(rows, "cluster").select("cluster", "segment")
    return rows.join(names, "cluster").select("user_id", "cluster", "segment")


@query("interaction_features", with_("profile") + """SELECT user_id, plan_tier || '_' || region AS plan_tier_x_region, round(total_usage * tenure_days, 4) AS total_usage_x_tenure_days,
 round(total_usage * total_usage, 4) AS total_usage_x_total_usage FROM profile""")
def interaction_features(spark, d):
    pairs = [("plan_tier", "region"), ("total_usage", "tenure_days"), ("total_usage", "total_usage")]
    out = clean.interactions(profile(spark, d), pairs)
    return out.select(
        "user_id", "plan_tier_x_region",
        rnd("total_usage_x_tenure_days", 4).alias("total_usage_x_tenure_days"),
        rnd("total_usage_x_total_usage", 4).alias("total_usage_x_total_usage"),
    )


# ---- 2.3 joins


@query("join_left_enrich", with_("profile") + """SELECT s.user_id, plan_tier, e.total_events, u.total_usage, u.feature_count FROM subs s
 LEFT JOIN ev e ON s.user_id = e.user_id LEFT JOIN uf u ON s.user_id = u.user_id""")
def join_left_enrich(spark, d):
    ev, us = ad.user_events(spark, d), ad.feature_usage(spark, d)
    out = joins.left_enrich(ad.subscriptions(spark, d), joins.event_counts(ev), joins.usage_rollup(us))
    return out.select("user_id", "plan_tier", "total_events", "total_usage", "feature_count")


@query("join_left_index", "SELECT o_custkey, c_mktsegment, count(*) AS orders FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2")
def join_left_index(spark, d):
    counts = src.table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("orders"))
    index = src.table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return counts.join(index, "o_custkey", "left").select("o_custkey", "c_mktsegment", "orders")


@query("join_inner", with_("subs", "ev") + "SELECT s.user_id, s.plan_tier, e.total_events FROM subs s JOIN ev e ON s.user_id = e.user_id")
def join_inner(spark, d):
    ev = joins.event_counts(ad.user_events(spark, d))
    return ad.subscriptions(spark, d).join(ev, "user_id", "inner").select("user_id", "plan_tier", "total_events")


OUTER_SQL = with_("ev") + """, fb AS (SELECT user_id, count(*) AS notes FROM (SELECT doc_id % 150 AS user_id FROM documents UNION ALL SELECT 100000000 + page_id FROM pages) GROUP BY 1)
"""


@query("join_outer", OUTER_SQL + "SELECT coalesce(e.user_id, f.user_id) AS user_id, e.total_events, f.notes FROM ev e FULL JOIN fb f ON e.user_id = f.user_id")
def join_outer(spark, d):
    notes = ad.feedback(spark, d).select("user_id").unionByName(
        src.table(spark, d, "pages").select((F.col("page_id") + 100000000).alias("user_id"))
    )
    notes = notes.groupBy("user_id").agg(F.count("*").alias("notes"))
    return joins.event_counts(ad.user_events(spark, d)).join(notes, "user_id", "full_outer")


@query("join_catalog_adoption", with_("usage", "subs", "catalog") + """, tiers AS (SELECT feature_name, min(tier) AS tier FROM catalog GROUP BY 1)
SELECT s.region, t.tier, u.feature_name, sum(u.usage_count) AS usage FROM usage u JOIN subs s ON u.user_id = s.user_id JOIN tiers t ON u.feature_name = t.feature_name GROUP BY 1, 2, 3""")
def join_catalog_adoption(spark, d):
    per_user = ad.feature_usage(spark, d).groupBy("user_id", "feature_name").agg(F.sum("usage_count").alias("usage"))
    tiers = ad.product_catalog(spark, d).groupBy("feature_name").agg(F.min("tier").alias("tier"))
    regions = ad.subscriptions(spark, d).select("user_id", "region")
    out = per_user.join(regions, "user_id").groupBy("region", "feature_name").agg(F.sum("usage").alias("usage"))
    return out.join(tiers, "feature_name").select("region", "tier", "feature_name", "usage")


@query("join_validate", """WITH a AS (SELECT c_custkey AS k FROM customer), b AS (SELECT user_id AS k FROM events),
l AS (SELECT k, count(*) AS n FROM a GROUP BY 1), r AS (SELECT k, count(*) AS n FROM b GROUP BY 1)
SELECT (SELECT count(*) FROM a) AS left_rows, (SELECT count(*) FROM b) AS right_rows, (SELECT count(*) FROM a LEFT JOIN b ON a.k = b.k) AS joined_rows,
 (SELECT count(*) FROM a WHERE k NOT IN (SELECT k FROM b)) AS unmatched_left_rows, (SELECT count(*) FROM b WHERE k NOT IN (SELECT k FROM a)) AS unmatched_right_rows,
 (SELECT count(*) FROM r WHERE n > 1) AS duplicate_right_keys, (SELECT count(*) FROM l JOIN r ON l.k = r.k) AS matched_keys""")
def join_validate(spark, d):
    users = src.table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    return joins.join_report(users, ad.user_events(spark, d), "user_id")


@query("join_fanout_guard", with_("profile") + "SELECT plan_tier, count(*) AS users, sum(total_usage) AS total_usage, CAST(sum(total_events) AS BIGINT) AS total_events FROM profile GROUP BY 1")
def join_fanout_guard(spark, d):
    return profile(spark, d).groupBy("plan_tier").agg(
        F.count("*").alias("users"), F.sum("total_usage").alias("total_usage"), F.sum("total_events").alias("total_events")
    )


FULL_SQL = with_("profile", "feedback") + """, fb AS (SELECT user_id, count(*) AS feedback_count, avg(score) AS avg_sentiment FROM feedback GROUP BY 1),
full360 AS (SELECT p.*, coalesce(fb.feedback_count, 0) AS feedback_count, fb.avg_sentiment FROM profile p LEFT JOIN fb ON p.user_id = fb.user_id)
"""


def full_view(spark, d):
    return joins.customer_360(
        ad.subscriptions(spark, d), ad.user_events(spark, d), ad.feature_usage(spark, d), ad.feedback(spark, d)
    )


@query("customer_360", FULL_SQL + """SELECT user_id, plan_tier, region, is_churned, tenure_days, round(mrr, 6) AS mrr, total_events, total_usage, feature_count,
 feedback_count, round(avg_sentiment, 6) AS avg_sentiment FROM full360""")
def customer_360(spark, d):
    return full_view(spark, d).select(
        "user_id", "plan_tier", "region", "is_churned", F.col("tenure_days").cast("bigint").alias("tenure_days"), rnd("mrr").alias("mrr"),
        "total_events", "total_usage", "feature_count", "feedback_count", rnd("avg_sentiment").alias("avg_sentiment"),
    )


@query("customer_360_by_plan", FULL_SQL + """SELECT plan_tier, count(*) AS users, CAST(sum(churned) AS BIGINT) AS churned, round(avg(churned), 6) AS churn_rate, round(avg(mrr), 4) AS avg_mrr,
 round(avg(total_usage), 6) AS avg_usage, round(avg(feature_count), 6) AS avg_features, CAST(sum(feedback_count) AS BIGINT) AS feedback FROM full360 GROUP BY 1""")
def customer_360_by_plan(spark, d):
    return full_view(spark, d).groupBy("plan_tier").agg(
        F.count("*").alias("users"), F.sum("churned").alias("churned"), rnd(F.avg("churned")).alias("churn_rate"),
        rnd(F.avg("mrr"), 4).alias("avg_mrr"), rnd(F.avg("total_usage")).alias("avg_usage"),
        rnd(F.avg("feature_count")).alias("avg_features"), F.sum("feedback_count").alias("feedback"),
    )


@query("engaged_satisfied_at_risk", FULL_SQL + """, lastuse AS (SELECT user_id, max(date) AS last_used FROM usage GROUP BY 1),
x AS (SELECT f.*, date_diff('day', l.last_used, DATE '2001-08-02') AS idle_days FROM full360 f LEFT JOIN lastuse l ON f.user_id = l.user_id)
SELECT user_id, plan_tier, round(usage_per_day, 8) AS usage_per_day, round(avg_sentiment, 6) AS avg_sentiment, is_churned, idle_days FROM x
WHERE usage_per_day >= (SELECT quantile_cont(usage_per_day, 0.5) FROM x) AND avg_sentiment > 0 AND (is_churned OR idle_days > 60)""")
def engaged_satisfied_at_risk(spark, d):
    last = ad.feature_usage(spark, d).groupBy("user_id").agg(F.datediff(today(), F.max("date")).cast("bigint").alias("idle_days"))
    out = joins.satisfied_but_at_risk(cut_lineage(full_view(spark, d).join(last, "user_id", "left")), 60, 0.5)
    return out.select("user_id", "plan_tier", rnd("usage_per_day", 8).alias("usage_per_day"), rnd("avg_sentiment").alias("avg_sentiment"), "is_churned", "idle_days")


@query("stage_resume_anti", with_("checkpoints") + """, done AS (SELECT DISTINCT workflow_id, node FROM checkpoints WHERE ts < TIMESTAMP '2024-01-03'),
planned AS (SELECT DISTINCT workflow_id, node FROM checkpoints)
SELECT workflow_id, node FROM planned p WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.workflow_id = p.workflow_id AND d.node = p.node)""")
def stage_resume_anti(spark, d):
    log = ad.checkpoints(spark, d)
    done = log.where(F.col("ts") < F.lit("2024-01-03").cast("timestamp_ntz"))
    return joins.not_done(log.select("workflow_id", "node").distinct(), done, ["workflow_id", "node"])


@query("self_compare_checkpoints", with_("checkpoints") + """, ends AS (SELECT workflow_id, arg_min(state, seq) AS a, arg_max(state, seq) AS b, arg_min(node, seq) AS na, arg_max(node, seq) AS nb FROM checkpoints GROUP BY 1)
SELECT workflow_id, na AS first_node, nb AS last_node, CASE WHEN json_extract_string(a, '$.k') IS DISTINCT FROM json_extract_string(b, '$.k') THEN 'k' ELSE '' END AS changed_keys,
 json_extract_string(a, '$.k') AS k_before, json_extract_string(b, '$.k') AS k_after FROM ends""")
def self_compare_checkpoints(spark, d):
    log = ad.checkpoints(spark, d)
    row = F.struct("node", F.from_json("state", "map<string,string>").alias("state"))
    ends = log.groupBy("workflow_id").agg(F.min_by(F.struct("node", "state"), "seq").alias("a"), F.max_by(F.struct("node", "state"), "seq").alias("b"))
    ends = ends.select("workflow_id", F.col("a.node").alias("first_node"), F.col("b.node").alias("last_node"),
                       F.from_json("a.state", "map<string,string>").alias("a"), F.from_json("b.state", "map<string,string>").alias("b"))
    names = F.array_sort(F.array_union(F.map_keys("a"), F.map_keys("b")))
    changed = F.filter(names, lambda k: ~F.col("a")[k].eqNullSafe(F.col("b")[k]))
    return ends.select("workflow_id", "first_node", "last_node", F.array_join(changed, ",").alias("changed_keys"),
                       F.col("a")["k"].alias("k_before"), F.col("b")["k"].alias("k_after"))
