"""Aggregations and top-k (inventory 2.4 and 2.6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scale import quantile_scalars, totals
from ..operators import aggregates as agg
from ..operators import clean, joins
from ..session import cut_lineage
from ..sources import adapters as ad
from ..sources import tables as src
from .oracle import with_
from .registry import query, rnd, text
from .tables import SEGMENT_SQL, clustered, profile, stored_profile, stored_subscriptions, today

MONTH_SQL = "CAST(CAST(date_trunc('month', signup_date) AS DATE) AS VARCHAR)"


def month(c="signup_date"):
    return F.trunc(c, "MM").cast("string")


@query("usage_stats_global", with_("usage") + """SELECT count(usage_count) AS n, round(avg(usage_count), 6) AS mean, round(stddev_pop(usage_count), 6) AS std, min(usage_count) AS min, max(usage_count) AS max,
 round(median(usage_count), 6) AS median, round(quantile_cont(usage_count, 0.95), 6) AS p95 FROM usage""")
def usage_stats_global(spark, d):
    out = agg.value_stats(ad.feature_usage(spark, d), "usage_count")
    return out.select("n", rnd("mean").alias("mean"), rnd("std").alias("std"), "min", "max", rnd("median").alias("median"), rnd("p95").alias("p95"))


@query("top_decile_rows", with_("usage") + """, t AS (SELECT quantile_cont(usage_count, 0.9) AS q FROM usage)
SELECT round(any_value(q), 6) AS threshold, count(*) AS usage_rows, count(DISTINCT user_id) AS users FROM usage, t WHERE usage_count >= q""")
def top_decile_rows(spark, d):
    top = agg.at_or_above(cut_lineage(ad.feature_usage(spark, d).select("user_id", "usage_count")), "usage_count", 0.9)
    return top.agg(rnd(F.max("threshold")).alias("threshold"), F.count("*").alias("usage_rows"), F.countDistinct("user_id").alias("users"))


PER_USER_SQL = with_("usage") + ", pu AS (SELECT user_id, sum(usage_count) AS total_usage, avg(usage_count) AS avg_usage, count(*) AS usage_rows FROM usage GROUP BY 1)\n"


@query("user_usage_sum_mean_count", PER_USER_SQL + "SELECT user_id, total_usage, round(avg_usage, 6) AS avg_usage, usage_rows FROM pu")
def user_usage_sum_mean_count(spark, d):
    return agg.per_user_usage(ad.feature_usage(spark, d)).withColumn("avg_usage", rnd("avg_usage"))


@query("user_top_decile", PER_USER_SQL + "SELECT count(*) AS users, round(avg(avg_usage), 6) AS mean_avg_usage FROM pu WHERE total_usage >= (SELECT quantile_cont(total_usage, 0.9) FROM pu)")
def user_top_decile(spark, d):
    top = agg.at_or_above(cut_lineage(agg.per_user_usage(ad.feature_usage(spark, d))), "total_usage", 0.9)
    return top.agg(F.count("*").alias("users"), rnd(F.avg("avg_usage")).alias("mean_avg_usage"))


@query("user_zscore_outliers", PER_USER_SQL + """, z AS (SELECT user_id, total_usage, (total_usage - (SELECT avg(total_usage) FROM pu)) / (SELECT stddev_pop(total_usage) FROM pu) AS z FROM pu)
SELECT user_id, total_usage, round(z, 6) AS z FROM z WHERE abs(z) > 2.5""")
def user_zscore_outliers(spark, d):
    z = agg.zscores(cut_lineage(agg.per_user_usage(ad.feature_usage(spark, d))), "total_usage")
    return z.where(F.abs("z") > 2.5).select("user_id", "total_usage", rnd("z").alias("z"))


@query("feature_usage_ranked", with_("usage") + "SELECT feature_name, sum(usage_count) AS total FROM usage GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def feature_usage_ranked(spark, d):
    return agg.ranked_sum(ad.feature_usage(spark, d), "feature_name", "usage_count", 5)


@query("single_feature_stats", with_("usage") + """SELECT count(usage_count) AS n, round(avg(usage_count), 6) AS mean, round(stddev_pop(usage_count), 6) AS std, round(median(usage_count), 6) AS median,
 round(quantile_cont(usage_count, 0.95), 6) AS p95 FROM usage WHERE feature_name = 'Brand#7'""")
def single_feature_stats(spark, d):
    out = agg.value_stats(ad.feature_usage(spark, d).where(F.col("feature_name") == "Brand#7"), "usage_count")
    return out.select("n", rnd("mean").alias("mean"), rnd("std").alias("std"), rnd("median").alias("median"), rnd("p95").alias("p95"))


@query("user_event_counts", with_("ev") + "SELECT * FROM ev")
def user_event_counts(spark, d):
    return joins.event_counts(ad.user_events(spark, d))


@query("user_event_profile", """SELECT user_id, count(*) AS events, CAST(CAST(min(ts) AS DATE) AS VARCHAR) AS first_day, CAST(CAST(max(ts) AS DATE) AS VARCHAR) AS last_day, round(avg(value), 6) AS avg_value,
 round(count(*) / CAST(date_diff('day', CAST(min(ts) AS DATE), CAST(max(ts) AS DATE)) + 1 AS DOUBLE), 6) AS events_per_day FROM events GROUP BY 1""")
def user_event_profile(spark, d):
    return agg.event_profile(ad.user_events(spark, d)).select(
        "user_id", "events", text(F.to_date("first_ts")).alias("first_day"), text(F.to_date("last_ts")).alias("last_day"),
        rnd("avg_value", 6).alias("avg_value"), rnd("events_per_day").alias("events_per_day"),
    )


@query("user_feature_rollup", with_("uf") + "SELECT user_id, total_usage, feature_count FROM uf")
def user_feature_rollup(spark, d):
    return ad.feature_usage(spark, d).groupBy("user_id").agg(
        F.sum("usage_count").alias("total_usage"), F.countDistinct("feature_name").alias("feature_count")
    )


@query("user_feature_summary", with_("usage") + """, pf AS (SELECT user_id, feature_name, sum(usage_count) AS s FROM usage GROUP BY 1, 2)
SELECT user_id, count(*) AS feature_count, sum(s) AS total_usage, max(s) AS top_feature_usage FROM pf GROUP BY 1""")
def user_feature_summary(spark, d):
    per_feature = ad.feature_usage(spark, d).groupBy("user_id", "feature_name").agg(F.sum("usage_count").alias("s"))
    return per_feature.groupBy("user_id").agg(F.count("*").alias("feature_count"), F.sum("s").alias("total_usage"), F.max("s").alias("top_feature_usage"))


@query("user_last_active", with_("subs", "usage") + """, l AS (SELECT user_id, max(date) AS last_used FROM usage GROUP BY 1)
SELECT s.user_id, date_diff('day', l.last_used, DATE '2001-08-02') AS days_since_active, l.last_used IS NULL AS never_active FROM subs s LEFT JOIN l ON s.user_id = l.user_id""")
def user_last_active(spark, d):
    last = ad.feature_usage(spark, d).groupBy("user_id").agg(F.max("date").alias("last_used"))
    out = ad.subscriptions(spark, d).select("user_id").join(last, "user_id", "left")
    return out.select("user_id", F.datediff(today(), "last_used").cast("bigint").alias("days_since_active"), F.col("last_used").isNull().alias("never_active"))


CH = "count(*) AS users, CAST(sum(churned) AS BIGINT) AS churned, round(avg(churned), 6) AS churn_rate"
SUBS_C = with_("subs") + ", c AS (SELECT *, CAST(churn_date IS NOT NULL AS INT) AS churned FROM subs)\n"


def flagged(spark, d):
    return clean.churn_flag(ad.subscriptions(spark, d))


@query("churn_by_plan", SUBS_C + f"SELECT plan_tier, {CH} FROM c GROUP BY 1 ORDER BY churn_rate DESC")
def churn_by_plan(spark, d):
    out = agg.churn_rates(flagged(spark, d), "plan_tier").withColumn("churn_rate", rnd("churn_rate"))
    return out.orderBy(F.col("churn_rate").desc(), "plan_tier")


@query("churn_by_plan_region", SUBS_C + f"SELECT coalesce(plan_tier, 'ALL') AS plan_tier, coalesce(region, 'ALL') AS region, {CH} FROM c GROUP BY CUBE (c.plan_tier, c.region)")
def churn_by_plan_region(spark, d):
    return agg.churn_cube(flagged(spark, d), "plan_tier", "region").withColumn("churn_rate", rnd("churn_rate"))


@query("churn_timeline", SUBS_C + f"SELECT {MONTH_SQL} AS signup_month, {CH} FROM c GROUP BY 1 ORDER BY 1 DESC LIMIT 6")
def churn_timeline(spark, d):
    out = agg.churn_rates(flagged(spark, d), month().alias("signup_month")).withColumn("churn_rate", rnd("churn_rate"))
    return out.orderBy(F.col("signup_month").desc()).limit(6)


@query("churn_spread", SUBS_C + ", t AS (SELECT plan_tier, avg(churned) AS r FROM c GROUP BY 1) SELECT round(max(r) - min(r), 6) AS spread, arg_max(plan_tier, r) AS highest, arg_min(plan_tier, r) AS lowest FROM t")
def churn_spread(spark, d):
    t = agg.churn_rates(flagged(spark, d), "plan_tier")
    return t.agg(
        rnd(F.max("churn_rate") - F.min("churn_rate")).alias("spread"),
        F.max_by("plan_tier", "churn_rate").alias("highest"), F.min_by("plan_tier", "churn_rate").alias("lowest"),
    )


@query("churned_per_month", SUBS_C + f"SELECT {MONTH_SQL} AS signup_month, count(*) AS churned_users FROM c WHERE churned = 1 GROUP BY 1")
def churned_per_month(spark, d):
    return flagged(spark, d).where("is_churned").groupBy(month().alias("signup_month")).agg(F.count("*").alias("churned_users"))


@query("lifetime_by_cohort", with_("subs") + f"SELECT {MONTH_SQL} AS signup_month, count(*) AS users, round(avg(tenure_days), 6) AS mean_lifetime FROM subs GROUP BY 1")
def lifetime_by_cohort(spark, d):
    df = clean.lifetime_days(ad.subscriptions(spark, d), today())
    return df.groupBy(month().alias("signup_month")).agg(F.count("*").alias("users"), rnd(F.avg("lifetime_days")).alias("mean_lifetime"))


@query("active_users_daily", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS events, count(DISTINCT user_id) AS active_users FROM events GROUP BY 1")
def active_users_daily(spark, d):
    ev = ad.user_events(spark, d).select(text(F.to_date("ts")).alias("day"), "user_id")
    per_user = ev.groupBy("day", "user_id").agg(F.count("*").alias("n"))
    return per_user.groupBy("day").agg(F.sum("n").alias("events"), F.count("*").alias("active_users"))


@query("adoption_by_plan", with_("profile") + """SELECT plan_tier, round(avg(feature_count), 6) AS mean_features, round(median(feature_count), 6) AS median_features, round(stddev_samp(feature_count), 6) AS std_features,
 round(avg(churned), 6) AS churn_rate FROM profile GROUP BY 1""")
def adoption_by_plan(spark, d):
    p = stored_profile(spark, d)
    out = p.groupBy("plan_tier").agg(
        rnd(F.avg("feature_count")).alias("mean_features"), rnd(F.stddev("feature_count")).alias("std_features"), rnd(F.avg("churned")).alias("churn_rate")
    )
    mid = agg.group_median(p, "plan_tier", "feature_count", "median_features").withColumn("median_features", rnd("median_features"))
    return out.join(mid, "plan_tier")


@query("adoption_vs_churn", with_("profile") + f"SELECT feature_count, {CH} FROM profile GROUP BY 1")
def adoption_vs_churn(spark, d):
    return agg.churn_rates(profile(spark, d), "feature_count").withColumn("churn_rate", rnd("churn_rate"))


@query("event_frequency_by_tier", with_("profile") + "SELECT plan_tier, round(avg(total_events), 6) AS avg_events, round(avg(events_per_day), 8) AS avg_events_per_day FROM profile GROUP BY 1 ORDER BY avg(total_events) DESC, 1 LIMIT 1")
def event_frequency_by_tier(spark, d):
    out = profile(spark, d).groupBy("plan_tier").agg(F.avg("total_events").alias("a"), F.avg("events_per_day").alias("b"))
    out = out.orderBy(F.col("a").desc(), "plan_tier").limit(1)
    return out.select("plan_tier", rnd("a").alias("avg_events"), rnd("b", 8).alias("avg_events_per_day"))


@query("mrr_by_cohort", with_("subs") + f"SELECT {MONTH_SQL} AS signup_month, round(sum(mrr), 2) AS mrr, count(*) AS users FROM subs GROUP BY 1")
def mrr_by_cohort(spark, d):
    return ad.subscriptions(spark, d).groupBy(month().alias("signup_month")).agg(rnd(F.sum("mrr"), 2).alias("mrr"), F.count("*").alias("users"))


@query("plan_distribution", "SELECT c_mktsegment AS plan_tier, count(*) AS users, round(count(*) / CAST((SELECT count(*) FROM customer) AS DOUBLE), 6) AS share FROM customer GROUP BY 1 ORDER BY 2 DESC")
def plan_distribution(spark, d):
    users = src.table(spark, d, "customer")
    n = totals(users, n=F.count("*"))["n"]
    out = users.groupBy(F.col("c_mktsegment").alias("plan_tier")).agg(F.count("*").alias("users"))
    return out.withColumn("share", rnd(F.col("users") / n)).orderBy(F.col("users").desc(), "plan_tier")


CLV_SQL = with_("profile") + """, tiers AS (SELECT plan_tier, avg(mrr) AS tier_mrr FROM profile GROUP BY 1),
v AS (SELECT p.*, p.mrr * (p.tenure_days / 30.0::DOUBLE) AS clv, t.tier_mrr * (p.tenure_days / 30.0::DOUBLE) AS predicted FROM profile p JOIN tiers t ON p.plan_tier = t.plan_tier)
"""


def valued(spark, d):
    """CLV and its plain prediction: the plan's mean MRR over the user's lifetime."""
    p = clean.lifetime_value(profile(spark, d).withColumn("lifetime_days", F.col("tenure_days")))
    tiers = p.groupBy("plan_tier").agg(F.avg("mrr").alias("tier_mrr"))
    return p.join(tiers, "plan_tier").withColumn("predicted", F.col("tier_mrr") * (F.col("lifetime_days") / 30.0))


@query("clv_summary", with_("subs") + ", v AS (SELECT mrr * (tenure_days / 30.0::DOUBLE) AS clv FROM subs) SELECT round(avg(clv), 4) AS mean_clv, round(median(clv), 4) AS median_clv, round(max(clv), 4) AS max_clv FROM v")
def clv_summary(spark, d):
    df = clean.lifetime_value(clean.lifetime_days(stored_subscriptions(spark, d), today()))
    mid = quantile_scalars(df, "clv", {"m": 0.5})["m"]
    out = df.agg(rnd(F.avg("clv"), 4).alias("mean_clv"), rnd(F.max("clv"), 4).alias("max_clv"))
    return out.withColumn("median_clv", rnd(mid, 4))


@query("segment_summary", CLV_SQL + """SELECT CASE WHEN predicted > 0 AND predicted <= 1500000 THEN 'Low' WHEN predicted > 1500000 AND predicted <= 2500000 THEN 'Medium' WHEN predicted > 2500000 AND predicted <= 100000000 THEN 'High' END AS clv_segment,
 count(*) AS users, round(avg(predicted), 4) AS mean_predicted, round(avg(clv), 4) AS mean_actual, round(avg(mrr), 4) AS mean_mrr, round(avg(feature_count), 6) AS mean_features FROM v GROUP BY 1""")
def segment_summary(spark, d):
    seg = clean.bin_cut(F.col("predicted"), [0, 1_500_000, 2_500_000, 100_000_000], ["Low", "Medium", "High"]).alias("clv_segment")
    return valued(spark, d).groupBy(seg).agg(
        F.count("*").alias("users"), rnd(F.avg("predicted"), 4).alias("mean_predicted"), rnd(F.avg("clv"), 4).alias("mean_actual"),
        rnd(F.avg("mrr"), 4).alias("mean_mrr"), rnd(F.avg("feature_count")).alias("mean_features"),
    )


@query("segment_share", SEGMENT_SQL + """SELECT segment, count(*) AS users, round(count(*) / CAST((SELECT count(*) FROM grouped) AS DOUBLE), 6) AS share, round(avg(mrr), 4) AS avg_mrr, round(avg(tenure_days), 4) AS avg_tenure,
 round(avg(feature_count), 6) AS avg_features, round(100 * avg(churned), 4) AS churn_pct FROM grouped g JOIN named n ON g.cluster = n.cluster GROUP BY 1""")
def segment_share(spark, d):
    rows = clustered(spark, d)
    n = totals(rows, n=F.count("*"))["n"]
    named = rows.join(clean.segment_names(rows, "cluster").select("cluster", "segment"), "cluster")
    out = named.groupBy("segment").agg(
        F.count("*").alias("users"), rnd(F.avg("mrr"), 4).alias("avg_mrr"), rnd(F.avg("tenure_days"), 4).alias("avg_tenure"),
        rnd(F.avg("feature_count")).alias("avg_features"), rnd(F.avg("churned") * 100, 4).alias("churn_pct"),
    )
    return out.withColumn("share", rnd(F.col("users") / n))


@query("cluster_profile", SEGMENT_SQL + """, m AS (SELECT cluster, plan_tier, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, plan_tier) AS r FROM grouped GROUP BY 1, 2)
SELECT g.cluster, count(*) AS users, round(avg(mrr), 4) AS avg_mrr, round(avg(tenure_days), 4) AS avg_tenure, round(avg(feature_count), 6) AS avg_features, round(avg(total_events), 6) AS avg_events,
 any_value(m.plan_tier) AS modal_plan_tier FROM grouped g JOIN m ON g.cluster = m.cluster AND r = 1 GROUP BY 1""")
def cluster_profile(spark, d):
    rows = clustered(spark, d)
    out = rows.groupBy("cluster").agg(
        F.count("*").alias("users"), rnd(F.avg("mrr"), 4).alias("avg_mrr"), rnd(F.avg("tenure_days"), 4).alias("avg_tenure"),
        rnd(F.avg("feature_count")).alias("avg_features"), rnd(F.avg("total_events")).alias("avg_events"),
    )
    return out.join(agg.modal_value(rows, "cluster", "plan_tier"), "cluster")


RISK = "1.0::DOUBLE / (1.0::DOUBLE + usage_per_day)"


def risk():
    return F.lit(1.0) / (F.lit(1.0) + F.col("usage_per_day"))


@query("risk_bucket_lift", with_("profile") + f""", s AS (SELECT churned, {RISK} AS score FROM profile), t AS (SELECT quantile_cont(score, 0.8) AS q FROM s)
SELECT count(*) FILTER (WHERE score >= q) AS bucket_size, round(avg(churned) FILTER (WHERE score >= q), 6) AS bucket_rate, round(avg(churned), 6) AS overall_rate,
 round(avg(churned) FILTER (WHERE score >= q) / avg(churned), 6) AS lift FROM s, t""")
def risk_bucket_lift(spark, d):
    out = agg.lift_above(stored_profile(spark, d).withColumn("score", risk()), "score", "churned", 0.8)
    return out.select("bucket_size", *[rnd(c).alias(c) for c in ("bucket_rate", "overall_rate", "lift")])


@query("crosstab_counts", SUBS_C + "SELECT plan_tier, count(*) FILTER (WHERE churned = 0) AS active, count(*) FILTER (WHERE churned = 1) AS churned FROM c GROUP BY 1")
def crosstab_counts(spark, d):
    wide = flagged(spark, d).groupBy("plan_tier").pivot("churned", [0, 1]).count().fillna(0)
    return wide.select("plan_tier", F.col("0").alias("active"), F.col("1").alias("churned"))


@query("feedback_summary", with_("feedback") + "SELECT user_id, count(*) AS feedback_count, round(avg(score), 6) AS avg_sentiment FROM feedback GROUP BY 1")
def feedback_summary(spark, d):
    return ad.feedback(spark, d).groupBy("user_id").agg(F.count("*").alias("feedback_count"), rnd(F.avg("score")).alias("avg_sentiment"))


DAU_SQL = with_("subs") + """, dau AS (SELECT CAST(o_orderdate AS DATE) AS day, region, count(DISTINCT o_custkey) AS users FROM orders JOIN subs ON o_custkey = user_id GROUP BY 1, 2)
"""


def daily_users(spark, d):
    """Distinct users per (day, region)."""
    users = src.table(spark, d, "customer").join(ad.regions(spark, d), F.col("c_nationkey") == F.col("n_nationkey"))
    orders = src.table(spark, d, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day")).distinct()
    seen = orders.join(users.select(F.col("c_custkey").alias("o_custkey"), "region"), "o_custkey")
    return seen.groupBy("day", "region").agg(F.count("*").alias("users"))


@query("daily_total_and_share", DAU_SQL + """, s AS (SELECT region, users / CAST(sum(users) OVER (PARTITION BY day) AS DOUBLE) AS share FROM dau),
a AS (SELECT region, avg(share) AS avg_share, count(*) AS days FROM s GROUP BY 1)
SELECT region, round(100 * avg_share, 6) AS avg_share_pct, days, avg_share = max(avg_share) OVER () AS is_highest, avg_share = min(avg_share) OVER () AS is_lowest FROM a""")
def daily_total_and_share(spark, d):
    a = agg.shares_by_day(daily_users(spark, d)).groupBy("region").agg(F.avg("share").alias("avg_share"), F.count("*").alias("days"))
    a = cut_lineage(a)
    ends = totals(a, top=F.max_by("region", "avg_share"), low=F.min_by("region", "avg_share"))
    return a.select(
        "region", rnd(F.col("avg_share") * 100).alias("avg_share_pct"), "days",
        (F.col("region") == ends["top"]).alias("is_highest"), (F.col("region") == ends["low"]).alias("is_lowest"),
    )


@query("segment_decline_alert", with_("subs") + """, x AS (SELECT region, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-02') AS age, o_totalprice AS v FROM orders JOIN subs ON o_custkey = user_id),
g AS (SELECT region, sum(v) FILTER (WHERE age > 0 AND age <= 180) AS recent, sum(v) FILTER (WHERE age > 180 AND age <= 360) AS before FROM x GROUP BY 1)
SELECT region, round(recent, 2) AS recent, round(before, 2) AS before, round(recent / before - 1, 6) AS change, recent / before - 1 < 0 AS alert FROM g""")
def segment_decline_alert(spark, d):
    users = ad.subscriptions(spark, d).select(F.col("user_id").alias("o_custkey"), "region")
    orders = src.table(spark, d, "orders").select("o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("day"))
    out = agg.period_change(orders.join(users, "o_custkey"), "region", "day", "o_totalprice", today(), 180)
    return out.select("region", rnd("recent", 2).alias("recent"), rnd("before", 2).alias("before"), rnd("change").alias("change"), (F.col("change") < 0).alias("alert"))


@query("feature_adoption_rate", with_("usage", "subs") + """, u AS (SELECT DISTINCT s.region, s.user_id, x.feature_name FROM usage x JOIN subs s ON x.user_id = s.user_id),
n AS (SELECT region, count(*) AS users FROM subs GROUP BY 1)
SELECT feature_name, u.region, count(*) AS users, round(count(*) / CAST(any_value(n.users) AS DOUBLE), 6) AS adoption FROM u JOIN n ON u.region = n.region GROUP BY 1, 2
UNION ALL SELECT feature_name, 'ALL', count(*), round(count(*) / CAST((SELECT count(*) FROM subs) AS DOUBLE), 6) FROM u GROUP BY 1""")
def feature_adoption_rate(spark, d):
    subs = ad.subscriptions(spark, d).select("user_id", "region")
    used = ad.feature_usage(spark, d).select("user_id", "feature_name").distinct().join(subs, "user_id")
    got = used.rollup("feature_name", "region").agg(F.grouping_id().alias("g"), F.count("*").alias("users")).where("g < 2")
    base = subs.rollup("region").agg(F.count("*").alias("n")).select(F.coalesce("region", F.lit("ALL")).alias("region"), "n")
    got = got.withColumn("region", F.coalesce("region", F.lit("ALL")))
    return got.join(base, "region").select("feature_name", "region", "users", rnd(F.col("users") / F.col("n")).alias("adoption"))


@query("upgrade_patterns", """WITH s AS (SELECT o_custkey, o_orderpriority AS plan, lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS before FROM orders)
SELECT before AS from_plan, plan AS to_plan, count(*) AS moves, count(DISTINCT o_custkey) AS users FROM s WHERE before IS NOT NULL AND before <> plan GROUP BY 1, 2""")
def upgrade_patterns(spark, d):
    orders = src.table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", F.col("o_orderpriority").alias("plan"))
    return agg.plan_moves(orders, "o_custkey", ["o_orderdate", "o_orderkey"], "plan", F.trunc("o_orderdate", "YEAR"))


@query("feedback_by_category", with_("feedback") + """SELECT category, count(*) AS tickets, count(*) FILTER (WHERE sentiment = 'positive') AS positive, count(*) FILTER (WHERE sentiment = 'neutral') AS neutral,
 count(*) FILTER (WHERE sentiment = 'negative') AS negative FROM feedback GROUP BY 1 ORDER BY 2 DESC, 1""")
def feedback_by_category(spark, d):
    names = ["positive", "neutral", "negative"]
    fb = ad.feedback(spark, d)
    out = fb.groupBy("category").agg(F.count("*").alias("tickets"), *[F.count_if(F.col("sentiment") == n).alias(n) for n in names])
    return out.orderBy(F.col("tickets").desc(), "category")


@query("catalog_portfolio", with_("catalog") + """SELECT tier, owner_team, count(*) AS features, round(avg(date_diff('day', release_date, DATE '2001-08-02')), 6) AS mean_age_days,
 CAST(max(release_date) AS VARCHAR) AS newest FROM catalog GROUP BY 1, 2""")
def catalog_portfolio(spark, d):
    age = F.datediff(today(), "release_date")
    return ad.product_catalog(spark, d).groupBy("tier", "owner_team").agg(
        F.count("*").alias("features"), rnd(F.avg(age)).alias("mean_age_days"), text(F.max("release_date")).alias("newest")
    )


@query("cross_sell_pairs", with_("usage") + """, u AS (SELECT DISTINCT user_id, feature_name FROM usage), n AS (SELECT feature_name, count(*) AS n FROM u GROUP BY 1), t AS (SELECT count(DISTINCT user_id) AS users FROM u),
p AS (SELECT a.feature_name AS a, b.feature_name AS b, count(*) AS both FROM u a JOIN u b ON a.user_id = b.user_id AND a.feature_name < b.feature_name GROUP BY 1, 2)
SELECT p.a, p.b, p.both, round(p.both / CAST(users AS DOUBLE), 6) AS support, round(p.both * users / CAST(x.n * y.n AS DOUBLE), 6) AS lift FROM p JOIN n x ON p.a = x.feature_name JOIN n y ON p.b = y.feature_name, t""")
def cross_sell_pairs(spark, d):
    out = agg.joint_use(ad.feature_usage(spark, d), "user_id", "feature_name")
    return out.select("a", "b", "both", rnd("support").alias("support"), rnd("lift").alias("lift"))


@query("grouping_totals", SUBS_C + """SELECT CASE WHEN grouping(region) = 1 THEN 'ALL' ELSE region END AS region, CASE WHEN grouping(plan_tier) = 1 THEN 'ALL' ELSE plan_tier END AS plan_tier,
 count(*) AS users, round(sum(mrr), 2) AS mrr FROM c GROUP BY ROLLUP (region, plan_tier)""")
def grouping_totals(spark, d):
    out = ad.subscriptions(spark, d).rollup("region", "plan_tier").agg(
        F.grouping("region").alias("gr"), F.grouping("plan_tier").alias("gp"), F.count("*").alias("users"), rnd(F.sum("mrr"), 2).alias("mrr")
    )
    return out.select(
        F.when(F.col("gr") == 1, "ALL").otherwise(F.col("region")).alias("region"),
        F.when(F.col("gp") == 1, "ALL").otherwise(F.col("plan_tier")).alias("plan_tier"), "users", "mrr",
    )


# ---- 2.6 sorts, limits, top-k


@query("sort_desc_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def sort_desc_limit(spark, d):
    return src.table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(20)


@query("sort_by_abs", with_("profile") + """, c AS (SELECT u.* FROM (SELECT corr(mrr, tenure_days) a, corr(mrr, total_usage) b, corr(mrr, feature_count) c, corr(mrr, total_events) e FROM profile) x,
 LATERAL (VALUES ('tenure_days', a), ('total_usage', b), ('feature_count', c), ('total_events', e)) u(feature, weight))
SELECT feature, round(weight, 6) AS weight FROM c ORDER BY abs(weight) DESC LIMIT 3""")
def sort_by_abs(spark, d):
    names = ["tenure_days", "total_usage", "feature_count", "total_events"]
    one = profile(spark, d).agg(*[F.corr("mrr", n).alias(n) for n in names])
    long = one.unpivot([], names, "feature", "weight")
    return long.orderBy(F.abs("weight").desc(), "feature").limit(3).withColumn("weight", rnd("weight"))


@query("nlargest", CLV_SQL + "SELECT user_id, round(abs(clv - predicted), 4) AS error FROM v ORDER BY abs(clv - predicted) DESC, user_id LIMIT 10")
def nlargest(spark, d):
    out = valued(spark, d).withColumn("error", F.abs(F.col("clv") - F.col("predicted")))
    return out.orderBy(F.col("error").desc(), "user_id").limit(10).select("user_id", rnd("error", 4).alias("error"))


@query("argmax_row", SUBS_C + f"SELECT plan_tier, region, {CH} FROM c GROUP BY 1, 2 ORDER BY avg(churned) DESC, 1, 2 LIMIT 1")
def argmax_row(spark, d):
    rates = agg.churn_rates(flagged(spark, d), "plan_tier", "region")
    best = F.min(F.struct((-F.col("churn_rate")).alias("x"), "plan_tier", "region", "users", "churned", "churn_rate")).alias("b")
    return rates.agg(best).select("b.plan_tier", "b.region", "b.users", "b.churned", rnd("b.churn_rate").alias("churn_rate"))


@query("worst_residuals", CLV_SQL + """(SELECT 'under' AS side, user_id, round(clv - predicted, 4) AS residual FROM v ORDER BY clv - predicted DESC, user_id LIMIT 10)
UNION ALL (SELECT 'over', user_id, round(clv - predicted, 4) FROM v ORDER BY clv - predicted, user_id LIMIT 10)""")
def worst_residuals(spark, d):
    rows = valued(spark, d).select("user_id", (F.col("clv") - F.col("predicted")).alias("residual"))
    under = rows.orderBy(F.col("residual").desc(), "user_id").limit(10).withColumn("side", F.lit("under"))
    over = rows.orderBy("residual", "user_id").limit(10).withColumn("side", F.lit("over"))
    return under.unionByName(over).select("side", "user_id", rnd("residual", 4).alias("residual"))
