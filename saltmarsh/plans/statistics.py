"""Tests, features, splits, metrics and composites (inventory 2.9, the part plain SQL can check)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scale import totals
from ..operators import stats as st
from ..operators.windows import recent_vs_history
from ..session import cut_lineage
from ..sources import adapters as ad
from ..sources import tables as src
from .aggregates import CLV_SQL, RISK, SUBS_C, flagged, risk, valued
from .oracle import with_
from .registry import query, rnd, text
from .tables import profile, stored_profile, stored_subscriptions, today


@query("chi2_independence", SUBS_C + """, cell AS (SELECT a.plan_tier, b.churned, (SELECT count(*) FROM c WHERE c.plan_tier = a.plan_tier AND c.churned = b.churned) AS observed FROM (SELECT DISTINCT plan_tier FROM c) a, (SELECT DISTINCT churned FROM c) b),
e AS (SELECT *, sum(observed) OVER (PARTITION BY plan_tier) * sum(observed) OVER (PARTITION BY churned) / CAST(sum(observed) OVER () AS DOUBLE) AS expected FROM cell), x AS (SELECT sum((observed - expected) ** 2 / expected) AS chi2 FROM e)
SELECT plan_tier, churned, observed, round(expected, 6) AS expected, round(chi2, 6) AS chi2, 4.0::DOUBLE AS dof, round(exp(-chi2 / 2) * (1 + chi2 / 2), 6) AS p_value FROM e, x""")
def chi2_independence(spark, d):
    out = st.chi_square(flagged(spark, d), "plan_tier", "churned")
    return out.select("plan_tier", "churned", "observed", rnd("expected").alias("expected"), rnd("chi2").alias("chi2"), "dof", rnd("p_value").alias("p_value"))


@query("proportion_ci95", SUBS_C + """, g AS (SELECT plan_tier, count(*) AS n, avg(churned) AS rate FROM c GROUP BY 1),
k AS (SELECT plan_tier, n, rate, unnest(generate_series(0, n)) AS k FROM g),
f AS (SELECT *, sum(exp(lgamma(n + 1.0) - lgamma(k + 1.0) - lgamma(n - k + 1.0) + k * ln(rate) + (n - k) * ln(1 - rate))) OVER (PARTITION BY plan_tier ORDER BY k) AS cdf FROM k)
SELECT plan_tier, any_value(n) AS n, round(any_value(rate), 6) AS rate, round(min(k) FILTER (WHERE cdf >= 0.025) / CAST(any_value(n) AS DOUBLE), 6) AS ci_low, round(min(k) FILTER (WHERE cdf >= 0.975) / CAST(any_value(n) AS DOUBLE), 6) AS ci_high FROM f GROUP BY 1""")
def proportion_ci95(spark, d):
    out = st.proportion_interval(flagged(spark, d), "plan_tier", "churned")
    return out.select("plan_tier", "n", *[rnd(c).alias(c) for c in ("rate", "ci_low", "ci_high")])


@query("ttest_two_sample", SUBS_C + """, s AS (SELECT count(mrr) FILTER (WHERE churned = 1) n1, count(mrr) FILTER (WHERE churned = 0) n0, avg(mrr) FILTER (WHERE churned = 1) m1, avg(mrr) FILTER (WHERE churned = 0) m0,
 var_samp(mrr) FILTER (WHERE churned = 1) v1, var_samp(mrr) FILTER (WHERE churned = 0) v0 FROM c)
SELECT round(m1, 4) AS mean_churned, round(m0, 4) AS mean_active, CAST(n1 + n0 - 2 AS DOUBLE) AS dof, round((m1 - m0) / sqrt(((n1 - 1) * v1 + (n0 - 1) * v0) / (n1 + n0 - 2) * (1.0::DOUBLE / n1 + 1.0::DOUBLE / n0)), 6) AS t FROM s""")
def ttest_two_sample(spark, d):
    out = st.two_sample_t(flagged(spark, d), "churned", "mrr")
    return out.select(rnd("mean1", 4).alias("mean_churned"), rnd("mean0", 4).alias("mean_active"), "dof", rnd("t").alias("t"))


ANOVA_SQL = with_("subs") + ", g AS (SELECT region, count(mrr) AS n, avg(mrr) AS m, var_samp(mrr) AS v FROM subs GROUP BY 1)\n"


@query("anova_oneway", ANOVA_SQL + """, p AS (SELECT sum(n * (m - (SELECT avg(mrr) FROM subs)) ** 2) AS ssb, sum((n - 1) * v) AS ssw, CAST(count(*) - 1 AS DOUBLE) AS d1, CAST(sum(n) - count(*) AS DOUBLE) AS d2 FROM g)
SELECT round((ssb / d1) / (ssw / d2), 6) AS f, d1 AS df_between, d2 AS df_within, round(ssb / (ssb + ssw), 8) AS eta_squared FROM p""")
def anova_oneway(spark, d):
    out = st.anova(ad.subscriptions(spark, d), "region", "mrr")
    return out.select(rnd("f").alias("f"), "df_between", "df_within", rnd("eta_squared", 8).alias("eta_squared"))


@query("posthoc_bonferroni", ANOVA_SQL + """SELECT a.region AS a, b.region AS b, CAST(a.n + b.n - 2 AS DOUBLE) AS dof, round((a.m - b.m) / sqrt(((a.n - 1) * a.v + (b.n - 1) * b.v) / (a.n + b.n - 2) * (1.0::DOUBLE / a.n + 1.0::DOUBLE / b.n)), 6) AS t,
 (SELECT count(*) * (count(*) - 1) / 2.0::DOUBLE FROM g) AS pairs FROM g a JOIN g b ON a.region < b.region""")
def posthoc_bonferroni(spark, d):
    out = st.pairwise_t(ad.subscriptions(spark, d), "region", "mrr")
    return out.select("a", "b", "dof", rnd("t").alias("t"), "pairs")


@query("significance_p_values")
def significance_p_values(spark, d):
    return st.significance_p_values(cut_lineage(flagged(spark, d)), "churned", "region", "mrr")


@query("ab_lift_test", SUBS_C + """, s AS (SELECT count(*) FILTER (WHERE plan_tier = 'BUILDING') na, count(*) FILTER (WHERE plan_tier = 'MACHINERY') nb, CAST(sum(churned) FILTER (WHERE plan_tier = 'BUILDING') AS DOUBLE) xa, CAST(sum(churned) FILTER (WHERE plan_tier = 'MACHINERY') AS DOUBLE) xb FROM c)
SELECT na AS n_a, nb AS n_b, round(xa / na, 6) AS rate_a, round(xb / nb, 6) AS rate_b, round((xa / na) / (xb / nb) - 1, 6) AS lift,
 round((xa / na - xb / nb) / sqrt((xa + xb) / (na + nb) * (1 - (xa + xb) / (na + nb)) * (1.0::DOUBLE / na + 1.0::DOUBLE / nb)), 6) AS z FROM s""")
def ab_lift_test(spark, d):
    out = st.two_proportions(flagged(spark, d), "plan_tier", "churned", "BUILDING", "MACHINERY")
    return out.select("n_a", "n_b", *[rnd(c).alias(c) for c in ("rate_a", "rate_b", "lift", "z")])


NUMBERS = ["tenure_days", "mrr", "total_usage", "feature_count", "total_events"]


@query("correlation_matrix", with_("profile") + "\nSELECT u.a, u.b, round(u.r, 6) AS correlation FROM (SELECT " + ", ".join(f"corr({a}, {b}) AS {a}_{b}" for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1:]) + " FROM profile) z, LATERAL (VALUES "
       + ", ".join(f"('{a}', '{b}', {a}_{b})" for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1:]) + ") u(a, b, r)")
def correlation_matrix(spark, d):
    return st.correlations(profile(spark, d), NUMBERS).withColumn("correlation", rnd("correlation"))


@query("variance_filter", with_("profile") + "\nSELECT u.f AS feature, round(u.v, 4) AS variance, u.v > 0.01 AS keep FROM (SELECT " + ", ".join(f"var_pop({c}) AS {c}" for c in [*NUMBERS, "usage_per_day"]) + " FROM profile) z, LATERAL (VALUES "
       + ", ".join(f"('{c}', {c})" for c in [*NUMBERS, "usage_per_day"]) + ") u(f, v)")
def variance_filter(spark, d):
    return st.variances(profile(spark, d), [*NUMBERS, "usage_per_day"], 0.01).withColumn("variance", rnd("variance", 4))


TIERS = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("onehot_drop_first", "SELECT c_custkey AS user_id, " + ", ".join(f"CAST(c_mktsegment = '{t}' AS INT) AS plan_tier_{t}" for t in TIERS) + " FROM customer")
def onehot_drop_first(spark, d):
    users = src.table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("plan_tier"))
    return st.one_hot(users, "plan_tier", "plan_tier").drop("plan_tier")


HASH = "CAST(('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8)) AS BIGINT)"


@query("target_encode", SUBS_C + f""", h AS (SELECT user_id, plan_tier, churned, {HASH} % 5 AS fold FROM c)
SELECT user_id, plan_tier, round(avg(churned) OVER (PARTITION BY plan_tier), 6) AS encoded,
 round((sum(churned) OVER (PARTITION BY plan_tier) - sum(churned) OVER (PARTITION BY plan_tier, fold)) / CAST(count(*) OVER (PARTITION BY plan_tier) - count(*) OVER (PARTITION BY plan_tier, fold) AS DOUBLE), 6) AS encoded_oof FROM h""")
def target_encode(spark, d):
    out = st.target_encoding(flagged(spark, d), "plan_tier", "churned", "user_id")
    return out.select("user_id", "plan_tier", rnd("encoded").alias("encoded"), rnd("encoded_oof").alias("encoded_oof"))


@query("standard_scale", with_("profile") + "SELECT user_id, " + ", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}_z" for c in NUMBERS) + " FROM profile")
def standard_scale(spark, d):
    out = st.standard_scale(stored_profile(spark, d), NUMBERS)
    return out.select("user_id", *[rnd(f"{c}_z").alias(f"{c}_z") for c in NUMBERS])


@query("minmax_scale", with_("profile") + "SELECT user_id, " + ", ".join(f"round(100.0 * ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 6) AS {c}_scaled" for c in NUMBERS) + " FROM profile")
def minmax_scale(spark, d):
    out = st.minmax_scale(stored_profile(spark, d), NUMBERS, 100.0)
    return out.select("user_id", *[rnd(f"{c}_scaled").alias(f"{c}_scaled") for c in NUMBERS])


@query("outlier_flags", with_("subs") + """, q AS (SELECT quantile_cont(mrr, 0.25) q1, quantile_cont(mrr, 0.75) q3, quantile_cont(mrr, 0.99) p99, avg(mrr) m, stddev_pop(mrr) s FROM subs)
SELECT user_id, mrr < q1 - 1.5 * (q3 - q1) OR mrr > q3 + 1.5 * (q3 - q1) AS iqr_outlier, abs((mrr - m) / s) > 3 AS z_outlier, round(least(mrr, p99), 6) AS capped FROM subs, q""")
def outlier_flags(spark, d):
    return st.outlier_flags(stored_subscriptions(spark, d), "mrr").select("user_id", "iqr_outlier", "z_outlier", rnd("capped", 6).alias("capped"))


@query("feature_matrix", with_("profile") + """SELECT user_id, CAST(month(signup_date) AS INT) AS signup_month_number, total_usage, feature_count, total_events, round(mrr, 6) AS mrr, """
       + ", ".join(f"CAST(plan_tier = '{t}' AS INT) AS plan_tier_{t}" for t in TIERS) + ", churned AS target FROM profile")
def feature_matrix(spark, d):
    df = st.one_hot(profile(spark, d), "plan_tier", "plan_tier")
    return df.select("user_id", F.month("signup_date").alias("signup_month_number"), "total_usage", "feature_count", "total_events", rnd("mrr", 6).alias("mrr"),
                     *[f"plan_tier_{t}" for t in TIERS], F.col("churned").alias("target"))


def drift_sql():
    edges = ", ".join(f"quantile_cont(v, {i / 10}) AS e{i}" for i in range(1, 10))
    bucket = " + ".join(f"CAST(v > e{i} AS INT)" for i in range(1, 10))
    return f"""WITH x AS (SELECT o_totalprice AS v, o_orderdate < TIMESTAMP '2000-01-01' AS base FROM orders), e AS (SELECT {edges} FROM x WHERE base),
b AS (SELECT {bucket} AS bucket, base FROM x, e), n AS (SELECT count(*) FILTER (WHERE base) AS nb, count(*) FILTER (WHERE NOT base) AS nr FROM x),
s AS (SELECT bucket, count(*) FILTER (WHERE base) / CAST(any_value(nb) AS DOUBLE) AS q, count(*) FILTER (WHERE NOT base) / CAST(any_value(nr) AS DOUBLE) AS p FROM b, n GROUP BY 1)
SELECT CAST(bucket AS INT) AS bucket, round(q, 6) AS base_share, round(p, 6) AS recent_share, round((greatest(p, 1e-6) - greatest(q, 1e-6)) * ln(greatest(p, 1e-6) / greatest(q, 1e-6)), 8) AS psi_part FROM s"""


@query("feature_drift", drift_sql())
def feature_drift(spark, d):
    orders = src.table(spark, d, "orders").select("o_totalprice", "o_orderdate")
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    out = st.population_stability(orders.where(F.col("o_orderdate") < cut), orders.where(F.col("o_orderdate") >= cut), "o_totalprice")
    return out.select("bucket", rnd("base_share").alias("base_share"), rnd("recent_share").alias("recent_share"), rnd("psi_part", 8).alias("psi_part"))


@query("split_random", with_("subs") + f"SELECT user_id, CASE WHEN {HASH} % 100 < 80 THEN 'train' ELSE 'test' END AS split FROM subs")
def split_random(spark, d):
    return st.hash_split(ad.subscriptions(spark, d), "user_id").select("user_id", "split")


@query("split_time", with_("subs") + "SELECT user_id, CASE WHEN date_trunc('month', signup_date) = (SELECT max(date_trunc('month', signup_date)) FROM subs) THEN 'test' ELSE 'train' END AS split FROM subs")
def split_time(spark, d):
    return st.time_split(ad.subscriptions(spark, d), "signup_date").select("user_id", "split")


FOLD_SQL = SUBS_C.rstrip() + f", fl AS (SELECT user_id, churned, CAST((row_number() OVER (PARTITION BY churned ORDER BY {HASH}, user_id) - 1) % 5 AS INT) AS fold FROM c)\n"


@query("stratified_kfold", FOLD_SQL + "SELECT user_id, churned, fold FROM fl")
def stratified_kfold(spark, d):
    return st.stratified_folds(flagged(spark, d), "churned", "user_id").select("user_id", "churned", "fold")


# ---- metrics

SCORED_SQL = with_("profile") + f", sc AS (SELECT user_id, churned, {RISK} AS score FROM profile)\n"


def scored(spark, d):
    return stored_profile(spark, d).withColumn("score", risk())


@query("regression_metrics", CLV_SQL + """SELECT count(*) AS n, round(avg(abs(clv - predicted)), 4) AS mae, round(sqrt(avg((clv - predicted) ** 2)), 4) AS rmse, round(1 - sum((clv - predicted) ** 2) / (var_pop(clv) * count(*)), 6) AS r2 FROM v""")
def regression_metrics(spark, d):
    out = st.regression_metrics(valued(spark, d), "clv", "predicted")
    return out.select("n", rnd("mae", 4).alias("mae"), rnd("rmse", 4).alias("rmse"), rnd("r2").alias("r2"))


@query("naive_baseline", CLV_SQL + ", m AS (SELECT avg(clv) AS a FROM v) SELECT round(any_value(a), 4) AS prediction, round(avg(abs(clv - a)), 4) AS mae, round(sqrt(avg((clv - a) ** 2)), 4) AS rmse FROM v, m")
def naive_baseline(spark, d):
    rows = valued(spark, d).select("clv")
    rows = rows.withColumn("a", totals(rows, a=F.avg("clv"))["a"])
    err = F.col("clv") - F.col("a")
    return rows.agg(rnd(F.max("a"), 4).alias("prediction"), rnd(F.avg(F.abs(err)), 4).alias("mae"), rnd(F.sqrt(F.avg(err * err)), 4).alias("rmse"))


@query("residual_analysis", CLV_SQL + "SELECT region, plan_tier, count(*) AS n, round(avg(clv - predicted), 4) AS mean_residual, round(stddev_pop(clv - predicted), 4) AS std_residual, avg(clv - predicted) > 0 AS underestimates FROM v GROUP BY 1, 2")
def residual_analysis(spark, d):
    err = F.col("clv") - F.col("predicted")
    return valued(spark, d).groupBy("region", "plan_tier").agg(
        F.count("*").alias("n"), rnd(F.avg(err), 4).alias("mean_residual"), rnd(F.stddev_pop(err), 4).alias("std_residual"), (F.avg(err) > 0).alias("underestimates")
    )


def counts_sql(t):
    return f"count(*) FILTER (WHERE churned = 1 AND score >= {t}) AS tp, count(*) FILTER (WHERE churned = 0 AND score >= {t}) AS fp, count(*) FILTER (WHERE churned = 1 AND score < {t}) AS fn, count(*) FILTER (WHERE churned = 0 AND score < {t}) AS tn"


RATES_SQL = """tp, fp, fn, tn, round((tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE), 6) AS accuracy, round(coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0), 6) AS "precision", round(coalesce(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 0), 6) AS recall,
 round(coalesce(2 * tp / CAST(nullif(2 * tp + fp + fn, 0) AS DOUBLE), 0), 6) AS f1"""


@query("binary_metrics", SCORED_SQL + f", k AS (SELECT {counts_sql(0.9)} FROM sc) SELECT {RATES_SQL} FROM k")
def binary_metrics(spark, d):
    out = st.binary_metrics(scored(spark, d), "churned", "score", 0.9)
    return out.select("tp", "fp", "fn", "tn", *[rnd(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


SWEEP = [0.3, 0.5, 0.7, 0.8, 0.9]


@query("threshold_sweep", SCORED_SQL + ", k AS (" + " UNION ALL ".join(f"SELECT {t}::DOUBLE AS threshold, {counts_sql(t)} FROM sc" for t in SWEEP) + f") SELECT threshold, {RATES_SQL} FROM k")
def threshold_sweep(spark, d):
    out = st.threshold_sweep(scored(spark, d), "churned", "score", SWEEP)
    return out.select("threshold", "tp", "fp", "fn", "tn", *[rnd(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


def auc_sql(rows, key="1"):
    return f"""(SELECT k, (sum(CASE WHEN churned = 1 THEN r END) - count(*) FILTER (WHERE churned = 1) * (count(*) FILTER (WHERE churned = 1) + 1) / 2.0::DOUBLE) / (count(*) FILTER (WHERE churned = 1) * count(*) FILTER (WHERE churned = 0)) AS auc
 FROM (SELECT {key} AS k, churned, rank() OVER (PARTITION BY {key} ORDER BY score) + (count(*) OVER (PARTITION BY {key}, score) - 1) / 2.0::DOUBLE AS r FROM {rows}) GROUP BY k)"""


@query("roc_auc", SCORED_SQL + f"SELECT round(auc, 6) AS auc, (SELECT count(*) FROM sc) AS n FROM {auc_sql('sc')}")
def roc_auc(spark, d):
    return st.roc_auc(scored(spark, d), "churned", "score").select(rnd("auc").alias("auc"), "n")


@query("pr_curve", SCORED_SQL + """, g AS (SELECT score, sum(churned) AS p, count(*) AS n FROM sc GROUP BY 1), r AS (SELECT score, sum(p) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS n FROM g)
SELECT round(score, 8) AS threshold, round(tp / CAST(n AS DOUBLE), 6) AS "precision", round(tp / CAST((SELECT sum(churned) FROM sc) AS DOUBLE), 6) AS recall FROM r""")
def pr_curve(spark, d):
    out = st.pr_curve(scored(spark, d), "churned", "score")
    return out.select(rnd("threshold", 8).alias("threshold"), rnd("precision").alias("precision"), rnd("recall").alias("recall"))


@query("cv_summary", with_("profile") + f""", base AS (SELECT user_id, churned, {RISK} AS score FROM profile), fl AS (SELECT user_id, CAST((row_number() OVER (PARTITION BY churned ORDER BY {HASH}, user_id) - 1) % 5 AS INT) AS fold FROM base),
sc AS (SELECT b.*, fold FROM base b JOIN fl ON b.user_id = fl.user_id), f AS {auc_sql('sc', 'fold')}, t AS {auc_sql('sc')}, m AS (SELECT avg(auc) AS mean, stddev_pop(auc) AS std FROM f)
SELECT round(mean, 6) AS mean, round(std, 6) AS std, round(mean - 1.96 * std, 6) AS ci_low, round(mean + 1.96 * std, 6) AS ci_high, round(t.auc, 6) AS test, abs(mean - t.auc) > 0.05 AS shifted FROM m, t""")
def cv_summary(spark, d):
    rows = scored(spark, d)
    folds = st.roc_auc(st.stratified_folds(rows, "churned", "user_id"), "churned", "score", ["fold"])
    whole = st.roc_auc(rows, "churned", "score").select("auc").scalar()
    out = st.cv_summary(folds, whole)
    return out.select(*[rnd(c).alias(c) for c in ("mean", "std", "ci_low", "ci_high", "test")], "shifted")


# ---- composites and chart data


@query("risk_score_composite", with_("profile") + """, c AS (SELECT coalesce(CAST(date_trunc('month', signup_date) AS DATE), DATE '1900-01-01') AS m, avg(churned) AS r FROM profile GROUP BY 1), e AS (SELECT max(r) AS hi, min(r) AS lo FROM c),
t AS (SELECT user_id, avg(usage_count) FILTER (WHERE date_diff('day', date, DATE '2001-08-02') < 180) / avg(usage_count) FILTER (WHERE date_diff('day', date, DATE '2001-08-02') >= 180) < 1 AS falling FROM usage GROUP BY 1),
s AS (SELECT p.user_id, 40 * (c.r - lo) / (hi - lo) + 30 * CAST(feature_count < (SELECT median(feature_count) FROM profile) AS INT) + 30 * CAST(coalesce(falling, false) AS INT) AS risk FROM profile p JOIN c ON coalesce(CAST(date_trunc('month', p.signup_date) AS DATE), DATE '1900-01-01') = c.m LEFT JOIN t ON p.user_id = t.user_id, e)
SELECT user_id, round(risk, 6) AS risk_score, CASE WHEN risk < 33 THEN 'low' WHEN risk < 66 THEN 'medium' ELSE 'high' END AS band FROM s""")
def risk_score_composite(spark, d):
    trend = recent_vs_history(ad.feature_usage(spark, d), today(), 180)
    return st.risk_composite(stored_profile(spark, d), trend).select("user_id", rnd("risk_score").alias("risk_score"), "band")


@query("quality_score_composite", with_("profile") + """, b AS (SELECT min(usage_per_day) u0, max(usage_per_day) u1, min(tenure_days) t0, max(tenure_days) t1, min(mrr) m0, max(mrr) m1 FROM profile),
s AS (SELECT user_id, churned, 40 * (usage_per_day - u0) / (u1 - u0) + 30 * (tenure_days - t0) / CAST(t1 - t0 AS DOUBLE) + 30 * (mrr - m0) / (m1 - m0) AS q FROM profile, b)
SELECT user_id, round(q, 6) AS quality_score, round((SELECT corr(q, churned) FROM s), 6) AS churn_correlation FROM s""")
def quality_score_composite(spark, d):
    rows = st.quality_composite(stored_profile(spark, d))
    c = totals(rows, c=F.corr("quality_score", "churned"))["c"]
    return rows.select("user_id", rnd("quality_score").alias("quality_score"), rnd(c).alias("churn_correlation"))


@query("mrr_forecast_drop", """WITH m AS (SELECT o_custkey AS user_id, (year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS x, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM orders GROUP BY 1, 2),
s AS (SELECT user_id, count(*) AS months, CAST(count(*) AS DOUBLE) AS n, CAST(sum(x) AS DOUBLE) AS sx, CAST(sum(x * x) AS DOUBLE) AS sxx, CAST(sum(v) AS DOUBLE) AS sv, CAST(sum(v * x) AS DOUBLE) AS sxv FROM m GROUP BY 1),
f AS (SELECT user_id, months, sv / n AS mv, greatest(sv / n + (n * sxv - sx * sv) / (n * sxx - sx * sx) * (80.0::DOUBLE - sx / n), 0.0::DOUBLE) AS ahead FROM s), g AS (SELECT user_id, months, mv, CASE WHEN months > 1 THEN ahead END AS forecast FROM f)
SELECT user_id, months, round(mv, 6) AS mean_value, round(forecast, 6) AS forecast, forecast < mv * (1 - 0.2::DOUBLE) AS is_drop FROM g""")
def mrr_forecast_drop(spark, d):
    month_no = (F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate")
    monthly = src.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("user_id"), month_no.alias("month_no")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("v")
    )
    out = st.forecast_drop(monthly, "user_id", "month_no", "v", 80)
    return out.select("user_id", "months", rnd("mean_value", 6).alias("mean_value"), rnd("forecast", 6).alias("forecast"), "is_drop")


@query("chart_data_histogram", with_("subs") + """, r AS (SELECT min(mrr) AS lo, max(mrr) AS hi FROM subs)
SELECT CAST(least(floor((mrr - lo) / (hi - lo) * 12), 11) AS BIGINT) AS bin, count(*) AS n, round(min(mrr), 4) AS low, round(max(mrr), 4) AS high FROM subs, r WHERE mrr IS NOT NULL GROUP BY 1""")
def chart_data_histogram(spark, d):
    out = st.histogram(stored_subscriptions(spark, d), "mrr", 12)
    return out.select("bin", "n", rnd("low", 4).alias("low"), rnd("high", 4).alias("high"))


@query("chart_data_box", with_("subs") + "SELECT plan_tier, round(min(mrr), 4) AS low, round(quantile_cont(mrr, 0.25), 4) AS q1, round(median(mrr), 4) AS median, round(quantile_cont(mrr, 0.75), 4) AS q3, round(max(mrr), 4) AS high FROM subs GROUP BY 1")
def chart_data_box(spark, d):
    out = st.box_data(stored_subscriptions(spark, d), "plan_tier", "mrr")
    return out.select("plan_tier", *[rnd(c, 4).alias(c) for c in ("low", "q1", "median", "q3", "high")])
