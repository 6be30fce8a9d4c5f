"""Hypothesis tests, feature preparation, splits and metrics on scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scale import attach, attach_quantiles, null_safe_join, quantile_scalars, quantiles, running, totals
from ..functions.special import binomial_interval_udf, p_value_udf
from ..session import cut_lineage

# ---- tests


def chi_square(df: DataFrame, a: str, b: str) -> DataFrame:
    """Observed and expected count per cell with the statistic, its degrees of freedom and p."""
    cells = cut_lineage(df.groupBy(a, b).agg(F.count("*").alias("observed")))
    by_a = cells.groupBy(a).agg(F.sum("observed").alias("n_a"))
    by_b = cells.groupBy(b).agg(F.sum("observed").alias("n_b"))
    n = totals(cells, n=F.sum("observed"))["n"]
    # cells that never occur count with observed 0, so every level pair is laid out
    levels = by_b.agg(F.collect_list(F.struct(b, "n_b")).alias("l")).scalar()
    full = null_safe_join(by_a.select(a, "n_a", F.inline(levels)), cells, [a, b], "left").fillna(0, ["observed"])
    full = full.withColumn("expected", F.col("n_a") * F.col("n_b") / n)
    s = totals(
        full, chi2=F.sum(F.try_divide(F.pow(F.col("observed") - F.col("expected"), 2), "expected")),
        dof=((F.countDistinct(F.struct(a)) - 1) * (F.countDistinct(F.struct(b)) - 1)).cast("double"),
    )
    p = p_value_udf()
    out = full.select(a, b, "observed", "expected", s["chi2"].alias("chi2"), s["dof"].alias("dof"))
    return out.withColumn("p_value", p(F.lit("chi2"), F.col("chi2"), F.col("dof"), F.lit(0.0)))


def group_moments(df: DataFrame, group: str, value: str) -> DataFrame:
    return df.groupBy(group).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("var"))


def two_sample_t(df: DataFrame, flag: str, value: str) -> DataFrame:
    """Pooled-variance t for rows with ``flag`` 1 against 0."""
    hit = F.col(flag) == 1
    s = df.agg(
        F.count(F.when(hit, F.col(value))).alias("n1"), F.count(F.when(~hit, F.col(value))).alias("n0"),
        F.avg(F.when(hit, F.col(value))).alias("mean1"), F.avg(F.when(~hit, F.col(value))).alias("mean0"),
        F.var_samp(F.when(hit, F.col(value))).alias("v1"), F.var_samp(F.when(~hit, F.col(value))).alias("v0"),
    )
    return _pooled_t(s)


def _pooled_t(s: DataFrame) -> DataFrame:
    dof = F.col("n1") + F.col("n0") - 2
    pooled = F.try_divide((F.col("n1") - 1) * F.col("v1") + (F.col("n0") - 1) * F.col("v0"), dof)
    s = s.withColumn("dof", dof.cast("double"))
    return s.withColumn("t", F.try_divide(F.col("mean1") - F.col("mean0"), F.sqrt(pooled * (F.try_divide(F.lit(1), "n1") + F.try_divide(F.lit(1), "n0")))))


def anova(df: DataFrame, group: str, value: str) -> DataFrame:
    """One-way F, its degrees of freedom, and eta squared, from group moments."""
    g = cut_lineage(group_moments(df, group, value))
    grand = totals(g, m=F.sum(F.col("n") * F.col("mean")) / F.sum("n"))["m"]
    parts = g.withColumn("grand", grand).agg(
        F.sum(F.col("n") * F.pow(F.col("mean") - F.col("grand"), 2)).alias("ssb"), F.sum((F.col("n") - 1) * F.col("var")).alias("ssw"),
        (F.count("*") - 1).cast("double").alias("df_between"), (F.sum("n") - F.count("*")).cast("double").alias("df_within"),
    )
    f = F.try_divide(F.try_divide("ssb", "df_between"), F.try_divide("ssw", "df_within"))
    return parts.withColumn("f", f).withColumn("eta_squared", F.try_divide(F.col("ssb"), F.col("ssb") + F.col("ssw")))


def pairwise_t(df: DataFrame, group: str, value: str) -> DataFrame:
    """Pooled t for each pair of groups, with the number of pairs for the Bonferroni factor."""
    g = cut_lineage(group_moments(df, group, value))
    listed = g.agg(F.array_sort(F.collect_list(F.struct(group, "n", "mean", "var"))).alias("l")).scalar()
    rows = g.select(F.col(group).alias("a"), F.col("n").alias("n1"), F.col("mean").alias("mean1"), F.col("var").alias("v1"), F.explode(listed).alias("o"))
    rows = rows.where(F.col("a") < F.col("o")[group]).select(
        "a", F.col("o")[group].alias("b"), "n1", "mean1", "v1", F.col("o.n").alias("n0"), F.col("o.mean").alias("mean0"), F.col("o.var").alias("v0")
    )
    k = totals(g, k=F.count("*"))["k"]
    return _pooled_t(rows).withColumn("pairs", k * (k - 1) / 2)


def two_proportions(df: DataFrame, group: str, flag: str, a: str, b: str) -> DataFrame:
    """Rates of two groups, lift of ``a`` over ``b`` and the pooled z."""
    def of(name):
        return F.col(group) == name

    s = df.agg(
        F.count_if(of(a)).alias("n_a"), F.count_if(of(b)).alias("n_b"),
        F.coalesce(F.sum(F.when(of(a), F.col(flag))), F.lit(0)).alias("x_a"), F.coalesce(F.sum(F.when(of(b), F.col(flag))), F.lit(0)).alias("x_b"),
    )
    s = s.withColumn("rate_a", F.try_divide("x_a", "n_a")).withColumn("rate_b", F.try_divide("x_b", "n_b"))
    pool = (F.col("x_a") + F.col("x_b")) / (F.col("n_a") + F.col("n_b"))
    se = F.sqrt(pool * (1 - pool) * (1 / F.col("n_a") + 1 / F.col("n_b")))
    return s.withColumn("lift", F.try_divide("rate_a", "rate_b") - 1).withColumn("z", F.try_divide(F.col("rate_a") - F.col("rate_b"), se))


def significance_p_values(df: DataFrame, flag: str, group: str, value: str) -> DataFrame:
    """p of the t-test, the one-way F and every Bonferroni-corrected pair in one table."""
    p = p_value_udf()
    none = F.lit(None).cast("double")
    t = two_sample_t(df, flag, value).select(F.lit("t").alias("kind"), F.lit(flag).alias("test"), F.col("t").alias("statistic"), F.col("dof").alias("d1"), none.alias("d2"), F.lit(1.0).alias("factor"))
    f = anova(df, group, value).select(F.lit("f").alias("kind"), F.lit(group).alias("test"), F.col("f").alias("statistic"), F.col("df_between").alias("d1"), F.col("df_within").alias("d2"), F.lit(1.0).alias("factor"))
    pairs = pairwise_t(df, group, value).select(F.lit("t").alias("kind"), F.concat_ws(" vs ", "a", "b").alias("test"), F.col("t").alias("statistic"), F.col("dof").alias("d1"), none.alias("d2"), F.col("pairs").cast("double").alias("factor"))
    every = t.unionByName(f).unionByName(pairs)
    return every.withColumn("p_value", F.least(p("kind", "statistic", "d1", "d2") * F.col("factor"), F.lit(1.0)))


def proportion_interval(df: DataFrame, group: str, flag: str, level: float = 0.95) -> DataFrame:
    """Binomial quantile interval at the observed rate, per group."""
    rates = df.groupBy(group).agg(F.count("*").alias("n"), F.avg(flag).alias("rate"))
    bounds = binomial_interval_udf()("n", "rate", F.lit(level))
    return rates.withColumn("ci", bounds).select(group, "n", "rate", F.col("ci.low").alias("ci_low"), F.col("ci.high").alias("ci_high"))


# ---- features


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    one = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = one.unpivot([], one.columns, "pair", "correlation")
    return long.select(F.split_part("pair", F.lit("|"), F.lit(1)).alias("a"), F.split_part("pair", F.lit("|"), F.lit(2)).alias("b"), "correlation")


def variances(df: DataFrame, columns: list[str], threshold: float) -> DataFrame:
    one = df.agg(*[F.var_pop(c).alias(c) for c in columns])
    return one.unpivot([], columns, "feature", "variance").withColumn("keep", F.col("variance") > threshold)


MOST_LEVEL_COLUMNS = 2000


def one_hot(df: DataFrame, column: str, prefix: str, levels: list | None = None) -> DataFrame:
    """0/1 column per level, the first in order left out. At most ``MOST_LEVEL_COLUMNS`` levels; ``LevelVectors`` takes any number."""
    if levels is None:
        found = df.select(column).where(F.col(column).isNotNull()).distinct().limit(MOST_LEVEL_COLUMNS + 1)
        levels = [r[0] for r in found.collect()]
    if len(levels) > MOST_LEVEL_COLUMNS:
        raise ValueError(f"{column} has more than {MOST_LEVEL_COLUMNS} levels; use LevelVectors")
    return df.select("*", *[(F.col(column) == v).cast("int").alias(f"{prefix}_{v}") for v in sorted(levels)[1:]])


class LevelVectors:
    """One sparse vector per row in place of a column per level, fitted on some rows (the training rows).

    Levels are numbered in descending order of their text; the first in ascending order is the base and has no entry. NULL
    and levels that the fitted rows lack are the base as well: all zero. The list of levels, as text, is
    kept on the driver, as any fitted indexer does; rows carry one number each.
    """

    def __init__(self, fitted_on: DataFrame, column: str):
        from pyspark.ml.feature import StringIndexer

        self.column = column
        text = fitted_on.select(F.col(column).cast("string").alias("_level")).where("_level IS NOT NULL")
        self.indexer = StringIndexer(inputCol="_level", outputCol="_at", stringOrderType="alphabetDesc", handleInvalid="keep").fit(text)
        self.levels = list(self.indexer.labelsArray[0])

    @property
    def names(self) -> list[str]:
        """The level of each vector entry."""
        return self.levels[:-1]

    def transform(self, df: DataFrame, output: str) -> DataFrame:
        from pyspark.ml.feature import OneHotEncoder
        from pyspark.ml.functions import array_to_vector

        base = max(len(self.levels) - 1, 0)
        at = self.indexer.transform(df.withColumn("_level", F.col(self.column).cast("string")))
        at = at.withColumn("_at", F.least(F.col("_at"), F.lit(float(base))))
        if not base:  # one level or none: nothing to tell apart
            return at.withColumn(output, array_to_vector(F.array().cast("array<double>"))).drop("_level", "_at")
        sizes = df.sparkSession.createDataFrame([(float(base),)], "_at double")
        encoder = OneHotEncoder(inputCols=["_at"], outputCols=[output], dropLast=True).fit(sizes)
        return encoder.transform(at).drop("_level", "_at")


def hash_share(key: str) -> Column:
    """A number in [0, 2^32) fixed by the key alone."""
    return F.conv(F.substr(F.md5(F.col(key).cast("string")), F.lit(1), F.lit(8)), 16, 10).cast("bigint")


def hash_split(df: DataFrame, key: str, train_percent: int = 80) -> DataFrame:
    return df.withColumn("split", F.when(hash_share(key) % 100 < train_percent, "train").otherwise("test"))


def time_split(df: DataFrame, date: str) -> DataFrame:
    """The latest month is the test set."""
    last = totals(df, m=F.max(F.trunc(date, "MM")))["m"]
    return df.withColumn("split", F.when(F.trunc(date, "MM") == last, "test").otherwise("train"))


def stratified_folds(df: DataFrame, label: str, key: str, folds: int = 5) -> DataFrame:
    """Fold numbers dealt in hash order inside each class, so class sizes differ by at most one."""
    rows = df.withColumn("_h", hash_share(key))
    dealt = running(rows, [label], ["_h", key], F.floor(F.col("_h") / 65536), _n=F.lit(1).cast("bigint"))
    return dealt.withColumn("fold", ((F.col("_n") - 1) % folds).cast("int")).drop("_h", "_n")


def target_encoding(df: DataFrame, category: str, label: str, key: str, folds: int = 5) -> DataFrame:
    """Mean label per category, and the mean without the row's own fold."""
    rows = df.withColumn("fold", hash_share(key) % folds).withColumn("_k", F.struct(category))  # in a struct NULL equals NULL
    per_fold = rows.groupBy("_k", "fold").agg(F.sum(label).alias("s"), F.count("*").alias("n"))
    whole = per_fold.groupBy("_k").agg(F.sum("s").alias("s_all"), F.sum("n").alias("n_all"))
    codes = per_fold.join(whole, "_k").select(
        "_k", "fold", (F.col("s_all") / F.col("n_all")).alias("encoded"),
        F.try_divide(F.col("s_all") - F.col("s"), F.col("n_all") - F.col("n")).alias("encoded_oof"),
    )
    return rows.join(codes, ["_k", "fold"]).drop("_k")


def standard_scale(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population std as ``<c>_z``; constants become 0, NULL stays NULL."""
    src = df if fit_on is None else fit_on
    df = attach(df, src, **{f"m_{c}": F.avg(c) for c in columns}, **{f"s_{c}": F.stddev_pop(c) for c in columns})

    def scaled(c):
        flat = F.when(F.col(c).isNotNull(), F.lit(0.0))
        return F.coalesce(F.try_divide(F.col(c) - F.col(f"_s.m_{c}"), F.col(f"_s.s_{c}")), flat).alias(f"{c}_z")

    return df.select("*", *[scaled(c) for c in columns]).drop("_s")


def minmax_scale(df: DataFrame, columns: list[str], top: float = 1.0) -> DataFrame:
    df = attach(df, df, **{f"a_{c}": F.min(c) for c in columns}, **{f"b_{c}": F.max(c) for c in columns})

    def scaled(c):
        low, high = F.col(f"_s.a_{c}"), F.col(f"_s.b_{c}")
        flat = F.when(F.col(c).isNotNull(), F.lit(0.0))
        return F.coalesce(F.try_divide((F.col(c) - low) * top, high - low), flat).alias(f"{c}_scaled")

    return df.select("*", *[scaled(c) for c in columns]).drop("_s")


def outlier_flags(df: DataFrame, value: str, z_limit: float = 3.0) -> DataFrame:
    """IQR and z-score flags and the value capped at P99."""
    out = attach_quantiles(df, df, value, {"q1": 0.25, "q3": 0.75, "p99": 0.99})
    out = attach(out, df, mean=F.avg(value), std=F.stddev_pop(value))
    x, q1, q3 = F.col(value), F.col("_q.q1"), F.col("_q.q3")
    fence = (q3 - q1) * 1.5
    return out.select(
        *df.columns, ((x < q1 - fence) | (x > q3 + fence)).alias("iqr_outlier"),
        (F.abs(F.try_divide(x - F.col("_s.mean"), F.col("_s.std"))) > z_limit).alias("z_outlier"), F.least(x, F.col("_q.p99")).alias("capped"),
    )


def population_stability(base: DataFrame, recent: DataFrame, value: str, buckets: int = 10) -> DataFrame:
    """Shares per bucket of the base quantiles, then and now, with each bucket's PSI part."""
    edges = {f"e{i}": i / buckets for i in range(1, buckets)}
    rows = base.select(value, F.lit(1).alias("is_base")).unionByName(recent.select(value, F.lit(0).alias("is_base")))
    rows = attach_quantiles(rows, base, value, edges)
    bucket = reduce(lambda a, b: a + b, [(F.col(value) > F.col(f"_q.{e}")).cast("int") for e in edges])
    counts = rows.groupBy(bucket.alias("bucket")).agg(F.sum("is_base").alias("b"), F.sum(1 - F.col("is_base")).alias("r"))
    n = totals(counts, b=F.sum("b"), r=F.sum("r"))
    both = counts.select("bucket", (F.col("b") / n["b"]).alias("base_share"), (F.col("r") / n["r"]).alias("recent_share"))
    floor = F.lit(1e-6)
    p, q = F.greatest("recent_share", floor), F.greatest("base_share", floor)
    return both.withColumn("psi_part", (p - q) * F.log(p / q))


# ---- metrics on scores


def regression_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    err = F.col(y) - F.col(yhat)
    r2 = 1 - F.try_divide(F.sum(err * err), F.var_pop(y) * F.count(y))
    return df.agg(F.count(y).alias("n"), F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse"), r2.alias("r2"))


def confusion(label: str, predicted: Column) -> dict[str, Column]:
    yes = F.col(label) == 1
    return {"tp": F.count_if(yes & predicted), "fp": F.count_if(~yes & predicted), "fn": F.count_if(yes & ~predicted), "tn": F.count_if(~yes & ~predicted)}


def rates(df: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 from the four counts; 0 where nothing is predicted or present."""
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), zero)
    recall = F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fn")), zero)
    df = df.withColumn("accuracy", F.try_divide(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")))
    df = df.withColumn("precision", precision).withColumn("recall", recall)
    return df.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), zero))


def binary_metrics(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    return rates(df.agg(*[c.alias(k) for k, c in confusion(label, F.col(score) >= threshold).items()]))


def threshold_sweep(df: DataFrame, label: str, score: str, thresholds: list[float]) -> DataFrame:
    """The same for several thresholds, counted in one pass."""
    one = df.agg(*[F.struct(F.lit(float(t)).alias("threshold"), *[c.alias(k) for k, c in confusion(label, F.col(score) >= t).items()]).alias(f"t{i}") for i, t in enumerate(thresholds)])
    return rates(one.select(F.inline(F.array(*[f"t{i}" for i in range(len(thresholds))]))))


def score_counts(df: DataFrame, label: str, score: str, keys: list[str]) -> DataFrame:
    """Positives and negatives per distinct score; rows without a score do not count."""
    return df.where(F.col(score).isNotNull()).groupBy(*keys, F.col(score).alias("score")).agg(F.sum(label).cast("bigint").alias("pos"), F.sum(1 - F.col(label)).cast("bigint").alias("neg"))


def roc_auc(df: DataFrame, label: str, score: str, keys: list[str] | tuple = (), blocks: int = 10_000) -> DataFrame:
    """Rank AUC, ties counted half: rows collapse to distinct scores, summed up block by block (scores lie in 0-1)."""
    keys = list(keys)
    counts = score_counts(df, label, score, keys)
    ranked = running(counts, keys, ["score"], F.floor(F.col("score") * blocks), below=F.col("neg"))
    wins = F.sum(F.col("pos") * (F.col("below") - F.col("neg") + F.col("neg") / 2))
    return ranked.groupBy(*keys).agg(F.try_divide(wins, (F.sum("pos") * F.sum("neg")).cast("double")).alias("auc"), F.sum(F.col("pos") + F.col("neg")).alias("n"))


def pr_curve(df: DataFrame, label: str, score: str, blocks: int = 10_000) -> DataFrame:
    """Precision and recall with every distinct score as threshold."""
    counts = score_counts(df, label, score, [])
    ranked = running(counts, [], [F.col("score").desc()], -F.floor(F.col("score") * blocks), tp=F.col("pos"), fp=F.col("neg"))
    positives = totals(df, p=F.sum(label))["p"]
    return ranked.select(F.col("score").alias("threshold"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), F.try_divide(F.col("tp"), positives).alias("recall"))


def cv_summary(fold_scores: DataFrame, test_score: Column, value: str = "auc", gap: float = 0.05) -> DataFrame:
    out = fold_scores.agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std")).withColumn("test", test_score)
    return out.select(
        "mean", "std", (F.col("mean") - 1.96 * F.col("std")).alias("ci_low"), (F.col("mean") + 1.96 * F.col("std")).alias("ci_high"), "test",
        (F.abs(F.col("mean") - F.col("test")) > gap).alias("shifted"),
    )


# ---- composite scores and chart data


def risk_composite(profile: DataFrame, trend: DataFrame) -> DataFrame:
    """0-100 from the signup month's churn, adoption below the median and falling usage, with a band."""
    # users without a signup date form a month of their own
    rows = profile.withColumn("signup_month", F.coalesce(F.trunc("signup_date", "MM"), F.lit("1900-01-01").cast("date")))
    cohorts = rows.groupBy("signup_month").agg(F.avg("churned").alias("cohort_churn"))
    mid = quantile_scalars(profile, "feature_count", {"m": 0.5})["m"]
    top = totals(cohorts, hi=F.max("cohort_churn"), lo=F.min("cohort_churn"))
    df = rows.join(cohorts, "signup_month").join(trend.select("user_id", "is_declining"), "user_id", "left")
    cohort = F.coalesce(F.try_divide(F.col("cohort_churn") - top["lo"], top["hi"] - top["lo"]), F.lit(0.0))
    low = (F.col("feature_count") < mid).cast("int")
    falling = F.coalesce(F.col("is_declining"), F.lit(False)).cast("int")
    df = df.withColumn("risk_score", cohort * 40 + low * 30 + falling * 30)
    return df.withColumn("band", F.when(F.col("risk_score") < 33, "low").when(F.col("risk_score") < 66, "medium").otherwise("high"))


def quality_composite(profile: DataFrame) -> DataFrame:
    scaled = minmax_scale(profile, ["usage_per_day", "tenure_days", "mrr"], 100.0)
    return scaled.withColumn("quality_score", F.col("usage_per_day_scaled") * 0.4 + F.col("tenure_days_scaled") * 0.3 + F.col("mrr_scaled") * 0.3)


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    s = totals(df, lo=F.min(value), hi=F.max(value))
    at = F.least(F.floor(F.coalesce(F.try_divide(F.col(value) - s["lo"], s["hi"] - s["lo"]), F.lit(0.0)) * bins), F.lit(bins - 1))
    return df.where(F.col(value).isNotNull()).groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))


def box_data(df: DataFrame, group: str, value: str) -> DataFrame:
    q = quantiles(df, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [group]).drop("n")
    return df.groupBy(group).agg(F.min(value).alias("low"), F.max(value).alias("high")).join(q, group)


def forecast_drop(monthly: DataFrame, user: str, month_no: str, value: str, next_month: int, drop: float = 0.2) -> DataFrame:
    """Least-squares line per user, its value in the next month, flagged when it falls by ``drop`` below the user's mean.

    ``value`` is a decimal: its sums are exact, so the line does not depend on the order of rows. A user with one month has no line:
    the forecast and the flag are NULL.
    """
    x, v = F.col(month_no).cast("bigint"), F.col(value)
    fit = monthly.groupBy(user).agg(
        F.count("*").alias("months"), F.sum(x).cast("double").alias("_x"), F.sum(x * x).cast("double").alias("_xx"),
        F.sum(v).cast("double").alias("_v"), F.sum(v * x).cast("double").alias("_xv"),
    )
    n = F.col("months").cast("double")
    slope = F.try_divide(n * F.col("_xv") - F.col("_x") * F.col("_v"), n * F.col("_xx") - F.col("_x") * F.col("_x"))
    fit = fit.withColumn("mean_value", F.col("_v") / n).withColumn("slope", slope)
    ahead = F.col("mean_value") + F.col("slope") * (F.lit(float(next_month)) - F.col("_x") / n)
    fit = fit.withColumn("forecast", F.when(F.col("months") > 1, F.greatest(ahead, F.lit(0.0)))).drop("_x", "_xx", "_v", "_xv")
    return fit.withColumn("is_drop", F.col("forecast") < F.col("mean_value") * (1 - drop))
