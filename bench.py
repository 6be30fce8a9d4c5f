"""Time headline queries: BENCH_SF_DIR, BENCH_CPUS and BENCH_KEYS (comma list or 'all') set the run; prints one JSON line."""

from __future__ import annotations

import json
import os
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from saltmarsh.plans import QUERIES  # noqa: E402
from saltmarsh.session import local_session  # noqa: E402

HEADLINE = """
scan_parquet table_overview describe_table drop_dupes impute_mean_median_mode segment_by_quartile_rules
join_validate join_catalog_adoption customer_360 customer_360_by_plan
usage_stats_global user_top_decile user_feature_summary churn_by_plan_region active_users_daily adoption_by_plan
cross_sell_pairs upgrade_patterns risk_bucket_lift grouping_totals sort_desc_limit
region_zscore_anomaly retention_matrix conversion_funnel session_duration history_token_budget latest_checkpoint
checkpoint_history cache_hit_flag p95_index_method word_overlap
classify_content doc_pipeline detect_language pii_redact ticket_rules_triage preference_product_match
chunk_fixed chunk_recursive similarity_search bm25_search text_similarity_metrics eval_summary slo_report approval_metrics approval_sla
chi2_independence anova_oneway correlation_matrix standard_scale roc_auc pr_curve feature_drift
logistic_regression cluster_by_cohort kmeans dbscan pca_variance stream_event_counts
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    asked = os.environ.get("BENCH_KEYS", "")
    keys = list(QUERIES) if asked == "all" else [k for k in asked.split(",") if k] or HEADLINE
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    for k in ("customer_360", "word_overlap"):  # start the JVM's compilers before timing
        QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for k in keys:
        t = time.perf_counter()
        QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[k] = round(time.perf_counter() - t, 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf_dir.rsplit("/sf", 1)[-1]}))


if __name__ == "__main__":
    main()
