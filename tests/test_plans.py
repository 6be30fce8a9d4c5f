"""What the physical plans must and must not hold."""

import pytest

from saltmarsh.plans import ORACLE, QUERIES
from saltmarsh.sources import tables as src

# these keep their numeric kernels in Arrow batches inside tasks
ARROW = {"cross_sell_pairs", "similarity_search", "retrieval_metrics", "hybrid_search", "chi2_independence", "proportion_ci95", "dbscan"}
# bounded by the number of groups, components or registered queries
MATERIALISING = ("stream_", "scan_", "sink_", "load_")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(k for k in ORACLE if not k.startswith(MATERIALISING)))
def test_no_products_and_no_python(key, spark, small):
    plan = plan_of(QUERIES[key](spark, small))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert key in ARROW or ("PythonUDF" not in plan and "InPandas" not in plan and "EvalPython" not in plan)


def test_filters_and_columns_reach_the_scan(spark, small):
    plan = plan_of(QUERIES["filter_date_from"](spark, small))
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan
    assert "l_tax" not in plan_of(QUERIES["table_overview"](spark, small))


def test_top_k_is_pruned_before_the_shuffle(spark, small):
    assert "WindowGroupLimit" in plan_of(QUERIES["history_window_k"](spark, small))
    assert "TakeOrderedAndProject" in plan_of(QUERIES["feature_usage_ranked"](spark, small))


def test_text_files_are_read_whole(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo")
    row = src.read_text_documents(spark, str(tmp_path)).first()
    assert row["text"] == "one\ntwo" and row["source"].endswith("a.txt")


def test_json_array_file(spark, tmp_path):
    (tmp_path / "f.json").write_text('[{"user_id": 1, "text": "a"}, {"user_id": 2, "text": null}]')
    rows = src.read_json(spark, str(tmp_path / "f.json"), "user_id bigint, text string", array_file=True).collect()
    assert [(r["user_id"], r["text"]) for r in rows] == [(1, "a"), (2, None)]


# hash exchanges without broadcasts: NULL-safe keys cost no shuffle of their own
EXCHANGES = {"history_token_budget": 6, "upgrade_patterns": 6, "checkpoint_history": 4, "region_zscore_anomaly": 2}


@pytest.mark.parametrize("key", sorted(EXCHANGES))
def test_null_safe_keys_add_no_shuffle(key, spark, small):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan_of(QUERIES[key](spark, small)).count("Exchange hashpartitioning") == EXCHANGES[key]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
