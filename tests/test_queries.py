"""Registered queries against their SQL at the smallest scale, and plan checks."""

import pytest

import __spark_entry__ as entry_module
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
CHECKED = ["s17_base_fact", "s08_keep_first", "a08_avg_inter_purchase_days", "a16_price_std", "a44_customer_features",
           "e14_category_performance", "e22_heat_map", "g04_segment_distribution", "g07_cohort_profiles", "n02_intent",
           "n13_resolved_requests", "n14_running_context", "t01_context_stream", "x10_feature_pipeline", "q08_constraint_report",
           "s24_playbook_segments", "n12_text_comparisons", "s13_manifest_rows", "g07_cohort_clusters"]


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, name):
    problem = compare(spark, connect(SF), entry_module.queries()[name], entry_module.oracle_sql()[name], SF)
    assert problem is None


def test_every_oracle_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["a08_avg_inter_purchase_days", "a11_category_concentration", "a35_weekend_shopping_rate", "e10_order_values"])
def test_no_single_task_and_no_python(spark, name):
    plan = entry_module.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subqueries")[0]
    assert "SinglePartition" not in main and "Python" not in main and "InPandas" not in main
