"""Plans hold no cross join, push filters down and read only the columns they need."""

import pytest

from brightledger.plans.catalog import all_queries

QUERIES = all_queries()


def plan_of(spark, folder, name):
    return QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["a37_dashboards", "m4_min_max_rescale", "q12_outlier_fences", "d7_event_age_check", "j5_interval_pairs",
                                  "j10_trailing_day_mean", "j13_best_overlap", "x15_keyword_search", "st8_unified_alerts", "a27_kernel_density",
                                  "g2_pagerank", "w2_trailing_row_mean"])
def test_no_cross_join(spark, folder, name):
    plan = plan_of(spark, folder, name)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_filter_and_columns_reach_the_scan(spark, folder):
    plan = plan_of(spark, folder, "p3_equality_filter")
    assert "EqualTo(o_orderstatus,F)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in plan


def test_top_n_is_cut_before_the_shuffle(spark, folder):
    assert "WindowGroupLimit" in plan_of(spark, folder, "w1_rank_ties_kept")
