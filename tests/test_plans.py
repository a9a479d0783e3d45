"""What the plans must look like."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["ind_sma", "ind_rsi_sma", "sig_crossover", "risk_returns", "news_rank", "news_buckets_daily", "merge_upsert"])
def test_no_python_in_native_paths(spark, name):
    assert "Pandas" not in plan(spark, name) and "ArrowEval" not in plan(spark, name)


@pytest.mark.parametrize("name", ["price_latest_snapshot", "news_dedupe", "financials_latest", "merge_apply_changes", "price_newest"])
def test_leading_rows_are_cut_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(spark, name)


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n.startswith(("ind", "news", "merge", "port_items", "summary", "content"))))
def test_no_cross_joins(spark, name):
    p = plan(spark, name)
    assert "CartesianProduct" not in p and "NestedLoop" not in p


def test_range_scan_is_pushed_down(spark):
    p = plan(spark, "price_scan_range")
    assert "EqualTo(ticker,S000003)" in p and "GreaterThanOrEqual(date" in p and "TakeOrderedAndProject" in p


def test_indicators_read_only_what_they_need(spark):
    p = plan(spark, "ind_sma")
    assert "ReadSchema: struct<ticker:string,date:date,close:double>" in p


def test_rows_are_never_the_broadcast_side(spark):
    assert "BuildLeft" not in plan(spark, "ind_sma") and "BuildLeft" not in plan(spark, "risk_returns")
