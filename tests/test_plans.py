"""Shape of the physical plans that decide the cost at scale."""

import re

import pytest

from creditloom.operators import bureau, evaluation, installments, previous, profiling, quality
from creditloom.plans import mart


@pytest.fixture
def large_tables(spark):
    """Plan as for tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_scan_the_payments_once(tables):
    one = plan_of(installments.installments_windowed(tables.stg("installments")))
    joined = plan_of(installments.installments_windowed_joined(tables.stg("installments")))
    assert (one.count("lineitem.parquet"), joined.count("lineitem.parquet")) == (1, 4)
    assert one.count("Exchange hashpartitioning") == 1


def test_histories_are_combined_before_the_shuffle(tables, large_tables):
    plan = plan_of(tables.mart())
    assert "Window" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
    # One exchange per history aggregate by loan, one for the applications; the
    # joins of the mart add none. Credit types and the balance level need their
    # own keys first.
    by_loan = re.findall(r"Exchange hashpartitioning\(loan_id#\d+L, \d+\)", plan)
    assert len(by_loan) == 7


def test_only_used_columns_are_read(tables):
    plan = plan_of(tables.mart())
    schemas = re.findall(r"lineitem.parquet.*?ReadSchema: struct<([^>]*)>", plan)
    assert sorted(schemas, key=len)[0].split(",") == ["l_orderkey:bigint", "l_quantity:double"]


def test_latest_row_is_limited_before_the_shuffle(tables):
    plan = plan_of(previous.latest_previous(tables.stg("previous")))
    assert plan.count("WindowGroupLimit") == 2


def test_scores_are_counted_before_the_shuffle(tables):
    plan = plan_of(evaluation.auc(tables.scored()))
    assert "partial_count" in plan.split("FileScan")[0]
    assert plan.count("FileScan") == 1


def test_split_does_not_shuffle_the_table(tables):
    from creditloom.operators.splits import stratified_split
    plan = plan_of(stratified_split(tables.stg("application")))
    assert "Exchange hashpartitioning" not in plan and "Sort" not in plan


def test_bureau_is_scanned_once(tables):
    plan = plan_of(bureau.bureau_features(tables.stg("bureau")))
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_bucketed_staging_needs_no_exchange_by_loan(tables, large_tables):
    """But for the balance history, which is combined by credit before it has a loan."""
    stg = mart.bucketed_staging(tables.spark, tables.raw)
    plan = plan_of(mart.mart_of_staged(stg.__getitem__))
    assert len(re.findall(r"Exchange hashpartitioning\(loan_id", plan)) == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_correlations_expand_no_rows(tables):
    raw = tables.raw("application_train")
    for df in (profiling.corr_matrix(raw, profiling.KEY_FEATURES), profiling.top_correlations(raw, "TARGET"), profiling.column_redundancy(raw)):
        assert "Expand" not in plan_of(df) and "Generate" not in plan_of(df)


def test_checks_scan_every_table_once(tables):
    plan = plan_of(quality.quality_report({n: tables.raw(n) for n in ("application_train", "bureau")},
                                          [c for c in quality.DECLARED if c.table in ("application_train", "bureau")]))
    assert plan.count("Generate explode") == 2 and len(re.findall(r"Exchange hashpartitioning", plan)) <= 2
