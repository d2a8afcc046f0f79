"""Plan checks: no cartesian products, filters and pruning reach the scan."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

BAD = ("CartesianProduct", "BroadcastNestedLoopJoin")
SAMPLE = ["a1_accounts_scan", "b10_iqr_outliers", "b14_histogram_age", "b16_density_age_by_target",
          "e02_stratified_kfold10", "f08_oof_te_conditional", "g05_identity_match_audit", "i04_threshold_sweep_81"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SAMPLE)
def test_no_cartesian_product(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert not any(b in plan for b in BAD), plan


def test_scan_prunes_columns(spark):
    from churnlake.sources.accounts import accounts

    df = accounts(spark, SF_SMALL).select("id", "age")
    plan = df._jdf.queryExecution().executedPlan().toString()
    # lineitem is read with only the columns `age` needs (the unused aggregates are pruned too)
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan
    assert "l_extendedprice" not in plan and "l_shipdate" not in plan


def test_fold_window_is_partitioned(spark):
    from pyspark.sql import functions as F

    from churnlake.operators.folds import stratified_kfold

    df = spark.range(1000).select("id", (F.col("id") % 2).alias("y"))
    plan = _plan(stratified_kfold(df, "y", 5))
    assert "hashpartitioning(y" in plan
