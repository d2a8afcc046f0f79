"""Null and edge-case behaviour."""

import pytest

from churnlake.operators import clean as C
from churnlake.operators import encoding as TE
from churnlake.operators import evaluate as I
from churnlake.operators import profile as P


def test_null_key_excluded_from_group_mean(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), ("a", 0)], "k string, y int")
    rows = P.group_mean(df, "k", "y").collect()
    assert [(r.k, r.rate) for r in rows] == [("a", 0.5)]


def test_all_null_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, x double")
    m = {r.col_name: r.missing for r in P.missing_counts(df).collect()}
    assert m == {"id": 0, "x": 2}
    assert C.fit_medians(df, ["x"]) == {"x": None}
    assert C.impute_median_all_numeric(df).where("x is null").count() == 2


def test_mode_ties_take_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert C.mode_of(df, "c") == "a"


def test_one_class_only_metrics(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, pred int")
    r = I.classification_metrics(df, "y", "pred").first()
    assert (r.accuracy, r.precision, r.recall, r.f1) == (1.0, 0.0, 0.0, 0.0)
    sc = spark.createDataFrame([(0, 0.3), (0, 0.4)], "y int, p double")
    assert I.roc_auc(sc, "y", "p").first().roc_auc is None


def test_zero_smoothing_with_key_only_in_own_fold(spark):
    df = spark.createDataFrame([(1, "a", 1, 0), (2, "b", 0, 1), (3, "b", 1, 0)], "id int, k string, y int, fold int")
    out = {r.id: r.te for r in TE.oof_target_encode(df, "k", "y", "fold", 0.0, "te").collect()}
    assert out[1] == pytest.approx(2 / 3)  # key 'a' unseen outside its fold -> prior
    assert out[2] == pytest.approx(1.0) and out[3] == pytest.approx(0.0)


def test_skewness_small_n_is_null(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    assert P.median_skew(df, ["x"]).first().skew is None
