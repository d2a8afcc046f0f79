"""Order statistics at the edges, fractional medians, and hot keys that AQE can split."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlake.operators import audit, clean, encoding, folds, joins, stats


def test_order_statistics_with_infinite_and_many_values(spark):
    n = 120_000
    v = np.random.default_rng(1).normal(size=n) * 10.0 ** np.random.default_rng(2).integers(-9, 9, n)
    v[:3], v[3:5] = np.inf, -np.inf
    df = spark.createDataFrame(zip(v.tolist()), "x double").repartition(4)
    got = stats.exact_quantiles(df, ["x"], [0.0, 0.25, 0.5, 0.75, 1.0])[((), "x")]
    s = np.sort(v)
    for p, q in zip([0.0, 0.25, 0.5, 0.75, 1.0], got):
        pos = p * (n - 1)
        a, b = s[math.floor(pos)], s[math.ceil(pos)]
        assert q == pytest.approx(a if a == b else a + (b - a) * (pos - math.floor(pos)), rel=1e-12)


def test_order_statistics_over_the_whole_double_range(spark):
    df = spark.createDataFrame([(x,) for x in (-1.7e308, -1.0, 5e-324, 1.0, 1.7e308)], "x double")
    assert stats.exact_quantiles(df, ["x"], [0.5], max_collect=1)[((), "x")] == [5e-324]


def test_integer_columns_take_fractional_medians(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, 5), (None, None)], "a int, b int")
    got = clean.impute_median_all_numeric(df)
    assert sorted(r["a"] for r in got.collect()) == [1.0, 2.0, 2.5, 3.0, 4.0]
    assert dict(clean.fill_constants(df, {"b": 3.0}).dtypes)["b"] == "int"


def test_null_labels_are_refused(spark):
    df = spark.createDataFrame([(1, 0), (2, None)], "id long, y int")
    with pytest.raises(Exception, match="null in label column"):
        folds.stratified_kfold(df, "y", 2).collect()


@pytest.fixture
def skewed(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    df = spark.range(200_000).repartition(8).select("id", F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 5000).alias("k"), (F.col("id") % 3 == 0).cast("int").alias("y"), (F.col("id") % 4).cast("int").alias("fold"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    yield df
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("hot", [0, None])
def test_hot_and_null_keys_are_split(spark, skewed, hot):
    df = skewed.withColumn("k", F.when(F.col("k") != 0, F.col("k")).otherwise(F.lit(hot)))
    table = df.groupBy("k").agg(F.avg("y").alias("v"))
    frames = [
        encoding.oof_target_encode(df, "k", "y", "fold", 5.0, "te"),
        encoding.te_apply(df, df, "k", "y", 5.0, "te"),
        joins.lookup_join_default(df, table, "k", "v", 0.0),
    ]
    for f in frames:
        f.write.format("noop").mode("overwrite").save()
        f = f.withColumn("_", F.lit(1))
        assert f.count() == 200_000
        rows = f.select("id").toPandas()  # runs the plan that is inspected below
        assert len(rows) == 200_000
    out = encoding.te_apply(df, df, "k", "y", 5.0, "te")
    out.collect()
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    assert audit.key_coverage(df, df, "k").first()["n_test"] == 200_000


@pytest.mark.parametrize("by", [[], ["g"]])
def test_order_statistics_with_heavy_values_and_sketches_that_miss(spark, monkeypatch, by):
    n = 60_000
    df = spark.range(0, n, 1, 4).select(
        F.when(F.rand(1) < 0.4, 2.5).otherwise(F.rand(2) * F.exp(F.randn(3) * 9)).alias("x"), (F.col("id") % 3).cast("double").alias("t"),
        F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("g"))
    pdf, probs, missed, plain = df.toPandas(), [0.0, 0.001, 0.25, 0.5, 0.9999, 1.0], set(), stats._bracket

    def misses_once(st, at, n, *rest):
        if at in missed:
            return plain(st, at, n, *rest)
        missed.add(at)
        return plain(st, (at + n // 2) % n, n, *rest)

    monkeypatch.setattr(stats, "_bracket", misses_once)
    got = stats.exact_quantiles(df, ["x", "t"], probs, by=by, max_collect=200)
    parts = [((None if np.isnan(g) else int(g),), p) for g, p in pdf.groupby("g", dropna=False)] if by else [((), pdf)]
    assert len(missed) > 3 and len(got) == 2 * len(parts)
    for g, part in parts:
        for c in ("x", "t"):
            assert np.allclose(got[g, c], np.quantile(part[c], probs), rtol=1e-12, atol=0)


def test_order_statistics_bound_their_groups_and_cache_nothing(spark):
    df = spark.range(500).select((F.col("id") % 50).alias("g"), F.col("id").cast("double").alias("x"))
    with pytest.raises(ValueError, match="groups"):
        stats.order_statistics(df, ["x"], lambda n: {0}, by=["g"], max_groups=49)
    values, counts = stats.order_statistics(df, ["x"], lambda n: {0, n - 1, n}, by=["g"], max_groups=50)
    assert len(counts) == 50 and values[(7,), "x"] == {0: 7.0, 9: 457.0}
    assert stats.order_statistics(df.where("x < 0"), ["x"], lambda n: {0}) == ({}, {})
    assert not list(spark.sparkContext._jsc.getPersistentRDDs())
