"""Property tests: the algebraic rewrites against plain loops / brute force."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from churnlake.functions.grids import GRID_41, GRID_81, GRID_161
from churnlake.operators import encoding as TE
from churnlake.operators import evaluate as I
from churnlake.operators import folds as E


def _loop_oof(pdf, keys, k, m, prior_kind):
    """The reference's per-fold loop, written plainly in pandas."""
    out = pd.Series(np.nan, index=pdf.index)
    gm = pdf["y"].mean()
    for f in range(k):
        tr, va = pdf[pdf.fold != f], pdf[pdf.fold == f]
        prior = gm if prior_kind == "global" else tr["y"].mean()
        st_ = tr.dropna(subset=keys).groupby(keys)["y"].agg(["count", "mean"])
        te = (st_["count"] * st_["mean"] + m * prior) / (st_["count"] + m)
        idx = pd.MultiIndex.from_frame(va[keys]) if len(keys) > 1 else va[keys[0]]
        out.loc[va.index] = pd.Series(idx.map(te), index=va.index).astype(float).fillna(prior).values
    return out


@pytest.mark.parametrize("m,prior_kind,keys", [
    (20.0, "global", ["a"]), (5.0, "global", ["a", "b"]), (0.001, "fold", ["a"]), (1.0, "fold", ["a", "b"]),
])
def test_oof_encoding_equals_fold_loop(spark, m, prior_kind, keys):
    rng = np.random.default_rng(3)
    n, k = 600, 5
    pdf = pd.DataFrame({
        "id": np.arange(n), "a": rng.choice(list("abcdefgh") + [None], n), "b": rng.choice(["x", "y"], n),
        "y": rng.integers(0, 2, n), "fold": rng.integers(0, k, n),
    })
    sdf = spark.createDataFrame(pdf)
    got = TE.oof_target_encode(sdf, keys, "y", "fold", m, "te", prior=prior_kind).select("id", "te").toPandas()
    got = got.set_index("id").sort_index()["te"]
    want = _loop_oof(pdf, keys, k, m, prior_kind)
    assert np.allclose(got.values, want.values, atol=1e-12)


def test_unseen_key_gets_prior(spark):
    tr = spark.createDataFrame([(1, "a", 1), (2, "a", 0), (3, "b", 1)], "id int, k string, y int")
    te = spark.createDataFrame([(10, "zzz"), (11, None)], "id int, k string")
    out = {r.id: r.te for r in TE.te_apply(tr, te, "k", "y", 20, "te").collect()}
    assert out[10] == pytest.approx(2 / 3) and out[11] == pytest.approx(2 / 3)


@settings(max_examples=8, deadline=None)
@given(st.integers(min_value=2, max_value=12), st.integers(min_value=30, max_value=400))
def test_stratified_fold_balance(spark, k, n):
    df = spark.range(n).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    f = E.stratified_kfold(df, "y", k, bits=6)
    sizes = f.groupBy("y", "fold").count().toPandas()
    for _, g in sizes.groupby("y"):
        full = g.set_index("fold")["count"].reindex(range(k), fill_value=0)
        assert full.max() - full.min() <= 1


def test_bucketed_rank_equals_plain_window(spark):
    from churnlake.functions.hashing import hash32

    df = spark.range(3000).select("id", (F.col("id") % 4 == 0).cast("int").alias("y"))
    got = E.rank_in_class(df, "y", bits=9).select("id", "rank_in_class")
    w = Window.partitionBy("y").orderBy(hash32("id", "fold"), "id")
    want = df.select("id", F.row_number().over(w).alias("want"))
    diff = got.join(want, "id").where(F.col("rank_in_class") != F.col("want")).count()
    assert diff == 0


def _brute_f1(y, p, t):
    pred = p >= t
    tp = int((pred & (y == 1)).sum())
    denom = int((y == 1).sum()) + int(pred.sum())
    return 2 * tp / denom if denom else 0.0


@pytest.mark.parametrize("grid", [GRID_81, GRID_161, GRID_41])
def test_sweep_equals_brute_force(spark, grid):
    rng = np.random.default_rng(11)
    y = rng.integers(0, 2, 2000)
    p = np.round(np.clip(0.3 * y + rng.random(2000) * 0.7, 0, 1), 3)
    sdf = spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))
    best_t, best_f = 0.5, 0.0
    for t in grid:
        f = _brute_f1(y, p, t)
        if f > best_f:
            best_t, best_f = t, f
    got = I.threshold_sweep_f1(sdf, "y", "p", grid).first()
    assert got.best_thresh == best_t
    assert got.best_f1 == pytest.approx(best_f, abs=1e-12)


def test_sweep_no_positive_predictions_keeps_start(spark):
    sdf = spark.createDataFrame([(0, 0.01), (1, 0.02), (0, 0.03)], "y int, p double")
    got = I.threshold_sweep_f1(sdf, "y", "p", GRID_81).first()
    assert (got.best_thresh, got.best_f1) == (0.5, 0.0)


@pytest.mark.parametrize("pct", [0.0, 0.21, 0.22, 0.5, 0.999])
def test_top_pct_equals_sorted(spark, pct):
    rng = np.random.default_rng(5)
    p = np.round(rng.random(5000), 4)  # many ties
    y = rng.integers(0, 2, 5000)
    sdf = spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))
    want = sorted(p, reverse=True)[int(pct * len(p))]
    assert I.score_at_rank_desc(sdf, "p", int(pct * len(p))) == want


def test_auc_equals_pairwise(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 700)
    p = np.round(rng.random(700), 2)
    pos, neg = p[y == 1], p[y == 0]
    want = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    sdf = spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))
    for ranges in (1, 7, 1000):
        got = I.roc_auc(sdf, "y", "p", ranges=ranges).first().roc_auc
        assert got == pytest.approx(want, abs=1e-12)


@settings(max_examples=6, deadline=None)
@given(st.integers(min_value=1, max_value=300), st.integers(min_value=0, max_value=10_000))
def test_order_statistics_equal_numpy_quantiles(spark, n, seed):
    from churnlake.operators.stats import exact_quantiles

    rng = np.random.default_rng(seed)
    g = rng.integers(0, 2, n)
    x = np.round(rng.normal(0, 10, n), 1)  # ties
    x[rng.random(n) < 0.1] = np.nan  # nulls
    pdf = pd.DataFrame({"g": g, "x": x, "z": np.round(rng.exponential(3, n), 2)})
    sdf = spark.createDataFrame(pdf).selectExpr("g", "nanvl(x, null) as x", "z")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    # tiny bins and collect cap force several narrowing passes
    got = exact_quantiles(sdf, ["x", "z"], probs, by=["g"], bins=3, max_collect=4)
    for gv in (0, 1):
        for c in ("x", "z"):
            vals = pdf.loc[pdf.g == gv, c].dropna().to_numpy()
            if len(vals) == 0:
                continue
            want = np.quantile(vals, probs)
            assert np.allclose(got[((gv,), c)], want, rtol=0, atol=1e-9)


def test_grouped_auc_paths_agree(spark):
    rng = np.random.default_rng(9)
    n = 900
    pdf = pd.DataFrame({"m": rng.choice(["a", "b", "c"], n), "y": rng.integers(0, 2, n), "p": np.round(rng.random(n), 2)})
    sdf = spark.createDataFrame(pdf)
    pdf.loc[pdf.m == "c", "m"] = None  # a null model is one of its own
    sdf = spark.createDataFrame(pdf)
    one_pass = {r.m: r.roc_auc for r in I.roc_auc(sdf, "y", "p", by="m", ranges=1).collect()}
    binned = {r.m: r.roc_auc for r in I.roc_auc(sdf, "y", "p", by="m", ranges=40).collect()}
    assert len(one_pass) == len(binned) == 3
    for m, g in pdf.assign(m=pdf.m.where(pdf.m.notna(), None).astype(object)).groupby("m", dropna=False):
        m = m if isinstance(m, str) else None
        pos, neg = g.p[g.y == 1].to_numpy(), g.p[g.y == 0].to_numpy()
        want = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
        assert one_pass[m] == pytest.approx(want, abs=1e-12)
        assert binned[m] == pytest.approx(want, abs=1e-12)


def test_running_sums_equal_a_plain_window(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 3001).cast("double").alias("v"), (F.col("id") % 11).alias("a"), (F.col("id") % 5).alias("b"))
    plain = Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("*", *[F.coalesce(F.sum(c).over(plain), F.lit(0)).alias(f"{c}_before") for c in "ab"])
    for ranges in (1, 9, 300):
        got = I.running_sums(df, "v", ["a", "b"], ["g"], ranges)
        assert got.columns == want.columns and got.count() == 3000 and got.exceptAll(want).isEmpty()
    whole = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    assert I.running_sums(df, "v", ["a"], ranges=9).exceptAll(df.select("*", F.coalesce(F.sum("a").over(whole), F.lit(0)).alias("a_before"))).isEmpty()
    assert I.running_sums(df.where("v < 0"), "v", ["a"]).isEmpty()
    assert I.roc_auc(df.where("v < 0").withColumn("y", F.lit(1)), "y", "v").first().roc_auc is None


def test_grouped_density_exact_and_binned(spark):
    from churnlake.operators.profile import grouped_density

    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"g": rng.integers(0, 2, 4000), "x": rng.exponential(3, 4000)})
    df = spark.createDataFrame(pdf).union(spark.createDataFrame([(9, 1.0), (0, None), (None, 2.0)], "g long, x double"))
    exact, binned = (grouped_density(df, "x", "g", 50, cells=c).toPandas() for c in (None, 1024))
    assert sorted(exact.g.unique()) == [0, 1] and len(exact) == len(binned) == 100  # one row has no deviation, hence no density
    for g, part in pdf.groupby("g"):
        x, n = part.x.to_numpy(), len(part)
        h = x.std(ddof=1) * n ** -0.2
        grid = np.linspace(x.min() - 3 * h, x.max() + 3 * h, 50)
        want = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(axis=1) / (n * h * np.sqrt(2 * np.pi))
        for got, off in ((exact, 1e-12), (binned, 1.2e-7 * 0.4 / h)):
            mine = got[got.g == g].sort_values("grid_i")
            assert np.allclose(mine.grid_x, grid, rtol=1e-12) and np.abs(mine.density.to_numpy() - want).max() <= off
