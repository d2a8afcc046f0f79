"""The histogram booster against brute force, and both ways of adding its sums."""

import numpy as np
import pandas as pd
import pytest
from pyspark import RDD, cloudpickle
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from churnlake.operators import boosting as B
from churnlake.session import written

K = 4


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 5))
    x[:, 3] = np.round(x[:, 3])
    x[:, 4] = 7.0  # constant
    z = x[:, 0] + (x[:, 1] > 0) * x[:, 2] - 0.5
    return x, (rng.random(1500) < 1 / (1 + np.exp(-2 * z))).astype(int), np.arange(1500) % K


@pytest.fixture(scope="module")
def frame(spark, rows):
    x, y, fold = rows
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(len(y)), "label": y, "fold": fold, "x": x.tolist()}))
    return df.withColumn("features", array_to_vector("x")).drop("x").repartition(3)


@pytest.fixture(scope="module")
def data(frame):
    return B.bin_rows(frame, "label", max_bins=32)


def same(a, b):
    for u, v in zip(a, b):
        assert len(u.trees) == len(v.trees) and u.best == v.best and u.base == pytest.approx(v.base)
        for s, t in zip(u.trees, v.trees):
            assert s.feature.tolist() == t.feature.tolist() and s.cut.tolist() == t.cut.tolist()
            assert np.allclose(s.value, t.value)


def grown_leaf_by_leaf(ids, g, h, bins, leaves, min_leaf, l2):
    """Row sets of a tree grown by the best gain first, every cut tried."""

    def best(rows):
        found = (1e-12, None)
        for f in range(len(ids)):
            for cut in range(bins.starts[f], bins.starts[f + 1] - 1):
                left = rows[ids[f, rows] <= cut]
                right = rows[ids[f, rows] > cut]
                if min(len(left), len(right)) >= min_leaf:
                    gain = sum(g[r].sum() ** 2 / (h[r].sum() + l2) * s for r, s in ((left, 1), (right, 1), (rows, -1)))
                    if gain > found[0] + 1e-9:
                        found = (gain, (left, right))
        return found

    open_leaves = [(best(np.arange(ids.shape[1])), np.arange(ids.shape[1]))]
    while len(open_leaves) < leaves:
        k = max(range(len(open_leaves)), key=lambda j: open_leaves[j][0][0])
        (gain, halves), _ = open_leaves[k]
        if halves is None:
            break
        open_leaves[k : k + 1] = [(best(r), r) for r in halves]
    return [r for _, r in open_leaves]


@pytest.mark.parametrize("held", [B.HELD_BYTES, 0])
def test_leaf_wise_tree_against_brute_force(data, rows, held):
    x, y, _ = rows
    s = B.Setting(rounds=1, step=1.0, max_leaves=9, min_leaf=25, l2=0.7)
    e = B.fit(data, [B.Member(s)], held_bytes=held)[0]
    ids = np.ascontiguousarray(data.bins.ids(x).T)
    p = np.full(len(y), 1 / (1 + np.exp(-e.base)))
    assert p[0] == pytest.approx(y.mean())
    want = grown_leaf_by_leaf(ids, p - y, p * (1 - p), data.bins, 9, 25, 0.7)
    leaf = B.walk(e.trees[0], ids)
    assert {frozenset(np.flatnonzero(leaf == k)) for k in set(leaf)} == {frozenset(r) for r in want}
    for r in want:
        assert e.trees[0].value[leaf[r[0]]] == pytest.approx(-(p - y)[r].sum() / ((p * (1 - p))[r].sum() + 0.7))
        assert len(r) >= 25


def test_symmetric_trees_cut_a_level_once(data):
    e = B.fit(data, [B.Member(B.Setting(rounds=2, growth="symmetric", max_depth=3, min_leaf=1, l2=3.0))])[0]
    for t in e.trees:
        level = [0]
        while any(t.feature[k] >= 0 for k in level):
            assert len({(t.feature[k], t.cut[k]) for k in level}) == 1
            level = [c for k in level for c in (t.left[k], t.right[k])]
        assert len(level) == 8


def test_many_models_equal_single_fits_and_both_ways_of_summing(data):
    settings = [B.Setting(rounds=5, step=0.3, max_leaves=6), B.Setting(rounds=4, growth="depth", max_depth=3, min_leaf=1, min_split=40), B.Setting(rounds=3, growth="symmetric", max_depth=2, rows=0.7)]
    members = [B.Member(s, f) for s in settings for f in range(2)] + [B.Member(settings[0], None, features=(1, 2))]
    together = B.fit(data, members)
    same(together, [B.fit(data, [m])[0] for m in members])
    same(together, B.fit(data, members, held_bytes=0))
    assert set(np.concatenate([t.feature for t in together[-1].trees])) <= {-1, 1, 2}


@pytest.mark.parametrize("held", [B.HELD_BYTES, 0])
def test_a_fit_goes_on_where_it_ended(data, held):
    s = B.Setting(rounds=6, step=0.3, max_leaves=5, rows=0.8)
    short = B.fit(data, [B.Member(B.replace(s, rounds=2), 1)], held_bytes=held)
    same(B.fit(data, [B.Member(s, 1)], held_bytes=held), B.fit(data, [B.Member(s, 1)], short, held_bytes=held))
    with pytest.raises(ValueError):
        B.fit(data, [B.Member(B.replace(s, step=0.1), 1)], short)


def test_margins_are_cut_off_from_their_lineage(data, monkeypatch):
    monkeypatch.setattr(B, "CUT_EVERY", 2)
    members = [B.Member(B.Setting(rounds=5, step=0.3, max_leaves=4), 0)]
    same(B.fit(data, members), B.fit(data, members, held_bytes=0))


def test_early_stopping_and_curve(data, frame, rows):
    x, y, fold = rows
    e = B.fit(data, [B.Member(B.Setting(rounds=400, step=0.5, max_leaves=31, patience=5), 2)])[0]
    losses = [p["held_loss"] for p in e.curve]
    assert len(e.trees) == len(losses) == e.best + 5 < 400 and losses[e.best - 1] == min(losses)
    got = B.scored(frame, data.bins, e, ["id", "label", "fold"]).where("fold = 2").toPandas()
    assert -np.where(got["label"] == 1, np.log(got["p"]), np.log(1 - got["p"])).mean() == pytest.approx(min(losses))


def test_scores_of_folds_and_their_mean(data, frame):
    models = B.fit(data, [B.Member(B.Setting(rounds=15, step=0.2, max_leaves=8), f) for f in range(K)])
    wide = B.with_margins(written(frame, "frame"), data.bins, models)
    assert "Exchange" not in wide._jdf.queryExecution().executedPlan().toString()
    got = wide.select("id", "label", "fold", "margins", B.own_fold("margins", "fold").alias("p"), B.mean_over_folds("margins", 0, K).alias("mean")).toPandas()
    z = 1 / (1 + np.exp(-np.stack(got["margins"])))
    assert np.allclose(got["p"], z[np.arange(len(z)), got["fold"]]) and np.allclose(got["mean"], z.mean(axis=1))
    order = got["p"].rank()
    n1 = got["label"].sum()
    assert (order[got["label"] == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(got) - n1)) > 0.8


def test_one_class_and_no_rows(spark, frame):
    one = B.bin_rows(frame.withColumn("label", F.lit(0)), "label")
    e = B.fit(one, [B.Member(B.Setting(rounds=3), 0)])[0]
    assert B.scored(frame, one.bins, e, ["id"]).agg(F.max("p")).first()[0] < 0.01
    with pytest.raises(ValueError):
        B.bin_rows(frame.limit(0), "label")


def test_random_cuts_are_drawn_by_place_and_leaves_hold_shares(data, rows, frame, monkeypatch):
    x, y, _ = rows
    members = B.random_cut_forest(12, 6, min_leaf=3)
    held = B.fit(data, members)
    same(held, B.fit(data, members))
    monkeypatch.setattr(B, "DRIVER_BYTES", 5 * 64 * 24 * data.bins.count)  # five trees a lot
    same(held, B.fit(data, members, held_bytes=0))
    ids = data.bins.ids(x).T
    cuts = {(int(e.trees[0].feature[0]), int(e.trees[0].cut[0])) for e in held}
    assert len(cuts) > 6 and all(f != 4 for f, _ in cuts)  # drawn apart, and never on the constant feature
    shares = []
    for e in held:
        leaf, base = B.walk(e.trees[0], ids), 1 / (1 + np.exp(-e.base))
        mean = pd.Series(y).groupby(leaf).transform("mean").to_numpy()
        assert pd.Series(y).groupby(leaf).size().min() >= 3
        assert np.allclose(base + e.trees[0].value[leaf] * base * (1 - base), mean, atol=1e-9)
        shares.append(mean)
    got = B.forest_scored(frame, data.bins, held, ["id"]).toPandas().set_index("id").p.sort_index().to_numpy()
    assert np.allclose(got, np.mean(shares, axis=0), atol=1e-9)
    order = np.argsort(got)
    rank = np.empty(len(y))
    rank[order] = np.arange(1, len(y) + 1)
    assert (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum())) > 0.75


def test_smoothings_share_one_matrix(spark):
    from churnlake.plans import churn

    train, test = churn.load(spark, "/root/testdata/sf0.001")
    both, places = churn.smoothing_matrix(train, test, 3, [1.0, 20.0])
    wide = {r.id: r.features.toArray() for r in both.train.collect()}
    for at, m in zip(places, (1.0, 20.0)):
        plain = churn.model_matrix(train, test, k=3, cid_m=m)
        names = [both.feature_names[j] for j in at]
        order = [names.index(c) if c in names else names.index("customer_id_te_0") for c in plain.feature_names]
        for r in plain.train.collect():
            assert np.allclose(wide[r.id][list(at)][order], r.features.toArray(), rtol=1e-12)


def test_joint_columns_give_every_features_sums():
    rng = np.random.default_rng(3)
    starts = np.array([0, 2, 7, 60, 62, 63])
    ids = np.stack([rng.integers(a, b, 900) for a, b in zip(starts, starts[1:])])
    columns = B.Columns(starts, joint=40)
    assert len(columns.groups) < 5 and max(columns.cells) <= 53
    x, rows, slot = columns.pack(ids), np.flatnonzero(rng.random(900) < 0.6), None
    slot, g = rng.integers(0, 3, len(rows)), rng.normal(size=len(rows))
    got = columns.sums(x, rows, slot, 3, (g, g * g, None), range(len(columns.groups)))
    for k in range(3):
        for row, w in enumerate((g, g * g, np.ones(len(rows)))):
            want = sum(np.bincount(ids[f, rows][slot == k], weights=w[slot == k], minlength=63) for f in range(5))
            assert np.allclose(got[k, row], want)
    for f, cut in ((1, 4), (2, 30), (3, 60)):
        assert (columns.right(x, f, cut, rows) == (ids[f, rows] > cut)).all()


def test_driver_gets_cuts_and_not_bin_sums(data, monkeypatch):
    sent, collect = [], RDD.collect
    monkeypatch.setattr(RDD, "collect", lambda self: [sent.append(len(cloudpickle.dumps(x))) or x for x in collect(self)])
    B.fit(data, [B.Member(B.Setting(rounds=2, max_leaves=8), 0), B.Member(B.Setting(rounds=1, growth="symmetric", max_depth=3, min_leaf=1))], held_bytes=0)
    assert sent and max(sent) < 24 * data.bins.count


def test_held_leaf_wise_growth_sums_no_leaf_in_vain(data, frame):
    waves, best = [], B._HeldRows.best

    class Counted(B._HeldRows):
        def best(self, work):
            waves.append(sum(len(a.nodes) for a in work.values()))
            return best(self, work)

    row = [B._block(r, np.uint16, data.n_features, data.n_folds) for r in data.blocks.collect()]
    ids, *rest = B._together(row)
    columns = B.Columns(data.bins.starts)
    e = B.Ensemble(B.Member(B.Setting(rounds=40, step=0.5, max_leaves=12, min_leaf=1)), 0.0)
    B._boost({0: e}, data.bins, Counted((columns.pack(ids), *rest), data.bins, columns, {0: np.zeros(len(rest[0]))}))
    assert sum(waves) <= 40 * (1 + 2 * 11)


def test_own_fold_scores_alone(data, frame):
    models = B.fit(data, [B.Member(B.Setting(rounds=4, step=0.3, max_leaves=5), f) for f in range(K)])
    every, own = (B.with_margins(frame, data.bins, models, fold=c).select("id", "fold", "margins", B.own_fold("margins", "fold").alias("p")).toPandas().set_index("id").sort_index() for c in (None, "fold"))
    assert np.allclose(every.p, own.p) and np.isnan(np.stack(own.margins)).sum(axis=1).tolist() == [K - 1] * len(own)


def test_forest_of_drawn_rows_and_features_both_ways(data, rows, frame, monkeypatch):
    x, y, fold = rows
    members = B.random_forest(10, 5, min_leaf=4, fold=1)
    held = B.fit(data, members)
    monkeypatch.setattr(B, "DRIVER_BYTES", 3 * 32 * 24 * data.bins.count)  # three trees a lot
    same(held, B.fit(data, members, held_bytes=0))
    ids, keys = data.bins.ids(x).T, frame.select("id", F.xxhash64("id").alias("key")).toPandas().set_index("id").key.sort_index().to_numpy()
    for e in held:
        w = B._times(keys, B._salt(B.Ensemble(e.member, 0.0))) * (fold != 1)
        assert 0.9 < w[fold != 1].mean() < 1.1 and w.max() > 2
        leaf, base = B.walk(e.trees[0], ids), 1 / (1 + np.exp(-e.base))
        for k in set(leaf.tolist()):
            at = leaf == k
            assert w[at].sum() >= 4 and base + e.trees[0].value[k] * base * (1 - base) == pytest.approx(np.average(y[at], weights=w[at]))
        root = int(e.trees[0].feature[0])
        best = {}
        for f in range(5):
            for cut in range(data.bins.starts[f], data.bins.starts[f + 1] - 1):
                left = ids[f] <= cut
                if min(w[left].sum(), w[~left].sum()) >= 4:
                    best[f] = max(best.get(f, 0), sum((w * (y - base))[s].sum() ** 2 / w[s].sum() for s in (left, ~left)))
        left = ids[root] <= e.trees[0].cut[0]
        assert sum((w * (y - base))[s].sum() ** 2 / w[s].sum() for s in (left, ~left)) == pytest.approx(best[root])
    got = B.forest_scored(frame.where("fold = 1"), data.bins, held, ["id", "label"]).toPandas()
    assert got.p.between(0, 1).all() and got[got.label == 1].p.mean() > got[got.label == 0].p.mean() + 0.2


def test_stumps_against_brute_force(data, rows, frame):
    from churnlake.operators import models as H

    x, y, _ = rows
    ids, w = data.bins.ids(x).T, np.ones(len(y))
    model = H.adaboost(frame, rounds=6, max_bins=32)
    margin = np.zeros(len(y))
    for s, alpha in zip(model.stumps, model.alphas):
        said = np.where(ids[s.feature] > s.cut, s.high, s.low)
        err = w[said != y].sum() / w.sum()
        assert alpha == pytest.approx(np.log((1 - err) / err))
        gini = lambda t: 2 * w[t & (y == 1)].sum() * w[t & (y == 0)].sum() / w[t].sum() if t.any() else 0.0
        cuts = [(f, c) for f in range(5) for c in range(data.bins.starts[f], data.bins.starts[f + 1] - 1)]
        decrease = [gini(ids[f] <= c) + gini(ids[f] > c) for f, c in cuts]
        assert gini(ids[s.feature] <= s.cut) + gini(ids[s.feature] > s.cut) == pytest.approx(min(decrease))
        w = w * np.exp(alpha * (said != y))
        margin += alpha * (2 * said - 1)
    got = model.transform_scores(frame, ["id"]).toPandas().set_index("id").p.sort_index().to_numpy()
    assert np.allclose(got, 1 / (1 + np.exp(-2 * margin / sum(model.alphas))))


def test_driver_gets_the_cuts_of_a_level_and_not_the_trees_so_far(data, monkeypatch):
    sent, collect = [], RDD.collect
    monkeypatch.setattr(RDD, "collect", lambda self: [sent.append(len(cloudpickle.dumps(x))) or x for x in collect(self)])
    for members in (B.random_cut_forest(6, 10), B.random_forest(6, 10)):
        sent.clear()
        found = B.fit(data, members, held_bytes=0)
        nodes = sum(len(e.trees[0].feature) for e in found)
        assert len(sent) > 30 and sum(sent) < 60 * nodes + 1500 * len(sent)


def test_sums_of_many_rows_are_exact_whatever_their_order(monkeypatch):
    rng = np.random.default_rng(5)
    starts, n = np.array([0, 1, 40, 45]), 3 * B.SUM_ROWS + 7
    ids = np.stack([rng.integers(a, b, n) for a, b in zip(starts, starts[1:])])
    columns, rows, calls = B.Columns(starts), np.arange(n), []
    x, (g, h) = columns.pack(ids), B._gradients(rng.integers(0, 2, n), np.where(rng.random(n) < 0.5, 0.0, rng.normal(size=n) * 9))
    assert h.max() == 0.25 and (h / B.HESSIAN_UNIT == np.round(h / B.HESSIAN_UNIT)).all()
    bincount = np.bincount
    monkeypatch.setattr(np, "bincount", lambda *a, **k: calls.append(1) or bincount(*a, **k))
    got, back = (columns.sums(x, r, None, 1, (g[r], h[r], None), range(len(columns.groups)))[0] for r in (rows, rows[::-1].copy()))
    assert not calls  # gradients, hessians and rows are added in one pass
    monkeypatch.undo()
    for f in range(3):
        at = slice(starts[f], starts[f + 1])
        want = [np.bincount(ids[f] - starts[f], weights=w, minlength=starts[f + 1] - starts[f]) for w in (g, h, np.ones(n))]
        assert np.allclose(got[0, at], want[0]) and (got[1:, at] == want[1:]).all() and (got[1:] == back[1:]).all()


def test_rows_in_nodes_that_a_tree_does_not_keep_are_routed_again(data):
    ids, *rest = B._together([B._block(r, np.uint16, data.n_features, data.n_folds) for r in data.blocks.collect()])
    columns, found = B.Columns(data.bins.starts), []
    for ahead in (1, 7):
        class Rows(B._HeldRows):
            pass

        Rows.ahead = ahead
        e = B.Ensemble(B.Member(B.Setting(rounds=6, step=0.5, max_leaves=9, min_leaf=3, rows=0.8), 1), 0.0)
        held = Rows((columns.pack(ids), *rest), data.bins, columns, {0: np.zeros(len(rest[0]))})
        B._boost({0: e}, data.bins, held)
        assert np.allclose(held.margins[0], sum(t.value[B.walk(t, ids)] for t in e.trees))
        found.append(e)
    same(found[:1], found[1:])


def test_spread_rows_carry_no_more_than_their_rounds_need(data, monkeypatch):
    columns, seen, made = B.Columns(np.array([0, 2, 7, 300])), [], B._SpreadRows.__init__
    x = columns.pack(np.array([[0, 1], [3, 6], [7, 299]]))
    assert [c.dtype for c in x] == [np.uint8, np.uint16] and [len(c) for c in x] == [2, 2]
    monkeypatch.setattr(B._SpreadRows, "__init__", lambda self, rows, *a: seen.append(rows.map(lambda b: len(b[3]) / len(b[1])).collect()) or made(self, rows, *a))
    for share in (1.0, 0.5):
        B.fit(data, [B.Member(B.Setting(rounds=1, max_leaves=3, rows=share), 0)], held_bytes=0)
    assert set(seen[0]) == {0.0} and set(seen[1]) == {1.0}  # keys are kept where rows are drawn by them
