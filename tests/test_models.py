"""Model operators on a seeded synthetic frame with planted signal."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from churnlake.functions.grids import GRID_161
from churnlake.operators import evaluate as I
from churnlake.operators import folds as E
from churnlake.operators import models as H
from churnlake.operators import search as S
from churnlake.plans import churn
from tests.helpers import synthetic_churn


@pytest.fixture(scope="module")
def matrix(spark):
    pdf = synthetic_churn(4000)
    df = spark.createDataFrame(pdf)
    train = df.where(F.col("id") % 5 != 0)
    test = df.where(F.col("id") % 5 == 0).drop("exit_status")
    return churn.model_matrix(train, test, k=4)


def _auc(scores):
    return I.roc_auc(scores, "exit_status", "p").first().roc_auc


@pytest.mark.parametrize("make", [
    lambda n: H.logistic_regression(n, max_iter=50),
    lambda n: H.decision_tree(5),
    lambda n: H.random_forest(20, 6),
    lambda n: H.forest_no_bootstrap(20, 6),
    lambda n: H.gradient_boosting(15, 0.1, 3),
])
def test_models_learn_planted_signal(matrix, make):
    tr, va = E.fold_slice(matrix.train, 0)
    model = make(tr.count()).fit(tr)
    s = H.score(model, va, ["id", "exit_status"])
    assert s.count() == va.count()
    assert s.where((F.col("p") < 0) | (F.col("p") > 1)).count() == 0
    assert _auc(s) > 0.7


def test_adaboost_and_determinism(matrix):
    tr, va = E.fold_slice(matrix.train, 1)
    m1 = H.adaboost(tr, rounds=6)
    m2 = H.adaboost(tr, rounds=6)
    assert m1.alphas == pytest.approx(m2.alphas)
    s = m1.transform_scores(va, ["id", "exit_status"])
    assert _auc(s) > 0.65


def test_oof_scores_cover_every_row_and_threshold(matrix):
    oof, tst = H.oof_scores(matrix.train, lambda f: H.gradient_boosting(8, 0.2, 3, seed=42 + f), "fold", 4,
                            ["id", "exit_status"], matrix.test, ["id"], parallelism=4)
    assert oof.count() == matrix.train.count()
    assert oof.select("id").distinct().count() == matrix.train.count()
    assert tst.count() == matrix.test.count()
    assert _auc(oof) > 0.7
    best, sub = churn.choose_and_submit(oof, tst, GRID_161, (0.22,))
    b = best.first()
    assert 0.0 < b.best_f1 <= 1.0
    assert sub.columns == ["id", "exit_status"] and sub.count() == matrix.test.count()


def test_early_stopping_and_curve(matrix):
    tr, va = E.fold_slice(matrix.train, 2)
    model, n_trees, losses = H.early_stopping_fit(tr, va, H.boosted_profile("a", 12), patience=3)
    assert 1 <= n_trees <= 12 and len(losses) <= 12 and model.getNumTrees == n_trees
    curve = H.learning_curve(model, tr, va).collect()
    assert len(curve) == n_trees and all(r.learn_logloss > 0 for r in curve)
    # the last iteration's F1 equals the F1 of the model's own predictions at 0.5
    from churnlake.operators import evaluate as I

    s = H.score(model, va, ["exit_status"]).withColumn("pred", (F.col("p") >= 0.5).cast("int"))
    want = I.classification_metrics(s, "exit_status", "pred").first().f1
    assert curve[-1].test_f1 == pytest.approx(want, abs=1e-12)


def test_stopped_model_equals_a_refit_and_trains_fewer_trees(matrix):
    tr, va = E.fold_slice(matrix.train, 3)
    est = H.gradient_boosting(400, 0.3, 4, subsample=0.8)
    model, n_trees, losses = H.early_stopping_fit(tr, va, est, patience=4, first=8)
    assert n_trees + 4 <= len(losses) < 400
    again = est.copy({est.maxIter: n_trees}).fit(H.sized_for_fit(tr))
    a, b = (H.score(m, va, ["id"]).orderBy("id").collect() for m in (model, again))
    assert [r.p for r in a] == pytest.approx([r.p for r in b], abs=1e-12)


def test_best_round():
    assert H.best_round([5, 4, 3, 3.5, 3.2, 1], 2) == (2, True)
    assert H.best_round([5, 4, 3, 3.5, 1], 2) == (4, False)


def test_adaboost_probability_is_the_two_class_softmax(matrix):
    import math

    tr, va = E.fold_slice(matrix.train, 1)
    m = H.adaboost(tr, rounds=1)
    m.alphas = [0.7]
    got = {round(r.p, 9) for r in m.transform_scores(va, ["id"]).collect()}
    assert got <= {round(1 / (1 + math.exp(-2 * d)), 9) for d in (-1.0, 1.0)}


def test_final_blend_with_early_stopping(matrix):
    oof, tst = churn.final_blend(matrix, 4, max_iter=6, patience=2)
    assert oof.count() == matrix.train.count()
    assert set(oof.columns) >= {"id", "exit_status", "p_a", "p_b", "p_c", "p"}
    assert tst.count() == matrix.test.count()
    assert _auc(oof) > 0.7


def test_search_shares_long_fits_and_scores_every_fold(matrix):
    data = matrix.train
    tried = S.candidates("b", S.settings({"step": [0.1], "max_iter": [2, 4]}), H.boosted_hist) + S.candidates("d", S.settings({"max_depth": [1, 5]}), H.decision_tree)
    assert tried[0].est is tried[1].est and tried[0].est.getMaxIter() == 4
    scores = S.cross_validate(data, tried, "fold", 4)
    assert sorted((s.candidate, s.fold) for s in scores) == [(c, f) for c in range(4) for f in range(4)]
    assert all(sum(s.n_scored for s in scores if s.candidate == c) == data.count() for c in range(4))
    # The shorter setting scores like a fit of its own.
    va = data.where("fold = 1")
    own = H.fit_sized(H.boosted_hist(2, 0.1), data.where("fold <> 1")).transform(va)
    expected = S._f1(own, "label")[0]
    assert next(s.f1 for s in scores if (s.candidate, s.fold) == (0, 1)) == pytest.approx(expected)
    best = S.best_candidate(scores)
    assert H.score(S.refit(data, tried[best]), va, ["id"]).count() == va.count()
    assert S.best_candidate([S.FoldScore(1, 0, 0.5, 1), S.FoldScore(0, 0, 0.5, 1)]) == 0


def test_forests_keep_the_rows_nodes_and_grow_the_same_trees(spark):
    rows = [(float(i % 2 if i % 7 else i % 3 == 0), Vectors.dense([i % 13, i % 5, (i * 7) % 11])) for i in range(400)]
    frame = spark.createDataFrame(rows, ["label", "features"]).coalesce(2)
    est = H.random_forest(8, 6)
    assert est.getCacheNodeIds()
    kept, walked = (e.fit(frame).toDebugString.split("\n", 1)[1] for e in (est, est.copy().setCacheNodeIds(False)))
    assert kept == walked
