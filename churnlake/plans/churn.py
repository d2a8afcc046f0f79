"""End-to-end churn plans built from the operators.

``model_matrix`` is the shared preparation of the final models (impute with
train constants, engineered features, stratified folds, out-of-fold target
encodings on ``last_name`` and on the composite identity key, train-fitted
encodings for test, one-hot with the first level dropped, feature vector).
``final_blend`` fits the three boosted members per fold, blends them and
chooses the threshold; ``model_a`` is the single-learner variant.

Intermediate tables that are read many times (the model matrix) are
written as Parquet in the session's shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.functions import features as FE
from churnlake.functions.grids import GRID_161
from churnlake.operators import boosting as B
from churnlake.operators import clean as C
from churnlake.operators import encode as D
from churnlake.operators import encoding as TE
from churnlake.operators import evaluate as I
from churnlake.operators import folds as E
from churnlake.operators import models as H
from churnlake.sources.accounts import accounts, train_test
from churnlake.session import materialised, written
from churnlake.sources.io import submission_table

TARGET = "exit_status"
IMPUTE_NUM = ["credit_score", "acc_balance", "prod_count"]
COMPOSITE = ["customer_id", "last_name", "country", "gender"]
BASE_NUM = ["credit_score", "age", "tenure", "acc_balance", "prod_count", "has_card", "is_active", "estimated_salary"]


@dataclass
class Matrix:
    train: DataFrame  # id, exit_status, label, fold, features
    test: DataFrame  # id, features
    feature_names: list[str]
    prior: float


def swept_names(sweep: Sequence[float]) -> list[str]:
    return [f"customer_id_te_{j}" for j in range(len(sweep))]


def model_frame(train: DataFrame, test: DataFrame, k: int = 30, ln_m: float = 20.0, cid_m: float = 5.0,
                engineered: bool = True, sweep: Sequence[float] = ()):
    """Wide train/test frames of the final model: (train with fold, test, feature names, prior).

    ``sweep``: more smoothings of the identity key, each a train column ``customer_id_te_<j>`` from the same aggregate.
    """
    train, test = C.impute_median_fit_train(train, test, IMPUTE_NUM)
    train, test = C.impute_mode_fit_train(train, test, ["country"])
    if engineered:
        train, test = FE.add_engineered(train), FE.add_engineered(test)
    # The folded table is read by every later step: materialise it once in the
    # shared checkpoint folder (cuts the lineage, survives executor loss).
    folded = written(E.stratified_kfold(train, TARGET, k), "folded")
    prior = TE.global_prior(folded, TARGET)
    # The first encoding is written too: the second reads its input three times (fold totals, key sums, rows).
    enc = written(TE.oof_target_encode(folded, "last_name", TARGET, "fold", ln_m, "last_name_te"), "encoded")
    enc = TE.oof_target_encode(enc, COMPOSITE, TARGET, "fold", [cid_m, *sweep], ["customer_id_te", *swept_names(sweep)])
    test_enc = TE.te_apply(train, test, "last_name", TARGET, ln_m, "last_name_te", prior)
    test_enc = TE.te_apply(train, test_enc, COMPOSITE, TARGET, cid_m, "customer_id_te", prior)
    levels = D.fit_one_hot(train, ["country", "gender"], drop_first=True)
    enc = D.apply_one_hot(enc, levels)
    test_enc = D.apply_one_hot(test_enc, levels)
    num = BASE_NUM + (list(FE.ENGINEERED) if engineered else []) + ["last_name_te", "customer_id_te"]
    dummies = [D.dummy_name(c, v) for c, vs in levels.items() for v in vs]
    names = num + dummies
    return enc, C.align_columns(test_enc, ["id", *names]), names, prior


def model_matrix(train: DataFrame, test: DataFrame, k: int = 30, ln_m: float = 20.0, cid_m: float = 5.0,
                 engineered: bool = True, persist: bool = True) -> Matrix:
    enc, test_wide, names, prior = model_frame(train, test, k, ln_m, cid_m, engineered)
    tr = D.assemble_features(enc.withColumn("label", F.col(TARGET).cast("double")), names).select(
        "id", TARGET, "label", "fold", "features"
    )
    te = D.assemble_features(test_wide, names).select("id", "features")
    if persist:  # written, not cached: nothing is left behind on the executors
        tr, te = materialised(tr), materialised(te)
    return Matrix(tr, te, names, prior)


def load(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Train/test of the accounts table, built once and written (both halves read it)."""
    return train_test(written(accounts(spark, sf_dir), "accounts"))


BLEND = {"a": 0.4, "b": 0.2, "c": 0.4}  # fixed value: the members' weights


def oof_models(m: Matrix, k: int, settings: list[list[B.Setting]], features: list[tuple[int, ...] | None] | None = None):
    """(bins, ensembles): for each list of k settings the k fold models, all grown together (H16). ``features`` names for each
    list the places of the features that its models may use."""
    data = B.bin_rows(m.train, "label")
    return data.bins, B.fit(data, [B.Member(s, f, features=features[j] if features else None) for j, per_fold in enumerate(settings) for f, s in enumerate(per_fold)])


def smoothing_matrix(train: DataFrame, test: DataFrame, k: int, smoothings: Sequence[float]) -> tuple[Matrix, list[tuple[int, ...]]]:
    """One training matrix with an identity-key encoding for every smoothing value, and for each value the places of its
    features: all of the plain matrix, with its own encoding. The encodings share one aggregate (I9)."""
    first, *others = smoothings
    enc, test_wide, names, prior = model_frame(train, test, k, cid_m=first, sweep=others)
    extra = swept_names(others)
    tr = D.assemble_features(enc.withColumn("label", F.col(TARGET).cast("double")), names + extra).select("id", TARGET, "label", "fold", "features")
    at, shared = names.index("customer_id_te"), [j for j, c in enumerate(names) if c != "customer_id_te"]
    own = [at, *range(len(names), len(names) + len(extra))]
    return Matrix(materialised(tr), test_wide, names + extra, prior), [tuple(sorted([*shared, j])) for j in own]


def final_blend(m: Matrix, k: int, max_iter: int = 1500, patience: int | None = 50, step: float = 0.03):
    """Three boosted members per fold, blended 0.4 / 0.2 / 0.4 (H9-H13, H16-H18): (out-of-fold scores, test scores).

    All 3 * k models are grown together, and train and test are scored in one pass each: own-fold scores, fold
    means and the blend are expressions over one array of margins, without union, shuffle or join by id.
    With ``patience``, each fold model stops on its validation fold (as the
    reference does; the OOF score is then optimistic, see SURVEY 4.3 leak 3).
    """
    bins, models = oof_models(m, k, [[B.boosted_profile(p, max_iter, step, patience, 42 + f) for f in range(k)] for p in BLEND])
    train, test = B.with_margins(m.train, bins, models, fold="fold"), B.with_margins(m.test, bins, models)
    oof = train.select("id", TARGET, *[B.own_fold("margins", "fold", j * k).alias(f"p_{p}") for j, p in enumerate(BLEND)])
    tst = test.select("id", *[B.mean_over_folds("margins", j * k, k).alias(f"p_{p}") for j, p in enumerate(BLEND)])
    weights = {f"p_{p}": w for p, w in BLEND.items()}
    return H.blend(oof, weights, "p"), H.blend(tst, weights, "p")


def choose_and_submit(oof: DataFrame, test_scores: DataFrame, grid=GRID_161, pcts=(0.22,)) -> tuple[DataFrame, DataFrame]:
    """Threshold by grid sweep + top-share candidates, then the submission table."""
    oof = materialised(oof)  # the search reads the scores several times; the models score once
    best = I.choose_threshold(oof, TARGET, "p", grid, pcts)
    t = best.first()["best_thresh"]
    return best, submission_table(test_scores, "p", t)
