"""Model fitting and scoring on Spark ML.

The reference's single-machine learners are re-aimed to Spark ML estimators
(distributed tree/LR training via tree aggregation):

* logistic regression  -> ``LogisticRegression`` (L2, C=1 -> regParam = 1/(C n))
* decision tree        -> ``DecisionTreeClassifier``
* random forest        -> ``RandomForestClassifier``; the queries grow theirs over bins (``boosting.random_forest``)
* extra trees          -> ``RandomForestClassifier(bootstrap=False)``: whole
  sample with random feature subsets; split points stay optimised, so this
  is an approximation of randomised splits
* gradient boosting, histogram boosting and the three boosted profiles ->
  ``GBTClassifier`` (level-wise trees, no L2 term on leaves)
* AdaBoost             -> SAMME loop over weighted depth-1 trees on binned rows
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import SparkContext
from pyspark.ml import Estimator
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.session import require_checkpoint_dir

FEATURES = "features"

# Tree/LR training runs a few short jobs per iteration; tiny partitions make
# every one of them pay per-task overhead. Training frames are coalesced (no
# shuffle) to about this many rows per partition, never to more partitions
# than they already have.
ROWS_PER_FIT_PARTITION = 25_000


def fit_partitions(spark, n_rows: int) -> int:
    return max(1, math.ceil(n_rows / ROWS_PER_FIT_PARTITION))


def sized_for_fit(df: DataFrame, n_rows: int | None = None) -> DataFrame:
    """Coalesce a training frame to :func:`fit_partitions` partitions."""
    n = df.count() if n_rows is None else n_rows
    return df.coalesce(fit_partitions(df.sparkSession, n))


def fit_sized(est: Estimator, df: DataFrame, n_rows: int | None = None):
    """``est.fit`` on a partition-sized training frame."""
    return est.fit(sized_for_fit(df, n_rows))


def logistic_regression(n_rows: int, C: float = 1.0, max_iter: int = 1000, label: str = "label") -> Estimator:
    """H1: L2 logistic regression equivalent to C-parameterised sum-of-losses on scaled features.

    ``standardization`` divides each feature by its standard deviation before the penalty; centring only moves the intercept.
    """
    return LogisticRegression(
        featuresCol=FEATURES, labelCol=label, regParam=1.0 / (C * max(1, n_rows)), elasticNetParam=0.0,
        standardization=True, maxIter=max_iter,
    )


def decision_tree(max_depth: int = 8, label: str = "label", seed: int = 42) -> Estimator:
    """H3."""
    return DecisionTreeClassifier(featuresCol=FEATURES, labelCol=label, maxDepth=max_depth, maxBins=256, seed=seed)


def random_forest(num_trees: int = 100, max_depth: int = 10, label: str = "label", seed: int = 42,
                  bootstrap: bool = True, min_leaf: int = 1) -> Estimator:
    """H4 (and H5 with ``bootstrap=False``). Rows keep their node of every tree, so that no pass walks the trees from the root."""
    return RandomForestClassifier(
        featuresCol=FEATURES, labelCol=label, numTrees=num_trees, maxDepth=max_depth, maxBins=256, cacheNodeIds=True,
        featureSubsetStrategy="sqrt", bootstrap=bootstrap, minInstancesPerNode=min_leaf, seed=seed,
    )


def forest_no_bootstrap(num_trees: int = 100, max_depth: int = 10, label: str = "label", seed: int = 42) -> Estimator:
    """H5: extra-trees re-aimed (see module doc)."""
    return random_forest(num_trees, max_depth, label, seed, bootstrap=False)


def gradient_boosting(max_iter: int = 100, step: float = 0.1, max_depth: int = 3, label: str = "label",
                      seed: int = 42, min_leaf: int = 1, subsample: float = 1.0, max_bins: int = 32) -> Estimator:
    """H6 and base of H8-H11."""
    return GBTClassifier(
        featuresCol=FEATURES, labelCol=label, maxIter=max_iter, stepSize=step, maxDepth=max_depth,
        minInstancesPerNode=min_leaf, subsamplingRate=subsample, maxBins=max_bins, seed=seed,
    )


def boosted_hist(max_iter: int = 300, step: float = 0.03, max_leaf_nodes: int = 31, min_leaf: int = 20,
                 label: str = "label", seed: int = 42) -> Estimator:
    """H8: histogram boosting re-aimed: depth chosen so 2^depth >= max_leaf_nodes (Spark's trees end at 30), 256 bins."""
    depth = max(1, math.ceil(math.log2(max(2, max_leaf_nodes))))
    return gradient_boosting(max_iter, step, min(depth, 30), label, seed, min_leaf, 1.0, 256)


def boosted_profile(profile: str, max_iter: int = 1500, step: float = 0.03, label: str = "label", seed: int = 42) -> Estimator:
    """Three boosted members; depth 5/5/6, the third subsampled so members differ."""
    depth, sub = {"a": (5, 1.0), "b": (5, 0.9), "c": (6, 0.8)}[profile]
    return gradient_boosting(max_iter, step, depth, label, seed, 1, sub, 64)


def score(model, df: DataFrame, keep: Sequence[str], out: str = "p") -> DataFrame:
    """``transform`` and keep the id/label columns plus the class-1 probability."""
    pred = model.transform(df)
    return pred.select(*keep, vector_to_array(F.col("probability"))[1].alias(out))


def oof_scores(
    data: DataFrame,
    make: Callable[[int], Estimator],
    fold_col: str,
    k: int,
    keep: Sequence[str],
    test: DataFrame | None = None,
    test_keep: Sequence[str] = ("id",),
    parallelism: int | None = None,
    out: str = "p",
    fit: Callable[[Estimator, DataFrame, DataFrame], object] | None = None,
):
    """H16 + H17: one model per fold (``make(fold)`` gets the fold for its seed).

    Returns (oof, test_mean): the held-out scores of every training row, and
    the test score averaged over the k fold models (or None). Fits run from a
    driver thread pool (default min(k, 8) at once): each boosting iteration is
    a few short Spark jobs, and concurrent fits overlap their scheduling latency.
    The input should be persisted by the caller (it is read 2k times).
    ``fit(estimator, train_part, valid_part)`` replaces the plain ``fit`` (early stopping).
    """

    n_fit = math.ceil(data.count() * (k - 1) / k)

    def run(f: int):
        tr = sized_for_fit(data.where(F.col(fold_col) != f), n_fit)
        va = data.where(F.col(fold_col) == f)
        model = make(f).fit(tr) if fit is None else fit(make(f), tr, va)
        held = score(model, va, keep, out)
        tst = score(model, test, test_keep, out) if test is not None else None
        return held, tst

    workers = parallelism if parallelism is not None else min(k, 8)
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        results = list(pool.map(run, range(k)))
    oof = _union([r[0] for r in results])
    test_mean = None
    if test is not None:
        test_mean = fold_mean_scores(_union([r[1] for r in results]), list(test_keep), out)
    return oof, test_mean


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def fold_mean_scores(scores: DataFrame, keys: Sequence[str], score_col: str = "p") -> DataFrame:
    """Mean score per row over the fold models."""
    return scores.groupBy(*keys).agg(F.avg(score_col).alias(score_col))


def blend(df: DataFrame, weights: dict[str, float], out: str = "p") -> DataFrame:
    """Weighted sum of score columns."""
    expr = None
    for c, w in weights.items():
        term = F.lit(float(w)) * F.col(c)
        expr = term if expr is None else expr + term
    return df.withColumn(out, expr)


# ----------------------------------------------------------------------------- AdaBoost


class AdaBoostModel:
    """Weighted vote of depth-1 trees (SAMME, two classes)."""

    def __init__(self, bins, stumps, alphas):
        self.bins = bins
        self.stumps = stumps
        self.alphas = alphas

    def transform_scores(self, df: DataFrame, keep: Sequence[str], out: str = "p") -> DataFrame:
        total = sum(self.alphas) or 1.0
        x = vector_to_array(F.col(FEATURES))
        margin = F.lit(0.0)
        for s, a in zip(self.stumps, self.alphas):
            at = s.cut - int(self.bins.starts[s.feature])
            cuts = self.bins.cuts[s.feature]
            # Values up to the cut's own edge go left; past the last edge all do. NaN is above every number, as in the bins.
            goes = F.get("__x", F.lit(s.feature)) > F.lit(float(cuts[at])) if at < len(cuts) else F.lit(False)
            margin = margin + F.lit(a) * F.when(goes, F.lit(2.0 * s.high - 1.0)).otherwise(F.lit(2.0 * s.low - 1.0))
        d = margin / F.lit(total)
        # Two-class SAMME: softmax over (-d, d).
        return df.withColumn("__x", x).select(*keep, (F.lit(1.0) / (F.lit(1.0) + F.exp(-2 * d))).alias(out))


def adaboost(train: DataFrame, label: str = "label", rounds: int = 50, learning_rate: float = 1.0, max_bins: int = 255) -> AdaBoostModel:
    """H7: SAMME with depth-1 trees and a per-row weight.

    Features are binned once and the bins written; a round is one aggregate of the classes' weights by bin (:func:`boosting.weighted_stumps`).
    """
    from churnlake.operators import boosting as B  # which takes its names from here

    data = B.bin_rows(train, label, (), max_bins=max_bins)
    found = B.weighted_stumps(data, rounds, learning_rate)
    return AdaBoostModel(data.bins, [s for s, _ in found], [a for _, a in found])


# ----------------------------------------------------------------------------- early stopping, curves


def best_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """The round (0-based) with the lowest loss up to the first run of ``patience`` rounds without
    improvement, and whether that run was seen."""
    best, best_i = float("inf"), 0
    for i, loss in enumerate(losses):
        if loss < best:
            best, best_i = loss, i
        elif i - best_i >= patience:
            return best_i, True
    return best_i, False


def first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The boosted model of the first ``n`` trees. Boosting is sequential, so this equals a fit with ``n`` iterations."""
    java, gateway = model._java_obj, SparkContext._gateway
    ml = gateway.jvm.org.apache.spark.ml
    trees = gateway.new_array(ml.regression.DecisionTreeRegressionModel, n)
    weights = gateway.new_array(gateway.jvm.double, n)
    all_trees, all_weights = java.trees(), java.treeWeights()
    for k in range(n):
        trees[k], weights[k] = all_trees[k], all_weights[k]
    cut = ml.classification.GBTClassificationModel(java.uid(), trees, weights, java.numFeatures(), java.numClasses())
    out = GBTClassificationModel(cut)
    model._copyValues(out)
    return out


def early_stopping_fit(train: DataFrame, valid: DataFrame, est: GBTClassifier, patience: int = 50, first: int = 64):
    """Boosting that stops after ``patience`` rounds without a lower loss on ``valid``.

    Spark ML cannot resume a boosted model, so the budget doubles (``first``, 2 * first, ... up to ``maxIter``) until the
    best round plus ``patience`` lies inside it; the model is then cut to its best round instead of being fitted again.
    Returns (model, best_iter, losses)."""
    train = sized_for_fit(train)
    budget = min(first, est.getMaxIter())
    while True:
        full = est.copy({est.maxIter: budget}).fit(train)
        losses = [x / 2.0 for x in full.evaluateEachIteration(valid)]  # logistic loss reported doubled
        best, stopped = best_round(losses, patience)
        if stopped or budget == est.getMaxIter():
            return first_trees(full, best + 1), best + 1, losses
        budget = min(2 * budget, est.getMaxIter())


def _f1_by_iteration(model, df: DataFrame, label: str, batch: int = 50) -> list[float]:
    """F1 at p >= 0.5 after each boosting iteration, from the model's own trees.

    The boosted margin after k trees is sum_i w_i * tree_i(x) and p >= 0.5
    exactly when the margin is >= 0. Tree outputs are added as columns one
    batch at a time; each batch is checkpointed (shared folder) so the plan
    stays small for long ensembles. One aggregate per batch.
    """
    trees, weights = model.trees, model.treeWeights
    y = F.col(label).cast("int")
    cur = df.select(y.alias("__y"), F.col(FEATURES)).withColumn("__m", F.lit(0.0))
    f1s: list[float] = []
    for start in range(0, len(trees), batch):
        aggs = [F.sum("__y").alias("P")]
        chunk = list(range(start, min(start + batch, len(trees))))
        for i in chunk:
            cur = trees[i].copy().setPredictionCol(f"__t{i}").transform(cur)
            cur = cur.withColumn("__m", F.col("__m") + F.lit(float(weights[i])) * F.col(f"__t{i}")).drop(f"__t{i}")
            cur = cur.withColumn(f"__m{i}", F.col("__m"))
            hit = F.col(f"__m{i}") >= 0
            aggs += [F.sum(F.when(hit, F.col("__y")).otherwise(0)).alias(f"tp{i}"), F.sum(F.when(hit, 1).otherwise(0)).alias(f"pr{i}")]
        cur = cur.checkpoint(eager=True)
        row = cur.agg(*aggs).first()
        for i in chunk:
            denom = row["P"] + row[f"pr{i}"]
            f1s.append(2.0 * row[f"tp{i}"] / denom if denom else 0.0)
        cur = cur.select("__y", FEATURES, "__m")
    return f1s


def learning_curve(model, learn: DataFrame, test: DataFrame, label: str = "label") -> DataFrame:
    """A5: per-iteration (F1, Logloss) on learn and test.

    Logloss comes from ``evaluateEachIteration`` (which reports twice the log
    loss for the logistic loss); F1 at the 0.5 cut from the partial margins.
    """
    spark = learn.sparkSession
    require_checkpoint_dir(spark)
    ll = [x / 2.0 for x in model.evaluateEachIteration(learn)]
    lt = [x / 2.0 for x in model.evaluateEachIteration(test)]
    fl = _f1_by_iteration(model, learn, label)
    ft = _f1_by_iteration(model, test, label)
    rows = [(i, a, b, c, d) for i, (a, b, c, d) in enumerate(zip(fl, ll, ft, lt))]
    return spark.createDataFrame(rows, "iter int, learn_f1 double, learn_logloss double, test_f1 double, test_logloss double")
