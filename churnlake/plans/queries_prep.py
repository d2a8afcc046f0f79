"""Registered queries: cleaning (C), features (D), folds (E), target encoding (F), joins/audit (G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlake.functions import features as FE
from churnlake.functions.hashing import FOLD_SEED, duckdb_hash32
from churnlake.operators import audit as G
from churnlake.operators import clean as C
from churnlake.operators import encode as D
from churnlake.operators import encoding as TE
from churnlake.operators import folds as E
from churnlake.operators.joins import lookup_join_default
from churnlake.operators.profile import group_mean
from churnlake.plans.catalog import register
from churnlake.sources.accounts import accounts, train_test

TARGET = "exit_status"
IMPUTE_NUM = ["credit_score", "acc_balance", "prod_count"]
SCALE_COLS = ["credit_score", "age", "tenure", "acc_balance", "prod_count", "estimated_salary"]
COMPOSITE = ["customer_id", "last_name", "country", "gender"]


def _tt(spark, sf_dir):
    return train_test(accounts(spark, sf_dir))


def _h(seed: str, id_expr: str = "id") -> str:
    return duckdb_hash32(id_expr, seed)


def _sfold_sql(src: str, k: int, seed: str = FOLD_SEED) -> str:
    """DuckDB: stratified k-fold by plain window rank (the oracle form)."""
    return (
        f"SELECT *, CAST((row_number() OVER (PARTITION BY exit_status ORDER BY {_h(seed)}, id) - 1) % {k} AS INTEGER) AS fold "
        f"FROM {src}"
    )


# ---------------------------------------------------------------- C: cleaning

_MED_CTE = "med AS (SELECT " + ", ".join(f"median({c}) AS {c}" for c in IMPUTE_NUM) + " FROM train)"


@register(
    "c01_impute_median_fit_train",
    " UNION ALL ".join(
        f"SELECT id, '{s}' AS split, "
        + ", ".join(f"coalesce(t.{c}, med.{c}) AS {c}" for c in IMPUTE_NUM)
        + f" FROM {s} t, med"
        for s in ("train", "test")
    ),
    rounded=tuple(IMPUTE_NUM),
    digits=4,
    ctes=_MED_CTE,
)
def c01_impute_median_fit_train(spark, sf_dir):
    train, test = _tt(spark, sf_dir)
    tr, te = C.impute_median_fit_train(train, test, IMPUTE_NUM)
    cols = ["id", *IMPUTE_NUM]
    return tr.select(cols).withColumn("split", F.lit("train")).unionByName(te.select(cols).withColumn("split", F.lit("test")))


_NUM_TRAIN = ["id", "customer_id", "credit_score", "age", "tenure", "acc_balance", "prod_count", "has_card",
              "is_active", "estimated_salary", "exit_status"]


@register(
    "c02_impute_median_all_numeric",
    "SELECT " + ", ".join(f"coalesce(t.{c}, m.{c}) AS {c}" if c in IMPUTE_NUM else f"t.{c}" for c in _NUM_TRAIN)
    + " FROM train t, (SELECT " + ", ".join(f"median({c}) AS {c}" for c in IMPUTE_NUM) + " FROM train) m",
    rounded=tuple(IMPUTE_NUM),
    digits=4,
)
def c02_impute_median_all_numeric(spark, sf_dir):
    train, _ = _tt(spark, sf_dir)
    return C.impute_median_all_numeric(train.select(*_NUM_TRAIN))


_MODE_COUNTRY = "(SELECT country FROM train WHERE country IS NOT NULL GROUP BY country ORDER BY count(*) DESC, country LIMIT 1)"


@register(
    "c03_impute_mode_fit_train",
    f"SELECT id, 'train' AS split, coalesce(country, {_MODE_COUNTRY}) AS country FROM train "
    f"UNION ALL SELECT id, 'test' AS split, coalesce(country, {_MODE_COUNTRY}) AS country FROM test",
)
def c03_impute_mode_fit_train(spark, sf_dir):
    train, test = _tt(spark, sf_dir)
    tr, te = C.impute_mode_fit_train(train, test, ["country"])
    return tr.select("id", F.lit("train").alias("split"), "country").unionByName(
        te.select("id", F.lit("test").alias("split"), "country")
    )


def _mode_sql(c: str, src: str = "train") -> str:
    return f"(SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


_NULL_COLS = ["credit_score", "country", "acc_balance", "prod_count"]


@register(
    "c04_impute_mode_all",
    "SELECT id, " + ", ".join(f"coalesce({c}, {_mode_sql(c)}) AS {c}" for c in _NULL_COLS) + " FROM train",
)
def c04_impute_mode_all(spark, sf_dir):
    train, _ = _tt(spark, sf_dir)
    return C.impute_mode_all(train).select("id", *_NULL_COLS)


@register(
    "c05_impute_where_needed",
    " UNION ALL ".join(
        f"SELECT id, '{s}' AS split, "
        + ", ".join(f"coalesce(t.{c}, med.{c}) AS {c}" for c in IMPUTE_NUM)
        + f", coalesce(t.country, {_MODE_COUNTRY}) AS country FROM {s} t, med"
        for s in ("train", "test")
    ),
    rounded=tuple(IMPUTE_NUM),
    digits=4,
    ctes=_MED_CTE,
)
def c05_impute_where_needed(spark, sf_dir):
    train, test = _tt(spark, sf_dir)
    tr, te = C.impute_where_needed(train, test)
    cols = ["id", *IMPUTE_NUM, "country"]
    return tr.select(cols).withColumn("split", F.lit("train")).unionByName(te.select(cols).withColumn("split", F.lit("test")))




@register("c06_drop_duplicates", "SELECT DISTINCT * FROM (SELECT * FROM train UNION ALL SELECT * FROM train WHERE id % 101 = 0)")
def c06_drop_duplicates(spark, sf_dir):
    train, _ = _tt(spark, sf_dir)
    return C.drop_duplicates(train.unionAll(train.where("id % 101 = 0")))


@register(
    "c07_outlier_rows_age",
    "SELECT id, age FROM train, (SELECT quantile_cont(age, 0.25) AS q1, quantile_cont(age, 0.75) AS q3 FROM train) q "
    "WHERE age < q1 - 1.5 * (q3 - q1) OR age > q3 + 1.5 * (q3 - q1)",
)
def c07_outlier_rows_age(spark, sf_dir):
    train, _ = _tt(spark, sf_dir)
    return C.outlier_rows(train, "age").select("id", "age")


@register("c08_project_drop", "SELECT * EXCLUDE (customer_id, last_name, exit_status) FROM train")
def c08_project_drop(spark, sf_dir):
    train, _ = _tt(spark, sf_dir)
    return C.project_drop(train, ["customer_id", "last_name", TARGET])


@register("c09_select_numeric", "SELECT " + ", ".join(_NUM_TRAIN) + " FROM train")
def c09_select_numeric(spark, sf_dir):
    train, _ = _tt(spark, sf_dir)
    return C.select_numeric(train)


# ---------------------------------------------------------------- D: features

_FEAT_SQL = {
    "zero_balance": "CAST(acc_balance = 0 AS INTEGER)",
    "age_x_active": "age * is_active",
    "balance_salary_ratio": "acc_balance / (estimated_salary + 1.0)",
    "products_per_tenure": "prod_count / CAST(tenure + 1 AS DOUBLE)",
    "is_senior": "CAST(age >= 60.0 AS INTEGER)",
    "credit_active": "credit_score * is_active",
    "is_active_products": "is_active * prod_count",
}


def _imputed_sql(src: str) -> str:
    return (
        f"SELECT {src}.* REPLACE (" + ", ".join(f"coalesce({src}.{c}, med.{c}) AS {c}" for c in IMPUTE_NUM)
        + f", coalesce({src}.country, {_MODE_COUNTRY}) AS country) FROM {src}, med"
    )


def _imputed(spark, sf_dir):
    train, test = _tt(spark, sf_dir)
    train, test = C.impute_median_fit_train(train, test, IMPUTE_NUM)
    return C.impute_mode_fit_train(train, test, ["country"])


@register(
    "d01_engineered_features",
    "SELECT id, " + ", ".join(f"{e} AS {n}" for n, e in _FEAT_SQL.items()) + " FROM itrain",
    rounded=("age_x_active", "balance_salary_ratio", "products_per_tenure", "credit_active", "is_active_products"),
    ctes=_MED_CTE + ",\nitrain AS (" + _imputed_sql("train") + ")",
)
def d01_engineered_features(spark, sf_dir):
    train, _ = _imputed(spark, sf_dir)
    return FE.add_engineered(train).select("id", *FE.ENGINEERED)


@register(
    "d08_one_hot_full_long",
    """
SELECT t.id, v.col_name, v.level, CAST(coalesce(CASE v.col_name WHEN 'country' THEN t.country ELSE t.gender END = v.level, false) AS INTEGER) AS flag
FROM test t, (SELECT DISTINCT 'country' AS col_name, country AS level FROM train WHERE country IS NOT NULL
              UNION ALL SELECT DISTINCT 'gender', gender FROM train WHERE gender IS NOT NULL) v
""",
)
def d08_one_hot_full_long(spark, sf_dir):
    train, test = _tt(spark, sf_dir)
    wide = D.one_hot_full(train, test.select("id", "country", "gender"), ["country", "gender"])
    return _melt_dummies(wide)


@register(
    "d09_one_hot_drop_first_long",
    """
SELECT t.id, v.col_name, v.level, CAST(coalesce(CASE v.col_name WHEN 'country' THEN t.country ELSE t.gender END = v.level, false) AS INTEGER) AS flag
FROM test t, (
  SELECT col_name, level FROM (
    SELECT col_name, level, row_number() OVER (PARTITION BY col_name ORDER BY level) AS r FROM (
      SELECT DISTINCT 'country' AS col_name, country AS level FROM train WHERE country IS NOT NULL
      UNION ALL SELECT DISTINCT 'gender', gender FROM train WHERE gender IS NOT NULL)) WHERE r > 1) v
""",
)
def d09_one_hot_drop_first_long(spark, sf_dir):
    train, test = _tt(spark, sf_dir)
    wide = D.one_hot_drop_first(train, test.select("id", "country", "gender"), ["country", "gender"])
    return _melt_dummies(wide)


def _melt_dummies(wide):
    dummies = [c for c in wide.columns if c not in ("id",)]
    structs = [
        F.struct(F.lit(c.split("_", 1)[0]).alias("col_name"), F.lit(c.split("_", 1)[1]).alias("level"), F.col(c).alias("flag"))
        for c in dummies
    ]
    return wide.select("id", F.explode(F.array(*structs)).alias("r")).select("id", "r.*")


@register(
    "c10_align_columns",
    "SELECT id, CAST(coalesce(gender = '2-HIGH', false) AS INTEGER) AS \"gender_2-HIGH\", 0 AS missing_col FROM test",
)
def c10_align_columns(spark, sf_dir):
    train, test = _tt(spark, sf_dir)
    wide = D.one_hot_full(train, test.select("id", "gender"), ["gender"])
    return C.align_columns(wide, ["id", "gender_2-HIGH", "missing_col"])


@register(
    "d10_standard_scale",
    "SELECT id, " + ", ".join(
        f"(t.{c} - s.m_{c}) / (CASE WHEN s.s_{c} = 0 OR s.s_{c} IS NULL THEN 1.0 ELSE s.s_{c} END) AS {c}" for c in SCALE_COLS
    ) + " FROM test t, (SELECT " + ", ".join(
        f"avg({c}::DOUBLE) AS m_{c}, stddev_pop({c}::DOUBLE) AS s_{c}" for c in SCALE_COLS
    ) + " FROM train) s",
    rounded=tuple(SCALE_COLS),
)
def d10_standard_scale(spark, sf_dir):
    train, test = _tt(spark, sf_dir)
    return D.standard_scale(train, test.select("id", *SCALE_COLS), SCALE_COLS)


# ---------------------------------------------------------------- E: folds


@register(
    "e01_stratified_holdout",
    f"""
SELECT id, exit_status,
       CAST(row_number() OVER (PARTITION BY exit_status ORDER BY {_h('holdout')}, id)
            <= ceil(count(*) OVER (PARTITION BY exit_status) * 0.2::DOUBLE) AS INTEGER) AS is_holdout
FROM train
""",
)
def e01_stratified_holdout(spark, sf_dir):
    train, _ = _tt(spark, sf_dir)
    return E.stratified_holdout(train.select("id", TARGET), TARGET, 0.2)


@register("e02_stratified_kfold10", "SELECT id, exit_status, fold FROM (" + _sfold_sql("train", 10) + ")")
def e02_stratified_kfold10(spark, sf_dir):
    train, _ = _tt(spark, sf_dir)
    return E.stratified_kfold(train.select("id", TARGET), TARGET, 10)


@register(
    "e02_fold_sizes30",
    "SELECT exit_status, fold, count(*) AS n FROM (" + _sfold_sql("train", 30) + ") GROUP BY exit_status, fold",
)
def e02_fold_sizes30(spark, sf_dir):
    train, _ = _tt(spark, sf_dir)
    f = E.stratified_kfold(train.select("id", TARGET), TARGET, 30)
    return f.groupBy(TARGET, "fold").agg(F.count(F.lit(1)).alias("n"))


@register("e03_kfold5", f"SELECT id, CAST({_h('kfold')} % 5 AS INTEGER) AS fold FROM train")
def e03_kfold5(spark, sf_dir):
    train, _ = _tt(spark, sf_dir)
    return E.kfold(train.select("id"), 5)


@register(
    "e04_fold_slice",
    "SELECT CASE WHEN fold = 3 THEN 'valid' ELSE 'train' END AS part, count(*) AS n, CAST(sum(exit_status) AS BIGINT) AS positives "
    "FROM (" + _sfold_sql("train", 10) + ") GROUP BY 1",
)
def e04_fold_slice(spark, sf_dir):
    train, _ = _tt(spark, sf_dir)
    tr, va = E.fold_slice(E.stratified_kfold(train, TARGET, 10), 3)
    agg = [F.count(F.lit(1)).alias("n"), F.sum(TARGET).cast("bigint").alias("positives")]
    return tr.agg(*agg).withColumn("part", F.lit("train")).unionByName(va.agg(*agg).withColumn("part", F.lit("valid")))


# ---------------------------------------------------------------- F: target encoding

_PRIOR_CTE = "pr AS (SELECT avg(exit_status::DOUBLE) AS prior FROM train)"


@register(
    "f01_te_stats_last_name",
    "SELECT last_name, count(*) AS n, avg(exit_status::DOUBLE) AS mean, "
    "(sum(exit_status) + 20.0 * first(pr.prior)) / (count(*) + 20.0) AS te FROM train, pr "
    "WHERE last_name IS NOT NULL GROUP BY last_name",
    rounded=("mean", "te"),
    ctes=_PRIOR_CTE,
)
def f01_te_stats_last_name(spark, sf_dir):
    train, _ = _tt(spark, sf_dir)
    return TE.te_stats(train, "last_name", TARGET, 20)


def _oof_sql(keys: list[str], m: float, k: int, out: str) -> str:
    """Direct definition: for each row, the other folds' rows with the same key."""
    on = " AND ".join(f"o.{c} = f.{c}" for c in keys)
    return f"""
SELECT f.id, coalesce((sum(o.exit_status) + {float(m)!r} * first(pr.prior)) / (count(o.id) + {float(m)!r}), first(pr.prior)) AS {out}
FROM fk f CROSS JOIN pr LEFT JOIN fk o ON {on} AND o.fold <> f.fold
GROUP BY f.id
"""


@register(
    "f02_oof_te_last_name",
    _oof_sql(["last_name"], 20, 10, "last_name_te"),
    rounded=("last_name_te",),
    ctes=_PRIOR_CTE + ",\nfk AS (" + _sfold_sql("train", 10) + ")",
)
def f02_oof_te_last_name(spark, sf_dir):
    train, _ = _tt(spark, sf_dir)
    f = E.stratified_kfold(train, TARGET, 10)
    return TE.oof_target_encode(f, "last_name", TARGET, "fold", 20, "last_name_te").select("id", "last_name_te")


_HOLD_CTE = f"""
hs AS (SELECT *, row_number() OVER (PARTITION BY exit_status ORDER BY {_h('holdout')}, id)
                 <= ceil(count(*) OVER (PARTITION BY exit_status) * 0.2::DOUBLE) AS is_holdout FROM train),
part80 AS (SELECT * EXCLUDE (is_holdout) FROM hs WHERE NOT is_holdout),
part20 AS (SELECT * EXCLUDE (is_holdout) FROM hs WHERE is_holdout),
fk5 AS (SELECT *, CAST({_h('kfold')} % 5 AS INTEGER) AS fold FROM part80)
"""


@register(
    "f03_oof_te_fold_prior",
    """
SELECT f.id, coalesce((sum(o.exit_status) + 20.0 * first(fp.prior)) / (count(o.id) + 20.0), first(fp.prior)) AS last_name_te
FROM fk5 f JOIN (SELECT a.fold, avg(b.exit_status::DOUBLE) AS prior FROM (SELECT DISTINCT fold FROM fk5) a
                 JOIN fk5 b ON b.fold <> a.fold GROUP BY a.fold) fp ON fp.fold = f.fold
LEFT JOIN fk5 o ON o.last_name = f.last_name AND o.fold <> f.fold
GROUP BY f.id
""",
    rounded=("last_name_te",),
    ctes=_HOLD_CTE,
)
def f03_oof_te_fold_prior(spark, sf_dir):
    train, _ = _tt(spark, sf_dir)
    h = E.stratified_holdout(train, TARGET, 0.2)
    part80 = E.kfold(h.where(F.col("is_holdout") == 0), 5)
    return TE.oof_target_encode(part80, "last_name", TARGET, "fold", 20, "last_name_te", prior="fold").select(
        "id", "last_name_te"
    )


def _apply_sql(src: str, fit: str, keys: list[str], m: float, out: str) -> str:
    on = " AND ".join(f"s.{c} = t.{c}" for c in keys)
    kl = ", ".join(keys)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in keys)
    return f"""
SELECT t.id, coalesce(s.te, p.prior) AS {out}
FROM {src} t CROSS JOIN (SELECT avg(exit_status::DOUBLE) AS prior FROM {fit}) p
LEFT JOIN (SELECT {kl}, (sum(exit_status) + {float(m)!r} * (SELECT avg(exit_status::DOUBLE) FROM {fit}))
                         / (count(*) + {float(m)!r}) AS te
           FROM {fit} WHERE {nn} GROUP BY {kl}) s ON {on}
"""


@register("f04_te_apply_test", _apply_sql("test", "train", ["last_name"], 20, "last_name_te"), rounded=("last_name_te",))
def f04_te_apply_test(spark, sf_dir):
    train, test = _tt(spark, sf_dir)
    return TE.te_apply(train, test, "last_name", TARGET, 20, "last_name_te").select("id", "last_name_te")


@register(
    "f05_te_apply_holdout",
    _apply_sql("part20", "part80", ["last_name"], 20, "last_name_te"),
    rounded=("last_name_te",),
    ctes=_HOLD_CTE,
)
def f05_te_apply_holdout(spark, sf_dir):
    train, _ = _tt(spark, sf_dir)
    h = E.stratified_holdout(train, TARGET, 0.2)
    p80, p20 = h.where(F.col("is_holdout") == 0), h.where(F.col("is_holdout") == 1)
    return TE.te_apply(p80, p20, "last_name", TARGET, 20, "last_name_te").select("id", "last_name_te")


@register("f06_te_self_inclusive", _apply_sql("train", "train", ["last_name"], 20, "last_name_te"), rounded=("last_name_te",))
def f06_te_self_inclusive(spark, sf_dir):
    train, _ = _tt(spark, sf_dir)
    return TE.te_self_inclusive(train, "last_name", TARGET, 20, "last_name_te").select("id", "last_name_te")


_CID_MS = [0.001, 1.0, 2.0, 5.0, 10.0, 20.0]
_CID_OUT = [f"cid_te_m{str(m).replace('.', '_')}" for m in _CID_MS]


@register(
    "f07_oof_te_customer_id_multi",
    "SELECT f.id, " + ", ".join(
        f"coalesce((sum(o.exit_status) + {m!r} * first(pr.prior)) / (count(o.id) + {m!r}), first(pr.prior)) AS {n}"
        for m, n in zip(_CID_MS, _CID_OUT)
    ) + " FROM fk f CROSS JOIN pr LEFT JOIN fk o ON o.customer_id = f.customer_id AND o.fold <> f.fold GROUP BY f.id",
    rounded=tuple(_CID_OUT),
    ctes=_PRIOR_CTE + ",\nfk AS (" + _sfold_sql("train", 10) + ")",
)
def f07_oof_te_customer_id_multi(spark, sf_dir):
    train, _ = _tt(spark, sf_dir)
    f = E.stratified_kfold(train, TARGET, 10)
    return TE.oof_target_encode(f, "customer_id", TARGET, "fold", _CID_MS, _CID_OUT).select("id", *_CID_OUT)


@register(
    "f08_oof_te_conditional",
    _oof_sql(COMPOSITE, 5, 30, "customer_id_te"),
    rounded=("customer_id_te",),
    ctes=_PRIOR_CTE + ",\nfk AS (" + _sfold_sql("train", 30) + ")",
)
def f08_oof_te_conditional(spark, sf_dir):
    train, _ = _tt(spark, sf_dir)
    f = E.stratified_kfold(train, TARGET, 30)
    return TE.oof_target_encode(f, COMPOSITE, TARGET, "fold", 5, "customer_id_te").select("id", "customer_id_te")


@register("f09_te_conditional_apply_test", _apply_sql("test", "train", COMPOSITE, 5, "customer_id_te"), rounded=("customer_id_te",))
def f09_te_conditional_apply_test(spark, sf_dir):
    train, test = _tt(spark, sf_dir)
    return TE.te_apply(train, test, COMPOSITE, TARGET, 5, "customer_id_te").select("id", "customer_id_te")


# ---------------------------------------------------------------- G: joins and audit


@register(
    "g01_lookup_join_default",
    "SELECT t.id, coalesce(r.rate, (SELECT avg(exit_status::DOUBLE) FROM train)) AS country_rate FROM test t "
    "LEFT JOIN (SELECT country, avg(exit_status::DOUBLE) AS rate FROM train WHERE country IS NOT NULL GROUP BY country) r "
    "ON t.country = r.country",
    rounded=("country_rate",),
)
def g01_lookup_join_default(spark, sf_dir):
    train, test = _tt(spark, sf_dir)
    rates = group_mean(train, "country", TARGET)
    prior = TE.global_prior(train, TARGET)
    return lookup_join_default(test.select("id", "country"), rates, "country", "rate", prior, "country_rate").select(
        "id", "country_rate"
    )


@register(
    "g02_lookup_join_composite",
    "SELECT t.id, coalesce(r.rate, -1.0) AS pair_rate FROM test t "
    "LEFT JOIN (SELECT country, gender, avg(exit_status::DOUBLE) AS rate FROM train "
    "WHERE country IS NOT NULL AND gender IS NOT NULL GROUP BY country, gender) r "
    "ON t.country = r.country AND t.gender = r.gender",
    rounded=("pair_rate",),
)
def g02_lookup_join_composite(spark, sf_dir):
    train, test = _tt(spark, sf_dir)
    rates = (
        train.where(F.col("country").isNotNull() & F.col("gender").isNotNull())
        .groupBy("country", "gender")
        .agg(F.avg(F.col(TARGET).cast("double")).alias("rate"))
    )
    return lookup_join_default(test.select("id", "country", "gender"), rates, ["country", "gender"], "rate", -1.0,
                               "pair_rate").select("id", "pair_rate")


@register(
    "g03_key_intersection",
    "SELECT count(*) AS n_overlap FROM (SELECT customer_id FROM train INTERSECT SELECT customer_id FROM test)",
)
def g03_key_intersection(spark, sf_dir):
    train, test = _tt(spark, sf_dir)
    return G.key_intersection_count(train, test, "customer_id")


@register(
    "g04_key_coverage",
    "SELECT count(*) AS n_test, count(*) FILTER (WHERE customer_id IN (SELECT customer_id FROM train)) AS n_covered, "
    "100.0 * count(*) FILTER (WHERE customer_id IN (SELECT customer_id FROM train)) / count(*) AS pct_covered FROM test",
    rounded=("pct_covered",),
)
def g04_key_coverage(spark, sf_dir):
    train, test = _tt(spark, sf_dir)
    return G.key_coverage(train, test, "customer_id")


_AUDIT_SQL = """
SELECT count(*) AS n_total,
       count(*) FILTER (WHERE EXISTS (SELECT 1 FROM train r WHERE r.customer_id = t.customer_id AND r.last_name = t.last_name
                                      AND r.country = t.country AND r.gender = t.gender)) AS n_matched,
       100.0 * count(*) FILTER (WHERE EXISTS (SELECT 1 FROM train r WHERE r.customer_id = t.customer_id AND r.last_name = t.last_name
                                      AND r.country = t.country AND r.gender = t.gender)) / count(*) AS pct_matched
FROM test t WHERE t.customer_id IN ({ids})
"""


@register(
    "g05_identity_match_audit",
    _AUDIT_SQL.format(ids="SELECT customer_id FROM train"),
    rounded=("pct_matched",),
)
def g05_identity_match_audit(spark, sf_dir):
    train, test = _tt(spark, sf_dir)
    return G.identity_match_audit(train, test, "customer_id", ["last_name", "country", "gender"])


@register(
    "g06_limit_keys_audit",
    _AUDIT_SQL.format(
        ids="SELECT customer_id FROM (SELECT customer_id FROM train INTERSECT SELECT customer_id FROM test) ORDER BY customer_id LIMIT 100"
    ),
    rounded=("pct_matched",),
)
def g06_limit_keys_audit(spark, sf_dir):
    train, test = _tt(spark, sf_dir)
    return G.identity_match_audit(train, test, "customer_id", ["last_name", "country", "gender"], limit_keys=100)


_MATRIX_NUM = ["credit_score", "age", "tenure", "acc_balance", "prod_count", "has_card", "is_active", "estimated_salary",
               *list(FE.ENGINEERED)]


@register(
    "d11_model_matrix_test",
    "SELECT t.id, " + ", ".join(f"t.{c}" for c in _MATRIX_NUM)
    + ", coalesce(ln.te, pr.prior) AS last_name_te, coalesce(ci.te, pr.prior) AS customer_id_te "
    "FROM ftest t CROSS JOIN pr "
    "LEFT JOIN (SELECT last_name, (sum(exit_status) + 20.0 * first(pr.prior)) / (count(*) + 20.0) AS te FROM itrain, pr "
    "           WHERE last_name IS NOT NULL GROUP BY last_name) ln ON t.last_name = ln.last_name "
    "LEFT JOIN (SELECT customer_id, last_name, country, gender, (sum(exit_status) + 5.0 * first(pr.prior)) / (count(*) + 5.0) AS te "
    "           FROM itrain, pr WHERE customer_id IS NOT NULL AND last_name IS NOT NULL AND country IS NOT NULL AND gender IS NOT NULL "
    "           GROUP BY customer_id, last_name, country, gender) ci "
    "  ON t.customer_id = ci.customer_id AND t.last_name = ci.last_name AND t.country = ci.country AND t.gender = ci.gender",
    rounded=("credit_score", "acc_balance", "age_x_active", "balance_salary_ratio", "products_per_tenure", "credit_active",
             "is_active_products", "last_name_te", "customer_id_te"),
    ctes=_MED_CTE + ",\n" + _PRIOR_CTE + ",\nitrain AS (" + _imputed_sql("train") + "),\nitest AS (" + _imputed_sql("test")
    + "),\nftest AS (SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in _FEAT_SQL.items()) + " FROM itest)",
)
def d11_model_matrix_test(spark, sf_dir):
    from churnlake.plans.churn import model_frame

    train, test = _tt(spark, sf_dir)
    _, test_wide, _, _ = model_frame(train, test, k=5)
    return test_wide.select("id", *_MATRIX_NUM, "last_name_te", "customer_id_te")
