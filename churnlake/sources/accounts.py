"""The ``accounts`` table: a customer-churn table derived from the order tables.

One order is one account row, so ``customer_id`` repeats. Missing values are
planted by key arithmetic so that Spark and the SQL oracle agree cell by cell.
The split into train/test uses an engine-neutral hash of the id.

Plan shape: ``lineitem`` is pre-aggregated per order (partial aggregation,
output hash-partitioned on the order key, so the order join does not
re-shuffle it); the nation x region dimension is broadcast only after a row
bound check; customer joins by a shuffle on the customer key (AQE may turn it
into a broadcast at run time when it is small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.functions.hashing import SPLIT_SEED, hash32
from churnlake.operators.joins import bounded_broadcast
from churnlake.sources.tables import read_table

ACCOUNT_COLUMNS = (
    "id", "customer_id", "last_name", "credit_score", "country", "gender", "age", "tenure",
    "acc_balance", "prod_count", "has_card", "is_active", "estimated_salary", "exit_status", "part5",
)

# Dimension tables are small by construction; the bound is checked before broadcasting.
_DIM_ROW_BOUND = 100_000


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    lineitem = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")

    per_order = lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("qty"),
        F.round(F.sum("l_extendedprice"), 2).alias("amt"),
    )
    # nation x region is one row per nation: its bound is checked once, then it is broadcast.
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
    cust = customer.join(bounded_broadcast(geo, _DIM_ROW_BOUND), customer.c_nationkey == geo.n_nationkey)

    base = orders.join(cust, orders.o_custkey == cust.c_custkey).join(
        per_order, orders.o_orderkey == per_order.l_orderkey, "left"
    )
    key = F.col("o_orderkey")
    return base.select(
        key.alias("id"),
        F.col("o_custkey").alias("customer_id"),
        F.substring("c_name", 1, 17).alias("last_name"),
        F.when(key % 17 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice")).alias("credit_score"),
        F.when(key % 29 == 0, F.lit(None).cast("string")).otherwise(F.col("r_name")).alias("country"),
        F.col("o_orderpriority").alias("gender"),
        F.coalesce(F.col("qty"), F.lit(0.0)).alias("age"),
        (F.lit(2001) - F.year("o_orderdate")).cast("int").alias("tenure"),
        F.when(F.col("o_custkey") % 23 == 0, F.lit(None).cast("double"))
        .otherwise(F.greatest(F.col("c_acctbal"), F.lit(0.0)))
        .alias("acc_balance"),
        F.when(key % 19 == 0, F.lit(None).cast("double"))
        .otherwise(F.coalesce(F.col("n_lines"), F.lit(0)).cast("double"))
        .alias("prod_count"),
        F.col("c_mktsegment").isin("AUTOMOBILE", "MACHINERY").cast("int").alias("has_card"),
        (F.month("o_orderdate") <= 6).cast("int").alias("is_active"),
        F.coalesce(F.col("amt"), F.lit(0.0)).alias("estimated_salary"),
        (F.col("o_orderstatus") == "F").cast("int").alias("exit_status"),
        (hash32(key, SPLIT_SEED) % 5).cast("int").alias("part5"),
    )


def train_test(acc: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train = ``part5 <> 0``; test = ``part5 = 0`` without the target."""
    train = acc.where(F.col("part5") != 0).drop("part5")
    test = acc.where(F.col("part5") == 0).drop("part5", "exit_status")
    return train, test


def train_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_test(accounts(spark, sf_dir))[0]


def test_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_test(accounts(spark, sf_dir))[1]


# DuckDB form of the same table, for the oracle. Fixed text shared by all oracle queries.
ACCOUNTS_SQL = """
accounts AS (
  SELECT o.o_orderkey AS id,
         o.o_custkey AS customer_id,
         substr(c.c_name, 1, 17) AS last_name,
         CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE o.o_totalprice END AS credit_score,
         CASE WHEN o.o_orderkey % 29 = 0 THEN NULL ELSE r.r_name END AS country,
         o.o_orderpriority AS gender,
         coalesce(li.qty, 0.0) AS age,
         CAST(2001 - year(o.o_orderdate) AS INTEGER) AS tenure,
         CASE WHEN o.o_custkey % 23 = 0 THEN NULL ELSE greatest(c.c_acctbal, 0.0) END AS acc_balance,
         CASE WHEN o.o_orderkey % 19 = 0 THEN NULL ELSE CAST(coalesce(li.n_lines, 0) AS DOUBLE) END AS prod_count,
         CASE WHEN c.c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 1 ELSE 0 END AS has_card,
         CASE WHEN month(o.o_orderdate) <= 6 THEN 1 ELSE 0 END AS is_active,
         coalesce(li.amt, 0.0) AS estimated_salary,
         CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS exit_status,
         CAST(CAST('0x' || substr(md5('42:' || CAST(o.o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 5 AS INTEGER) AS part5
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty,
                    round(sum(l_extendedprice), 2) AS amt
             FROM lineitem GROUP BY l_orderkey) li ON o.o_orderkey = li.l_orderkey
),
train AS (SELECT * EXCLUDE (part5) FROM accounts WHERE part5 <> 0),
test AS (SELECT * EXCLUDE (part5, exit_status) FROM accounts WHERE part5 = 0)
"""


def with_accounts(sql_body: str, extra_ctes: str = "") -> str:
    """Prefix an oracle query with the accounts/train/test CTEs."""
    ctes = ACCOUNTS_SQL.strip()
    if extra_ctes:
        ctes += ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{sql_body.strip()}"
