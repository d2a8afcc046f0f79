"""Explicit schemas (no schema inference at scale)."""

from __future__ import annotations

from pyspark.sql import types as T

# Schema of the training table; the test table is the same without the target.
TRAIN_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("customer_id", T.LongType(), False),
        T.StructField("last_name", T.StringType(), True),
        T.StructField("credit_score", T.DoubleType(), True),
        T.StructField("country", T.StringType(), True),
        T.StructField("gender", T.StringType(), True),
        T.StructField("age", T.DoubleType(), True),
        T.StructField("tenure", T.IntegerType(), True),
        T.StructField("acc_balance", T.DoubleType(), True),
        T.StructField("prod_count", T.DoubleType(), True),
        T.StructField("has_card", T.IntegerType(), True),
        T.StructField("is_active", T.IntegerType(), True),
        T.StructField("estimated_salary", T.DoubleType(), True),
        T.StructField("exit_status", T.IntegerType(), True),
    ]
)
