"""Catalog of registered queries and their SQL oracles.

Every query reads the driver tables of ``sf_dir`` through the ``accounts``
table (or tables Spark derives from it). Each entry pairs the Spark
DataFrame with an equivalent DuckDB query over the same parquet files.
Doubles are rounded to ``digits`` places on both sides so value hashes do
not depend on floating-point summation order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlake.sources.accounts import with_accounts

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    fn: QueryFn
    sql: str | None  # None: no SQL form (model output); rows-only check
    rounded: tuple[str, ...] = ()
    digits: int = 6


CATALOG: dict[str, Entry] = {}


def register(name: str, sql_body: str | None, rounded: tuple[str, ...] = (), digits: int = 6, ctes: str = ""):
    """Decorator: register a Spark query with the DuckDB form of the same result."""

    def deco(fn: QueryFn) -> QueryFn:
        sql = None
        if sql_body is not None:
            sql = with_accounts(sql_body, ctes)
            if rounded:
                repl = ", ".join(f"CAST(round({c}, {digits}) AS DOUBLE) AS {c}" for c in rounded)
                sql = f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS q"
        CATALOG[name] = Entry(fn, sql, tuple(rounded), digits)
        return fn

    return deco


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    e = CATALOG[name]
    df = e.fn(spark, sf_dir)
    if e.rounded:
        df = df.select(*[F.round(F.col(c), e.digits).alias(c) if c in e.rounded else F.col(c) for c in df.columns])
    return df


def queries() -> dict[str, QueryFn]:
    _load()
    return {name: (lambda spark, sf_dir, _n=name: run(_n, spark, sf_dir)) for name in CATALOG}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: e.sql for name, e in CATALOG.items() if e.sql is not None}


def _load() -> None:
    # Importing the query modules fills CATALOG.
    from churnlake.plans import queries_eval, queries_models, queries_prep, queries_profile  # noqa: F401


def double_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
