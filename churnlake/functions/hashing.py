"""Engine-neutral deterministic hashing.

``md5('<seed>:' || id)``, first 8 hex digits read as an unsigned 32-bit
integer. The same number comes out of Spark and of DuckDB
(``cast('0x' || substr(md5(...), 1, 8) as bigint)``), so splits, folds and
stand-in scores built on it can be checked against an SQL oracle.
Use a different seed per purpose: reusing one hash for the split and the
folds would leave some folds empty.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed seed prefixes (one per purpose).
SPLIT_SEED = "42"
FOLD_SEED = "fold"
SCORE_SEEDS = ("score", "score2", "score3")

TWO_POW_32 = 4294967296.0


def hash32(id_col: str | Column, seed: str) -> Column:
    """Unsigned 32-bit hash of ``seed:id`` as a bigint in [0, 2^32)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    hexpart = F.substring(F.md5(F.concat(F.lit(seed + ":"), c.cast("string"))), 1, 8)
    return F.conv(hexpart, 16, 10).cast("bigint")


def unit_score(id_col: str | Column, seed: str) -> Column:
    """Deterministic pseudo-score in [0, 1) from the hash (stand-in for a model score)."""
    return hash32(id_col, seed).cast("double") / F.lit(TWO_POW_32)


def duckdb_hash32(id_expr: str, seed: str) -> str:
    """The DuckDB expression that equals :func:`hash32`."""
    return f"cast('0x' || substr(md5('{seed}:' || cast({id_expr} as varchar)), 1, 8) as bigint)"
