"""Test helpers: order-insensitive frame comparison and a seeded synthetic churn frame."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd


def norm(v):
    if v is None:
        return (0, "")
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float) and math.isnan(v):
        return (0, "")
    if isinstance(v, bool):
        v = int(v)
    if isinstance(v, (int, float)):
        return (1, repr(round(float(v), 9)))
    return (2, str(v))


def same_rows(cols_a, rows_a, cols_b, rows_b) -> tuple[bool, str]:
    if sorted(cols_a) != sorted(cols_b):
        return False, f"columns {cols_a} vs {cols_b}"
    if len(rows_a) != len(rows_b):
        return False, f"rows {len(rows_a)} vs {len(rows_b)}"
    order = sorted(cols_a)
    ia = [cols_a.index(c) for c in order]
    ib = [cols_b.index(c) for c in order]
    a = sorted(tuple(norm(r[i]) for i in ia) for r in rows_a)
    b = sorted(tuple(norm(r[i]) for i in ib) for r in rows_b)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return (not bad), (f"{len(bad)} rows differ, first {bad[0]}" if bad else "")


def synthetic_churn(n: int = 4000, seed: int = 7) -> pd.DataFrame:
    """Frame of the reference's input schema with planted signal:
    the odds of leaving rise with age and fall with is_active and prod_count."""
    rng = np.random.default_rng(seed)
    age = rng.integers(18, 80, n).astype(float)
    active = rng.integers(0, 2, n)
    prods = rng.integers(1, 5, n).astype(float)
    country = rng.choice(["France", "Germany", "Spain"], n)
    gender = rng.choice(["Female", "Male"], n)
    logit = -3.0 + 0.07 * (age - 18) - 1.2 * active - 0.5 * (prods - 1) + 0.8 * (country == "Germany")
    y = (rng.random(n) < 1 / (1 + np.exp(-logit))).astype(int)
    cust = rng.integers(0, n // 4, n)
    df = pd.DataFrame({
        "id": np.arange(n, dtype=np.int64),
        "customer_id": cust.astype(np.int64),
        "last_name": [f"name{c % 97}" for c in cust],
        "credit_score": rng.normal(650, 80, n),
        "country": country,
        "gender": gender,
        "age": age,
        "tenure": rng.integers(0, 11, n).astype(np.int32),
        "acc_balance": np.where(rng.random(n) < 0.4, 0.0, rng.normal(100000, 30000, n)),
        "prod_count": prods,
        "has_card": rng.integers(0, 2, n).astype(np.int32),
        "is_active": active.astype(np.int32),
        "estimated_salary": rng.uniform(10000, 200000, n),
        "exit_status": y.astype(np.int32),
    })
    df.loc[rng.random(n) < 0.05, "credit_score"] = np.nan
    df.loc[rng.random(n) < 0.03, "country"] = None
    return df
