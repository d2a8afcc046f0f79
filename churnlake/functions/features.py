"""Engineered scalar features (D1-D7) as built-in column expressions.

ANSI mode is on in Spark 4, so divisions use ``try_divide`` (null instead of
an error on a zero denominator).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zero_balance(balance: str = "acc_balance") -> Column:
    return (F.col(balance) == 0).cast("int")


def age_x_active(age: str = "age", active: str = "is_active") -> Column:
    return F.col(age) * F.col(active)


def balance_salary_ratio(balance: str = "acc_balance", salary: str = "estimated_salary") -> Column:
    return F.try_divide(F.col(balance), F.col(salary) + F.lit(1.0))


def products_per_tenure(products: str = "prod_count", tenure: str = "tenure") -> Column:
    return F.try_divide(F.col(products), (F.col(tenure) + F.lit(1)).cast("double"))


def is_senior(age: str = "age", cutoff: float = 60.0) -> Column:
    return (F.col(age) >= F.lit(cutoff)).cast("int")


def credit_active(credit: str = "credit_score", active: str = "is_active") -> Column:
    return F.col(credit) * F.col(active)


def is_active_products(active: str = "is_active", products: str = "prod_count") -> Column:
    return F.col(active) * F.col(products)


ENGINEERED = {
    "zero_balance": zero_balance,
    "age_x_active": age_x_active,
    "balance_salary_ratio": balance_salary_ratio,
    "products_per_tenure": products_per_tenure,
    "is_senior": is_senior,
    "credit_active": credit_active,
    "is_active_products": is_active_products,
}


def add_engineered(df: DataFrame, names=tuple(ENGINEERED)) -> DataFrame:
    """Append the engineered features in one projection."""
    return df.select("*", *[ENGINEERED[n]().alias(n) for n in names])
