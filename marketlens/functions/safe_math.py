"""Math that never raises and never turns a missing input into an error.

A missing input counts as 0.0, a square root below zero is 0.0, and a logarithm
at or below zero is 0.0. Division by zero is NULL. All are plain Catalyst
expressions, so they stay inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F


def safe_div(num: Column, den: Column) -> Column:
    return F.try_divide(num, den)


def safe_sqrt(x: Column) -> Column:
    # greatest() skips NULL, which covers both the missing and the negative case
    return F.sqrt(F.greatest(x, F.lit(0.0)))


def safe_pow(x: Column, y: Column | float) -> Column:
    return F.when(x.isNull(), F.lit(0.0)).otherwise(F.pow(x, y))


def safe_ln(x: Column) -> Column:
    # ln() is already NULL at or below zero
    return F.coalesce(F.ln(x), F.lit(0.0))


def safe_exp(x: Column) -> Column:
    return F.coalesce(F.exp(x), F.lit(0.0))


_SQL_BODIES = {
    "safe_div(n DOUBLE, d DOUBLE)": "try_divide(n, d)",
    "safe_sqrt(x DOUBLE)": "sqrt(greatest(x, 0D))",
    "safe_pow(x DOUBLE, y DOUBLE)": "CASE WHEN x IS NULL THEN 0D ELSE power(x, y) END",
    "safe_ln(x DOUBLE)": "coalesce(ln(x), 0D)",
    "safe_exp(x DOUBLE)": "coalesce(exp(x), 0D)",
}


def register_safe_math(spark: SparkSession) -> None:
    """Make the same functions callable from SQL text. Catalyst inlines them."""
    for head, body in _SQL_BODIES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS DOUBLE RETURN {body}")
