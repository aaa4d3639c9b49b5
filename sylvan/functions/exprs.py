"""Small column-expression helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col_of(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI-safe, never raises)."""
    return F.try_divide(col_of(num), col_of(den))


def positive_ratio(num, den) -> Column:
    """Scoring-time ratio: num / den if den > 0 else 0."""
    d = col_of(den)
    return F.when(d > 0, col_of(num) / d).otherwise(F.lit(0.0))


def finite_or_null(c) -> Column:
    """NaN and +-inf become NULL (one missing-value marker everywhere)."""
    x = col_of(c)
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None)).otherwise(x)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint only after counting the rows below ``max_rows``;
    otherwise leave the join strategy to Spark/AQE."""
    n = df.count()
    return F.broadcast(df) if n <= max_rows else df


def unused(df, *names: str) -> list:
    """Column names made from ``names`` that ``df`` does not have (case aside)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
