"""Window functions over the monthly series.

A monthly series has at most one row per calendar month, so these windows run
on one partition by design: their size is bounded by the calendar span, not by
the data.  ``lag`` is written once and reused, so Catalyst builds a single
Window node.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(order: str = "month"):
    return Window.orderBy(order)


def prev_value(col: str = "mrr_amount", order: str = "month") -> Column:
    """``LAG(col) OVER (ORDER BY month)`` - the previous *present* month (T4)."""
    return F.lag(col).over(_order(order))


def change(cur: Column, prev: Column) -> Column:
    """Change against the previous month, two decimals; no previous month counts as 0."""
    return F.round(cur - F.coalesce(prev, F.lit(0.0)), 2)


def change_pct_rounded(cur: Column, prev: Column) -> Column:
    """Percent change, one decimal; NULL when the previous value is NULL or 0."""
    return F.when(prev != 0, F.round((cur - prev) / prev * 100, 1))


def change_pct(cur: Column, prev: Column) -> Column:
    """Unrounded ``(cur - prev) / prev * 100``; NULL without a previous value or
    when it is 0 (T13: NULL, never Infinity/NaN)."""
    return F.when(prev != 0, (cur - prev) / prev * 100)


def row_change_pct(df: DataFrame, col: str = "mrr_amount", order: str = "month",
                   out: str = "mom_change_pct") -> DataFrame:
    """Each row against the row before it (NULL on the first row)."""
    return df.withColumn(out, change_pct(F.col(col), prev_value(col, order)))


def series_ends(df: DataFrame, order: str = "month",
                cols=("mrr_amount", "active_subscriptions", "active_customers")) -> DataFrame:
    """One row with the row count and the first, previous and latest values of ``cols``.

    ``prev_*`` is the row before the latest one (NULL for a one-row series);
    an empty series gives one row of NULLs, like the dashboard's ``undefined``.
    """
    w = _order(order)
    with_prev_cols = df.select(order, *cols, *[F.lag(c).over(w).alias(f"_prev_{c}") for c in cols],
                               F.lag(order).over(w).alias("_prev_order"))
    row = F.struct(order, *cols, *[f"_prev_{c}" for c in cols], "_prev_order")
    agg = with_prev_cols.agg(F.min_by(row, F.col(order)).alias("first"),
                             F.max_by(row, F.col(order)).alias("latest"),
                             F.count(F.lit(1)).alias("rows"))
    return agg.select("rows",
        F.col(f"first.{order}").alias(f"first_{order}"),
        *[F.col(f"first.{c}").alias(f"first_{c}") for c in cols],
        F.col("latest._prev_order").alias(f"prev_{order}"),
        *[F.col(f"latest._prev_{c}").alias(f"prev_{c}") for c in cols],
        F.col(f"latest.{order}").alias(f"latest_{order}"),
        *[F.col(f"latest.{c}").alias(f"latest_{c}") for c in cols])
