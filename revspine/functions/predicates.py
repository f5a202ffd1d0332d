"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dates import next_month

# The revenue-generating statuses of each query variant.
FULL_STATUSES = ("active", "past_due", "canceled", "trialing")
BASE_STATUSES = ("active", "past_due", "canceled")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def filter_status(df: DataFrame, statuses=BASE_STATUSES, col="status") -> DataFrame:
    """keep rows whose status is in ``statuses`` (NULL status never passes)."""
    return df.filter(_c(col).isin(*statuses))


def drop_trialing(df: DataFrame, col="status") -> DataFrame:
    """the full query's late ``status != 'trialing'`` (F1 + F3 == F2)."""
    return df.filter(_c(col) != "trialing")


def started_by(start, month) -> Column:
    """``start <= month + 1 month``; inclusive, so a start on the 1st also
    counts in the month before (T1)."""
    return _c(start) <= next_month(month)


def not_ended(end, month) -> Column:
    """``end IS NULL OR end >= month``; an end on the 1st still counts."""
    e = _c(end)
    return e.isNull() | (e >= _c(month))


def is_true(flag) -> Column:
    """``flag = TRUE`` where NULL is not true."""
    return F.coalesce(_c(flag), F.lit(False))
