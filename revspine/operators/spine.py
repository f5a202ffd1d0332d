"""Month spine (C3) and its bounds.

The spine runs from the month of the earliest ``created_at`` over *all*
subscriptions (before any status filter, trap T5) to the month of ``as_of``
(``CURRENT_DATE()`` when not given, T6).

The bounds are a one-row DataFrame (a global aggregate: partial minimum per
task, one row shuffled per task).  Consumers attach it with a broadcast cross
join - its size is exactly one row, so the broadcast is bounded by
construction - and Spark reuses the single broadcast wherever the same bounds
plan appears in a query.  The spine itself has one row per month: it is bounded
by the calendar span, not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_of_date, index_month, month_index, utc_date

START, END = "spine_start_idx", "spine_end_idx"


def month_bounds(subs: DataFrame, as_of=None) -> DataFrame:
    """One row (A5, J5, C6): first and last spine month as month indices.  The
    first is that of ``DATE(MIN(created_at))``, the same as ``MIN(DATE(created_at))``,
    so the scan aggregates the raw column and converts one value, not every row."""
    return subs.agg(month_index(utc_date(F.min("created_at"))).alias(START),
                    month_index(as_of_date(as_of)).alias(END))


def with_bounds(df: DataFrame, bounds: DataFrame) -> DataFrame:
    """Attach the one-row bounds to every row (broadcast; one row by construction)."""
    return df.crossJoin(F.broadcast(bounds))


def _sequence(start: Column, end: Column) -> Column:
    """All month indices from start to end; empty when the table is empty
    or the first subscription starts after ``as_of`` (a descending ``sequence``
    would otherwise count backwards)."""
    return F.when(start <= end, F.sequence(start, end))


def spine_indices(bounds: DataFrame) -> DataFrame:
    """The spine as a one-column DataFrame ``idx`` of month indices."""
    return bounds.select(F.explode(_sequence(F.col(START), F.col(END))).alias("idx"))


def month_spine(subs: DataFrame, as_of=None) -> DataFrame:
    """``GENERATE_DATE_ARRAY(first month, as_of month, 1 MONTH)`` unnested,
    one DATE row ``month_start`` per month."""
    return spine_indices(month_bounds(subs, as_of)).select(index_month("idx").alias("month_start"))
