"""Calendar functions (C1-C6).  All are built-in, codegen'd column expressions.

Months are handled as an integer *month index* (``year * 12 + month - 1``)
inside the interval arithmetic: it turns "the next month" into ``+ 1`` and a
month range into an integer range, which is what the delta-based aggregation
needs.  Conversions to and from DATE are at the edges only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc_date(ts) -> Column:
    """C1 ``DATE(ts)``: the calendar date of a timestamp in the session zone (UTC)."""
    return F.to_date(_c(ts))


def month_of(d) -> Column:
    """C2 ``DATE_TRUNC(d, MONTH)`` as a DATE (``date_trunc`` would give a TIMESTAMP)."""
    return F.trunc(_c(d), "MM")


def next_month(d) -> Column:
    """C4 ``DATE_ADD(d, INTERVAL 1 MONTH)``."""
    return F.add_months(_c(d), 1)


def month_text(d) -> Column:
    """C5 ``FORMAT_DATE('%Y-%m', d)``."""
    return F.date_format(_c(d), "yyyy-MM")


def month_index(d) -> Column:
    """Month of a DATE as an integer index: ``year * 12 + month - 1``."""
    d = _c(d)
    return F.year(d) * 12 + F.month(d) - 1


def index_month(i) -> Column:
    """Inverse of :func:`month_index`: the first day of that month, as a DATE."""
    i = _c(i)
    return F.make_date(F.floor(i / 12).cast("int"), (i % 12 + 1).cast("int"), F.lit(1))


def as_of_date(as_of=None) -> Column:
    """C6 ``CURRENT_DATE()``: the spine's upper bound, fixed when ``as_of`` is given."""
    if as_of is None:
        return F.current_date()
    return F.to_date(F.lit(str(as_of)))
