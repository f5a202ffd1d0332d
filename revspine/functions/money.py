"""Revenue expressions: effective end date (P8), monthly normalisation (P9-P11),
cents to dollars (P12) and the output cast (C11).

Literal types matter (trap T10): ``12.0`` in Spark SQL text is a DECIMAL, so
the constants here are Python floats, which Spark types as DOUBLE, matching the
source dialect's FLOAT64 arithmetic.  Rounding happens per subscription, before
any sum (T8).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import utc_date
from .predicates import is_true

MODES = ("full", "view", "api")

# Fixed values of the normalisation (must equal the reference's):
# months per year 12.0, weeks per year 52.0, days per year 365.25, cents per dollar 100.0.
MONTHS_PER_YEAR = 12.0
WEEKS_PER_YEAR = 52.0
DAYS_PER_YEAR = 365.25
CENTS_PER_DOLLAR = 100.0


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def end_date(ended_at="ended_at", status="status", canceled_at="canceled_at",
             cancel_at_period_end="cancel_at_period_end",
             current_period_end="current_period_end") -> Column:
    """ended_at, else canceled_at when canceled, else the period end when set to
    cancel at period end; NULL means still running.  A NULL flag is not true (F6)."""
    return F.coalesce(
        utc_date(ended_at),
        F.when(_c(status) == "canceled", utc_date(canceled_at)),
        F.when(is_true(_c(cancel_at_period_end)), utc_date(current_period_end)),
    )


def monthly_cents(mode: str = "full", plan_amount="plan_amount", quantity="quantity",
                  plan_interval="plan_interval", plan_interval_count="plan_interval_count") -> Column:
    """A subscription's plan price normalised to cents per month.

    * ``full``: year, month, week, day; any other interval -> raw amount.
    * ``view``: year and month only; week/day fall to the raw amount.
    * ``api``: as ``view`` but a NULL interval count counts as 1.
    In ``full``/``view`` a NULL interval count gives NULL cents.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    amount = _c(plan_amount) * _c(quantity)
    ic = _c(plan_interval_count)
    if mode == "api":
        ic = F.coalesce(ic, F.lit(1).cast("bigint"))
    interval = _c(plan_interval)

    def rounded(x):
        return F.round(x).cast("bigint")

    expr = (F.when(interval == "year", rounded(amount / (F.lit(MONTHS_PER_YEAR) * ic)))
             .when(interval == "month", rounded(amount / ic)))
    if mode == "full":
        expr = (expr
                .when(interval == "week",
                      rounded(amount * (F.lit(WEEKS_PER_YEAR) / F.lit(MONTHS_PER_YEAR)) / ic))
                .when(interval == "day",
                      rounded(amount * (F.lit(DAYS_PER_YEAR) / F.lit(MONTHS_PER_YEAR)) / ic)))
    return expr.otherwise(amount.cast("bigint"))


def cents_to_dollars(cents) -> Column:
    """``ROUND(cents / 100.0, 2)`` as DOUBLE."""
    return F.round(_c(cents) / F.lit(CENTS_PER_DOLLAR), 2)


def as_double(col) -> Column:
    """C11: the API's ``float(x)`` on output."""
    return _c(col).cast("double")
