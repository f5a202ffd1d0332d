"""Subscription windows: each subscription's active dates and monthly value.

``subscription_windows`` is the per-variant CTE of the three MRR queries;
``month_ranges`` turns a window into the inclusive range of spine months in
which it counts, so that later steps never compare every window with every
month (the theta join J4 becomes integer range arithmetic).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_index, utc_date
from ..functions.money import end_date, monthly_cents
from ..functions.predicates import BASE_STATUSES, FULL_STATUSES, filter_status
from .spine import END, START, with_bounds

FULL_COLUMNS = ("subscription_id", "customer_id", "plan_amount", "plan_interval",
                "plan_interval_count", "quantity", "currency", "status")
BASE_COLUMNS = ("subscription_id", "customer_id")


def subscription_windows(subs: DataFrame, mode: str = "full") -> DataFrame:
    """Active window and normalised monthly cents per subscription row.

    ``full`` keeps the plan columns and admits ``trialing`` (dropped later by
    F3); ``view`` and ``api`` carry only ids, dates and cents.  Subscriptions
    are not deduplicated (T22); currencies are summed together (T16); the
    current price applies to every past month (T17); trial dates are unused (T18).
    """
    statuses = FULL_STATUSES if mode == "full" else BASE_STATUSES
    cols = FULL_COLUMNS if mode == "full" else BASE_COLUMNS
    return filter_status(subs, statuses).select(
        *cols,
        utc_date("created_at").alias("start_date"),
        end_date().alias("end_date"),
        monthly_cents(mode).alias("monthly_amount_cents"),
    )


def month_ranges(windows: DataFrame, bounds: DataFrame) -> DataFrame:
    """Add ``first_idx``/``last_idx``: the spine months in which a window counts.

    A month ``m`` counts when ``start <= m + 1 month`` (T1: a start on the 1st
    also counts in the month before) and ``end IS NULL OR end >= m`` (T2), so
    the range is ``[month(start - 1 day), month(end)]`` clamped to the spine
    (``bounds`` from ``spine.month_bounds``).  Windows that end before they
    start, or lie outside the spine, drop out (T3).
    """
    first = F.greatest(month_index(F.date_sub("start_date", 1)), F.col(START))
    last = F.least(F.coalesce(month_index("end_date"), F.col(END)), F.col(END))
    return (with_bounds(windows.filter(F.col("start_date").isNotNull()), bounds)
            .withColumn("first_idx", first)
            .withColumn("last_idx", last)
            .drop(START, END)
            .filter(F.col("first_idx") <= F.col("last_idx")))
