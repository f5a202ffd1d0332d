"""Subscription x month activity.

``active_sub_months`` is the operator whose *output* is the pairs themselves,
so it expands each window into its months with ``explode(sequence(first,
last))``: work proportional to the output, no comparison of every window with
every month.  No aggregate is computed from it (see ``interval_agg``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import index_month
from .windows import month_ranges

PAIR_COLUMNS = ("subscription_id", "customer_id", "monthly_amount_cents", "status", "plan_interval")


def active_sub_months(windows: DataFrame, bounds: DataFrame,
                      columns=PAIR_COLUMNS) -> DataFrame:
    """One row per (spine month, window) in which the window is active."""
    ranges = month_ranges(windows, bounds)
    expanded = ranges.select(F.explode(F.sequence("first_idx", "last_idx")).alias("idx"), *columns)
    return expanded.select(index_month("idx").alias("month_start"), *columns)
