"""Monthly recurring revenue (Q1-Q3): one plan, three variants.

==========  ===================================  ===============  ==========
mode        week/day plans                       NULL int. count  columns
==========  ===================================  ===============  ==========
``full``    x52/12, x365.25/12; trialing dropped  NULL cents       8
``view``    raw amount                           NULL cents       4
``api``     raw amount                           counts as 1      4
==========  ===================================  ===============  ==========

Physical shape (see ``operators.interval_agg``):
one columnar scan of the subscription columns that tags window-end events and
per-key ranges, one map-side-combined aggregate, one window per key for the
exact distinct counts, and a running sum over the months; plus a one-column
scan for the spine's lower bound.  No step expands windows into months, no
join compares every window with every month, and nothing larger than the
month spine is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import index_month, month_text
from ..functions.money import as_double, cents_to_dollars
from ..functions.predicates import drop_trialing
from ..operators.interval_agg import monthly_deltas, running_totals, window_ranges
from ..operators.series import change, change_pct_rounded, prev_value
from ..operators.spine import month_bounds, spine_indices
from ..operators.windows import subscription_windows

# Output columns of the variants.
BASE_OUTPUT = ("month", "active_subscriptions", "active_customers", "mrr_amount")
FULL_OUTPUT = BASE_OUTPUT + ("mrr_cents", "prev_month_mrr", "mrr_change", "mrr_change_pct")


def revenue_windows(subs: DataFrame, mode: str = "full") -> DataFrame:
    """The windows that count as revenue: F1+F3 for ``full``, F2 otherwise."""
    win = subscription_windows(subs, mode)
    return drop_trialing(win) if mode == "full" else win


def monthly_totals(subs: DataFrame, mode: str = "full", as_of=None) -> DataFrame:
    """Per present month: ``month_start`` (DATE), both exact distinct counts and
    ``mrr_cents`` (NULL when every active row has NULL cents)."""
    totals = running_totals(spine_indices(month_bounds(subs, as_of)), monthly_deltas(window_ranges(revenue_windows(subs, mode))))
    return totals.select(index_month("idx").alias("month_start"), "active_subscriptions", "active_customers", "mrr_cents")


def present(totals: DataFrame, mode: str = "full") -> DataFrame:
    """The variant's output columns from monthly totals, ordered by month (L2)."""
    amount = cents_to_dollars("mrr_cents")
    out = totals.select(month_text("month_start").alias("month"), "active_subscriptions", "active_customers",
                        (as_double(amount) if mode == "api" else amount).alias("mrr_amount"), "mrr_cents")
    if mode == "full":
        prev = prev_value("mrr_amount")  # W1, one Window node for all three uses
        out = out.select(*FULL_OUTPUT[:5], prev.alias("prev_month_mrr"),
                         change(F.col("mrr_amount"), prev).alias("mrr_change"),
                         change_pct_rounded(F.col("mrr_amount"), prev).alias("mrr_change_pct"))
        return out.orderBy("month")
    return out.select(*BASE_OUTPUT).orderBy("month")


def monthly_mrr(subs: DataFrame, mode: str = "full", as_of=None) -> DataFrame:
    """Q1 (``full``), Q2 (``view``), Q3 (``api``), ordered by month."""
    return present(monthly_totals(subs, mode, as_of), mode)
