"""Scalar column functions: built-in Spark expressions only, no Python UDFs."""

from .dates import (as_of_date, index_month, month_index, month_of, month_text,
                    next_month, utc_date)
from .extract import first_item, interval_count, safe_get, stamp, ts_utc
from .money import as_double, cents_to_dollars, end_date, monthly_cents
from .predicates import (BASE_STATUSES, FULL_STATUSES, drop_trialing, filter_status,
                         is_true, not_ended, started_by)
from .text import fmt_axis_k, fmt_currency, fmt_delta, fmt_pct, trend

__all__ = [
    "as_of_date", "index_month", "month_index", "month_of", "month_text", "next_month",
    "utc_date", "first_item", "interval_count", "safe_get", "stamp", "ts_utc", "as_double",
    "cents_to_dollars", "end_date", "monthly_cents", "BASE_STATUSES", "FULL_STATUSES",
    "drop_trialing", "filter_status", "is_true", "not_ended", "started_by", "fmt_axis_k",
    "fmt_currency", "fmt_delta", "fmt_pct", "trend",
]
