"""Dashboard figures over a monthly series (K1-K6, X1-X5) and the API payload.

Input is a monthly series ``(month, mrr_amount, active_subscriptions,
active_customers)`` - the output of ``monthly_mrr(..., mode="api")``.  It has at
most one row per calendar month, so every operator here works on a bounded
input: the single-partition windows and the one-row aggregates are sized by the
calendar span, never by the subscription data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import MISSING, fmt_axis_k, fmt_currency, fmt_delta, fmt_pct, trend
from .series import change_pct, row_change_pct, series_ends

SERIES_COLUMNS = ("month", "mrr_amount", "active_subscriptions", "active_customers")


def total_growth(first, latest):
    """K2: growth since the first month, only when the first MRR is above 0."""
    return F.when(first > 0, (latest - first) / first * 100)


def sub_delta(latest, prev):
    """K3: subscriptions gained since the previous month."""
    return latest - prev


def _kpis() -> list:
    return [
        F.col("latest_mrr_amount").alias("current_mrr"),
        change_pct(F.col("latest_mrr_amount"), F.col("prev_mrr_amount")).alias("mom_change_pct"),
        F.col("latest_active_subscriptions").alias("active_subscriptions"),
        sub_delta(F.col("latest_active_subscriptions"), F.col("prev_active_subscriptions")).alias("subscription_delta"),
        F.col("latest_active_customers").alias("active_customers"),
        total_growth(F.col("first_mrr_amount"), F.col("latest_mrr_amount")).alias("total_growth_pct"),
        F.col("first_mrr_amount").alias("first_mrr"),
    ]


def _span() -> list:
    return [F.col("rows").alias("months_loaded"), F.col("first_month"), F.col("latest_month").alias("last_month"),
            F.when(F.col("rows") > 0, F.concat(F.col("first_month"), F.lit(" — "), F.col("latest_month")))
             .otherwise(F.lit("")).alias("range_text")]


def kpi_cards(monthly: DataFrame) -> DataFrame:
    """K1: one row - current MRR, MoM %, subscriptions and their delta,
    customers, total growth % and the first month's MRR.  Percentages are
    unrounded; NULL where the dashboard shows a dash (T13: no Infinity)."""
    return series_ends(monthly).select(*_kpis())


def series_span(monthly: DataFrame) -> DataFrame:
    """K4: months loaded, first and last month, and the range caption."""
    return series_ends(monthly).select(*_span())


def monthly_breakdown(monthly: DataFrame) -> DataFrame:
    """K5: the breakdown table - each month with its change against the row
    before it (W4), as numbers and as display text."""
    t = row_change_pct(monthly.select(*SERIES_COLUMNS))
    return t.select(*SERIES_COLUMNS, "mom_change_pct",
                    fmt_currency("mrr_amount").alias("mrr_text"),
                    fmt_pct("mom_change_pct").alias("change_text"),
                    trend("mom_change_pct").alias("trend")).orderBy("month")


def mrr_trend(monthly: DataFrame) -> DataFrame:
    """K6: the chart series - points with their axis and tooltip text."""
    return monthly.select(
        *SERIES_COLUMNS,
        fmt_axis_k("mrr_amount").alias("axis_label"),
        fmt_currency("mrr_amount").alias("tooltip_mrr"),
        F.concat(F.col("active_subscriptions").cast("string"), F.lit(" subs · "),
                 F.col("active_customers").cast("string"), F.lit(" customers")).alias("tooltip_detail"),
    ).orderBy("month")


def report_text(monthly: DataFrame) -> DataFrame:
    """Q4's text: the KPI cards and captions exactly as displayed."""
    one = series_ends(monthly).select(*_kpis(), *_span())  # one aggregate over the series
    dash = F.lit(MISSING)
    return one.select(
        F.coalesce(fmt_currency("current_mrr"), dash).alias("current_mrr_text"),
        F.when(F.col("mom_change_pct").isNotNull(),
               F.concat(fmt_pct("mom_change_pct"), F.lit(" MoM"))).alias("mom_text"),
        trend("mom_change_pct").alias("mom_trend"),
        F.coalesce(F.col("active_subscriptions").cast("string"), dash).alias("subscriptions_text"),
        fmt_delta("subscription_delta").alias("subscription_delta_text"),
        trend("subscription_delta").alias("subscription_trend"),
        F.coalesce(F.col("active_customers").cast("string"), dash).alias("customers_text"),
        fmt_pct("total_growth_pct").alias("total_growth_text"),
        trend("total_growth_pct").alias("total_growth_trend"),
        F.when(F.col("first_mrr").isNotNull(), F.concat(F.lit("from "), fmt_currency("first_mrr")))
         .alias("first_mrr_text"),
        F.when(F.col("months_loaded") > 0, F.concat(F.col("months_loaded").cast("string"),
                                                    F.lit(" months loaded")))
         .otherwise(F.lit("")).alias("months_loaded_text"),
        F.col("range_text"),
    )


def dashboard(monthly: DataFrame) -> dict[str, DataFrame]:
    """Q4: every dashboard figure, keyed by panel."""
    return {"kpi_cards": kpi_cards(monthly), "series_span": series_span(monthly),
            "monthly_breakdown": monthly_breakdown(monthly), "mrr_trend": mrr_trend(monthly),
            "report_text": report_text(monthly)}


def mrr_payload(monthly: DataFrame) -> DataFrame:
    """``{"data": [...], "status": "ok"}`` as one JSON text row.

    Collecting the series into one value is bounded (one element per month).
    Amounts are written as ``decimal(18,2)`` so the text does not switch to
    exponent notation, and NULL fields are kept (T9)."""
    row = F.struct("month", "active_subscriptions", "active_customers",
                   F.col("mrr_amount").cast("decimal(18,2)").alias("mrr_amount"))
    body = F.struct(F.array_sort(F.collect_list(row)).alias("data"), F.lit("ok").alias("status"))
    return monthly.agg(F.to_json(body, {"ignoreNullFields": "false"}).alias("payload"))


__all__ = ["kpi_cards", "series_span", "monthly_breakdown", "mrr_trend", "report_text", "dashboard",
           "mrr_payload", "total_growth", "sub_delta"]
