"""The expanding forms of monthly MRR, as partners of the plan in tests: every
window against every month (A), and every window exploded into its months (B)."""

from pyspark.sql import functions as F

from revspine.functions.predicates import not_ended, started_by
from revspine.operators.activity import active_sub_months
from revspine.operators.spine import month_bounds, month_spine
from revspine.plans.mrr import monthly_mrr, present, revenue_windows

METHODS = ("delta", "explode", "cross")


def mrr_by(subs, mode, as_of, method):
    if method == "delta":
        return monthly_mrr(subs, mode, as_of)
    windows = revenue_windows(subs, mode)
    if method == "explode":
        pairs = active_sub_months(windows, month_bounds(subs, as_of), ("subscription_id", "customer_id", "monthly_amount_cents"))
    else:
        pairs = F.broadcast(month_spine(subs, as_of)).crossJoin(windows).filter(started_by("start_date", "month_start") & not_ended("end_date", "month_start"))
    return present(pairs.groupBy("month_start").agg(F.countDistinct("subscription_id").alias("active_subscriptions"),
                                                    F.countDistinct("customer_id").alias("active_customers"), F.sum("monthly_amount_cents").alias("mrr_cents")), mode)
