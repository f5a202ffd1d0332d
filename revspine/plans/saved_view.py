"""The saved MRR view (Q2) as Spark SQL text, for a view that the catalog keeps.

The same plan as ``plans.mrr`` in SQL: windows become + and - events per month,
a key's overlapping windows are merged with a running maximum, and a running
sum over the calendar gives the totals.  Nothing is expanded into months.
"""

from __future__ import annotations

from ..functions.predicates import BASE_STATUSES

OPEN_END = 1 << 30


def mrr_view_sql(subscriptions: str, as_of=None) -> str:
    """SQL over a relation name: ``month, active_subscriptions, active_customers, mrr_amount``."""
    statuses = ", ".join(f"'{s}'" for s in BASE_STATUSES)
    today = f"DATE'{as_of}'" if as_of is not None else "current_date()"
    return f"""
WITH priced AS (
    SELECT subscription_id, customer_id, to_date(created_at) AS start_date,
           coalesce(to_date(ended_at), CASE WHEN status = 'canceled' THEN to_date(canceled_at) END,
                    CASE WHEN cancel_at_period_end THEN to_date(current_period_end) END) AS end_date,
           CASE plan_interval
               WHEN 'year' THEN CAST(round(plan_amount * quantity / (12.0D * plan_interval_count)) AS BIGINT)
               WHEN 'month' THEN CAST(round(plan_amount * quantity / plan_interval_count) AS BIGINT)
               ELSE CAST(plan_amount * quantity AS BIGINT) END AS cents
    FROM {subscriptions} WHERE status IN ({statuses})
), ranges AS (
    SELECT * FROM (
        SELECT subscription_id, customer_id, cents, year(date_sub(start_date, 1)) * 12 + month(date_sub(start_date, 1)) - 1 AS first_idx,
               coalesce(year(end_date) * 12 + month(end_date) - 1, {OPEN_END}) AS last_idx
        FROM priced WHERE start_date IS NOT NULL)
    WHERE first_idx <= last_idx
), keyed AS (
    SELECT kind, key, first_idx, max(last_idx) AS last_idx
    FROM ranges LATERAL VIEW stack(2, 's', subscription_id, 'c', customer_id) AS kind, key
    WHERE key IS NOT NULL GROUP BY kind, key, first_idx
), added AS (
    SELECT kind, last_idx, greatest(first_idx, 1 + max(last_idx) OVER (
               PARTITION BY kind, key ORDER BY first_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS from_idx
    FROM keyed
), events AS (
    SELECT idx, d_rows, d_valued, d_cents, 0 AS d_subs, 0 AS d_custs
    FROM ranges LATERAL VIEW stack(2, first_idx, 1, CAST(cents IS NOT NULL AS INT), cents,
                                      last_idx + 1, -1, -CAST(cents IS NOT NULL AS INT), -cents) AS idx, d_rows, d_valued, d_cents
    UNION ALL
    SELECT idx, 0, 0, CAST(NULL AS BIGINT), IF(kind = 's', sign, 0), IF(kind = 'c', sign, 0)
    FROM added LATERAL VIEW stack(2, from_idx, 1, last_idx + 1, -1) AS idx, sign
    WHERE from_idx <= last_idx
), monthly AS (
    SELECT idx, sum(d_rows) AS d_rows, sum(d_valued) AS d_valued, coalesce(sum(d_cents), 0) AS d_cents,
           sum(d_subs) AS d_subs, sum(d_custs) AS d_custs
    FROM events GROUP BY idx
), bounds AS (
    SELECT year(min(created_at)) * 12 + month(min(created_at)) - 1 AS low, year({today}) * 12 + month({today}) - 1 AS high
    FROM {subscriptions}
), spine AS (
    SELECT explode(CASE WHEN low <= high THEN sequence(low, high) END) AS idx FROM bounds
), running AS (
    SELECT idx, in_spine, sum(coalesce(d_rows, 0)) OVER upto AS n_rows, sum(coalesce(d_valued, 0)) OVER upto AS n_valued,
           sum(coalesce(d_cents, 0)) OVER upto AS cents, sum(coalesce(d_subs, 0)) OVER upto AS subs, sum(coalesce(d_custs, 0)) OVER upto AS custs
    FROM monthly FULL JOIN (SELECT idx, TRUE AS in_spine FROM spine) USING (idx)
    WINDOW upto AS (ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)
SELECT date_format(make_date(CAST(floor(idx / 12) AS INT), CAST(idx % 12 + 1 AS INT), 1), 'yyyy-MM') AS month,
       subs AS active_subscriptions, custs AS active_customers,
       round(CASE WHEN n_valued > 0 THEN cents END / 100.0D, 2) AS mrr_amount
FROM running WHERE in_spine AND n_rows > 0 ORDER BY month"""
