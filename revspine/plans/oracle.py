"""Independent DuckDB SQL for every registered query (the correctness oracle).

The statements share no formulation with the Spark plans: MRR is counted from
each subscription's own generated months (the plans never expand windows), and
extraction from the given tables (the plans parse JSON text).  They run on the
driver's pre-registered views; the fixture derivations come from
``sources.fixtures``.  Dialect notes: DuckDB types ``12.0`` as DECIMAL, so
constants are cast to DOUBLE; ``SUM(BIGINT)`` is HUGEINT, so sums are cast back.
"""

from __future__ import annotations

from ..schemas import INVOICE_COLUMNS
from ..sources.fixtures import (AS_OF, ASKED_YEARS, BROKEN_AT, BROKEN_EVERY, COPY_EVERY, COPY_WINS_EVERY, DAMAGED_DOCUMENT_AT,
                                DAMAGED_DOCUMENT_EVERY, DOCUMENT_KEYS, LOST_ENTRY_AT, LOST_ENTRY_EVERY, PLAN_AMOUNTS, SQL_INVOICE_LINES,
                                SQL_MANIFEST, SQL_SUBSCRIPTIONS, UNREADABLE_AMOUNT_AT, UNREADABLE_AMOUNT_EVERY, UNREADABLE_CREATED_AT,
                                UNREADABLE_CREATED_EVERY, UNREADABLE_NAME_AT, UNREADABLE_NAME_EVERY, UNREADABLE_QUANTITY_AT, UNREADABLE_QUANTITY_EVERY)

#: Statuses that count, and months per billing period, of each variant.
_COUNTED = {"full": ("active", "past_due", "canceled"), "view": ("active", "past_due", "canceled"), "api": ("active", "past_due", "canceled")}
_PERIODS = {"full": {"year": "12", "month": "1", "week": "12/52", "day": "12/365.25"}, "view": {"year": "12", "month": "1"}, "api": {"year": "12", "month": "1"}}


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _cents(mode: str) -> str:
    """Cents a month: the amount over the months of its period, rounded per subscription."""
    count = "ifnull(plan_interval_count, 1)" if mode == "api" else "plan_interval_count"
    total = "plan_amount * quantity"
    by_period = {"year": f"{total} / (12::DOUBLE * {count})", "month": f"{total} / {count}",
                 "week": f"{total} * (52::DOUBLE / 12::DOUBLE) / {count}", "day": f"{total} * (365.25::DOUBLE / 12::DOUBLE) / {count}"}
    cases = " ".join(f"WHEN '{p}' THEN round({by_period[p]})::BIGINT" for p in _PERIODS[mode])
    return f"CASE plan_interval {cases} ELSE ({total})::BIGINT END"


_ENDS = """CASE WHEN ended_at IS NOT NULL THEN ended_at::DATE
                 WHEN status = 'canceled' AND canceled_at IS NOT NULL THEN canceled_at::DATE
                 WHEN cancel_at_period_end THEN current_period_end::DATE END"""


def _first_month() -> str:
    return "(SELECT date_trunc('month', min(created_at)) FROM subscriptions)::DATE"


def _active(mode: str, as_of: str = AS_OF) -> str:
    """One row per subscription row and month in which it counts: a start on
    the first of a month counts for the month before too."""
    return SQL_SUBSCRIPTIONS + f""",
dated AS (
    SELECT subscription_id, customer_id, status, plan_interval, {_cents(mode)} AS cents,
           created_at::DATE AS started, {_ENDS} AS stopped
    FROM subscriptions WHERE status IN {_in(_COUNTED[mode])}
),
lived AS (
    SELECT *, unnest(generate_series(
               greatest(date_trunc('month', started - 1)::DATE, {_first_month()})::TIMESTAMP,
               least(date_trunc('month', ifnull(stopped, DATE '{as_of}')), date_trunc('month', DATE '{as_of}'))::TIMESTAMP,
               INTERVAL 1 MONTH))::DATE AS at_month
    FROM dated
)"""


def _series(mode: str, as_of: str = AS_OF) -> str:
    return _active(mode, as_of) + """,
per_month AS (
    SELECT at_month, count(DISTINCT subscription_id) AS n_subs, count(DISTINCT customer_id) AS n_custs,
           sum(cents)::BIGINT AS total_cents, round(sum(cents) / 100::DOUBLE, 2) AS dollars
    FROM lived GROUP BY at_month
)"""


def monthly_mrr_sql(mode: str, as_of: str = AS_OF) -> str:
    shown = "strftime(at_month, '%Y-%m') AS month, n_subs AS active_subscriptions, n_custs AS active_customers, dollars AS mrr_amount"
    if mode != "full":
        return f"WITH {_series(mode, as_of)}\nSELECT {shown} FROM per_month ORDER BY month"
    return f"""WITH {_series(mode, as_of)},
beside AS (SELECT *, lag(dollars) OVER (ORDER BY at_month) AS before FROM per_month)
SELECT {shown}, total_cents AS mrr_cents, before AS prev_month_mrr, round(dollars - ifnull(before, 0), 2) AS mrr_change,
       round((dollars - before) / nullif(before, 0) * 100, 1) AS mrr_change_pct
FROM beside ORDER BY month"""


def month_spine_sql(as_of: str = AS_OF) -> str:
    return f"""WITH {SQL_SUBSCRIPTIONS}
SELECT unnest(generate_series({_first_month()}::TIMESTAMP, date_trunc('month', DATE '{as_of}')::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS month_start"""


def subscription_windows_sql(mode: str) -> str:
    plan = "plan_amount, plan_interval, plan_interval_count, quantity, currency, status, " if mode == "full" else ""
    statuses = _COUNTED[mode] + ("trialing",) * (mode == "full")
    return f"""WITH {SQL_SUBSCRIPTIONS}
SELECT subscription_id, customer_id, {plan}created_at::DATE AS start_date, {_ENDS} AS end_date, {_cents(mode)} AS monthly_amount_cents
FROM subscriptions WHERE status IN {_in(statuses)}"""


def active_sub_months_sql(as_of: str = AS_OF) -> str:
    return f"""WITH {_active('full', as_of)}
SELECT at_month AS month_start, subscription_id, customer_id, cents AS monthly_amount_cents, status, plan_interval FROM lived"""


def active_in_months_sql(as_of: str = AS_OF) -> str:
    years = ", ".join(map(str, ASKED_YEARS))
    return f"""WITH {_active('full', as_of)}
SELECT at_month AS month_start, subscription_id, customer_id, cents AS monthly_amount_cents, status, plan_interval FROM lived
WHERE month(at_month) = 12 AND year(at_month) IN ({years})"""


# --------------------------------------------------------------------------
# Report queries over the API series.
# --------------------------------------------------------------------------

def _fmt_currency(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN NULL ELSE (CASE WHEN {x} < 0 THEN '-' ELSE '' END) || '$' || "
            f"format('{{:,}}', CAST(round(abs({x})) AS BIGINT)) END")


def _fmt_pct(x: str) -> str:
    shown = f"printf('%.1f', abs(round({x}, 1)))"
    return f"ifnull((CASE sign({x}) WHEN 1 THEN '+' WHEN -1 THEN '-' ELSE '' END) || {shown} || '%', '—')"


def _trend(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'none' WHEN {x} >= 0 THEN 'up' ELSE 'down' END"


def _fmt_delta(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN NULL ELSE (CASE WHEN {x} >= 0 THEN '+' ELSE '' END) || "
            f"CAST({x} AS VARCHAR) || ' from last month' END")


def series_ctes(as_of: str = AS_OF) -> str:
    return _series("api", as_of) + """,
series AS (
    SELECT strftime(at_month, '%Y-%m') AS month, dollars AS mrr_amount, n_subs AS active_subscriptions, n_custs AS active_customers
    FROM per_month
),
ordered AS (
    SELECT *, LAG(mrr_amount) OVER (ORDER BY month) AS prev_mrr,
           LAG(active_subscriptions) OVER (ORDER BY month) AS prev_subs,
           row_number() OVER (ORDER BY month DESC) AS rn_desc,
           row_number() OVER (ORDER BY month) AS rn_asc
    FROM series
),
kpi AS (
    SELECT l.mrr_amount AS current_mrr,
           CASE WHEN l.prev_mrr <> 0 THEN (l.mrr_amount - l.prev_mrr) / l.prev_mrr * 100 END AS mom_change_pct,
           l.active_subscriptions,
           l.active_subscriptions - l.prev_subs AS subscription_delta,
           l.active_customers,
           CASE WHEN f.mrr_amount > 0 THEN (l.mrr_amount - f.mrr_amount) / f.mrr_amount * 100 END AS total_growth_pct,
           f.mrr_amount AS first_mrr
    FROM (SELECT 1 AS one) d
    LEFT JOIN (SELECT * FROM ordered WHERE rn_desc = 1) l ON TRUE
    LEFT JOIN (SELECT * FROM ordered WHERE rn_asc = 1) f ON TRUE
),
span AS (
    SELECT count(*) AS months_loaded, min(month) AS first_month, max(month) AS last_month,
           CASE WHEN count(*) > 0 THEN min(month) || ' — ' || max(month) ELSE '' END AS range_text
    FROM series
)"""


def kpi_cards_sql() -> str:
    return "WITH " + series_ctes() + "\nSELECT * FROM kpi"


def series_span_sql() -> str:
    return "WITH " + series_ctes() + "\nSELECT * FROM span"


def monthly_breakdown_sql() -> str:
    pct = "CASE WHEN prev_mrr <> 0 THEN (mrr_amount - prev_mrr) / prev_mrr * 100 END"
    return ("WITH " + series_ctes() + f"""
SELECT month, mrr_amount, active_subscriptions, active_customers,
       {pct} AS mom_change_pct,
       {_fmt_currency('mrr_amount')} AS mrr_text,
       {_fmt_pct(pct)} AS change_text,
       {_trend(pct)} AS trend
FROM ordered ORDER BY month""")


def mrr_trend_sql() -> str:
    return ("WITH " + series_ctes() + f"""
SELECT month, mrr_amount, active_subscriptions, active_customers,
       '$' || CAST(CAST(round(mrr_amount / 1000) AS BIGINT) AS VARCHAR) || 'k' AS axis_label,
       {_fmt_currency('mrr_amount')} AS tooltip_mrr,
       CAST(active_subscriptions AS VARCHAR) || ' subs · ' || CAST(active_customers AS VARCHAR) || ' customers'
           AS tooltip_detail
FROM series ORDER BY month""")


def report_text_sql() -> str:
    return ("WITH " + series_ctes() + f"""
SELECT COALESCE({_fmt_currency('current_mrr')}, '—') AS current_mrr_text,
       CASE WHEN mom_change_pct IS NOT NULL THEN {_fmt_pct('mom_change_pct')} || ' MoM' END AS mom_text,
       {_trend('mom_change_pct')} AS mom_trend,
       COALESCE(CAST(active_subscriptions AS VARCHAR), '—') AS subscriptions_text,
       {_fmt_delta('subscription_delta')} AS subscription_delta_text,
       {_trend('subscription_delta')} AS subscription_trend,
       COALESCE(CAST(active_customers AS VARCHAR), '—') AS customers_text,
       {_fmt_pct('total_growth_pct')} AS total_growth_text,
       {_trend('total_growth_pct')} AS total_growth_trend,
       CASE WHEN first_mrr IS NOT NULL THEN 'from ' || {_fmt_currency('first_mrr')} END AS first_mrr_text,
       CASE WHEN months_loaded > 0 THEN CAST(months_loaded AS VARCHAR) || ' months loaded' ELSE '' END
           AS months_loaded_text,
       range_text
FROM kpi CROSS JOIN span""")


def mrr_payload_sql() -> str:
    return ("WITH " + series_ctes() + """
SELECT to_json({'data': COALESCE(list({'month': month, 'active_subscriptions': active_subscriptions,
                                       'active_customers': active_customers,
                                       'mrr_amount': CAST(mrr_amount AS DECIMAL(18, 2))} ORDER BY month), []),
                'status': 'ok'}) AS payload
FROM series""")


# --------------------------------------------------------------------------
# Extraction queries (Q5 without the writes), stated over the given tables.
# --------------------------------------------------------------------------

# The contract of "first seen": a customer's invoices newest first, then by every other field.
_LIST_ORDER = ("created_at DESC NULLS LAST, invoice_id ASC NULLS LAST, amount_due DESC NULLS LAST, "
               "amount_paid DESC NULLS LAST, status ASC NULLS LAST, subscription_id ASC NULLS LAST, "
               "period_start ASC NULLS LAST, period_end ASC NULLS LAST, paid_at ASC NULLS LAST, "
               "currency ASC NULLS LAST, hosted_invoice_url ASC NULLS LAST")

_INVOICE_COLS = ", ".join(INVOICE_COLUMNS)

_FLAT_SUB = f"""
flat_subscriptions AS (
    SELECT k, subscription_id, status,
           CASE WHEN plan_amount IS NOT NULL THEN price_id END AS price_id,
           CASE WHEN plan_amount IS NOT NULL THEN product_id END AS product_id,
           plan_amount,
           CASE WHEN k % 10 <> 9 THEN plan_interval END AS plan_interval,
           CASE WHEN k % 10 <> 9 THEN ifnull(plan_interval_count, 1) END::BIGINT AS plan_interval_count,
           currency,
           CASE WHEN plan_amount IS NULL OR k % {UNREADABLE_QUANTITY_EVERY} = {UNREADABLE_QUANTITY_AT} THEN 1 ELSE quantity END::BIGINT AS quantity,
           CASE WHEN k % {UNREADABLE_CREATED_EVERY} <> {UNREADABLE_CREATED_AT} THEN created_at END AS created_at, current_period_start, current_period_end, canceled_at, cancel_at_period_end,
           ended_at, trial_start, trial_end, extracted_at
    FROM subscriptions
)"""

_FETCHED = SQL_MANIFEST + "," + SQL_INVOICE_LINES + f""",
fetched AS (
    SELECT {_INVOICE_COLS}, first_position
    FROM invoice_lines JOIN (SELECT customer_id, min(position) AS first_position FROM manifest GROUP BY customer_id) USING (customer_id)
)"""


def _broken(prefix: str, key: str) -> str:
    return f"""'{{"id": "{prefix}' || CAST({key} AS VARCHAR) || '", "status": '"""


_REJECTS = SQL_MANIFEST + f""",
looked_up AS (
    SELECT m.position, m.customer_id, m.subscription_id, o.o_orderkey IS NULL AS no_sub, c.c_custkey IS NULL AS no_cust
    FROM manifest m
    LEFT JOIN orders o ON m.subscription_id = 'sub_' || CAST(o.o_orderkey AS VARCHAR)
    LEFT JOIN customer c ON m.customer_id = 'cus_' || CAST(c.c_custkey AS VARCHAR)
),
rejects AS (
    SELECT 'subscriptions' AS load, position, customer_id, subscription_id,
           CASE WHEN no_sub THEN 'subscription not found' ELSE 'customer not found' END AS reason, NULL::VARCHAR AS record
    FROM looked_up WHERE no_sub OR no_cust
    UNION ALL
    SELECT 'invoices', position, customer_id, subscription_id, 'customer not found', NULL FROM looked_up WHERE no_cust
    UNION ALL
    SELECT 'subscriptions', NULL, NULL, NULL, 'malformed', {_broken("sub_", "o_orderkey")} FROM orders WHERE o_orderkey % {BROKEN_EVERY} = {BROKEN_AT}
    UNION ALL
    SELECT 'subscriptions', NULL, NULL, NULL, 'malformed', {_broken("cus_", "c_custkey")} FROM customer WHERE c_custkey % {BROKEN_EVERY} = {BROKEN_AT}
    UNION ALL
    SELECT 'invoices', NULL, NULL, NULL, 'malformed', {_broken("in_", "l_orderkey")}
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber = 1 AND l_orderkey % {BROKEN_EVERY} = {BROKEN_AT}
)"""


def flatten_subscriptions_sql() -> str:
    """All landed records: the copies differ in their currency."""
    return f"""WITH {SQL_SUBSCRIPTIONS}, {_FLAT_SUB}
SELECT * EXCLUDE (k) FROM flat_subscriptions
UNION ALL
SELECT * EXCLUDE (k) REPLACE (CASE WHEN k % {COPY_WINS_EVERY} = 0 THEN 'xts' ELSE 'eur' END AS currency)
FROM flat_subscriptions WHERE k % {COPY_EVERY} = 0"""


def extract_subscriptions_sql() -> str:
    """One row per manifest entry; the greater of two records of an id is the one looked up."""
    return f"""WITH {SQL_SUBSCRIPTIONS}, {_FLAT_SUB}, {SQL_MANIFEST}
SELECT m.subscription_id, m.customer_id, lower(replace(c.c_name, '#', '.')) || '@example.com' AS customer_email,
       CASE WHEN c.c_custkey % {UNREADABLE_NAME_EVERY} <> {UNREADABLE_NAME_AT} THEN c.c_name END AS customer_name,
       f.* EXCLUDE (k, subscription_id) REPLACE (CASE WHEN f.k % {COPY_WINS_EVERY} = 0 THEN 'xts' ELSE currency END AS currency)
FROM manifest m
JOIN flat_subscriptions f ON m.subscription_id = f.subscription_id
JOIN customer c ON m.customer_id = 'cus_' || CAST(c.c_custkey AS VARCHAR)"""


def extract_errors_sql() -> str:
    return f"WITH {_REJECTS}\nSELECT * FROM rejects"


def field_violations_sql() -> str:
    """Every landed record lists its own: copies of a subscription do so too."""
    return f"""WITH {SQL_SUBSCRIPTIONS}, {SQL_INVOICE_LINES},
landed AS (SELECT *, unnest(CASE WHEN k % {COPY_EVERY} = 0 THEN [1, 2] ELSE [1] END) AS copy FROM subscriptions)
SELECT 'subscriptions' AS load, subscription_id AS record_id, 'items.data[0].quantity' AS field, 'many' AS value FROM landed
WHERE k % {UNREADABLE_QUANTITY_EVERY} = {UNREADABLE_QUANTITY_AT} AND quantity <> 1 AND plan_amount IS NOT NULL
UNION ALL
SELECT 'subscriptions', subscription_id, 'created', 'soon' FROM landed WHERE k % {UNREADABLE_CREATED_EVERY} = {UNREADABLE_CREATED_AT}
UNION ALL
SELECT 'subscriptions', 'cus_' || CAST(c_custkey AS VARCHAR), 'name', '{{"full":"' || c_name || '"}}' FROM customer
WHERE c_custkey % {UNREADABLE_NAME_EVERY} = {UNREADABLE_NAME_AT}
UNION ALL
SELECT 'invoices', invoice_id, 'amount_due', CAST(round(l_extendedprice * 100) AS BIGINT) || ' USD' FROM invoice_lines
WHERE l_linenumber = 1 AND l_orderkey % {UNREADABLE_AMOUNT_EVERY} = {UNREADABLE_AMOUNT_AT}"""


def manifest_split_sql() -> str:
    """One document of all entries."""
    amounts = " ".join(f"WHEN {i} THEN {a}" for i, a in enumerate(PLAN_AMOUNTS))
    return f"""WITH {SQL_MANIFEST}
SELECT row_number() OVER (ORDER BY position) - 1 AS position, customer_id, subscription_id, 'plan_' || CAST(k % 10 AS VARCHAR) AS plan,
       (CASE k % 10 {amounts} END)::BIGINT AS amount, 'month' AS interval, 'clock_' || CAST(o_custkey % 25 AS VARCHAR) AS clock_id, 'active' AS status
FROM manifest"""


def manifest_rejects_sql() -> str:
    """Entries that are no object, at the end of their documents, and documents that break off."""
    return f"""WITH {SQL_MANIFEST},
sized AS (SELECT k // {DOCUMENT_KEYS} AS document, count(*) AS n FROM manifest GROUP BY ALL)
SELECT 'manifest' AS load, document * 4294967296 + n AS position, NULL::VARCHAR AS customer_id, NULL::VARCHAR AS subscription_id,
       'malformed' AS reason, 'lost' AS record
FROM sized WHERE document % {LOST_ENTRY_EVERY} = {LOST_ENTRY_AT}
UNION ALL
SELECT 'manifest', NULL, NULL, NULL, 'malformed', '{{"num_customers":' || n || ',"customers":[{{"customer_id":'
FROM sized WHERE document % {DAMAGED_DOCUMENT_EVERY} = {DAMAGED_DOCUMENT_AT}"""


def flatten_invoices_sql() -> str:
    return f"WITH {SQL_INVOICE_LINES}\nSELECT {_INVOICE_COLS} FROM invoice_lines"


def cap_per_customer_sql(n: int) -> str:
    return f"""WITH {SQL_INVOICE_LINES}
SELECT {_INVOICE_COLS}, row_number() OVER (PARTITION BY customer_id ORDER BY {_LIST_ORDER}) AS list_rank
FROM invoice_lines QUALIFY list_rank <= {n}"""


def dedup_invoices_sql() -> str:
    return f"""WITH {_FETCHED}
SELECT {_INVOICE_COLS} FROM fetched
QUALIFY row_number() OVER (PARTITION BY invoice_id ORDER BY first_position, customer_id, {_LIST_ORDER}) = 1"""


def invoices_per_customer_sql() -> str:
    return f"WITH {_FETCHED}\nSELECT customer_id, count(*) AS invoices FROM fetched GROUP BY customer_id"


def load_summary_sql() -> str:
    return f"""WITH {_FETCHED}, {_REJECTS.removeprefix(SQL_MANIFEST + ",")}
SELECT 'subscriptions' AS table_name, (SELECT count(*) FROM looked_up WHERE NOT (no_sub OR no_cust)) AS rows_fetched,
       (SELECT count(*) FROM looked_up WHERE NOT (no_sub OR no_cust)) AS rows_loaded,
       (SELECT count(*) FROM rejects WHERE load = 'subscriptions') AS rows_rejected
UNION ALL
SELECT 'invoices', (SELECT count(*) FROM fetched), (SELECT count(DISTINCT invoice_id) FROM fetched), (SELECT count(*) FROM rejects WHERE load = 'invoices')"""


def full_refresh_load_sql() -> str:
    """What a first load leaves in its tables, from the statements of their rows."""
    def of(name, rows, key, amount, version=1):
        return f"SELECT '{name}' AS table_name, {version}::BIGINT AS version, count(*) AS row_count, count(DISTINCT {key}) AS id_count, sum({amount})::BIGINT AS total FROM ({rows}) HAVING count(*) > 0"

    return "\nUNION ALL\n".join([
        of("subscriptions", extract_subscriptions_sql(), "subscription_id", "plan_amount"), of("invoices", dedup_invoices_sql(), "invoice_id", "amount_due"),
        of("load_rejects", extract_errors_sql(), "record", "position"), of("load_violations", field_violations_sql(), "record_id", "NULL::BIGINT"),
        of("load_summary", load_summary_sql(), "table_name", "rows_loaded"), of("export", dedup_invoices_sql(), "invoice_id", "amount_due", 0)])


def manifest_entries_sql() -> str:
    """Places within documents of DOCUMENT_KEYS order keys, documents in steps of 2^32."""
    amounts = " ".join(f"WHEN {i} THEN {a}" for i, a in enumerate(PLAN_AMOUNTS))
    return f"""WITH {SQL_MANIFEST}
SELECT (k // {DOCUMENT_KEYS}) * 4294967296 + row_number() OVER (PARTITION BY k // {DOCUMENT_KEYS} ORDER BY position) - 1 AS position,
       customer_id, subscription_id, 'plan_' || CAST(k % 10 AS VARCHAR) AS plan, (CASE k % 10 {amounts} END)::BIGINT AS amount,
       'month' AS interval, 'clock_' || CAST(o_custkey % 25 AS VARCHAR) AS clock_id, 'active' AS status
FROM manifest"""


def required_violations_sql(columns) -> str:
    return f"WITH {SQL_SUBSCRIPTIONS}\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count FROM subscriptions" for c in columns)
