"""Declared schemas (fixed, no inference, no evolution).

``SUBSCRIPTIONS`` and ``INVOICES`` are the two warehouse tables; ``REQUIRED``
lists the columns that must never be NULL.  The ``RAW_*`` schemas describe the
nested billing records as they land in the JSON landing zone.  Every raw time
field is typed as a string (``TIME`` in its metadata): it may hold epoch seconds
or ISO-8601 text, and ``functions.extract.ts_utc`` resolves both.
"""

from __future__ import annotations

from pyspark.sql import types as T

#: Text of a landed line that is no JSON object; NULL for a record.
CORRUPT = "_corrupt_record"
#: Fields of a record whose value can't be read as the declared type: array of (field, value).
UNREADABLE = "_unreadable"
#: Partition column of staged records: true where ``CORRUPT`` holds a line.
BROKEN = "_broken"

S, L, B, TS, D = T.StringType(), T.LongType(), T.BooleanType(), T.TimestampType(), T.DoubleType()


def _schema(fields, required):
    return T.StructType([T.StructField(n, t, n not in required) for n, t in fields])


# Names, types and REQUIRED marks of both warehouse tables.
SUBSCRIPTIONS_REQUIRED = ("subscription_id", "customer_id", "extracted_at")
SUBSCRIPTIONS = _schema([
    ("subscription_id", S), ("customer_id", S), ("customer_email", S), ("customer_name", S),
    ("status", S), ("price_id", S), ("product_id", S), ("plan_amount", L),
    ("plan_interval", S), ("plan_interval_count", L), ("currency", S), ("quantity", L),
    ("created_at", TS), ("current_period_start", TS), ("current_period_end", TS),
    ("canceled_at", TS), ("cancel_at_period_end", B), ("ended_at", TS),
    ("trial_start", TS), ("trial_end", TS), ("extracted_at", TS),
], SUBSCRIPTIONS_REQUIRED)

INVOICES_REQUIRED = ("invoice_id", "customer_id", "extracted_at")
INVOICES = _schema([
    ("invoice_id", S), ("customer_id", S), ("subscription_id", S), ("status", S),
    ("amount_due", L), ("amount_paid", L), ("currency", S), ("period_start", TS),
    ("period_end", TS), ("created_at", TS), ("paid_at", TS), ("hosted_invoice_url", S),
    ("extracted_at", TS),
], INVOICES_REQUIRED)

SUBSCRIPTION_COLUMNS = tuple(SUBSCRIPTIONS.fieldNames())
INVOICE_COLUMNS = tuple(INVOICES.fieldNames())

REQUIRED = {"subscriptions": SUBSCRIPTIONS_REQUIRED, "invoices": INVOICES_REQUIRED}
TABLES = {"subscriptions": SUBSCRIPTIONS, "invoices": INVOICES}

# What a load leaves behind besides its two tables.
REJECTS = _schema([("load", S), ("position", L), ("customer_id", S), ("subscription_id", S), ("reason", S), ("record", S)], ("load", "reason"))
VIOLATIONS = _schema([("load", S), ("record_id", S), ("field", S), ("value", S)], ("load", "field", "value"))
SUMMARY = _schema([("table_name", S), ("rows_fetched", L), ("rows_loaded", L), ("rows_rejected", L)], ("table_name", "rows_fetched", "rows_loaded", "rows_rejected"))
REPORTS = {"load_rejects": REJECTS, "load_violations": VIOLATIONS, "load_summary": SUMMARY}



def time(name: str) -> T.StructField:
    return T.StructField(name, S, metadata={"kind": "time"})


RAW_RECURRING = T.StructType([
    T.StructField("interval", S), T.StructField("interval_count", L)])
RAW_PRICE = T.StructType([
    T.StructField("id", S), T.StructField("product", S), T.StructField("unit_amount", L),
    T.StructField("recurring", RAW_RECURRING)])
RAW_ITEM = T.StructType([T.StructField("quantity", L), T.StructField("price", RAW_PRICE)])

RAW_SUBSCRIPTION = T.StructType([
    T.StructField("id", S), T.StructField("status", S), T.StructField("currency", S),
    T.StructField("items", T.StructType([T.StructField("data", T.ArrayType(RAW_ITEM))])),
    time("created"), time("current_period_start"),
    time("current_period_end"), time("canceled_at"),
    T.StructField("cancel_at_period_end", B), time("ended_at"),
    time("trial_start"), time("trial_end"),
])

RAW_CUSTOMER = T.StructType([
    T.StructField("id", S), T.StructField("email", S), T.StructField("name", S)])

RAW_INVOICE = T.StructType([
    T.StructField("id", S), T.StructField("customer", S), T.StructField("subscription", S),
    T.StructField("status", S), T.StructField("amount_due", L), T.StructField("amount_paid", L),
    T.StructField("currency", S), time("period_start"), time("period_end"),
    time("created"),
    T.StructField("status_transitions", T.StructType([time("paid_at")])),
    T.StructField("hosted_invoice_url", S),
])

MANIFEST_ENTRY = T.StructType([
    T.StructField("customer_id", S), T.StructField("subscription_id", S),
    T.StructField("plan", S), T.StructField("amount", L), T.StructField("interval", S),
    T.StructField("clock_id", S), T.StructField("status", S)])

# A manifest as one document: a JSON object holding a ``customers`` array.
MANIFEST_DOCUMENT = T.StructType([
    T.StructField("num_customers", L),
    T.StructField("customers", T.ArrayType(MANIFEST_ENTRY))])

# A manifest at scale: one entry per JSON line, the position carried explicitly.
MANIFEST_LINES = T.StructType([T.StructField("position", L)] + list(MANIFEST_ENTRY.fields))

MONTHLY_SERIES = T.StructType([
    T.StructField("month", S), T.StructField("mrr_amount", D),
    T.StructField("active_subscriptions", L), T.StructField("active_customers", L)])
