"""Test inputs derived by fixed rules from the driver's TPC-H-like tables.

The engine's inputs are two billing tables, a manifest and raw nested records,
with the flaws of a real landing zone: copies of records, broken lines, fields
of another type, repeated manifest entries, unknown ids, damaged manifest
documents, invoices that two customers share.
Each is derived here from ``orders``, ``customer`` and
``lineitem`` (FIXTURES.md), twice: as Spark DataFrames (what the engine runs)
and as DuckDB SQL (what the oracle runs).  Every derivation is a projection or
a key join of the given tables, so its size grows with them.

``k`` below is ``o_orderkey``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.extract import stamp
from ..schemas import SUBSCRIPTION_COLUMNS

# Fixed values of the derivation rules (FIXTURES.md).
AS_OF = "2002-03-01"
EXTRACTED_AT = "2002-03-01 00:00:00"
ASKED_YEARS = (1995, 1996, 1998, 2001)  # whose Decembers are asked for
PLAN_AMOUNTS = (2900, 7900, 19900, 49900, 79000, 199000, 21000, 1550, 333)  # by k % 10 = 0..8
ALT_AMOUNT = 5000  # k % 10 = 9 and k % 4 != 1
MISSING_SUB_EVERY = 1000  # extra manifest entry sub_missing_k when k % 1000 = 0
MISSING_CUSTOMER_AT = 500  # extra manifest entry with cus_missing_k when k % 1000 = 500
REPEATED_EVERY = 250  # the entry once more when k % 250 = 1
COPY_EVERY = 97  # a second subscription record when k % 97 = 0, ...
COPY_WINS_EVERY = 194  # ... which sorts after the first when k % 194 = 0
CUSTOMER_COPY_EVERY = 89  # a second, nameless customer record when c_custkey % 89 = 0
BROKEN_EVERY, BROKEN_AT = 777, 5  # an extra line that breaks off
SHARED_EVERY, SHARED_AT = 333, 7  # line 1 of the order is invoiced to the next customer as well
TEXT_AMOUNT_EVERY, TEXT_AMOUNT_AT = 101, 9  # line 1: amount_due is the integer as text, ...
DECIMAL_AMOUNT_EVERY, DECIMAL_AMOUNT_AT = 103, 11  # ... has a decimal point, ...
UNREADABLE_AMOUNT_EVERY, UNREADABLE_AMOUNT_AT = 107, 13  # ... or a currency behind it
UNREADABLE_QUANTITY_EVERY, UNREADABLE_QUANTITY_AT = 109, 15  # a subscription's quantity (where it has one) is "many"
UNREADABLE_CREATED_EVERY, UNREADABLE_CREATED_AT = 113, 17  # its creation time is "soon"
UNREADABLE_NAME_EVERY, UNREADABLE_NAME_AT = 53, 9  # a customer's name is an object
DOCUMENT_KEYS = 100  # order keys of one manifest document
DAMAGED_DOCUMENT_EVERY, DAMAGED_DOCUMENT_AT = 5, 3  # a copy of the document that breaks off, ...
LOST_ENTRY_EVERY, LOST_ENTRY_AT = 4, 1  # ... and an entry at its end that is no object
CLOCKS = 25
URL_PREFIX = "https://example.com/"

# The demo series whose figures are known (tests only).
GOLDEN_SERIES = [
    ("2025-09", 4280.0, 52, 48), ("2025-10", 5120.0, 58, 53), ("2025-11", 5890.0, 62, 56),
    ("2025-12", 6430.0, 65, 59), ("2026-01", 7150.0, 70, 63), ("2026-02", 7680.0, 73, 66),
]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows out by key before the heavy per-row work below (JSON building).

    A Parquet row group is the unit of a scan split, and the given files hold
    few of them.  The same plan at every size; the inputs derived here stand in
    for stored tables, which need no such step."""
    return df.repartition(*keys)


def _days(n) -> F.Column:
    return F.make_dt_interval(days=n.cast("int"))


def _sid(prefix: str, key) -> F.Column:
    return F.concat(F.lit(prefix), key.cast("string"))


def subscriptions(spark: SparkSession, sf_dir: str, with_customer: bool = True) -> DataFrame:
    """The ``subscriptions`` table (21 columns) derived from ``orders``.

    ``with_customer=False`` leaves the two customer text columns NULL and skips
    the customer join; the MRR queries never read them.
    """
    return _subscription_rows(spark, sf_dir, with_customer).select(*SUBSCRIPTION_COLUMNS)


def earlier(subs: DataFrame) -> DataFrame:
    """The table as it was before its last load: a seventh of the rows was not
    there, a fifth had another price, a third another end, some were there that are gone."""
    k = F.substring("subscription_id", 5, 20).cast("bigint")
    old = subs.where(k % 7 != 3).withColumn("plan_amount", F.when(k % 5 == 1, F.col("plan_amount") + 100).otherwise(F.col("plan_amount")))
    old = old.withColumn("ended_at", F.when(k % 3 == 2, F.col("created_at") + F.make_dt_interval(days=F.lit(200))).otherwise(F.col("ended_at")))
    gone = subs.where(k % 11 == 4).withColumns({"subscription_id": F.concat("subscription_id", F.lit("_gone")), "created_at": F.col("created_at") - F.make_dt_interval(days=F.lit(900))})
    return old.unionByName(gone)


def _subscription_rows(spark: SparkSession, sf_dir: str, with_customer: bool = True) -> DataFrame:
    """``subscriptions`` plus the order key ``k`` and ``o_custkey``."""
    o = spread(_read(spark, sf_dir, "orders"), "o_orderkey")
    k = F.col("o_orderkey")
    m10 = k % 10
    status = (F.when((F.col("o_orderpriority") == "5-LOW") & (k % 3 == 0), "trialing")
               .when((F.col("o_orderpriority") == "1-URGENT") & (k % 5 == 0), "incomplete")
               .when(F.col("o_orderstatus") == "F", "canceled")
               .when(F.col("o_orderstatus") == "P", "past_due")
               .otherwise("active"))
    plan_amounts = F.array(*[F.lit(a) for a in PLAN_AMOUNTS])
    amount = (F.when(m10 < len(PLAN_AMOUNTS), F.try_element_at(plan_amounts, (m10 + 1).cast("int")))
               .when(k % 4 == 1, F.lit(None))
               .otherwise(F.lit(ALT_AMOUNT))).cast("bigint")
    interval = (F.when(m10.isin(4, 5), "year").when(m10 == 7, "week").when(m10 == 8, "day")
                 .when(m10 == 9, F.when(k % 4 == 1, F.lit(None).cast("string")).otherwise("quarter"))
                 .otherwise("month"))
    icount = (F.when(m10 == 6, 3).when(m10 == 7, 2).when(m10 == 9, F.lit(None))
               .when(k % 50 == 1, F.lit(None)).otherwise(1)).cast("bigint")
    created = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(secs=((k * 37) % 86400).cast("int"))
    base = o.select(
        k.alias("k"), F.col("o_custkey"),
        _sid("sub_", k).alias("subscription_id"),
        _sid("cus_", F.col("o_custkey")).alias("customer_id"),
        status.alias("status"),
        _sid("price_", m10).alias("price_id"),
        _sid("prod_", m10).alias("product_id"),
        amount.alias("plan_amount"), interval.alias("plan_interval"),
        icount.alias("plan_interval_count"), F.lit("usd").alias("currency"),
        (k % 3 + 1).cast("bigint").alias("quantity"),
        created.alias("created_at"))
    canceled = F.col("status") == "canceled"
    period_end = F.col("created_at") + _days((F.col("k") * 13) % 900 + 20)
    canceled_at = F.when(canceled, F.col("created_at") + _days((F.col("k") * 13) % 900))
    trialing = F.col("status") == "trialing"
    out = base.select(F.inline(F.array(F.struct(
        "k", "o_custkey", "subscription_id", "customer_id", "status", "price_id", "product_id",
        "plan_amount", "plan_interval", "plan_interval_count", "currency", "quantity", "created_at",
        (period_end - _days(F.lit(30))).alias("current_period_start"),
        period_end.alias("current_period_end"),
        canceled_at.alias("canceled_at"),
        (F.col("k") % 7 == 0).alias("cancel_at_period_end"),
        F.when(canceled & (F.col("k") % 2 == 0), canceled_at + _days(F.col("k") % 31)).alias("ended_at"),
        F.when(trialing, F.col("created_at")).alias("trial_start"),
        F.when(trialing, F.col("created_at") + _days(F.lit(14))).alias("trial_end"),
        stamp(EXTRACTED_AT).alias("extracted_at")))))
    # The rows are derived once, inside a generator: the fixture stands in for
    # a stored table, and predicates pushed down later must not re-derive the
    # columns (through a plain projection each filter would inline them).
    if with_customer:
        c = _read(spark, sf_dir, "customer").select("c_custkey", "c_name")
        out = out.join(c, out.o_custkey == c.c_custkey, "left")
        name = F.col("c_name")
    else:
        name = F.lit(None).cast("string")
    email = F.concat(F.lower(F.replace(name, F.lit("#"), F.lit("."))), F.lit("@example.com"))
    return out.select(
        "k", "o_custkey",
        "subscription_id", "customer_id", email.alias("customer_email"), name.alias("customer_name"),
        "status", "price_id", "product_id", "plan_amount", "plan_interval", "plan_interval_count",
        "currency", "quantity", "created_at", "current_period_start", "current_period_end",
        "canceled_at", "cancel_at_period_end", "ended_at", "trial_start", "trial_end", "extracted_at")


def invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices (13 columns) from ``lineitem`` joined to ``orders``, before dedup,
    plus ``l_orderkey``, ``l_linenumber``, ``l_partkey`` and ``o_custkey``."""
    li = spread(_read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        "l_returnflag", "l_shipdate"), "l_orderkey", "l_linenumber")
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    inv_id = F.concat(F.lit("in_"), F.col("l_orderkey").cast("string"), F.lit("_"),
                      F.col("l_linenumber").cast("string"))
    status = (F.when(F.col("l_returnflag") == "A", "paid").when(F.col("l_returnflag") == "N", "open")
               .when(F.col("l_returnflag") == "R", "uncollectible"))
    due = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    created = F.col("l_shipdate").cast("timestamp")
    return j.select(
        inv_id.alias("invoice_id"),
        _sid("cus_", F.col("o_custkey")).alias("customer_id"),
        _sid("sub_", F.col("o_orderkey")).alias("subscription_id"),
        status.alias("status"),
        due.alias("amount_due"),
        F.when(status == "paid", due).otherwise(F.lit(0).cast("bigint")).alias("amount_paid"),
        F.lit("usd").alias("currency"),
        created.alias("period_start"),
        (created + _days(F.lit(30))).alias("period_end"),
        created.alias("created_at"),
        F.when(status == "paid", created + _days(F.lit(3))).alias("paid_at"),
        F.concat(F.lit(URL_PREFIX), inv_id).alias("hosted_invoice_url"),
        stamp(EXTRACTED_AT).alias("extracted_at"),
        "l_orderkey", "l_linenumber", "l_partkey", "o_custkey")


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest entries, one per order at position ``2k``, and at position
    ``2k + 1`` entries that must fail, ``sub_missing_k`` (k % 1000 = 0) and
    ``cus_missing_k`` (k % 1000 = 500), or that repeat the first (k % 250 = 1)."""
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    k = F.col("o_orderkey")
    cust = _sid("cus_", F.col("o_custkey"))
    extra_sub = F.when(k % MISSING_SUB_EVERY == 0, _sid("sub_missing_", k)).otherwise(_sid("sub_", k))
    extra_cust = F.when(k % MISSING_SUB_EVERY == MISSING_CUSTOMER_AT, _sid("cus_missing_", k)).otherwise(cust)
    entries = F.array(
        F.struct((k * 2).alias("position"), cust.alias("customer_id"), _sid("sub_", k).alias("subscription_id")),
        F.struct((k * 2 + 1).alias("position"), extra_cust.alias("customer_id"),
                 extra_sub.alias("subscription_id")))
    keep = F.col("position") % 2 == 0
    keep = keep | (F.col("k") % MISSING_SUB_EVERY).isin(0, MISSING_CUSTOMER_AT) | (F.col("k") % REPEATED_EVERY == 1)
    rows = o.select(k.alias("k"), F.col("o_custkey"), F.inline(entries)).filter(keep)
    return rows.select(
        "position", "customer_id", "subscription_id",
        _sid("plan_", F.col("k") % 10).alias("plan"),
        F.try_element_at(F.array(*[F.lit(a).cast("bigint") for a in PLAN_AMOUNTS]),
                         (F.col("k") % 10 + 1).cast("int")).alias("amount"),
        F.lit("month").alias("interval"),
        _sid("clock_", F.col("o_custkey") % CLOCKS).alias("clock_id"),
        F.lit("active").alias("status"))


# Raw time fields are written as epoch seconds for even keys and as ISO-8601
# text for odd keys, so both forms of P2 are exercised at scale.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"


def _raw_json(fields, time_fields, epoch: F.Column) -> F.Column:
    """JSON text of one raw object.  ``time_fields`` (name -> timestamp column, or
    name -> dict for a nested object) are written as epoch-second numbers where
    ``epoch`` holds, as ISO-8601 text otherwise; only the chosen branch runs."""
    def times(as_epoch: bool):
        out = []
        for name, ts in time_fields.items():
            if isinstance(ts, dict):
                out.append(F.struct(*[(F.unix_seconds(t) if as_epoch else F.date_format(t, ISO_FORMAT)).alias(n)
                                      for n, t in ts.items()]).alias(name))
            else:
                out.append((F.unix_seconds(ts) if as_epoch else F.date_format(ts, ISO_FORMAT)).alias(name))
        return out
    return F.when(epoch, F.to_json(F.struct(*fields, *times(True)))) \
            .otherwise(F.to_json(F.struct(*fields, *times(False))))


def _changed(text: F.Column, where, pattern: str, by: str) -> F.Column:
    """The text of a record with one value of another type, where the condition holds."""
    return F.when(where, F.regexp_replace(text, pattern, by)).otherwise(text)


def _broken(prefix: str, key, where) -> F.Column:
    """A line that breaks off, where the condition holds."""
    return F.when(where, F.concat(F.lit('{"id": "' + prefix), key.cast("string"), F.lit('", "status": ')))


def _lines(df: DataFrame, *values) -> DataFrame:
    """One row of JSON text per value that is not NULL."""
    return df.select(F.explode(F.array_compact(F.array(*values))).alias("value"))


def raw_subscription_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw subscription objects as JSON text (column ``value``).

    ``items.data`` is empty when the plan amount is NULL; ``recurring`` is
    an empty object for k % 10 = 9; ``quantity`` and ``interval_count`` are
    absent when they are 1 / NULL.  Some orders give a second record in another
    currency, some an extra broken line."""
    r = _subscription_rows(spark, sf_dir, with_customer=False)
    k = F.col("k")
    present = k % 10 != 9
    recurring = F.struct(F.when(present, F.col("plan_interval")).alias("interval"),
                         F.when(present, F.col("plan_interval_count")).alias("interval_count"))
    item = F.struct(F.when(F.col("quantity") != 1, F.col("quantity")).alias("quantity"),
                    F.struct(F.col("price_id").alias("id"), F.col("product_id").alias("product"),
                             F.col("plan_amount").alias("unit_amount"), recurring.alias("recurring")).alias("price"))
    items = F.struct(F.filter(F.array(item), lambda _: F.col("plan_amount").isNotNull()).alias("data"))
    times = {"created": F.col("created_at")} | {
        n: F.col(n) for n in ("current_period_start", "current_period_end", "canceled_at", "ended_at",
                              "trial_start", "trial_end")}

    def record(currency):
        fields = [F.col("subscription_id").alias("id"), "status", currency.alias("currency"), items.alias("items"), "cancel_at_period_end"]
        text = _raw_json(fields, times, k % 2 == 0)
        text = _changed(text, k % UNREADABLE_QUANTITY_EVERY == UNREADABLE_QUANTITY_AT, '"quantity":[0-9]+', '"quantity":"many"')
        return _changed(text, k % UNREADABLE_CREATED_EVERY == UNREADABLE_CREATED_AT, '"created":("[^"]*"|[0-9]+)', '"created":"soon"')

    other = F.when(k % COPY_WINS_EVERY == 0, F.lit("xts")).otherwise(F.lit("eur"))
    return _lines(r, record(F.col("currency")), F.when(k % COPY_EVERY == 0, record(other)), _broken("sub_", k, k % BROKEN_EVERY == BROKEN_AT))


def raw_customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw customer objects as JSON text (column ``value``), some twice, some broken."""
    c = _read(spark, sf_dir, "customer")
    k, name = F.col("c_custkey"), F.col("c_name")
    email = F.concat(F.lower(F.replace(name, F.lit("#"), F.lit("."))), F.lit("@example.com"))

    def record(shown):
        text = F.to_json(F.struct(_sid("cus_", k).alias("id"), email.alias("email"), shown.alias("name")))
        return _changed(text, k % UNREADABLE_NAME_EVERY == UNREADABLE_NAME_AT, '"name":("[^"]*")', '"name":{"full":$1}')

    return _lines(c, record(name), F.when(k % CUSTOMER_COPY_EVERY == 0, record(F.lit(None).cast("string"))),
                  _broken("cus_", k, k % BROKEN_EVERY == BROKEN_AT))


def raw_invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw invoice objects as JSON text (column ``value``), duplicates included;
    some are invoiced to two customers, some orders add a broken line."""
    li = invoice_lines(spark, sf_dir)
    k, first = F.col("l_orderkey"), F.col("l_linenumber") == 1
    times = {"period_start": F.col("period_start"), "period_end": F.col("period_end"),
             "created": F.col("created_at"), "status_transitions": {"paid_at": F.col("paid_at")}}

    def record(customer):
        fields = [F.col("invoice_id").alias("id"), customer.alias("customer"), F.col("subscription_id").alias("subscription"),
                  "status", "amount_due", "amount_paid", "currency", "hosted_invoice_url"]
        text = _raw_json(fields, times, F.col("l_partkey") % 2 == 0)
        amount = '"amount_due":([0-9]+)'
        text = _changed(text, first & (k % TEXT_AMOUNT_EVERY == TEXT_AMOUNT_AT), amount, '"amount_due":"$1"')
        text = _changed(text, first & (k % DECIMAL_AMOUNT_EVERY == DECIMAL_AMOUNT_AT), amount, '"amount_due":$1.0')
        return _changed(text, first & (k % UNREADABLE_AMOUNT_EVERY == UNREADABLE_AMOUNT_AT), '"amount_due":"?([0-9]+)(.0)?"?', '"amount_due":"$1 USD"')

    return _lines(li, record(F.col("customer_id")),
                  F.when(first & (k % SHARED_EVERY == SHARED_AT), record(_sid("cus_", F.col("o_custkey") + 1))),
                  _broken("in_", k, first & (k % BROKEN_EVERY == BROKEN_AT)))


def manifest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest as documents of at most 100 order keys each: ``document``
    (their order) and ``value`` (JSON text with a ``customers`` array).  Some end
    with an entry that is no object, some are there once more and break off."""
    m = manifest(spark, sf_dir)
    entry = F.struct("customer_id", "subscription_id", "plan", "amount", "interval", "clock_id", "status")
    grouped = (m.withColumn("document", F.expr(f"position div {2 * DOCUMENT_KEYS}"))
                .groupBy("document").agg(F.array_sort(F.collect_list(F.struct("position", entry.alias("entry")))).alias("es")))
    body = F.struct(F.size("es").cast("bigint").alias("num_customers"), F.transform("es", lambda e: e["entry"]).alias("customers"))
    text = _changed(F.to_json(body), F.col("document") % LOST_ENTRY_EVERY == LOST_ENTRY_AT, r"\]\}$", ',"lost"]}')
    damaged = F.concat(F.lit('{"num_customers":'), F.size("es").cast("string"), F.lit(',"customers":[{"customer_id":'))
    both = F.array(F.struct("document", text.alias("value")),
                   F.when(F.col("document") % DAMAGED_DOCUMENT_EVERY == DAMAGED_DOCUMENT_AT, F.struct((-1 - F.col("document")).alias("document"), damaged.alias("value"))))
    return grouped.select(F.inline(F.array_compact(both)))


def golden_series(spark: SparkSession) -> DataFrame:
    """The six-row demo series whose KPIs the preview page shows (tests only)."""
    return spark.createDataFrame(
        GOLDEN_SERIES, "month string, mrr_amount double, active_subscriptions long, active_customers long")


# --------------------------------------------------------------------------
# The same derivations in DuckDB SQL, as CTE text for the oracle queries.
# --------------------------------------------------------------------------

_AMOUNT_CASES = "\n".join(f"            WHEN o_orderkey % 10 = {i} THEN {a}" for i, a in enumerate(PLAN_AMOUNTS))

SQL_SUBSCRIPTIONS = f"""
sub_base AS (
    SELECT o_orderkey AS k, o_custkey, o_orderpriority, o_orderstatus,
           CAST(o_orderdate AS TIMESTAMP) + ((o_orderkey * 37) % 86400) * INTERVAL '1' SECOND AS created_at,
           CASE WHEN o_orderpriority = '5-LOW' AND o_orderkey % 3 = 0 THEN 'trialing'
                WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 5 = 0 THEN 'incomplete'
                WHEN o_orderstatus = 'F' THEN 'canceled'
                WHEN o_orderstatus = 'P' THEN 'past_due'
                ELSE 'active' END AS status,
           CAST(CASE
{_AMOUNT_CASES}
            WHEN o_orderkey % 4 = 1 THEN NULL
            ELSE {ALT_AMOUNT} END AS BIGINT) AS plan_amount,
           CASE WHEN o_orderkey % 10 IN (4, 5) THEN 'year'
                WHEN o_orderkey % 10 = 7 THEN 'week'
                WHEN o_orderkey % 10 = 8 THEN 'day'
                WHEN o_orderkey % 10 = 9 THEN CASE WHEN o_orderkey % 4 = 1 THEN NULL ELSE 'quarter' END
                ELSE 'month' END AS plan_interval,
           CAST(CASE WHEN o_orderkey % 10 = 6 THEN 3
                     WHEN o_orderkey % 10 = 7 THEN 2
                     WHEN o_orderkey % 10 = 9 THEN NULL
                     WHEN o_orderkey % 50 = 1 THEN NULL
                     ELSE 1 END AS BIGINT) AS plan_interval_count
    FROM orders
),
sub_dates AS (
    SELECT *,
           created_at + ((k * 13) % 900 + 20) * INTERVAL '1' DAY AS current_period_end,
           CASE WHEN status = 'canceled' THEN created_at + ((k * 13) % 900) * INTERVAL '1' DAY END AS canceled_at
    FROM sub_base
),
subscriptions AS (
    SELECT 'sub_' || CAST(k AS VARCHAR) AS subscription_id,
           'cus_' || CAST(o_custkey AS VARCHAR) AS customer_id,
           lower(replace(c.c_name, '#', '.')) || '@example.com' AS customer_email,
           c.c_name AS customer_name,
           status,
           'price_' || CAST(k % 10 AS VARCHAR) AS price_id,
           'prod_' || CAST(k % 10 AS VARCHAR) AS product_id,
           plan_amount, plan_interval, plan_interval_count,
           'usd' AS currency,
           CAST(k % 3 + 1 AS BIGINT) AS quantity,
           created_at,
           current_period_end - INTERVAL '30' DAY AS current_period_start,
           current_period_end,
           canceled_at,
           k % 7 = 0 AS cancel_at_period_end,
           CASE WHEN status = 'canceled' AND k % 2 = 0 THEN canceled_at + (k % 31) * INTERVAL '1' DAY END AS ended_at,
           CASE WHEN status = 'trialing' THEN created_at END AS trial_start,
           CASE WHEN status = 'trialing' THEN created_at + INTERVAL '14' DAY END AS trial_end,
           TIMESTAMP '{EXTRACTED_AT}' AS extracted_at,
           k, o_custkey
    FROM sub_dates LEFT JOIN customer c ON c.c_custkey = sub_dates.o_custkey
)"""

SQL_MANIFEST = f"""
manifest AS (
    SELECT 2 * o_orderkey AS position, 'cus_' || CAST(o_custkey AS VARCHAR) AS customer_id,
           'sub_' || CAST(o_orderkey AS VARCHAR) AS subscription_id, o_orderkey AS k, o_custkey
    FROM orders
    UNION ALL
    SELECT 2 * o_orderkey + 1,
           CASE WHEN o_orderkey % {MISSING_SUB_EVERY} = {MISSING_CUSTOMER_AT} THEN 'cus_missing_' || CAST(o_orderkey AS VARCHAR)
                ELSE 'cus_' || CAST(o_custkey AS VARCHAR) END,
           CASE WHEN o_orderkey % {MISSING_SUB_EVERY} = 0 THEN 'sub_missing_' || CAST(o_orderkey AS VARCHAR)
                ELSE 'sub_' || CAST(o_orderkey AS VARCHAR) END, o_orderkey, o_custkey
    FROM orders
    WHERE o_orderkey % {MISSING_SUB_EVERY} IN (0, {MISSING_CUSTOMER_AT}) OR o_orderkey % {REPEATED_EVERY} = 1
)"""

SQL_INVOICE_LINES = f"""
one_invoice AS (
    SELECT 'in_' || CAST(l.l_orderkey AS VARCHAR) || '_' || CAST(l.l_linenumber AS VARCHAR) AS invoice_id,
           'cus_' || CAST(o.o_custkey AS VARCHAR) AS customer_id,
           'sub_' || CAST(o.o_orderkey AS VARCHAR) AS subscription_id,
           CASE l.l_returnflag WHEN 'A' THEN 'paid' WHEN 'N' THEN 'open' WHEN 'R' THEN 'uncollectible' END AS status,
           CASE WHEN NOT (l.l_linenumber = 1 AND l.l_orderkey % {UNREADABLE_AMOUNT_EVERY} = {UNREADABLE_AMOUNT_AT})
                THEN CAST(round(l.l_extendedprice * 100) AS BIGINT) END AS amount_due,
           CASE WHEN l.l_returnflag = 'A' THEN CAST(round(l.l_extendedprice * 100) AS BIGINT) ELSE CAST(0 AS BIGINT) END AS amount_paid,
           'usd' AS currency,
           CAST(l.l_shipdate AS TIMESTAMP) AS period_start,
           CAST(l.l_shipdate AS TIMESTAMP) + INTERVAL '30' DAY AS period_end,
           CAST(l.l_shipdate AS TIMESTAMP) AS created_at,
           CASE WHEN l.l_returnflag = 'A' THEN CAST(l.l_shipdate AS TIMESTAMP) + INTERVAL '3' DAY END AS paid_at,
           '{URL_PREFIX}in_' || CAST(l.l_orderkey AS VARCHAR) || '_' || CAST(l.l_linenumber AS VARCHAR) AS hosted_invoice_url,
           TIMESTAMP '{EXTRACTED_AT}' AS extracted_at,
           l.l_orderkey, l.l_linenumber, o.o_custkey, l.l_extendedprice
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
invoice_lines AS (
    SELECT * FROM one_invoice
    UNION ALL
    SELECT * REPLACE ('cus_' || CAST(o_custkey + 1 AS VARCHAR) AS customer_id) FROM one_invoice
    WHERE l_linenumber = 1 AND l_orderkey % {SHARED_EVERY} = {SHARED_AT}
)"""
