"""Registered queries: name -> (Spark callable, oracle SQL).

Every callable takes ``(spark, sf_dir)``, reads the driver's tables under
``sf_dir`` (or data Spark derives from them: the billing tables, raw JSON
records and the manifest of ``sources.fixtures``) over their whole extent, and
returns a DataFrame whose column names equal those of the matching SQL.  Names
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import report
from ..operators.activity import PAIR_COLUMNS, active_sub_months
from ..operators.extract import REJECT_COLUMNS, cap_per_customer, flatten_invoices, flatten_subscription_records, malformed_records, records
from ..operators.interval_index import active_in, index_windows, read_index, write_index
from ..operators.spine import month_bounds, month_spine
from ..operators.windows import subscription_windows
from ..schemas import CORRUPT, INVOICE_COLUMNS, INVOICES, MANIFEST_ENTRY, RAW_CUSTOMER, RAW_INVOICE, RAW_SUBSCRIPTION, SUBSCRIPTIONS_REQUIRED
from ..session import ensure_utc
from ..sources import fixtures as fx
from ..sources import versions
from ..sources.documents import read_split_manifest
from ..sources.files import delete, scratch
from ..sources.raw import manifest_entries, parse_json
from ..sources.staging import stage_source
from ..sources.tables import export_json_array, required_violations
from . import oracle
from .etl import etl_full_refresh, extract
from .maintained_view import MaintainedView
from .mrr import monthly_mrr, revenue_windows
from .saved_view import mrr_view_sql

Query = Callable[[SparkSession, str], DataFrame]
CAP_TEST_LIMIT = 20  # most customers have more invoices (FIXTURES.md §3)
LANDED_LINES = 200_000  # of one landed file; compressed files are read as a whole
CHECKED_COLUMNS = (*SUBSCRIPTIONS_REQUIRED, "plan_amount", "ended_at")  # the last two do hold NULLs


def _subs(spark: SparkSession, sf_dir: str, with_customer: bool = False) -> DataFrame:
    ensure_utc(spark)
    return fx.subscriptions(spark, sf_dir, with_customer=with_customer)


def q_month_spine(spark, sf_dir):
    return month_spine(_subs(spark, sf_dir), fx.AS_OF)


def _q_windows(mode):
    def q(spark, sf_dir):
        return subscription_windows(_subs(spark, sf_dir), mode)
    return q


def q_active_sub_months(spark, sf_dir):
    subs = _subs(spark, sf_dir)
    return active_sub_months(revenue_windows(subs, "full"), month_bounds(subs, fx.AS_OF))


def q_active_in_months(spark, sf_dir):
    """The pairs of every December, from an index over all windows."""
    subs = _subs(spark, sf_dir)
    index, path = index_windows(revenue_windows(subs, "full"), month_bounds(subs, fx.AS_OF)), scratch(spark)
    write_index(index, path)
    return active_in(read_index(spark, path, index.schema), [12 * year + 11 for year in fx.ASKED_YEARS]).select("month_start", *PAIR_COLUMNS)


def q_mrr_maintained(spark, sf_dir):
    """A view built from the table as it was, refreshed to the table as it is."""
    subs, view = _subs(spark, sf_dir), MaintainedView(spark, scratch(spark))
    view.refresh(fx.earlier(subs))
    view.refresh(subs)
    return view.read(fx.AS_OF)


def _q_mrr(mode):
    def q(spark, sf_dir):
        return monthly_mrr(_subs(spark, sf_dir), mode, fx.AS_OF)
    return q


def _api_series(spark, sf_dir):
    return monthly_mrr(_subs(spark, sf_dir), "api", fx.AS_OF)


def _q_report(fn):
    def q(spark, sf_dir):
        return fn(_api_series(spark, sf_dir))
    return q


# --- extraction -------------------------------------------------------------

def _raw_subs(spark, sf_dir):
    ensure_utc(spark)
    return parse_json(fx.raw_subscription_lines(spark, sf_dir), RAW_SUBSCRIPTION)


def _raw_customers(spark, sf_dir):
    return parse_json(fx.raw_customer_lines(spark, sf_dir), RAW_CUSTOMER)


def _raw_invoices(spark, sf_dir):
    ensure_utc(spark)
    return parse_json(fx.raw_invoice_lines(spark, sf_dir), RAW_INVOICE)


def _extract(spark, sf_dir):
    return extract(fx.manifest(spark, sf_dir), _raw_subs(spark, sf_dir), _raw_customers(spark, sf_dir),
                   _raw_invoices(spark, sf_dir), fx.EXTRACTED_AT)


def _staged_extract(spark, sf_dir, counts_invoices: bool):
    """The same for what is counted and rejected: every source is parsed once and
    staged with the columns that are read again, its ids and its broken lines."""
    folder = scratch(spark)

    def staged(name, raw, schema, *columns):
        kept = stage_source(raw.select(*columns, CORRUPT), f"{folder}/{name}").rows
        return kept.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in columns])

    subs = staged("subscriptions", _raw_subs(spark, sf_dir), RAW_SUBSCRIPTION, "id")
    customers = staged("customers", _raw_customers(spark, sf_dir), RAW_CUSTOMER, "id")
    invoices = _raw_invoices(spark, sf_dir)  # without counts, read once, for its broken lines
    if counts_invoices:
        invoices = staged("invoices", invoices, RAW_INVOICE, "id", "customer")
    return extract(fx.manifest(spark, sf_dir), subs, customers, invoices, fx.EXTRACTED_AT, with_violations=False)


def q_flatten_subscriptions(spark, sf_dir):
    return flatten_subscription_records(_raw_subs(spark, sf_dir), fx.EXTRACTED_AT)


def q_flatten_invoices(spark, sf_dir):
    return flatten_invoices(_raw_invoices(spark, sf_dir), fx.EXTRACTED_AT)


def q_cap_per_customer(spark, sf_dir):
    capped = cap_per_customer(q_flatten_invoices(spark, sf_dir), CAP_TEST_LIMIT)
    return capped.select(*INVOICE_COLUMNS, F.col("list_rank").cast("bigint").alias("list_rank"))


def q_manifest_entries(spark, sf_dir):
    return records(manifest_entries(fx.manifest_documents(spark, sf_dir))).select("position", *MANIFEST_ENTRY.fieldNames())


def q_manifest_split(spark, sf_dir):
    """The manifest as one JSON document, written in parts and read by entry boundaries."""
    entries, path = fx.manifest(spark, sf_dir).orderBy("position").drop("position"), scratch(spark)
    export_json_array(entries, path, '{"customers":[', "]}")
    return records(read_split_manifest(spark, path, one=True)).select("position", *MANIFEST_ENTRY.fieldNames())


def q_manifest_rejects(spark, sf_dir):
    return malformed_records(manifest_entries(fx.manifest_documents(spark, sf_dir)), "manifest").select(*REJECT_COLUMNS)


def land(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The landing zone: compressed JSON lines, in files of a size that one task reads."""
    for name, lines in (("subscriptions", fx.raw_subscription_lines), ("customers", fx.raw_customer_lines), ("invoices", fx.raw_invoice_lines)):
        lines(spark, sf_dir).write.option("maxRecordsPerFile", LANDED_LINES).text(f"{folder}/{name}", compression="gzip")
    fx.manifest(spark, sf_dir).write.option("maxRecordsPerFile", LANDED_LINES).json(f"{folder}/manifest", compression="gzip")


def q_full_refresh_load(spark, sf_dir):
    """A whole load (Q5) into a scratch database, and what is read back from it.
    Nothing of it stays on disk after the answer."""
    ensure_utc(spark)
    folder, db = scratch(spark), f"scratch_{uuid.uuid4().hex}"
    land(spark, sf_dir, f"{folder}/landing")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{folder}/warehouse'")
    try:
        etl_full_refresh(spark, f"{folder}/landing", db, fx.EXTRACTED_AT, export_dir=f"{folder}/export", export_compression="gzip")
        found = []
        for table, key, amount in (("subscriptions", "subscription_id", "plan_amount"), ("invoices", "invoice_id", "amount_due"),
                                   ("load_rejects", "record", "position"), ("load_violations", "record_id", "NULL"), ("load_summary", "table_name", "rows_loaded")):
            number = versions.latest(spark, f"{db}.{table}").number
            found.append(spark.table(f"{db}.{table}").selectExpr(f"'{table}' AS table_name", f"{number}L AS version", key, f"CAST({amount} AS BIGINT) AS amount"))
        found.append(spark.read.schema(INVOICES).json(f"{folder}/export/invoices").selectExpr("'export' AS table_name", "0L AS version", "invoice_id", "amount_due"))
        counts = [F.count(F.lit(1)).alias("row_count"), F.count_distinct(F.col("key")).alias("id_count"), F.sum("amount").alias("total")]
        rows = [df.toDF("table_name", "version", "key", "amount").groupBy("table_name", "version").agg(*counts).collect() for df in found]  # a row per table
        return spark.createDataFrame([r for some in rows for r in some], "table_name string, version bigint, row_count bigint, id_count bigint, total bigint")
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")
        delete(spark, folder)


def q_required_violations(spark, sf_dir):
    return required_violations(_subs(spark, sf_dir), CHECKED_COLUMNS)


def q_saved_view(spark, sf_dir):
    return spark.sql(mrr_view_sql("{subscriptions}", fx.AS_OF), subscriptions=_subs(spark, sf_dir))


def _wall_clock(q: Query) -> Query:
    """Present UTC instants as UTC wall-clock ``TIMESTAMP_NTZ``: the type of the
    oracle's ``TIMESTAMP`` (and of a tz-naive value in Arrow and Python), so
    results compare independently of any reader's local zone.  The session is
    UTC, so the cast keeps every value."""
    def wrapped(spark, sf_dir):
        df = q(spark, sf_dir)
        return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                           if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
                           for f in df.schema.fields])
    return wrapped


def registry() -> dict[str, tuple[Query, str | None]]:
    return {k: (_wall_clock(q), sql) for k, (q, sql) in _registry().items()}


def _registry() -> dict[str, tuple[Query, str | None]]:
    return {
        # MRR (Q1-Q3) and their building blocks
        "month_spine": (q_month_spine, oracle.month_spine_sql()),
        "subscription_windows_full": (_q_windows("full"), oracle.subscription_windows_sql("full")),
        "subscription_windows_view": (_q_windows("view"), oracle.subscription_windows_sql("view")),
        "subscription_windows_api": (_q_windows("api"), oracle.subscription_windows_sql("api")),
        "active_sub_months": (q_active_sub_months, oracle.active_sub_months_sql()),
        "active_in_months": (q_active_in_months, oracle.active_in_months_sql()),
        "monthly_mrr_full": (_q_mrr("full"), oracle.monthly_mrr_sql("full")),
        "monthly_mrr_view": (_q_mrr("view"), oracle.monthly_mrr_sql("view")),
        "monthly_mrr_api": (_q_mrr("api"), oracle.monthly_mrr_sql("api")),
        "monthly_mrr_saved_view": (q_saved_view, oracle.monthly_mrr_sql("view")),
        "monthly_mrr_maintained": (q_mrr_maintained, oracle.monthly_mrr_sql("view")),
        # dashboard (Q4) and API payload
        "kpi_cards": (_q_report(report.kpi_cards), oracle.kpi_cards_sql()),
        "series_span": (_q_report(report.series_span), oracle.series_span_sql()),
        "monthly_breakdown": (_q_report(report.monthly_breakdown), oracle.monthly_breakdown_sql()),
        "mrr_trend": (_q_report(report.mrr_trend), oracle.mrr_trend_sql()),
        "report_text": (_q_report(report.report_text), oracle.report_text_sql()),
        "mrr_payload": (_q_report(report.mrr_payload), oracle.mrr_payload_sql()),
        # extraction (Q5 without the writes)
        "flatten_subscriptions": (q_flatten_subscriptions, oracle.flatten_subscriptions_sql()),
        "flatten_invoices": (q_flatten_invoices, oracle.flatten_invoices_sql()),
        "extract_subscriptions": (lambda s, d: _extract(s, d).subscriptions, oracle.extract_subscriptions_sql()),
        "extract_errors": (lambda s, d: _staged_extract(s, d, False).rejects, oracle.extract_errors_sql()),
        "field_violations": (lambda s, d: _extract(s, d).violations, oracle.field_violations_sql()),
        "cap_per_customer": (q_cap_per_customer, oracle.cap_per_customer_sql(CAP_TEST_LIMIT)),
        "dedup_invoices": (lambda s, d: _extract(s, d).invoices, oracle.dedup_invoices_sql()),
        "invoices_per_customer": (lambda s, d: _extract(s, d).per_customer(), oracle.invoices_per_customer_sql()),
        "manifest_entries": (q_manifest_entries, oracle.manifest_entries_sql()),
        "manifest_split": (q_manifest_split, oracle.manifest_split_sql()),
        "manifest_rejects": (q_manifest_rejects, oracle.manifest_rejects_sql()),
        "required_violations": (q_required_violations, oracle.required_violations_sql(CHECKED_COLUMNS)),
        "full_refresh_load": (q_full_refresh_load, oracle.full_refresh_load_sql()),
        "load_summary": (lambda s, d: _staged_extract(s, d, True).summary(), oracle.load_summary_sql()),
    }


def queries() -> dict[str, Query]:
    return {k: v[0] for k, v in registry().items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in registry().items() if v[1] is not None}
