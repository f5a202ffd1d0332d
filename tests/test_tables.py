"""Load rules (S5-S9) and the extract-and-load pipeline (Q5), in scratch folders."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from revspine.operators.extract import extract_subscriptions, flatten_subscription_records
from revspine.operators.report import dashboard
from revspine.plans.etl import etl_full_refresh
from revspine.schemas import RAW_CUSTOMER, RAW_SUBSCRIPTION
from revspine.sources import fixtures as fx
from revspine.sources.raw import parse_json, read_manifest, read_raw_subscriptions
from revspine.sources.tables import SchemaViolation, create_mrr_view, ensure_tables, export_json, full_refresh, stage
from conftest import make_subs

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture()
def db(spark):
    d = tempfile.mkdtemp(prefix="revspine-wh-")
    name = "wh_" + os.path.basename(d).replace("-", "_")
    ensure_tables(spark, name, location=d)
    return name


def test_overwrite_replaces_and_empty_keeps(spark, db):
    two = make_subs(spark, [dict(created_at="2024-01-02"), dict(created_at="2024-02-02")])
    three = make_subs(spark, [dict(created_at="2024-01-02")] * 3)
    assert full_refresh(two, "subscriptions", db) == 2
    assert full_refresh(three, "subscriptions", db) == 3
    assert spark.table(f"{db}.subscriptions").count() == 3
    assert full_refresh(three.limit(0), "subscriptions", db) == 0
    assert spark.table(f"{db}.subscriptions").count() == 3


def test_null_in_required_fails_before_write(spark, db):
    ok = make_subs(spark, [dict(created_at="2024-01-02")])
    full_refresh(ok, "subscriptions", db)
    bad = make_subs(spark, [dict(created_at="2024-01-02", customer_id=None)] * 2)
    with pytest.raises(SchemaViolation, match="customer_id"):
        full_refresh(bad, "subscriptions", db)
    assert spark.table(f"{db}.subscriptions").count() == 1


def _folders(db, spark):
    root = spark.sql(f"DESCRIBE DATABASE {db}").filter("info_name = 'Location'").first()["info_value"].removeprefix("file:")
    return sorted(os.listdir(root)), root


def test_required_columns_are_marked_in_the_catalog(spark, db):
    def marked():
        return {c.name for c in spark.catalog.listColumns(f"{db}.subscriptions") if c.description == "REQUIRED"}

    assert marked() == {"subscription_id", "customer_id", "extracted_at"}
    full_refresh(make_subs(spark, [dict(created_at="2024-01-02")]), "subscriptions", db)
    assert marked() == {"subscription_id", "customer_id", "extracted_at"}  # a load keeps the declared schema


def test_loads_keep_the_folder_before_and_no_more(spark, db):
    for n in (1, 2, 4, 3):
        full_refresh(make_subs(spark, [dict(created_at="2024-01-02")] * n), "subscriptions", db)
    names, _ = _folders(db, spark)
    assert len([f for f in names if f.startswith("subscriptions")]) == 2
    assert spark.table(f"{db}.subscriptions").count() == 3


def test_failing_write_leaves_the_old_table(spark, db):
    full_refresh(make_subs(spark, [dict(created_at="2024-01-02")]), "subscriptions", db)
    before = _folders(db, spark)[0]
    bad = make_subs(spark, [dict(created_at="2024-01-02")] * 50).withColumn("quantity", F.expr("CAST(raise_error('lost in the middle') AS BIGINT)"))
    with pytest.raises(Exception, match="lost in the middle"):
        full_refresh(bad, "subscriptions", db)
    assert spark.table(f"{db}.subscriptions").count() == 1 and _folders(db, spark)[0] == before


def test_staged_rows_are_invisible_until_published(spark, db):
    full_refresh(make_subs(spark, [dict(created_at="2024-01-02")]), "subscriptions", db)
    staged = stage(make_subs(spark, [dict(created_at="2024-01-02")] * 4), "subscriptions", db)
    assert spark.table(f"{db}.subscriptions").count() == 1 and staged.rows.count() == 4
    assert staged.publish() == 4 and spark.table(f"{db}.subscriptions").count() == 4


def test_view_is_kept_by_the_catalog(spark, db):
    subs = make_subs(spark, [dict(created_at="2024-01-15", plan_amount=1000)])
    full_refresh(subs, "subscriptions", db)
    rows = create_mrr_view(spark, db, as_of="2024-03-01").collect()
    assert [r.month for r in rows] == ["2024-01", "2024-02", "2024-03"]
    other = spark.newSession()
    assert other.table(f"{db}.v_monthly_mrr").count() == 3
    full_refresh(make_subs(spark, [dict(created_at="2024-02-15")]), "subscriptions", db)
    other.catalog.refreshTable(f"{db}.subscriptions")
    assert [r.month for r in other.table(f"{db}.v_monthly_mrr").collect()] == ["2024-02", "2024-03"]  # run again on every read


def test_dashboard_panels(spark):
    panels = dashboard(fx.golden_series(spark))
    assert set(panels) == {"kpi_cards", "series_span", "monthly_breakdown", "mrr_trend", "report_text"}
    assert panels["report_text"].first().current_mrr_text == "$7,680" and panels["mrr_trend"].count() == 6


def _lines(path, objs):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.json"), "w") as f:
        for o in objs:
            f.write(json.dumps(o) + "\n")


def test_flatten_defaults_and_first_item(spark):
    d = tempfile.mkdtemp(prefix="revspine-raw-")
    _lines(d, [
        {"id": "sub_a", "status": "active", "currency": "usd", "created": 1700000000, "cancel_at_period_end": True,
         "items": {"data": [
             {"quantity": 2, "price": {"id": "p1", "product": "prod1", "unit_amount": 1000,
                                       "recurring": {"interval": "month", "interval_count": 3}}},
             {"quantity": 5, "price": {"id": "p2", "unit_amount": 9999, "recurring": {"interval": "year"}}}]}},
        {"id": "sub_b", "status": "active", "items": {"data": []}, "created": "2024-01-01T00:00:00+00:00"},
        {"id": "sub_c", "items": {"data": [{"price": {"id": "p3", "unit_amount": 500}}]}, "canceled_at": None},
        {"id": "sub_d", "items": {"data": [{"price": {"id": "p4", "unit_amount": 500,
                                                      "recurring": {"interval": "week"}}}]}},
        {"id": "sub_e", "items": {"data": [{"price": {"id": "p5", "unit_amount": 500, "recurring": {}}}]}},
    ])
    now = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
    rows = {r.subscription_id: r for r in flatten_subscription_records(read_raw_subscriptions(spark, d), now).collect()}
    a, b, c, e = rows["sub_a"], rows["sub_b"], rows["sub_c"], rows["sub_d"]
    assert (a.price_id, a.quantity, a.plan_interval, a.plan_interval_count, a.plan_amount) == ("p1", 2, "month", 3, 1000)
    assert a.created_at == dt.datetime(2023, 11, 14, 22, 13, 20) and a.cancel_at_period_end is True
    assert (b.price_id, b.plan_amount, b.quantity, b.plan_interval_count) == (None, None, 1, None)
    assert b.created_at == dt.datetime(2024, 1, 1) and b.cancel_at_period_end is False
    assert (c.price_id, c.plan_interval, c.plan_interval_count, c.quantity) == ("p3", None, None, 1)
    assert (e.plan_interval, e.plan_interval_count) == ("week", 1)
    assert (rows["sub_e"].plan_interval, rows["sub_e"].plan_interval_count) == (None, None)  # an empty object counts as absent
    assert {r.extracted_at for r in rows.values()} == {dt.datetime(2024, 2, 1)}


def test_manifest_document_and_missing_lookups(spark):
    d = tempfile.mkdtemp(prefix="revspine-man-")
    doc = {"num_customers": 3, "clock_ids": ["clk"], "customers": [
        {"customer_id": "cus_1", "subscription_id": "sub_1", "plan": "Pro", "amount": 7900, "interval": "month",
         "clock_id": "clk", "status": "active"},
        {"customer_id": "cus_2", "subscription_id": "sub_missing", "plan": "Pro", "amount": 7900,
         "interval": "month", "clock_id": "clk", "status": "active"},
        {"customer_id": "cus_missing", "subscription_id": "sub_1", "plan": "Pro", "amount": 7900,
         "interval": "month", "clock_id": "clk", "status": "active"}]}
    with open(os.path.join(d, "manifest.json"), "w") as f:
        json.dump(doc, f, indent=2)
    m = read_manifest(spark, os.path.join(d, "manifest.json"), lines=False)
    assert [(r.position, r.subscription_id) for r in m.orderBy("position").collect()] == [
        (0, "sub_1"), (1, "sub_missing"), (2, "sub_1")]
    subs = spark.createDataFrame([('{"id":"sub_1","status":"active"}',)], "value string")
    custs = spark.createDataFrame([('{"id":"cus_1","email":"a@b","name":"A"}',)], "value string")
    out = extract_subscriptions(m, parse_json(subs, RAW_SUBSCRIPTION), parse_json(custs, RAW_CUSTOMER),
                                "2024-01-01 00:00:00").collect()
    assert [(r.subscription_id, r.customer_id, r.customer_name) for r in out] == [("sub_1", "cus_1", "A")]


def test_etl_full_refresh_end_to_end(spark, db):
    land = tempfile.mkdtemp(prefix="revspine-landing-")
    fx.raw_subscription_lines(spark, SMOKE).write.text(os.path.join(land, "subscriptions"))
    fx.raw_customer_lines(spark, SMOKE).write.text(os.path.join(land, "customers"))
    fx.raw_invoice_lines(spark, SMOKE).write.text(os.path.join(land, "invoices"))
    fx.manifest(spark, SMOKE).write.json(os.path.join(land, "manifest"))
    exports = tempfile.mkdtemp(prefix="revspine-exports-")
    n = etl_full_refresh(spark, land, db, now=fx.EXTRACTED_AT, export_dir=exports)
    orders = extract_subscriptions(fx.manifest(spark, SMOKE), parse_json(fx.raw_subscription_lines(spark, SMOKE), RAW_SUBSCRIPTION),
                                   parse_json(fx.raw_customer_lines(spark, SMOKE), RAW_CUSTOMER), fx.EXTRACTED_AT).count()
    assert n["subscriptions"] == orders >= spark.read.parquet(f"{SMOKE}/orders.parquet").count()
    expected_inv = (spark.read.parquet(f"{SMOKE}/lineitem.parquet")
                    .select("l_orderkey", "l_linenumber").distinct().count())
    assert n["invoices"] == expected_inv
    loaded = spark.table(f"{db}.subscriptions")
    assert loaded.filter(F.col("subscription_id").isNull()).count() == 0
    assert spark.read.json(os.path.join(exports, "invoices")).count() == expected_inv
    # a second run with an empty landing zone keeps the tables
    empty = tempfile.mkdtemp(prefix="revspine-landing-")
    for sub in ("subscriptions", "customers", "invoices", "manifest"):
        os.makedirs(os.path.join(empty, sub))
        open(os.path.join(empty, sub, "part-0.json"), "w").close()
    assert etl_full_refresh(spark, empty, db, now=fx.EXTRACTED_AT) == \
        {"subscriptions": 0, "invoices": 0}
    assert spark.table(f"{db}.subscriptions").count() == orders


def test_t20_empty_manifest_gives_empty_frames(spark):
    from revspine.plans.etl import extract
    from revspine.schemas import MANIFEST_LINES, RAW_INVOICE
    empty_manifest = spark.createDataFrame([], MANIFEST_LINES)
    subs = parse_json(spark.createDataFrame([('{"id":"sub_1","status":"active"}',)], "value string"), RAW_SUBSCRIPTION)
    custs = parse_json(spark.createDataFrame([('{"id":"cus_1"}',)], "value string"), RAW_CUSTOMER)
    invs = parse_json(spark.createDataFrame([('{"id":"in_1","customer":"cus_1"}',)], "value string"), RAW_INVOICE)
    ex = extract(empty_manifest, subs, custs, invs, "2024-01-01 00:00:00")
    assert ex.subscriptions.count() == 0 and ex.invoices.count() == 0 and ex.rejects.count() == 0
    assert [tuple(r) for r in ex.summary().orderBy("table_name").collect()] == [
        ("invoices", 0, 0, 0), ("subscriptions", 0, 0, 0)]


def test_landing_zone_and_exports_are_compressed(spark, tmp_path):
    from revspine.plans.registry import land
    from revspine.sources.raw import read_raw_customers

    sources = tmp_path / "sf"
    spark.createDataFrame([(1, 1, "O", "1-URGENT", dt.date(2000, 1, 1))], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate date").write.parquet(f"{sources}/orders.parquet")
    spark.createDataFrame([(1, "Customer#1"), (2, "Customer#2")], "c_custkey long, c_name string").write.parquet(f"{sources}/customer.parquet")
    spark.createDataFrame([(1, 1, 7, 12.5, "A", dt.date(2000, 2, 1))], "l_orderkey long, l_linenumber int, l_partkey long, l_extendedprice double, l_returnflag string, l_shipdate date").write.parquet(f"{sources}/lineitem.parquet")
    land(spark, str(sources), str(tmp_path / "landing"))
    for name in ("subscriptions", "customers", "invoices", "manifest"):
        files = [f for f in os.listdir(tmp_path / "landing" / name) if f.startswith("part-")]
        assert files and all(f.endswith(".gz") for f in files)
    assert sorted(r.id for r in read_raw_customers(spark, str(tmp_path / "landing" / "customers")).collect()) == ["cus_1", "cus_2"]
    export_json(spark.range(5), str(tmp_path / "out"), "gzip")
    assert spark.read.json(str(tmp_path / "out")).count() == 5 and all(f.endswith(".json.gz") for f in os.listdir(tmp_path / "out") if f.startswith("part-"))
