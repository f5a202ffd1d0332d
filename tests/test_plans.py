"""Physical plan shape: pushdown, pruning, no pair expansion, map-side limits."""

import contextlib
import io
import os
import tempfile


from revspine.operators.extract import cap_per_customer, dedup_invoices, fetch_invoices, invoice_counts, invoices_per_customer
from revspine.plans.mrr import monthly_mrr
from conftest import make_subs


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def _table(spark):
    d = tempfile.mkdtemp(prefix="revspine-plan-")
    rows = [dict(created_at=f"2024-0{m}-1{m}", status=s, customer_id=f"c{m % 3}")
            for m in range(1, 7) for s in ("active", "canceled", "incomplete")]
    make_subs(spark, rows).write.parquet(os.path.join(d, "subs"))
    return spark.read.parquet(os.path.join(d, "subs"))


def test_mrr_filter_pushed_and_columns_pruned(spark):
    p = plan(monthly_mrr(_table(spark), "view", "2024-07-01"))
    pushed = [ln for ln in p.splitlines() if ln.startswith("PushedFilters:")]
    assert any("In(status, [active,canceled,past_due])" in ln for ln in pushed), pushed
    schemas = [ln for ln in p.splitlines() if ln.startswith("ReadSchema:")]
    assert "struct<created_at:timestamp>" in " ".join(schemas)  # the spine bound reads one column
    for unused in ("customer_email", "customer_name", "price_id", "trial_start", "extracted_at"):
        assert all(unused not in ln for ln in schemas), unused


def test_mrr_plan_never_builds_pairs(spark):
    p = plan(monthly_mrr(_table(spark), "full", "2024-07-01"))
    assert "NestedLoop" not in p and "CartesianProduct" not in p and "Expand" not in p
    assert p.count("sequence(") >= 1  # only the spine itself is a sequence


def _invoices(spark, n=50):
    return spark.createDataFrame(
        [(f"in_{i % 7}", f"cus_{i % 3}", "sub", "paid", 100 + i, 100, "usd", None, None, None, None, "u", None)
         for i in range(n)],
        "invoice_id string, customer_id string, subscription_id string, status string, amount_due long, "
        "amount_paid long, currency string, period_start timestamp, period_end timestamp, created_at timestamp, "
        "paid_at timestamp, hosted_invoice_url string, extracted_at timestamp")


MANIFEST = [(0, "cus_0"), (1, "cus_1"), (2, "cus_0")]


def test_cap_limits_before_the_shuffle(spark):
    assert plan(cap_per_customer(_invoices(spark), 5)).count("WindowGroupLimit") >= 2  # partial (before the exchange) and final


def test_dedup_is_one_wide_shuffle_with_a_limit_before_it(spark):
    manifest = spark.createDataFrame(MANIFEST, "position long, customer_id string")
    d = dedup_invoices(fetch_invoices(manifest, _invoices(spark)))
    assert d.count() == len({f"in_{i % 7}" for i in range(50) if i % 3 in (0, 1)})
    p = plan(d)
    assert p.count("WindowGroupLimit") >= 2
    assert [ln for ln in p.splitlines() if ln.startswith("Arguments: hashpartitioning(invoice_id")]
    assert not [ln for ln in p.splitlines() if "Window [" in ln and "customer_id" in ln.split("partition")[-1]]


def test_counts_need_no_window(spark):
    manifest = spark.createDataFrame(MANIFEST, "position long, customer_id string")
    for df in (invoice_counts(fetch_invoices(manifest, _invoices(spark))), invoices_per_customer(manifest, _invoices(spark))):
        p = plan(df)
        assert "Window" not in p and "partial_count" in p


def test_mrr_reads_the_table_once_plus_the_bound(spark):
    p = plan(monthly_mrr(_table(spark), "api", "2024-07-01"))
    scans = [ln for ln in p.splitlines() if ln.startswith("ReadSchema:")]
    assert len(scans) == 2, scans  # the windows, and created_at for the spine's lower bound


def test_mrr_has_exactly_two_keyed_shuffles(spark):
    p = plan(monthly_mrr(_table(spark), "view", "2024-07-01"))
    exchanges = [ln for ln in p.splitlines() if ln.startswith("Arguments: hashpartitioning(")]
    keyed = [ln for ln in exchanges if "kind" in ln]
    assert len(keyed) == 2, exchanges  # (kind, key, month) for the combine, (kind, key) for the window
    others = [ln for ln in exchanges if "kind" not in ln]
    assert all("idx" in ln for ln in others), others  # the rest is keyed by month only
