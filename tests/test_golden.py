"""Golden values: the six-row demo series and the KPIs its preview page shows."""

from revspine.operators import report
from revspine.sources.fixtures import golden_series


def test_kpi_text_matches_preview(spark):
    r = report.report_text(golden_series(spark)).first()
    assert r.current_mrr_text == "$7,680"
    assert r.mom_text == "+7.4% MoM"
    assert r.subscriptions_text == "73"
    assert r.subscription_delta_text == "+3 from last month"
    assert r.customers_text == "66"
    assert r.total_growth_text == "+79.4%"
    assert r.first_mrr_text == "from $4,280"
    assert r.months_loaded_text == "6 months loaded"
    assert r.range_text == "2025-09 — 2026-02"
    assert (r.mom_trend, r.subscription_trend, r.total_growth_trend) == ("up", "up", "up")


def test_kpi_numbers(spark):
    k = report.kpi_cards(golden_series(spark)).first()
    assert k.current_mrr == 7680.0 and k.first_mrr == 4280.0
    assert abs(k.mom_change_pct - (7680 - 7150) / 7150 * 100) < 1e-9
    assert k.subscription_delta == 3 and k.active_customers == 66
    assert abs(k.total_growth_pct - (7680 - 4280) / 4280 * 100) < 1e-9


def test_breakdown_first_row_has_dash(spark):
    rows = report.monthly_breakdown(golden_series(spark)).collect()
    assert [r.month for r in rows] == sorted(r.month for r in rows)
    assert rows[0].mom_change_pct is None and rows[0].change_text == "—" and rows[0].trend == "none"
    assert rows[1].change_text == "+19.6%" and rows[1].mrr_text == "$5,120"


def test_trend_axis_and_payload(spark):
    rows = report.mrr_trend(golden_series(spark)).collect()
    assert rows[-1].axis_label == "$8k" and rows[0].axis_label == "$4k"
    assert rows[0].tooltip_detail == "52 subs · 48 customers"
    p = report.mrr_payload(golden_series(spark)).first().payload
    assert p.startswith('{"data":[{"month":"2025-09","active_subscriptions":52,"active_customers":48,'
                        '"mrr_amount":4280.00}')
    assert p.endswith('],"status":"ok"}')


def test_empty_series_gives_dashes(spark):
    empty = golden_series(spark).limit(0)
    r = report.report_text(empty).first()
    assert r.current_mrr_text == "—" and r.mom_text is None and r.total_growth_text == "—"
    assert r.months_loaded_text == "" and r.range_text == ""
    assert report.mrr_payload(empty).first().payload == '{"data":[],"status":"ok"}'
