
import pytest

from forms import METHODS, mrr_by
from conftest import make_subs

AS_OF = "2024-06-15"


def run(subs, mode="view", method="delta"):
    return [tuple(r) for r in mrr_by(subs, mode, AS_OF, method).collect()]


def all_forms(subs, mode="view"):
    res = {m: run(subs, mode, m) for m in METHODS}
    assert res["delta"] == res["explode"] == res["cross"], res
    return res["delta"]


def test_t1_start_on_first_counts_month_before(spark):
    subs = make_subs(spark, [dict(created_at="2024-01-15"), dict(created_at="2024-03-01")])
    rows = all_forms(subs)
    assert rows[0][:2] == ("2024-01", 1)
    assert rows[1][:2] == ("2024-02", 2)


def test_t2_end_on_first_still_counts(spark):
    subs = make_subs(spark, [dict(created_at="2024-01-15", ended_at="2024-04-01", status="canceled")])
    rows = all_forms(subs)
    assert [r[0] for r in rows] == ["2024-01", "2024-02", "2024-03", "2024-04"]


def test_t3_end_before_start_never_counts(spark):
    subs = make_subs(spark, [dict(created_at="2024-01-15"),
                             dict(created_at="2024-03-10", ended_at="2024-02-20", status="canceled")])
    rows = all_forms(subs)
    assert all(r[1] == 1 for r in rows)


def test_t4_missing_months_and_lag(spark):
    subs = make_subs(spark, [dict(created_at="2024-01-15", ended_at="2024-02-10", status="canceled",
                                  plan_amount=1000),
                             dict(created_at="2024-05-10", plan_amount=3000)])
    for m in METHODS:
        rows = run(subs, "full", m)
        assert [r[0] for r in rows] == ["2024-01", "2024-02", "2024-05", "2024-06"]
        may = rows[2]
        assert may[5] == 10.0 and may[6] == 20.0 and may[7] == 200.0  # prev is Feb, the previous present month


def test_t5_spine_starts_before_status_filter(spark):
    subs = make_subs(spark, [dict(created_at="2023-11-05", status="incomplete"),
                             dict(created_at="2024-01-01")])
    rows = all_forms(subs)
    assert rows[0][0] == "2023-12"
    only_active = make_subs(spark, [dict(created_at="2024-01-01")])
    assert all_forms(only_active)[0][0] == "2024-01"


def test_t7_empty_table(spark):
    subs = make_subs(spark, [dict(created_at="2024-01-15")]).limit(0)
    assert all_forms(subs) == []
    assert run(subs, "full") == []


def test_start_after_as_of_gives_nothing(spark):
    subs = make_subs(spark, [dict(created_at="2025-01-15")])
    assert all_forms(subs) == []


def test_t8_round_per_subscription(spark):
    subs = make_subs(spark, [dict(created_at="2024-06-10", plan_amount=1001, plan_interval="year"),
                             dict(created_at="2024-06-10", plan_amount=1001, plan_interval="year")])
    rows = run(subs, "full")
    assert rows[-1][4] == 166 and rows[-1][3] == 1.66


def test_t9_all_null_month(spark):
    subs = make_subs(spark, [dict(created_at="2024-06-10", plan_interval_count=None)])
    for mode in ("full", "view"):
        rows = all_forms(subs, mode) if mode == "view" else run(subs, mode)
        assert rows[-1][1] == 1 and rows[-1][3] is None
    assert run(subs, "api")[-1][3] == 10.0  # api treats a NULL count as 1


def test_t14_zero_interval_count_raises(spark):
    subs = make_subs(spark, [dict(created_at="2024-06-10", plan_interval_count=0)])
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        run(subs, "full")


def test_t22_duplicate_subscription(spark):
    subs = make_subs(spark, [dict(created_at="2024-06-10", plan_amount=1000)])
    dup = subs.unionByName(subs)
    rows = all_forms(dup)
    assert rows[-1][1] == 1 and rows[-1][2] == 1 and rows[-1][3] == 20.0


def test_trialing_modes(spark):
    subs = make_subs(spark, [dict(created_at="2024-06-10", status="trialing"),
                             dict(created_at="2024-06-10", status="past_due", plan_amount=500)])
    assert run(subs, "full")[-1][:4] == ("2024-06", 1, 1, 5.0)
    assert all_forms(subs)[-1][:4] == ("2024-06", 1, 1, 5.0)


def test_week_day_plans_by_mode(spark):
    subs = make_subs(spark, [dict(created_at="2024-06-10", plan_amount=1200, plan_interval="week")])
    assert run(subs, "full")[-1][3] == 52.0
    assert run(subs, "view")[-1][3] == 12.0


def test_customer_counted_once(spark):
    subs = make_subs(spark, [dict(created_at="2024-01-10", customer_id="c"),
                             dict(created_at="2024-03-10", customer_id="c"),
                             dict(created_at="2024-02-10", ended_at="2024-02-20", status="canceled",
                                  customer_id="c")])
    rows = all_forms(subs)
    assert [r[2] for r in rows] == [1] * len(rows)
    assert [r[1] for r in rows][:3] == [1, 2, 2]  # the third one ends on Feb 20


def test_hot_customer_and_copied_subscription(spark):
    """One customer owns a third of the rows and one subscription is copied many
    times; the exact counts must not change with the skew."""
    rows = [dict(created_at=f"2024-0{1 + i % 5}-1{i % 9}", plan_amount=100 + i,
                 customer_id="hot" if i % 3 == 0 else f"c{i}",
                 ended_at=(f"2024-0{2 + i % 4}-0{1 + i % 8}" if i % 4 == 0 else None),
                 status="canceled" if i % 4 == 0 else "active") for i in range(90)]
    rows += [dict(rows[1], subscription_id="copied")] * 40
    subs = make_subs(spark, rows)
    res = all_forms(subs)
    assert max(r[2] for r in res) <= 61  # 60 other customers + "hot"
    assert any(r[1] >= 50 for r in res)


def test_t12_first_month_change_is_full_amount(spark):
    subs = make_subs(spark, [dict(created_at="2024-05-10", plan_amount=1234)])
    first = run(subs, "full")[0]
    assert first[5] is None and first[6] == first[3] == 12.34 and first[7] is None


def test_t13_zero_previous_month_gives_null_percent(spark):
    from revspine.operators import report
    subs = make_subs(spark, [dict(created_at="2024-01-10", plan_amount=0),
                             dict(created_at="2024-03-10", plan_amount=1000)])
    rows = run(subs, "full")
    assert [r[0] for r in rows][:3] == ["2024-01", "2024-02", "2024-03"]
    assert rows[2][5] == 0.0 and rows[2][7] is None  # previous month 0 -> NULL, never Infinity
    series = mrr_by(subs, "api", AS_OF, "delta")
    b = report.monthly_breakdown(series).collect()
    assert b[2].mom_change_pct is None and b[2].change_text == "—"


def test_t16_currencies_are_summed_together(spark):
    subs = make_subs(spark, [dict(created_at="2024-06-10", plan_amount=1000, currency="usd"),
                             dict(created_at="2024-06-10", plan_amount=500, currency="eur")])
    assert run(subs, "full")[-1][4] == 1500
