"""Window-end events against brute force: random ranges per key, every month enumerated."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from revspine.operators.interval_agg import CUST, DELTA_COLUMNS, OPEN_END, SUB, monthly_deltas, running_totals

SPINE = list(range(100, 130))

row = st.tuples(
    st.integers(0, 6),                                  # subscription key
    st.integers(0, 3),                                  # customer key
    st.integers(90, 132),                               # first month index
    st.one_of(st.integers(88, 140), st.just(None)),     # last month index, None = open
    st.one_of(st.integers(-50, 900), st.just(None)),    # cents
)


def brute(rows):
    out = {}
    for m in SPINE:
        act = [r for r in rows if r[2] <= m <= (OPEN_END if r[3] is None else r[3])]
        if not act:
            continue
        cents = [r[4] for r in act if r[4] is not None]
        out[m] = (len({r[0] for r in act}), len({r[1] for r in act}), sum(cents) if cents else None)
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=0, max_size=25))
def test_delta_counts_match_brute_force(spark, rows):
    rows = [r for r in rows if r[3] is None or r[2] <= r[3]]  # window_ranges drops reversed ranges
    df = spark.createDataFrame(
        [(f"s{a}", f"c{b}", f, OPEN_END if l is None else l, v) for a, b, f, l, v in rows],
        "subscription_id string, customer_id string, first_idx int, last_idx int, monthly_amount_cents long")
    spine = spark.createDataFrame([(m,) for m in SPINE], "idx int")
    got = {r.idx: (r.active_subscriptions, r.active_customers, r.mrr_cents)
           for r in running_totals(spine, monthly_deltas(df)).collect()}
    assert got == brute(rows)


def test_brute_force_sanity():
    rows = [(0, 0, 100, 102, 5), (0, 0, 101, 103, 7), (1, 0, 103, None, None)]
    b = brute(rows)
    assert b[101] == (1, 1, 12) and b[103] == (2, 1, 7) and b[110] == (1, 1, None)


def test_one_kind_of_key_makes_its_events_alone(spark):
    rows = [("s1", "c1", 100, 102, 5), ("s1", "c2", 101, 104, 7), ("s2", "c1", 103, 103, None), (None, "c2", 101, 101, 1)]
    df = spark.createDataFrame(rows, "subscription_id string, customer_id string, first_idx int, last_idx int, monthly_amount_cents long")
    whole = {r.idx: r for r in monthly_deltas(df).collect()}
    for kind, column in ((SUB, "d_subs"), (CUST, "d_custs")):
        own = {r.idx: r for r in monthly_deltas(df, kinds=(kind,)).collect()}
        assert {i: r[column] for i, r in own.items() if r[column]} == {i: r[column] for i, r in whole.items() if r[column]}
        assert not any(r[c] for r in own.values() for c in DELTA_COLUMNS if c != column)


def test_a_first_refresh_looks_no_keys_up(spark, tmp_path, monkeypatch):
    from conftest import make_subs
    from revspine.plans import maintained_view
    from revspine.plans.mrr import monthly_mrr

    subs = make_subs(spark, [dict(subscription_id="s1", created_at="2023-01-10"), dict(subscription_id="s1", created_at="2023-01-10"), dict(subscription_id="s2", created_at="2023-03-10", ended_at="2023-05-01")])
    view = maintained_view.MaintainedView(spark, str(tmp_path / "v"))
    with monkeypatch.context() as m:
        m.setattr(maintained_view, "hot_join", lambda *_: (_ for _ in ()).throw(AssertionError("joined")))
        assert view.refresh(subs) == 1
    assert [tuple(r) for r in view.read("2023-07-01").collect()] == [tuple(r) for r in monthly_mrr(subs, "view", "2023-07-01").collect()]
