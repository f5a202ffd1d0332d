"""The maintained view equals the full computation after any changes, and reads monthly rows alone."""

import random

import pytest

from conftest import make_subs
from revspine.plans import maintained_view
from revspine.plans.maintained_view import MaintainedView
from revspine.plans.mrr import monthly_mrr
from revspine.sources import files

AS_OF = "2024-06-01"


def _row(r, k):
    day = lambda: f"{r.randrange(2020, 2024)}-{r.randrange(1, 13):02d}-{r.choice([1, 15, 28]):02d}"
    return dict(subscription_id=r.choice([f"s{k}", f"s{k % 7}", None]), customer_id=r.choice([f"c{r.randrange(5)}", "hot", None]), created_at=day(), plan_amount=r.choice([100, 250, None]),
                ended_at=day() if r.random() < 0.5 else None, status=r.choice(["active", "canceled", "past_due", "trialing"]))


def _same(view, subs):
    assert [tuple(r) for r in view.read(AS_OF).collect()] == [tuple(r) for r in monthly_mrr(subs, "view", AS_OF).collect()]


@pytest.mark.parametrize("compact", [2, 16])
def test_random_changes(spark, tmp_path, compact, monkeypatch):
    monkeypatch.setattr(maintained_view, "COMPACT", compact)
    r, view = random.Random(compact), MaintainedView(spark, str(tmp_path / "v"))
    rows = [_row(r, k) for k in range(40)]
    for step in range(4):
        subs = make_subs(spark, rows)
        assert view.refresh(subs) == step + 1
        _same(view, subs)
        rows = [x if r.random() < 0.7 else _row(r, k) for k, x in enumerate(rows) if r.random() < 0.9] + [_row(r, 100 + k) for k in range(4)] + rows[:2]
    view.refresh(make_subs(spark, []))
    assert view.read(AS_OF).count() == 0


def test_reading_scans_monthly_rows_and_a_refresh_writes_changes(spark, tmp_path):
    r, view = random.Random(9), MaintainedView(spark, str(tmp_path / "v"))
    rows = [_row(r, k) for k in range(300)]
    view.refresh(make_subs(spark, rows))
    rows[0] = dict(rows[0], plan_amount=999, status="active", created_at="2021-01-15", ended_at=None)
    view.refresh(make_subs(spark, rows))
    _, state = view._state()
    read = view.read(AS_OF)
    assert read.inputFiles() and all(f"/{state['monthly']}/" in f for f in read.inputFiles())
    assert spark.read.parquet(f"{tmp_path}/v/{state['windows'][1]}").count() <= 2  # the row before and the row after
    _same(view, make_subs(spark, rows))


def test_a_crash_leaves_the_state_before(spark, tmp_path, monkeypatch):
    r, view = random.Random(3), MaintainedView(spark, str(tmp_path / "v"))
    first, second = ([_row(r, k) for k in range(20)] for _ in range(2))
    view.refresh(make_subs(spark, first))
    with monkeypatch.context() as m:
        m.setattr(files, "create_if_absent", lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            view.refresh(make_subs(spark, second))
    _same(view, make_subs(spark, first))
    view.refresh(make_subs(spark, second))
    _same(view, make_subs(spark, second))


def test_a_refresh_that_was_overtaken_starts_again(spark, tmp_path, monkeypatch):
    r, view = random.Random(4), MaintainedView(spark, str(tmp_path / "v"))
    first, second = ([_row(r, k) for k in range(15)] for _ in range(2))
    real, other = files.create_if_absent, []

    def late(s, path, text):
        if not other:
            other.append(1)
            MaintainedView(spark, str(tmp_path / "v")).refresh(make_subs(spark, first))
        return real(s, path, text)

    monkeypatch.setattr(files, "create_if_absent", late)
    assert view.refresh(make_subs(spark, second)) == 2
    _same(view, make_subs(spark, second))
