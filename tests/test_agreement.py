"""Forms A (cross join), B (explode) and C (window-end deltas) agree on random data."""

import datetime as dt
import random

import pytest

from forms import mrr_by
from conftest import make_subs

STATUSES = ["active", "past_due", "canceled", "trialing", "incomplete", None]
PLANS = [(2900, "month", 1), (79000, "year", 1), (1550, "week", 2), (333, "day", 1), (5000, "quarter", None),
         (7900, "month", None), (None, None, None), (21000, "month", 3)]


def random_subs(spark, seed, n=25):
    rng = random.Random(seed)
    rows = []
    base = dt.datetime(2023, 1, 1)
    for i in range(n):
        created = base + dt.timedelta(days=rng.randrange(0, 540), seconds=rng.randrange(86400))
        if rng.random() < 0.15:
            created = created.replace(day=1)
        status = rng.choice(STATUSES)
        amount, interval, ic = rng.choice(PLANS)
        r = dict(subscription_id=f"s{rng.randrange(n)}", customer_id=f"c{rng.randrange(n // 3)}",
                 status=status, plan_amount=amount, plan_interval=interval, plan_interval_count=ic,
                 quantity=rng.choice([1, 2, 3, None]), created_at=created,
                 cancel_at_period_end=rng.choice([True, False, None]),
                 current_period_end=created + dt.timedelta(days=rng.randrange(-30, 400)))
        if rng.random() < 0.4:
            r["canceled_at"] = created + dt.timedelta(days=rng.randrange(-40, 300))
        if rng.random() < 0.3:
            r["ended_at"] = created + dt.timedelta(days=rng.randrange(-40, 300))
        if rng.random() < 0.05:
            r["created_at"] = None
        rows.append(r)
    rows += [dict(rows[rng.randrange(n)]) for _ in range(4)]  # exact copies
    return make_subs(spark, rows)


@pytest.mark.parametrize("seed", range(6))
def test_forms_agree(spark, seed):
    subs = random_subs(spark, seed)
    for mode in ("full", "view", "api"):
        got = {m: [tuple(r) for r in mrr_by(subs, mode, "2024-09-30", m).collect()]
               for m in ("delta", "explode", "cross")}
        assert got["delta"] == got["cross"], (mode, seed)
        assert got["explode"] == got["cross"], (mode, seed)
