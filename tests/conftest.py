import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import types as T  # noqa: E402

from revspine.schemas import SUBSCRIPTIONS  # noqa: E402
from revspine.session import build_session  # noqa: E402

EXTRACTED = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", 8, app_name="revspine-tests")
    yield s
    s.stop()


def ts(s):
    """'2024-01-01' or '2024-01-01 10:00:00' -> naive UTC datetime."""
    return dt.datetime.fromisoformat(s) if s else None


def make_subs(spark, rows):
    """Subscriptions frame from partial dicts; unspecified columns get defaults."""
    defaults = dict(customer_email=None, customer_name=None, status="active", price_id="p", product_id="prod",
                    plan_amount=1000, plan_interval="month", plan_interval_count=1, currency="usd",
                    quantity=1, created_at=None, current_period_start=None, current_period_end=None,
                    canceled_at=None, cancel_at_period_end=False, ended_at=None, trial_start=None,
                    trial_end=None, extracted_at=EXTRACTED)
    out = []
    for i, r in enumerate(rows):
        d = dict(defaults)
        d["subscription_id"] = f"sub_{i}"
        d["customer_id"] = f"cus_{i}"
        d.update(r)
        for c in ("created_at", "current_period_start", "current_period_end", "canceled_at", "ended_at",
                  "trial_start", "trial_end"):
            if isinstance(d[c], str):
                d[c] = ts(d[c])
        out.append(tuple(d[f.name] for f in SUBSCRIPTIONS.fields))
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in SUBSCRIPTIONS.fields])
    return spark.createDataFrame(out, loose)
