"""The MRR view kept up to date by changes.

What is stored is the sum of all window-end events per month (one row a month,
``operators.interval_agg``) and the windows behind it.  Reading the view adds up
the monthly rows and touches nothing else.  A refresh compares the new windows
with the stored ones: rows that are only in one of them are signed changes.

* Amounts change by the events of the signed rows themselves.
* Distinct counts change for the keys that occur in them: of each such
  subscription and customer, the events of its old windows are taken back and
  those of its new windows are added (only events of that kind of key are made).
  A view without windows has no old ones, so its first refresh looks nothing up.

The changes are appended to the stored windows as signed rows, so a refresh
writes as much as has changed; every ``COMPACT`` refreshes the windows are written
anew.  States are versions (``sources.versions``' records): a crash leaves the state
before, and of two refreshes at once the second starts again from the state of the first.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.interval_agg import CUST, DELTA_COLUMNS, SUB, monthly_deltas, running_totals, window_ranges
from ..operators.joins import hot_join
from ..operators.spine import START, month_bounds, spine_indices
from ..functions.dates import as_of_date, index_month, month_index
from ..sources import files
from .mrr import present, revenue_windows

COMPACT = 16
_WINDOW = ("subscription_id", "customer_id", "first_idx", "last_idx", "monthly_amount_cents")
_WINDOWS = "subscription_id string, customer_id string, first_idx int, last_idx int, monthly_amount_cents bigint, sign bigint"
_MONTHLY = "idx int, " + ", ".join(f"{c} bigint" for c in DELTA_COLUMNS)


class MaintainedView:
    """The ``mode`` variant of monthly MRR in a folder on shared storage."""

    def __init__(self, spark: SparkSession, folder: str, mode: str = "view"):
        self.spark, self.folder, self.mode = spark, folder.rstrip("/"), mode

    # --- states ----------------------------------------------------------------

    def _state(self) -> tuple[int, dict]:
        numbers = [int(n) for n in files.names(self.spark, f"{self.folder}/states") if n.isdigit()]
        if not numbers:
            return 0, {"windows": [], "monthly": None, "start": None}
        return max(numbers), json.loads(files.read_text(self.spark, f"{self.folder}/states/{max(numbers):08d}"))

    def _windows(self, state: dict) -> DataFrame:
        """The stored windows with their number of copies."""
        if not state["windows"]:
            return self.spark.createDataFrame([], _WINDOWS)
        signed = self.spark.read.schema(_WINDOWS).parquet(*[f"{self.folder}/{p}" for p in state["windows"]])
        return signed.groupBy(*_WINDOW).agg(F.sum("sign").alias("sign")).where("sign <> 0")

    def _monthly(self, state: dict) -> DataFrame:
        if state["monthly"] is None:
            return self.spark.createDataFrame([], _MONTHLY)
        return self.spark.read.schema(_MONTHLY).parquet(f"{self.folder}/{state['monthly']}")

    # --- reading ---------------------------------------------------------------

    def read(self, as_of=None) -> DataFrame:
        """The view's rows, from the monthly rows alone."""
        _, state = self._state()
        bounds = self.spark.range(1).select(F.lit(state["start"]).cast("int").alias("spine_start_idx"), month_index(as_of_date(as_of)).alias("spine_end_idx"))
        totals = running_totals(spine_indices(bounds), self._monthly(state))
        return present(totals.select(index_month("idx").alias("month_start"), "active_subscriptions", "active_customers", "mrr_cents"), self.mode)

    # --- refreshing ------------------------------------------------------------

    def refresh(self, subs: DataFrame) -> int:
        """Bring the view to the subscriptions ``subs``; the number of the new state."""
        while True:
            number, state = self._state()
            name = uuid.uuid4().hex[:12]
            now = window_ranges(revenue_windows(subs, self.mode)).select(*_WINDOW, F.lit(1).cast("bigint").alias("sign"))
            old = self._windows(state)
            changes = f"windows-{name}"
            signed = now.unionByName(old.withColumn("sign", -F.col("sign"))).groupBy(*_WINDOW).agg(F.sum("sign").alias("sign")).where("sign <> 0")
            signed.write.parquet(f"{self.folder}/{changes}")
            signed = self.spark.read.schema(_WINDOWS).parquet(f"{self.folder}/{changes}")
            windows = [*state["windows"], changes]
            current = self._windows({"windows": windows})

            parts = [self._values(signed)]
            if not state["windows"]:  # every key is new, and its windows are the signed rows: nothing to look up
                parts.append(monthly_deltas(signed.where("sign > 0"), kinds=(SUB, CUST)))
            for key, column, kind in (("subscription_id", "d_subs", SUB), ("customer_id", "d_custs", CUST)) if state["windows"] else ():
                touched = signed.select(key).where(F.col(key).isNotNull()).distinct()
                for rows, sign in ((old, -1), (current, 1)):
                    own = hot_join(rows.drop("sign"), touched, [key], "left_semi")
                    parts.append(_only(monthly_deltas(own, kinds=(kind,)), column, sign))
            if state["monthly"] is not None:
                parts.append(self._monthly(state))
            total = parts[0]
            for p in parts[1:]:
                total = total.unionByName(p)
            monthly = f"monthly-{name}"
            summed = total.groupBy("idx").agg(*[F.sum(c).cast("bigint").alias(c) for c in DELTA_COLUMNS])  # a row a month
            summed.where(" OR ".join(f"{c} <> 0" for c in DELTA_COLUMNS)).coalesce(1).write.parquet(f"{self.folder}/{monthly}")
            if len(windows) > COMPACT:
                whole = f"windows-{uuid.uuid4().hex[:12]}"
                current.write.parquet(f"{self.folder}/{whole}")
                windows = [whole]
            start = month_bounds(subs).first()[START]
            if files.create_if_absent(self.spark, f"{self.folder}/states/{number + 1:08d}", json.dumps({"windows": windows, "monthly": monthly, "start": start})):
                return number + 1
            for path in {changes, monthly, *windows} - set(state["windows"]):  # another refresh was first: begin again from its state
                files.delete(self.spark, f"{self.folder}/{path}")

    def _values(self, signed: DataFrame) -> DataFrame:
        valued, cents = F.col("monthly_amount_cents").isNotNull().cast("int"), F.coalesce("monthly_amount_cents", F.lit(0))

        def event(idx, sign):
            s = F.col("sign") * sign
            return F.struct(idx.cast("int").alias("idx"), s.alias("d_rows"), (s * valued).alias("d_valued"), (s * cents).alias("d_cents"))

        events = signed.select(F.inline(F.array(event(F.col("first_idx"), 1), event(F.col("last_idx") + 1, -1))))
        none = F.lit(0).cast("bigint")
        return events.groupBy("idx").agg(*[F.sum(c).cast("bigint").alias(c) for c in DELTA_COLUMNS[:3]]).withColumns({c: none for c in DELTA_COLUMNS[3:]})


def _only(deltas: DataFrame, column: str, sign: int) -> DataFrame:
    """The events of one kind of key, taken back or added."""
    return deltas.select(F.col("idx").cast("int").alias("idx"), *[(F.col(c) * sign if c == column else F.lit(0)).cast("bigint").alias(c) for c in DELTA_COLUMNS])
