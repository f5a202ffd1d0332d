"""Exact per-month totals over month ranges without expanding them (form C).

Expanding every window into its months (one row per window per month) costs
``N x months`` rows and then a distinct-count ``Expand``.  Instead each window
emits a ``+`` event at its first month and a ``-`` event after its last one,
and a running sum over the months gives the totals.  Events before the spine
starts net out, and an open-ended window closes at ``OPEN_END`` (beyond any
spine), so no range needs clamping and the map side needs no spine bounds.

Exact distinct counts need one more idea: a key (subscription or customer) with
several windows must count once per month.  Per ``(key, first month)`` only the
longest range matters; ordered by first month, each range only adds the months
after the furthest month any earlier range of that key reached.  Those added
pieces are disjoint per key, so their ``+1``/``-1`` events count every key at
most once per month.

Physical shape - one scan, two shuffles of keyed rows, the rest bounded by the
calendar span:

1. one pass over the windows emits tagged rows: value events (untagged by key)
   and one row per subscription key and per customer key;
2. ``groupBy(kind, key, idx)`` with map-side combine: value events collapse to
   at most one row per month per task, and a hot key or a group of copies
   collapses to one row per first month before anything is shuffled;
3. one window per ``(kind, key)`` (at most one row per first month per key)
   turns the ranges into coverage events;
4. all events summed per month (map-side combined again), then a running sum
   over at most the months touched - a single-partition window whose size is
   bounded by the calendar, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_index

OPEN_END = 1 << 30  # month index standing for "never ends"
DELTA_COLUMNS = ("d_rows", "d_valued", "d_cents", "d_subs", "d_custs")
VALUE, SUB, CUST = 0, 1, 2


def window_ranges(windows: DataFrame) -> DataFrame:
    """``first_idx``/``last_idx`` of each window: the months ``m`` with
    ``start <= m + 1 month`` (T1) and ``end IS NULL OR end >= m`` (T2), i.e.
    ``[month(start - 1 day), month(end)]``; an open end is ``OPEN_END``.
    Windows that end before they start are dropped (T3)."""
    first = month_index(F.date_sub("start_date", 1))
    last = F.coalesce(month_index("end_date"), F.lit(OPEN_END))
    return (windows.select("*", first.alias("first_idx"), last.alias("last_idx"))
                   .filter(F.col("start_date").isNotNull() & (F.col("first_idx") <= F.col("last_idx"))))


def monthly_deltas(ranges: DataFrame, sub_key: str = "subscription_id", cust_key: str = "customer_id",
                   value: str = "monthly_amount_cents", kinds: tuple[int, ...] = (VALUE, SUB, CUST)) -> DataFrame:
    """All events summed per month index ``idx`` (one row per month touched); of
    ``kinds`` that are left out no row is made, and their columns are 0."""
    v = F.col(value)
    valued = v.isNotNull().cast("int")
    no_key, no_last, zero = F.lit(None).cast("string"), F.lit(None).cast("int"), F.lit(0)

    def row(kind, key, idx, last, d_rows, d_valued, d_cents):
        return F.struct(F.lit(kind).alias("kind"), key.alias("key"), idx.alias("idx"), last.alias("last_idx"),
                        d_rows.alias("d_rows"), d_valued.alias("d_valued"), d_cents.alias("d_cents"))

    rows = {VALUE: [row(VALUE, no_key, F.col("first_idx"), no_last, F.lit(1), valued, v),
                    row(VALUE, no_key, F.col("last_idx") + 1, no_last, F.lit(-1), -valued, -v)],
            SUB: [row(SUB, F.col(sub_key), F.col("first_idx"), F.col("last_idx"), zero, zero, F.lit(None).cast("bigint"))],
            CUST: [row(CUST, F.col(cust_key), F.col("first_idx"), F.col("last_idx"), zero, zero, F.lit(None).cast("bigint"))]}
    tagged = ranges.select(F.inline(F.array(*[r for k in kinds for r in rows[k]]))).filter((F.col("kind") == VALUE) | F.col("key").isNotNull())  # COUNT(DISTINCT) skips NULL keys
    combined = tagged.groupBy("kind", "key", "idx").agg(
        F.sum("d_rows").alias("d_rows"), F.sum("d_valued").alias("d_valued"),
        F.sum("d_cents").alias("d_cents"), F.max("last_idx").alias("last_idx"))

    earlier = Window.partitionBy("kind", "key").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.max("last_idx").over(earlier)  # NULL on a key's first range; greatest() skips it
    kind = F.col("kind")
    ranged = combined.withColumn("from_idx", F.greatest(F.col("idx"), reached + 1))
    is_sub, is_cust = (kind == SUB).cast("int"), (kind == CUST).cast("int")

    def event(idx, d_rows, d_valued, d_cents, d_subs, d_custs):
        return F.struct(idx.alias("idx"), d_rows.alias("d_rows"), d_valued.alias("d_valued"),
                        d_cents.alias("d_cents"), d_subs.alias("d_subs"), d_custs.alias("d_custs"))

    none = F.lit(None).cast("bigint")
    events = F.when(kind == VALUE, F.array(event(F.col("idx"), F.col("d_rows"), F.col("d_valued"),
                                                 F.col("d_cents"), zero, zero))) \
              .when(F.col("from_idx") <= F.col("last_idx"),
                    F.array(event(F.col("from_idx"), zero, zero, none, is_sub, is_cust),
                            event(F.col("last_idx") + 1, zero, zero, none, -is_sub, -is_cust)))
    return (ranged.select(F.inline(events))
                  .groupBy("idx")
                  .agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in DELTA_COLUMNS]))


def running_totals(spine_idx: DataFrame, deltas: DataFrame) -> DataFrame:
    """Per spine month: both exact distinct counts and ``mrr_cents``.

    Months with no active row are dropped (T4); a month whose rows all have
    NULL cents sums to NULL (T9).  Events before the spine start are part of
    the running sum (they net out for windows that ended before it).  Both
    inputs have at most one row per month touched, so the unpartitioned
    window and the final join are bounded by the calendar span."""
    months = deltas.join(spine_idx.withColumn("in_spine", F.lit(True)), "idx", "full")
    upto = Window.orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = months.select("idx", "in_spine",
                        *[F.sum(F.coalesce(F.col(c), F.lit(0))).over(upto).alias(c) for c in DELTA_COLUMNS])
    return (run.filter(F.col("in_spine") & (F.col("d_rows") > 0))
               .select("idx",
                       F.col("d_subs").alias("active_subscriptions"),
                       F.col("d_custs").alias("active_customers"),
                       F.when(F.col("d_valued") > 0, F.col("d_cents")).alias("mrr_cents")))
