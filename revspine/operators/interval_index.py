"""Which subscriptions are active in a month, without listing every pair.

A window's months [first, last] are the union of few aligned blocks of 1, 2, 4,
... months (at most two of each size), and a month lies in exactly one block of
each size.  The index stores every window under its blocks, O(log months) rows
instead of one per month, in files parted by block; a month reads the files of
its own blocks, and each window found there is active in it, once.

The number of blocks is that of the calendar's months, not of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import index_month
from .activity import PAIR_COLUMNS
from .windows import month_ranges

LEVELS = 17  # blocks of up to 2^16 months: more than the calendar has


def blocks() -> F.Column:
    """The blocks (level, start / 2^level) of ``first_idx`` to ``last_idx``: going
    up one level at a time, an odd left end and an odd right end each leave one block."""
    def at(level):
        low = F.expr(f"shiftright(first_idx + {(1 << level) - 1}, {level})")
        high = F.expr(f"shiftright(last_idx + 1, {level})")
        left = F.when((low < high) & (low % 2 == 1), F.struct(F.lit(level).alias("level"), low.alias("block")))
        right = F.when((low < high) & (high % 2 == 1), F.struct(F.lit(level).alias("level"), (high - 1).alias("block")))
        return [left, right]

    return F.array_compact(F.array(*[b for level in range(LEVELS) for b in at(level)]))


def index_windows(windows: DataFrame, bounds: DataFrame, columns=PAIR_COLUMNS) -> DataFrame:
    """The rows of the index: ``level, block`` and the window's columns."""
    return month_ranges(windows, bounds).select(F.inline(blocks()), *columns)


def write_index(index: DataFrame, path: str) -> None:
    """Store the index in files parted by level and block: a small block is one
    file, and Spark deals a block with many windows out to several tasks."""
    index.hint("rebalance", "level", "block").write.partitionBy("level", "block").parquet(path)


def read_index(spark: SparkSession, path: str, columns) -> DataFrame:
    return spark.read.schema(columns).parquet(path)


def active_in(index: DataFrame, months: list[int], columns=PAIR_COLUMNS) -> DataFrame:
    """The pairs of the given months (month indices): one row per month and window active in it.

    The blocks of the months are literals of the filter, so only their files are opened."""
    asked = [(m, level, m >> level) for m in sorted(set(months)) for level in range(LEVELS)]
    if not asked:
        return index.select(index_month(F.lit(0)).alias("month_start"), *columns).limit(0)
    by_level: dict[int, list[int]] = {}
    for _, level, block in asked:
        by_level.setdefault(level, []).append(block)
    wanted = F.lit(False)
    for level, named in by_level.items():
        wanted = wanted | ((F.col("level") == level) & F.col("block").isin(sorted(set(named))))
    of = index.sparkSession.createDataFrame(asked, "idx int, level int, block int")  # LEVELS rows a month
    found = index.where(wanted).join(F.broadcast(of), ["level", "block"])
    return found.select(index_month("idx").alias("month_start"), *columns)
