"""One parse of every raw source (J3, S11): records and broken lines are
written apart, once, and everything later reads the staged columns it needs.

The counts of a source come from the write itself (``DataFrame.observe``), in
the stage that writes: a task that is run again counts once, and no second read is needed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..schemas import BROKEN, CORRUPT, UNREADABLE

_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def write_counted(df: DataFrame, path: str, partition_by: str | None = None, **counts: Column) -> dict[str, int]:
    """Write ``df`` as Parquet; the aggregates ``counts`` over the written rows.

    With ``partition_by`` a task keeps a writer open for each of its (few)
    values, so rows need not be sorted by it first."""
    spark = df.sparkSession
    seen = Observation()
    observed = df.observe(seen, *[c.alias(n) for n, c in counts.items()])
    writer = observed.write.partitionBy(partition_by) if partition_by else observed.write
    before = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, "8")
    try:
        writer.parquet(path)
    finally:
        spark.conf.set(_WRITERS, before)
    found = seen.get
    return {n: found.get(n) or 0 for n in counts}


@dataclass
class StagedSource:
    """A raw source as staged: ``rows`` has its columns and ``_broken``, by which
    its files are parted; ``counts`` has rows, broken and unreadable."""

    rows: DataFrame
    counts: dict[str, int]


def stage_source(raw: DataFrame, path: str) -> StagedSource:
    """Write a raw frame (:func:`~.raw.parse_json`) once, parted into records and broken lines."""
    marked = raw.withColumn(BROKEN, F.col(CORRUPT).isNotNull())
    unreadable = {"unreadable": F.sum(F.size(UNREADABLE))} if UNREADABLE in raw.columns else {}
    counts = write_counted(marked, path, BROKEN, rows=F.count(F.lit(1)), broken=F.count_if(BROKEN), **unreadable)
    return StagedSource(raw.sparkSession.read.schema(marked.schema).parquet(path), counts)
