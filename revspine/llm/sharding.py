"""Proportional stratified interleaving into shards, in built-in functions only.

Rows are shuffled by a seeded hash and ranked within their source; a row's
fractional rank (rank - 1/2) / (rows of its source) places it in one order of
all rows, in which every stretch has the sources in their overall proportions.
Equal cuts of that order are the shards: counts differ by one at most.

No window ever holds a whole source or the whole table: ranks are a running
count of ``BUCKETS`` hash ranges (from counts combined before the shuffle) plus
a rank within one range, and places are found in the same way over ranges of
the fractional rank.

Defined results: a NULL source is a stratum of its own; NULL text has size 1
and the checksum of the empty text; rows with a NULL id, and rows that repeat an
id, are shuffled by their further columns (``ties``), so they share a range only
where they are equal in these too, and there they are ranked as a sorted
stream; columns named ``shard`` or ``slot`` are replaced; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

BUCKETS = 4096  # a power of two


def interleave(df: DataFrame, shards: int, id_col: str = "doc_id", source_col: str = "source", seed: int = 17, ties: list[str] = ()) -> DataFrame:
    """``df`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each).

    ``ties`` are columns that shuffle and order rows of equal id."""
    shift = 64 - (BUCKETS - 1).bit_length()
    df = df.drop("shard", "slot")
    carried = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(df.columns)]
    at = {c: f"c{k}" for k, c in enumerate(df.columns)}
    source = F.col(f"`{source_col}`")
    rows = df.select(*carried, F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source.cast("string"))).alias("_source"),
                     F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in (id_col, *ties)]).alias("_h")).withColumn("_bucket", F.shiftrightunsigned("_h", shift))
    order = ["_h", at[id_col], *[at[c] for c in ties]]

    per_bucket = rows.groupBy("_source", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    run = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_bucket.select(F.col("_source").alias("_s"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_n").over(run), F.lit(0)).alias("_before"),
                               F.sum("_n").over(Window.partitionBy("_source")).alias("_all"))
    rank = F.col("_before") + F.row_number().over(Window.partitionBy("_source", "_bucket").orderBy(*order))
    ranked = (rows.join(starts, (F.col("_source") == F.col("_s")) & (F.col("_bucket") == F.col("_b")))
              .withColumn("_rank", rank.cast("bigint"))
              .withColumn("_place", (2 * F.col("_rank") - 1) / (2 * F.col("_all")))
              .withColumn("_range", F.expr(f"((2 * _rank - 1) * {BUCKETS}) div (2 * _all)"))
              .drop("_s", "_b", "_before", "_bucket", "_rank", "_all"))
    ranked = cut(ranked)  # narrow rows, used for the counts and for the places

    per_range = ranked.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))  # BUCKETS rows at most
    everything = Window.orderBy("_range")
    offsets = per_range.select(F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(everything.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"),
                               F.sum("_n").over(everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_total"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy("_place", "_source", *order))
    placed = (ranked.join(offsets, F.col("_range") == F.col("_r"))
              .withColumn("_pos", (F.col("_start") + within - 1).cast("bigint"))
              .withColumn("_shard", F.expr(f"(_pos * {shards}) div _total")))
    slot = F.col("_pos") - F.expr(f"(_shard * _total + {shards - 1}) div {shards}")
    return placed.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(df.columns)], F.col("_shard").cast("int").alias("shard"), slot.alias("slot"))


def shard_digest(documents: DataFrame, shards: int = 8, seed: int = 17) -> DataFrame:
    """The placement of every document with its size and text checksum."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select("doc_id", "source", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = interleave(rows, shards, seed=seed, ties=["size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")
