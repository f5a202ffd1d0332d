"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import re
import tempfile
import uuid

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import hot_join  # noqa: F401  (shared by the operators here)
from ..sources.files import delete

#: White space of the text contracts: space, tab, LF, VT, FF, CR.
ASCII_SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read by Spark (any file system it knows)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without the setting (tests) gets a temporary folder;
    on a cluster, where executors do not see each other's disks, it has to be set."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        named = sc.getConf().get("spark.checkpoint.dir")
        if named is None and not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read from there: its
    lineage ends at files that survive a lost executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """A new folder in the shared checkpoint folder, deleted when the program ends."""
    folder = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    atexit.register(forget, spark, folder)
    return folder


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    """``df`` written as compressed Parquet to a shared folder and read from
    there: for wide rows that are read more than once."""
    folder = folder or shared_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def forget(spark: SparkSession, folder: str) -> None:
    """Delete a shared folder that nothing reads any more."""
    with contextlib.suppress(Exception):  # the JVM may be gone
        delete(spark, folder)


def text_bytes(text) -> "F.Column":
    """The text as UTF-8 binary; NULL counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast(T.BinaryType())


def bounded_sample(df: DataFrame, text_col: str, bound: int, salt: int, classes: tuple[str, ...] = ()) -> DataFrame:
    """Of each class the ``bound`` different texts of smallest salted hash, one
    row each: columns ``classes``, the text and ``_h``.

    Only texts count, so the sample holds for NULL and repeated ids and for any
    number of copies.  An estimate of a class's different texts (a sketch,
    combined in the tasks) tells below which hash there are somewhat over twice
    as many as needed; only those rows are shuffled and ranked."""
    hashed = df.select(*classes, text_col, F.xxhash64(F.lit(salt), F.col(text_col)).alias("_h"))
    sizes = hashed.groupBy(*classes).agg(F.approx_count_distinct("_h").alias("_n"))  # a row per class
    some = 2 * bound + 50
    most = F.when(F.col("_n") <= 2 * some, F.lit(2**63 - 1)).otherwise((F.lit(2.0**64 * some) / F.col("_n") - F.lit(2.0**63)).cast("bigint"))
    near = hashed.join(F.broadcast(sizes), list(classes)) if classes else hashed.crossJoin(F.broadcast(sizes))
    few = near.where(F.col("_h") <= most).groupBy(*classes, "_h").agg(F.min(text_col).alias(text_col))
    first = F.row_number().over(Window.partitionBy(*classes, F.lit(0)).orderBy("_h"))
    return few.withColumn("_rank", first).where(F.col("_rank") <= bound).drop("_rank")


def column_bytes(column) -> list[bytes]:
    """The values of a binary Arrow column as Python bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.to_pylist()


def chunks(values: list, size, limit: int):
    """Index ranges ``(lo, hi)`` of consecutive values whose sizes sum to about
    ``limit`` (one value at least), so that work arrays stay bounded."""
    lo, total = 0, 0
    for k, value in enumerate(values):
        if k > lo and total + size(value) > limit:
            yield lo, k
            lo, total = k, 0
        total += size(value)
    if lo < len(values):
        yield lo, len(values)


def pieces(batches, column: int, limit: int = 4 << 20):
    """Arrow batches cut so that a text column holds about ``limit`` bytes each
    (one row at least): what Python makes of a batch stays bounded however long its texts are."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(column)), 0).to_pylist()
        for lo, hi in chunks(sizes, int, limit):
            yield b.slice(lo, hi - lo)
    release()


def release() -> None:
    """Give freed memory back to the system: Spark keeps a task's Python worker
    for other stages, whose needs would otherwise add up."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc
        trim(0)


def in_fold(doc_id, modulus: int, remainder: int):
    """crc32(doc_id as text) mod ``modulus`` = ``remainder``; a NULL id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))
