"""Session helpers.

The engine's date semantics are UTC (a billing timestamp is an instant, and
``DATE(ts)`` is taken in UTC), and it relies on ANSI arithmetic so that a
division by a zero interval count fails loudly instead of producing ``inf``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

UTC = "UTC"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  min_partition_size: str | None = None, driver_memory: str | None = None,
                  app_name: str = "revspine") -> SparkSession:
    """Create (or reuse) a session configured the way the engine expects.

    On a cluster the master, memory and shuffle sizing come from the
    submitter; only the semantic settings are forced here.  ``master`` and
    ``shuffle_partitions`` are for local runs and tests.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory is not None:
        # local mode runs every task inside the driver JVM; only effective when
        # this call starts the JVM.
        b = b.config("spark.driver.memory", driver_memory)
    if min_partition_size is not None:
        # AQE merges shuffle partitions down to this size; small local data
        # would otherwise end up in one or two tasks.
        b = b.config("spark.sql.adaptive.coalescePartitions.minPartitionSize", min_partition_size)
    b = (b.config("spark.sql.session.timeZone", UTC)
          .config("spark.sql.ansi.enabled", "true")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
          # Python call-site capture for error messages costs several JVM round
          # trips per Column function while a plan is built; the plans here are
          # built from hundreds of such calls.
          .config("spark.python.sql.dataFrameDebugging.enabled", "false"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """The engine computes calendar dates in UTC, and of a repeated JSON key it
    takes the last value; enforce both on a session."""
    for key, value in (("spark.sql.session.timeZone", UTC), ("spark.sql.variant.allowDuplicateKeys", "true")):
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
