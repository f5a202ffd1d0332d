"""Files on any file system Spark knows, through Hadoop's interface."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder; none if there is no such folder."""
    p, fs = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file, complete or not at all; False if there is one already.

    The text is written beside it and given the name in one atomic step that
    fails where the name is taken: a hard link on a local disk, a rename
    without overwriting elsewhere."""
    p, fs = _path(spark, path)
    fs.mkdirs(p.getParent())
    temporary = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}-{uuid.uuid4().hex}")
    stream = fs.create(temporary, False)
    stream.write(text.encode())
    stream.close()
    try:
        if fs.getScheme() == "file":
            files = spark._jvm.java.nio.file.Paths
            files_of = lambda x: files.get(spark._jvm.java.net.URI.create("file://" + x.toUri().getPath().replace(" ", "%20")))
            spark._jvm.java.nio.file.Files.createLink(files_of(p), files_of(temporary))
        else:
            context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsparkSession.sessionState().newHadoopConf())
            none = spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
            options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = none
            context.rename(temporary, p, options)
        return True
    except Exception as e:  # noqa: BLE001 - the class depends on the file system
        if fs.exists(p) and "AlreadyExists" in f"{type(e).__name__} {e}":
            return False
        raise
    finally:
        fs.delete(temporary, False)


def scratch(spark: SparkSession) -> str:
    """A new folder on shared storage (the cluster's checkpoint folder, else the
    warehouse), deleted when the program ends."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{root.rstrip('/')}/revspine-{uuid.uuid4().hex}"

    def clean():
        with contextlib.suppress(Exception):  # the JVM may be gone
            delete(spark, folder)

    atexit.register(clean)
    return folder
