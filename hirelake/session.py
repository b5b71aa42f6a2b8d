"""Session helpers: settings, the shared scratch folder and staging."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

#: A side of a join with at most so many rows is broadcast; it should have a few short columns (some 100 bytes a row).
BROADCAST_ROWS = 500_000


def configure(spark: SparkSession) -> SparkSession:
    """Settings the library relies on; all of them can be changed at run time.

    Nanosecond timestamps of files that other tools wrote are read as bigint, also in streams.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a ``local`` session, where driver and executors are one process, falls
    back to a temporary folder; elsewhere a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if folder is None:
        folder = context.getCheckpointDir()
    if folder is None:
        if context.master.startswith("local-cluster") or not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="hirelake-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_folder(spark: SparkSession) -> str:
    """The folder of all staged copies of this application."""
    return f"{shared_folder(spark).rstrip('/')}/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under :func:`scratch_folder`."""
    return f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, location: str) -> None:
    """Delete a folder, in whatever file system it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def files(spark: SparkSession, location: str) -> list[str]:
    """Names of the files and folders in a folder, none if there is no such folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in system.listStatus(path)] if system.exists(path) else []


def read_text(spark: SparkSession, location: str) -> str:
    """A small text file."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_once(spark: SparkSession, location: str, text: str) -> bool:
    """Make a small file appear whole, and only if there is none of its name; tells whether it did.

    The text is written under a name of its own. What then gives it its name fails if that is taken, in one step of
    the file system: a hard link on local files, a rename without overwriting elsewhere.
    """
    fs = spark._jvm.org.apache.hadoop.fs
    final, own = fs.Path(location), fs.Path(f"{location}.{uuid.uuid4().hex}.tmp")
    system = own.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = system.create(own, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if system.getScheme() == "file":
            local = spark._jvm.java.nio.file.Paths
            spark._jvm.java.nio.file.Files.createLink(
                local.get(system.makeQualified(final).toUri().getPath(), _none(spark)),
                local.get(system.makeQualified(own).toUri().getPath(), _none(spark)))
        else:
            options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
            fs.FileContext.getFileContext(own.toUri(), spark._jsc.hadoopConfiguration()).rename(own, final, options)
        return True
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    finally:
        system.delete(own, False)


def _none(spark: SparkSession):
    return spark.sparkContext._gateway.new_array(spark._jvm.java.lang.String, 0)


def clean_scratch(spark: SparkSession) -> None:
    """Delete all staged copies of this application; frames that were not written yet are lost."""
    remove(spark, scratch_folder(spark))


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a scan of it.

    Used where one result feeds several branches of a plan: the branches then
    read only the columns they need, Spark knows the real size when it picks a
    join strategy, and random keys are drawn once. A lost executor costs only a
    re-read, because the files outlive it.
    """
    return _write(df, scratch_path(df.sparkSession, label))


def broadcast_few(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` with the hint to broadcast it if it has at most :data:`BROADCAST_ROWS` rows, which are counted.

    For sides that are small but that Spark expects to be large: its estimate for a join is the product of the sizes.
    """
    limit = BROADCAST_ROWS if rows is None else rows
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """:func:`stage` for the length of a ``with`` block; the files go at its end."""
    spark = df.sparkSession
    location = scratch_path(spark, label)
    try:
        yield _write(df, location)
    finally:
        remove(spark, location)
