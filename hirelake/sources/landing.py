"""Landing files, staging loads and plain sinks."""

from __future__ import annotations

import logging
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from hirelake.session import remove, staged
from hirelake.sources.tables import read_or_empty, read_table, replace_parts

log = logging.getLogger(__name__)
#: The only part of a table that is replaced as a whole.
WHOLE = "all"
#: The partition column of appended batches.
BATCH = "_batch"


def land_frames(frames: dict[str, DataFrame], base: str, ingest_time: datetime) -> dict[str, str]:
    """Write each frame under ``base/processed/<name>/<name>_<stamp>.parquet``.

    Rows are counted as they are written; empty frames leave a warning and no file, and are
    not in the result.
    """
    return land_counted(frames, base, ingest_time)[0]


def land_counted(frames: dict[str, DataFrame], base: str, ingest_time: datetime) -> tuple[dict[str, str], dict[str, int]]:
    """:func:`land_frames`, and the rows of every frame, empty ones included, as observed by the writes."""
    stamp = ingest_time.strftime("%Y%m%d%H%M%S")
    paths, counts = {}, {}
    for name, df in frames.items():
        path = f"{base.rstrip('/')}/processed/{name}/{name}_{stamp}.parquet"
        counted = Observation(f"landed-{name}")
        df.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
        counts[name] = counted.get["rows"]
        if not counts[name]:
            log.warning("nothing to land for %s", name)
            remove(df.sparkSession, path)
            continue
        paths[name] = path
    if not paths:
        raise ValueError("no frame had rows to land")
    return paths, counts


def read_landed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Landed Parquet with a declared schema.

    Files written by other tools may carry nanosecond timestamps; a session set up by
    :func:`hirelake.session.configure` takes them as bigint, which is what the staging schema declares.
    """
    return spark.read.schema(schema).parquet(path)


def load_staging(spark: SparkSession, path: str, schema: str, table_path: str) -> DataFrame:
    """Replace a staging table by the landed files and return it."""
    replace(read_landed(spark, path, schema), table_path)
    return read_table(spark, table_path, schema)


def replace(df: DataFrame, path: str) -> None:
    """Truncate and reload in one step: until all rows are written, readers (``tables.read_table``) see the old ones."""
    replace_parts(df.sparkSession, path, {WHOLE: df})


def replace_table(df: DataFrame, table: str) -> None:
    """CREATE OR REPLACE TABLE AS SELECT on a catalog table of Parquet files.

    The rows are written to a folder of their own before the catalog entry is moved there, so a reload that fails leaves the old
    table, and the old files stay for readers that have begun. Only where the columns change is the old entry dropped first.
    """
    spark = df.sparkSession
    folder = f"{_place(spark, table)}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    if spark.catalog.tableExists(table):
        if [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in df.schema]:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")
    spark.catalog.createTable(table, path=folder, source="parquet", schema=df.schema)


def _place(spark: SparkSession, table: str) -> str:
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table.replace('.', '/')}-versions"


def append(df: DataFrame, path: str, max_records_per_file: int = 0, batch: str | None = None) -> None:
    """Append rows; files hold at most ``max_records_per_file`` rows if it is set.

    A named ``batch`` is a partition of its own, written as a whole: appending it again replaces what it wrote before, so
    a retry adds nothing twice. Other batches stay as they are. Without a name, the rows get one of their own.
    """
    named = df.withColumn(BATCH, F.lit(batch or uuid.uuid4().hex))
    writer = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH)
    writer.option("maxRecordsPerFile", max_records_per_file).parquet(path)


def read_appended(spark: SparkSession, path: str, schema: str, without: str | None = None) -> DataFrame:
    """All appended rows, or those of all batches but one; empty if nothing was appended."""
    rows = read_or_empty(spark, path, f"{schema}, {BATCH} string")
    return (rows if without is None else rows.filter(F.col(BATCH) != without)).drop(BATCH)


def replace_if_any(df: DataFrame, path: str) -> bool:
    """Replace the content of ``path`` unless ``df`` is empty; tells whether it wrote."""
    with staged(df, "replacement") as rows:
        if rows.isEmpty():
            return False
        replace(rows, path)
    return True
