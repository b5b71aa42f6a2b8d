"""Arrow-batch plumbing shared by the operators: choosing columns, keeping whole rows, casting ids."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows sent to Python and handed on at once, so that a batch of long texts stays small.
ROWS = 1000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def map_texts(df: DataFrame, columns: dict[str, Column], schema: str,
              function: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]]) -> DataFrame:
    """``function`` over Arrow batches of the named expressions only, at most :data:`ROWS` rows each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(small(batches))

    return df.select(*[expression.alias(name) for name, expression in columns.items()]).mapInArrow(run, schema)


def small(batches: Iterable[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def whole_row(df: DataFrame) -> Column:
    """All columns of a row as one struct, so that no name clashes with an operator's own."""
    return F.struct(*[df[name] for name in df.columns])


def with_texts(df: DataFrame, text_col: str, kept: dict[str, Column]) -> tuple[dict[str, Column], Callable[[pa.RecordBatch], pa.Array]]:
    """The columns to send, and how to get the texts out of a batch.

    If a :func:`whole_row` is kept as ``row``, the text is taken from there, so that it is sent once.
    """
    if "row" in kept:
        place = list(kept).index("row")
        return kept, lambda batch: batch.column(place).field(text_col)
    after = len(kept)
    return kept | {"text": text_of(df, text_col)}, lambda batch: batch.column(after)


def text_of(df: DataFrame, name: str) -> Column:
    """The text column; null becomes the empty text."""
    return F.coalesce(df[name].cast("string"), F.lit(""))


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this library from where the driver has it.

    For sessions that were started elsewhere on the same machine; on a cluster the library is
    installed or sent with ``--py-files``, and a folder that is not there does no harm. Also
    lowers the rows of an Arrow batch to :data:`ROWS` for the session, if it has Spark's default.
    """
    if spark.conf.get(BATCH_SETTING) == "10000":
        spark.conf.set(BATCH_SETTING, str(ROWS))
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join([root, *filter(None, paths)])
    return spark
