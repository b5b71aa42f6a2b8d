"""Landed files as a stream: each new file is applied once to the star schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from hirelake import schemas
from hirelake.plans.star import load_star

FRAMES = {
    "jobs": schemas.STAGING_JOBS,
    "jobstats": schemas.STAGING_JOBSTATS,
    "companies": schemas.STAGING_COMPANIES,
    "categories": schemas.STAGING_CATEGORIES,
    "locations": schemas.STAGING_LOCATIONS,
}


def apply_new_files(
    spark: SparkSession,
    landing: str,
    schema: str,
    apply: Callable[[DataFrame, str], None],
    checkpoint: str,
    max_files: int | None = None,
) -> StreamingQuery:
    """Apply the files that are new under ``landing``, then stop.

    ``checkpoint`` remembers which files are done. A micro-batch that fails is
    repeated as a whole under the same name, the second argument of ``apply``, which must give
    the same table when run twice; ``merge_into`` does with that name as its ``batch``.
    """
    reader = spark.readStream.schema(schema).format("parquet").option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def on_batch(batch: DataFrame, number: int) -> None:
        apply(batch, f"{checkpoint}#{number}")

    query = (
        reader.load(landing).writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def update_star(
    spark: SparkSession, landing: str, tables: str, checkpoint: str, key_mode: str = "uuid",
    buckets: int | dict[str, int] | None = None, load: Callable[..., object] = load_star,
) -> None:
    """Apply newly landed frames (``landing/processed/<name>``) to the star schema: one stream over all of them.

    A micro-batch holds the new files of all frames; they are told apart by their path, read with the schema of their frame and
    merged dimensions first, so a new job finds its keys whichever file was listed first. A batch that fails between two
    frames is applied again as a whole under the same name, which gives the same tables.
    """

    def on_batch(batch: DataFrame, number: int) -> None:
        # The names of the new files; only the paths are read here.
        found = [row["file"] for row in batch.select("file").distinct().collect()]
        frames = {}
        for name, schema in FRAMES.items():
            own = [file for file in found if f"/processed/{name}/" in file]
            if own:
                frames[name] = batch.sparkSession.read.schema(schema).parquet(*own)
        if frames:
            load(batch.sparkSession, frames, tables, key_mode, buckets, f"{checkpoint}#{number}")

    reader = spark.readStream.schema("job_id string").format("parquet").option("recursiveFileLookup", "true")
    try:
        files = reader.load(f"{landing.rstrip('/')}/processed").select(F.col("_metadata.file_path").alias("file"))
        query = files.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":  # nothing has been landed yet
            raise
