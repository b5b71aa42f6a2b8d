"""Enrichment of jobs from structured responses (JSON text) and vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hirelake.functions.text import is_blank
from hirelake.functions.vectors import zero_vector
from hirelake.session import stage


def unprocessed(jobs: DataFrame, done: DataFrame, key: str = "job_id", done_key: str | None = None) -> DataFrame:
    """Jobs with a key not in ``done``; a null key is never found there, so it stays."""
    keys = done.select(F.col(done_key or key).alias(key)).distinct()
    return jobs.join(keys, key, "left_anti")


def pending(jobs: DataFrame, done: DataFrame, key: str = "job_id", done_key: str | None = None) -> DataFrame:
    """:func:`unprocessed` for wide jobs: the keys are compared first, the texts are fetched after.

    The open keys are staged, so their real size is known. When they are few, as
    in a daily run, Spark broadcasts them and the job texts are only filtered.
    """
    ids = jobs.select(key).filter(F.col(key).isNotNull()).distinct()
    open_ids = stage(unprocessed(ids, done, key, done_key), "open-keys")
    keyless = jobs.filter(F.col(key).isNull())
    return jobs.join(open_ids, key, "left_semi").unionByName(keyless)


def add_keys(df: DataFrame, table: str, key: str = "job_id", buckets: int = 64) -> None:
    """Add the distinct keys of ``df`` to a catalog table that is cut into hash buckets of the key; null keys are left out.

    The bucket count is that of the first call for a table. Tables that are to be compared need the same one.
    """
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    keys.write.mode("append").format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def open_keys(spark: SparkSession, table: str, done: str, key: str = "job_id") -> DataFrame:
    """Distinct keys of one table of :func:`add_keys` that another one does not have.

    Both are read bucket by bucket and compared where they are read, so neither side is exchanged, whatever their size. A key that
    was added several times is one row.
    """
    return spark.table(table).select(key).distinct().join(spark.table(done).select(key), key, "left_anti")


def _texts(parsed: str, key: str) -> Column:
    """A list of texts; a plain value counts as a list of one, an object or nothing as an empty one."""
    listed = F.try_variant_get(parsed, f"$.{key}", "array<string>")
    plain = F.when(~F.schema_of_variant(F.coalesce(F.try_variant_get(parsed, f"$.{key}", "variant"), F.parse_json(F.lit("{}")))).rlike("^(OBJECT|ARRAY|VOID)"),
                   F.try_variant_get(parsed, f"$.{key}", "string"))
    return F.coalesce(listed, F.array_compact(F.array(plain)))


def _whole_number(parsed: str, key: str) -> Column:
    """A number or a number written as text, cut to a whole one; null for anything else."""
    return F.try_variant_get(parsed, f"$.{key}", "string").try_cast("double").try_cast("int")


def parse_responses(responses: DataFrame, processed_at: Column) -> DataFrame:
    """Enrichment records of the responses that are JSON objects; any other text gives no
    row, so its job is tried again in the next run.

    Fields are read one by one: a missing, null or unusable array becomes empty, such a
    scalar null, and the rest of the record stays.
    """
    parsed = responses.select("job_id", F.try_parse_json("response").alias("r")).filter(F.schema_of_variant("r").startswith("OBJECT"))
    return parsed.select(
        "job_id",
        _texts("r", "skills").alias("extracted_skills"),
        _whole_number("r", "years_min").alias("years_experience_min"),
        _whole_number("r", "years_max").alias("years_experience_max"),
        F.try_variant_get("r", "$.education", "string").alias("education_level"),
        _texts("r", "benefits").alias("benefits"),
        _texts("r", "tech_stack").alias("tech_stack"),
        processed_at.alias("processed_at"),
    )


def embedding_rows(vectors: DataFrame, model_name: str, created_at: Column) -> DataFrame:
    """Embedding records of the jobs that have a vector."""
    return vectors.filter("vector IS NOT NULL").select(
        "job_id",
        F.col("vector").cast("array<double>").alias("embedding_vector"),
        F.lit(model_name).alias("model_name"),
        created_at.alias("created_at"),
    )


def guard_blank(text: Column, vector: Column, size: int = 3072) -> Column:
    """The vector, or zeros where the text is blank."""
    return F.when(is_blank(text), zero_vector(size)).otherwise(vector)
