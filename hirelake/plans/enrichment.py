"""Incremental enrichment of jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from hirelake import schemas
from hirelake.functions.text import prompt_text
from hirelake.operators.enrichment import embedding_rows, parse_responses, pending
from hirelake.session import staged
from hirelake.sources.landing import append, read_appended
from hirelake.sources.tables import read_table

Responder = Callable[[DataFrame], DataFrame]


def jobs_to_enrich(jobs: DataFrame, done: DataFrame) -> DataFrame:
    """Described jobs without a record in ``done``, with the text to enrich."""
    described = jobs.select("job_id", "title", "description").filter("description IS NOT NULL")
    return pending(described, done).select(
        "job_id", prompt_text(F.col("title"), F.col("description")).alias("job_text")
    )


def enrich_jobs(
    spark: SparkSession,
    tables: str,
    respond: Responder,
    embed: Responder,
    model_name: str,
    processed_at: str,
    chunk: int = 500_000,
    batch: str | None = None,
) -> str:
    """Enrich and embed the jobs that lack a record, each output on its own.

    ``respond`` turns (job_id, job_text) into (job_id, response), ``embed`` into
    (job_id, vector): a join with a table of stored answers, or a
    ``mapInPandas`` call. Either may leave jobs out; these are tried again in
    the next run, without repeating the other output. A run that is retried under its ``batch`` name
    asks for its jobs again and replaces what it had stored; other runs need other names.
    """
    base = tables.rstrip("/")
    jobs = read_table(spark, f"{base}/jobs", schemas.JOBS)
    at = F.lit(processed_at)
    outputs = {
        "job_enrichment": (
            schemas.JOB_ENRICHMENT, lambda todo: parse_responses(respond(todo), at)),
        "job_embeddings": (
            schemas.JOB_EMBEDDINGS, lambda todo: embedding_rows(embed(todo), model_name, at)),
    }
    written = {}
    for name, (schema, build) in outputs.items():
        path = f"{base}/{name}"
        todo = jobs_to_enrich(jobs, read_appended(spark, path, schema, without=batch))
        # Staged, so that a costly response function runs once.
        with staged(build(todo), name) as rows:
            written[name] = rows.count()
            if written[name]:
                append(rows, path, chunk, batch)
    if not any(written.values()):
        return "No new jobs."
    return "Wrote " + ", ".join(f"{n} rows to {name}" for name, n in written.items()) + "."
