"""Postings to star schema, and the merges that keep the star schema current."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from hirelake import schemas
from hirelake.functions.times import (
    iso_text, nanos_to_timestamp, parse_created, posting_week, timestamp_to_nanos,
)
from hirelake.operators.dedup import latest_per_key
from hirelake.operators.lookup import lookup
from hirelake.operators.upsert import insert_new, upsert
from hirelake.session import stage
from hirelake.sources.tables import merge_into, read_table

# Columns of a known job that a later posting does not change.
FROZEN = ["redirected_url", "ingest_data"]


def flatten(postings: DataFrame) -> DataFrame:
    """Postings with company, category and location parts as plain columns."""
    area = F.col("location.area")
    return postings.select(
        F.col("id").alias("job_id"), "title", "description", "salary_min", "salary_max",
        "created", "redirect_url", "contract_type", "contract_time",
        F.col("company.display_name").alias("company_name"),
        F.col("category.label").alias("category_label"),
        F.get(area, F.lit(2)).alias("city"),
        F.get(area, F.lit(1)).alias("state"),
        F.get(area, F.lit(0)).alias("country"),
    )


def _filled(column: str):
    return F.coalesce(column, F.lit("")) != ""


def build_star(postings: DataFrame, ingest_time: datetime) -> dict[str, DataFrame]:
    """The five frames of the star schema, from one pass over the postings, which are staged flat."""
    return star_frames(stage(flatten(postings), "postings"), ingest_time)


def star_frames(flat: DataFrame, ingest_time: datetime) -> dict[str, DataFrame]:
    """The five frames of flat postings: two facts and three distinct dimensions."""
    moment = F.lit(ingest_time).cast("timestamp")
    jobs = flat.select(
        "job_id", "title", "description", "salary_min", "salary_max",
        timestamp_to_nanos(parse_created(F.col("created"))).alias("created"),
        F.col("redirect_url").alias("redirected_url"),
        iso_text(moment).alias("ingest_data"),
        timestamp_to_nanos(moment).alias("ingest_ts"),
        "company_name", "category_label", "city", "state",
    )
    jobstats = flat.select(
        "job_id", "contract_type", "contract_time",
        posting_week(F.col("created")).alias("posting_week"),
    )
    return {
        "jobs": jobs,
        "jobstats": jobstats,
        "companies": flat.filter(_filled("company_name")).select("company_name").distinct(),
        "locations": flat.filter(_filled("city") | _filled("state"))
        .select("city", "state", "country").distinct(),
        "categories": flat.filter(_filled("category_label")).select("category_label").distinct(),
    }


def merge_companies(target: DataFrame, staging: DataFrame, key_mode: str = "uuid") -> DataFrame:
    return insert_new(target, staging, ["company_name"], "company_id", key_mode)


def merge_categories(target: DataFrame, staging: DataFrame, key_mode: str = "uuid") -> DataFrame:
    return insert_new(target, staging, ["category_label"], "category_id", key_mode)


def merge_locations(target: DataFrame, staging: DataFrame, key_mode: str = "uuid") -> DataFrame:
    return insert_new(
        target, staging, ["city", "state", "country"], "location_id", key_mode, blank_is_null=True
    )


def latest_jobs(staging_jobs: DataFrame) -> DataFrame:
    """The newest staging row per job."""
    return latest_per_key(staging_jobs, ["job_id"], "ingest_ts")


def with_dimension_keys(
    jobs: DataFrame, companies: DataFrame, categories: DataFrame, locations: DataFrame
) -> DataFrame:
    """Add company, category and location ids; null where the dimension has no such row."""
    jobs = lookup(jobs, companies, ["company_name"], "company_id")
    jobs = lookup(jobs, categories, ["category_label"], "category_id")
    return lookup(
        jobs, locations, ["city", "state"], "location_id", blank_is_null=True, prefer=["country"]
    )


def jobs_source(
    staging_jobs: DataFrame, companies: DataFrame, categories: DataFrame, locations: DataFrame
) -> DataFrame:
    """Source of the jobs merge: one row per job, timestamps decoded, ids looked up.

    Rows are reduced to one per job before the lookups, so these move the fewest rows.
    """
    latest = latest_jobs(staging_jobs).withColumns({
        "created": nanos_to_timestamp(F.col("created")),
        "ingest_ts": nanos_to_timestamp(F.col("ingest_ts")),
    })
    return with_dimension_keys(latest, companies, categories, locations)


def merge_jobs(target: DataFrame, source: DataFrame, unique_source: bool = False) -> DataFrame:
    """Upsert of :func:`jobs_source` rows; link and first ingest text of a known job stay.

    ``unique_source`` says that the source has one row per job, as :func:`jobs_source` gives it.
    """
    return upsert(target, source, ["job_id"], frozen=FROZEN, unique_source=unique_source)


def merge_jobstats(target: DataFrame, staging: DataFrame, deduplicate: bool = True) -> DataFrame:
    """Upsert by job. Without ``deduplicate``, a job with several source rows is an error."""
    source = latest_per_key(staging, ["job_id"]) if deduplicate else staging
    return upsert(target, source, ["job_id"], unique_source=deduplicate)


def merge_skill_catalogue(target: DataFrame, staging: DataFrame) -> DataFrame:
    """Upsert of the full skill catalogue by skill id."""
    return upsert(target, staging, ["skill_id"])


def taken_over(schema: str, frozen: list[str] = ()) -> list[str]:
    """Columns of a table keyed by job that a merge takes from its source."""
    return [name for name in StructType.fromDDL(schema).names if name != "job_id" and name not in frozen]


def load_star(
    spark: SparkSession, staging: dict[str, DataFrame], tables: str, key_mode: str = "uuid",
    buckets: int | dict[str, int] | None = None, batch: str | None = None,
) -> dict[str, DataFrame]:
    """Merge staged frames into the five tables under ``tables``, dimensions before facts.

    A frame that was not landed (because it was empty) is left out. ``buckets`` is a number for all
    tables or one per table name; ``batch`` names the frames, so that a retry adds nothing twice. Rows that
    a table has already, and known dimension rows, rewrite nothing.
    """
    base = tables.rstrip("/")

    def merge_table(
        name: str, schema: str, source: DataFrame, keys: list[str], merge, blank_is_null: bool = False, same: list[str] = (),
    ) -> None:
        number = buckets.get(name) if isinstance(buckets, dict) else buckets
        merge_into(spark, f"{base}/{name}", schema, source, keys, merge, number, blank_is_null, batch=batch, same=list(same))

    dimensions = {
        "companies": (schemas.COMPANIES, ["company_name"], merge_companies),
        "categories": (schemas.CATEGORIES, ["category_label"], merge_categories),
        "locations": (schemas.LOCATIONS, ["city", "state", "country"], merge_locations),
    }
    for name, (schema, keys, merge) in dimensions.items():
        if name in staging:
            merge_table(name, schema, staging[name], keys,
                        lambda t, s, merge=merge: merge(t, s, key_mode), name == "locations")
    current = {n: read_table(spark, f"{base}/{n}", d[0]) for n, d in dimensions.items()}
    if "jobs" in staging:
        source = jobs_source(
            staging["jobs"], current["companies"], current["categories"], current["locations"]
        )
        merge_table("jobs", schemas.JOBS, source, ["job_id"], lambda t, s: merge_jobs(t, s, unique_source=True), same=taken_over(schemas.JOBS, FROZEN))
    if "jobstats" in staging:
        stats = latest_per_key(staging["jobstats"], ["job_id"])
        merge_table("jobstats", schemas.JOBSTATS, stats, ["job_id"], merge_jobstats, same=taken_over(schemas.JOBSTATS))
    return {
        **current,
        "jobs": read_table(spark, f"{base}/jobs", schemas.JOBS),
        "jobstats": read_table(spark, f"{base}/jobstats", schemas.JOBSTATS),
    }
