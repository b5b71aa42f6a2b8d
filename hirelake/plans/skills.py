"""Skill extraction, the skills dimension and the job-skill bridge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hirelake import schemas
from hirelake.functions.tagging import tag_phrases
from hirelake.functions.text import experience
from hirelake.operators import marts
from hirelake.operators.dictionary import tag_with
from hirelake.operators.enrichment import pending, unprocessed
from hirelake.operators.upsert import insert_new
from hirelake.session import staged
from hirelake.sources.landing import append, read_appended, replace
from hirelake.sources.tables import BUCKET, merge_into, read_table, refresh_derived


def skill_rows(
    jobs: DataFrame,
    phrases: list[str] | DataFrame,
    extraction_date: Column,
    model_version: str,
    tokenize_dictionary: bool = False,
) -> DataFrame:
    """One row per distinct item of a job: dictionary phrases, and years of experience.

    A list of phrases rides along in the plan; a table of them (column ``phrase``) is joined with and may be of any
    size. Jobs are then told apart by their id, so rows without one only have their years.
    """
    described = jobs.select("job_id", "description").filter("description IS NOT NULL")
    years = F.concat(experience(F.col("description")), F.lit(" years experience"))
    if isinstance(phrases, DataFrame):
        found = tag_with(described, "job_id", "description", phrases, tokenize_dictionary)
        stated = described.select("job_id", years.alias("phrase")).filter("phrase IS NOT NULL")
        return found.unionByName(stated).distinct().select(
            F.col("job_id").alias("source_job_id"), F.col("phrase").alias("skill_name"),
            extraction_date.alias("extraction_date"), F.lit(model_version).alias("model_version"))
    tagged = tag_phrases(described, "description", phrases, "skills", tokenize_dictionary)
    items = F.array_union("skills", F.array_compact(F.array(years)))
    return tagged.select(
        F.col("job_id").alias("source_job_id"),
        F.explode(items).alias("skill_name"),
        extraction_date.alias("extraction_date"),
        F.lit(model_version).alias("model_version"),
    )


def merge_skills(target: DataFrame, job_skills: DataFrame, key_mode: str = "uuid") -> DataFrame:
    return insert_new(target, job_skills.select("skill_name"), ["skill_name"], "skill_id", key_mode)


def bridge_source(job_skills: DataFrame, skills: DataFrame) -> DataFrame:
    """Distinct (job, skill id) links of the raw extraction."""
    return (
        job_skills.filter("source_job_id IS NOT NULL")
        .join(skills.select("skill_id", "skill_name"), "skill_name")
        .select(F.col("source_job_id").alias("job_id"), "skill_id").distinct()
    )


def merge_bridge(target: DataFrame, links: DataFrame) -> DataFrame:
    return insert_new(target, links, ["job_id", "skill_id"])


def extract_skills(
    spark: SparkSession,
    tables: str,
    phrases: list[str] | DataFrame,
    extraction_date: str,
    model_version: str,
    key_mode: str = "uuid",
    buckets: int | None = None,
    tokenize_dictionary: bool = False,
    batch: str | None = None,
) -> None:
    """Tag the jobs not tagged yet, then refresh the dimension, the bridge and the marts.

    A run that is retried under its ``batch`` name tags the same jobs again and replaces the rows it had stored; other runs
    need other names. Only the new rows are merged. If an earlier run broke off after it had stored its rows, their jobs
    are missing in the bridge; they are found by key and merged with the new ones.
    """
    base = tables.rstrip("/")
    jobs = read_table(spark, f"{base}/jobs", schemas.JOBS)
    job_skills = read_appended(spark, f"{base}/job_skills", schemas.JOB_SKILLS, without=batch)
    new = pending(
        jobs.select("job_id", "description").filter("description IS NOT NULL"),
        job_skills, "job_id", "source_job_id")
    linked = read_table(spark, f"{base}/job_skills_bridge", schemas.JOB_SKILLS_BRIDGE)
    unlinked = unprocessed(job_skills.filter("source_job_id IS NOT NULL"), linked, "source_job_id", "job_id")
    with staged(unlinked.select("source_job_id", "skill_name"), "unlinked") as left, \
            staged(skill_rows(new, phrases, F.lit(extraction_date), model_version, tokenize_dictionary), "skills") as rows:
        append(rows, f"{base}/job_skills", batch=batch)
        fresh = rows.select("source_job_id", "skill_name").unionByName(left)
        merge_into(
            spark, f"{base}/skills", schemas.SKILLS,
            fresh.select("skill_name").filter("skill_name IS NOT NULL").distinct(),
            ["skill_name"], lambda t, s: merge_skills(t, s, key_mode), buckets, same=[],
        )
        skills = read_table(spark, f"{base}/skills", schemas.SKILLS)
        merge_into(
            spark, f"{base}/job_skills_bridge", schemas.JOB_SKILLS_BRIDGE,
            bridge_source(fresh, skills), ["job_id", "skill_id"], merge_bridge, buckets, same=[],
        )
    refresh_marts(spark, tables)


def refresh_marts(spark: SparkSession, tables: str) -> int:
    """Bring company presence and the category-company overlap up to date; returns how many parts of the jobs were read.

    Counts and pairs are kept per part of the jobs table. Only parts that a merge has rewritten since are read again; the
    two marts are put together from what is kept.
    """
    base = tables.rstrip("/")
    companies = read_table(spark, f"{base}/companies", schemas.COMPANIES)
    counts, presence = f"{base}/category_company_counts", f"{base}/presence_by_part"
    read = refresh_derived(spark, f"{base}/jobs", schemas.JOBS, counts, lambda jobs: marts.part_counts(jobs, BUCKET))
    refresh_derived(spark, f"{base}/jobs", schemas.JOBS, presence, lambda jobs: marts.part_presence(jobs, BUCKET))
    replace(read_table(spark, presence, schemas.COMPANY_PRESENCE).distinct(), f"{base}/company_presence")
    replace(marts.overlap_of_parts(read_table(spark, counts, schemas.PART_COUNTS), companies), f"{base}/category_industry_overlap")
    return read
