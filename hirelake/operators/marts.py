"""Tables derived from the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hirelake.operators.dedup import top_per_group
from hirelake.session import stage


def company_presence(jobs: DataFrame) -> DataFrame:
    """Distinct (company, location) pairs with both sides known."""
    pair = ["company_id", "location_id"]
    return jobs.select(*pair).dropna(how="any").distinct()


def category_company_counts(jobs: DataFrame, companies: DataFrame) -> DataFrame:
    """Distinct jobs per (category, company name)."""
    named = (
        jobs.select("job_id", "category_label", "company_id")
        .filter("category_label IS NOT NULL AND company_id IS NOT NULL")
        .join(companies.select("company_id", "company_name"), "company_id")
        .filter("company_name IS NOT NULL")
    )
    return named.groupBy("category_label", "company_name").agg(
        F.count_distinct("job_id").alias("count")
    )


def part_counts(jobs: DataFrame, part: str) -> DataFrame:
    """Distinct jobs per part, category and company id; a job's rows must be in one part."""
    known = jobs.select(part, "job_id", "category_label", "company_id").filter("category_label IS NOT NULL AND company_id IS NOT NULL")
    return known.groupBy(part, "category_label", "company_id").agg(F.count_distinct("job_id").alias("jobs"))


def part_presence(jobs: DataFrame, part: str) -> DataFrame:
    """Distinct (company, location) pairs per part."""
    return jobs.select(part, "company_id", "location_id").dropna(how="any", subset=["company_id", "location_id"]).distinct()


def category_overlap(jobs: DataFrame, companies: DataFrame, top: int = 5) -> DataFrame:
    """Per category: its ``top`` companies by job count, and the sum of all counts."""
    return overlap_of(category_company_counts(jobs, companies), top)


def overlap_of_parts(counts: DataFrame, companies: DataFrame, top: int = 5) -> DataFrame:
    """:func:`category_overlap` from the :func:`part_counts` of all parts."""
    named = counts.join(companies.select("company_id", "company_name"), "company_id").filter("company_name IS NOT NULL")
    return overlap_of(named.groupBy("category_label", "company_name").agg(F.sum("jobs").alias("count")), top)


def overlap_of(counts: DataFrame, top: int = 5) -> DataFrame:
    """The overlap from the number of jobs (``count``) per category and company name.

    The array is built from at most ``top`` rows; the rest of a category only
    ever meets in a partial sum. The counts feed both and are written once.
    """
    counts = stage(counts, "overlap-counts")
    totals = counts.groupBy("category_label").agg(F.sum("count").alias("total_jobs"))
    leaders = top_per_group(
        counts, ["category_label"], [F.desc("count"), F.asc("company_name")], top
    )
    entry = F.struct("rank", "company_name", "count")
    lists = leaders.groupBy("category_label").agg(
        F.transform(
            F.array_sort(F.collect_list(entry)),
            lambda e: F.struct(e["company_name"].alias("company_name"), e["count"].alias("count")),
        ).alias("top_companies")
    )
    return (
        totals.join(lists, "category_label")
        .select("category_label", "top_companies", "total_jobs")
    )


def by_total(overlap: DataFrame) -> DataFrame:
    """Reading order of the overlap table: largest category first."""
    return overlap.orderBy(F.desc("total_jobs"), F.asc("category_label"))


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One (table, rows) line per frame, by counting each."""
    report = None
    for name, df in frames.items():
        line = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        report = line if report is None else report.unionByName(line)
    return report


def counted_rows(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """The same report from numbers that were taken while the frames were written (``landing.land_counted``)."""
    return spark.createDataFrame(list(counts.items()), "table string, rows bigint")
