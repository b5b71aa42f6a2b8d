"""Posting pages: JSON files with a ``results`` array, in landed folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hirelake import schemas
from hirelake.session import stage


def read_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Postings of all pages under ``path``; a page that cannot be parsed gives none.

    ``multi_line`` reads files that hold one pretty-printed page each instead of
    one page per line.
    """
    pages = (
        spark.read.schema(schemas.PAGE)
        .json(path, mode="PERMISSIVE", multiLine=multi_line)
    )
    return explode_pages(pages)


def parse_pages(pages: DataFrame, text: str) -> DataFrame:
    """Replace a page's JSON text column by its ``results`` array."""
    parsed = F.from_json(text, schemas.PAGE, {"mode": "PERMISSIVE"})
    return pages.withColumn("results", parsed["results"]).drop(text)


def explode_pages(pages: DataFrame) -> DataFrame:
    """One row per posting; missing, null and empty ``results`` give none. Repeats stay."""
    keep = [c for c in pages.columns if c != "results"]
    return pages.select(*keep, F.inline("results"))


def split_pages(spark: SparkSession, path: str, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """The postings of :func:`read_pages` that have an id, and what was left out: ``file``, ``line`` (its text), ``reason``.

    The files are read and parsed once, into staged rows from which both results come. Reasons are ``malformed`` (no JSON, or a part that
    does not fit the schema), ``no results`` (the array is missing or null) and ``no id`` (``line`` is then the posting).
    A page with an empty array is a good one. Every line but blank ones is in one of the two or is such a page.
    """
    broken = "_corrupt_record"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken}
    lines = spark.read.text(path, wholetext=multi_line).filter("trim(value) != ''")
    parsed = F.from_json("value", f"{schemas.PAGE}, {broken} string", options).alias("page")
    pages = lines.select(F.col("_metadata.file_path").alias("file"), "value", parsed)
    reason = F.when(F.col(f"page.{broken}").isNotNull(), "malformed").when(F.col("page.results").isNull(), "no results")
    pages = stage(pages.select(
        "file", F.when(reason.isNotNull(), F.col("value")).alias("line"), reason.alias("reason"),
        F.when(reason.isNull(), F.col("page.results")).alias("results")), "pages")
    good = pages.filter("reason IS NULL").select("file", F.explode("results").alias("posting"))
    keyless = good.filter("posting.id IS NULL").select(
        "file", F.coalesce(F.to_json("posting"), F.lit("null")).alias("line"), F.lit("no id").alias("reason"))
    bad = pages.filter("reason IS NOT NULL").select("file", "line", "reason")
    return good.filter("posting.id IS NOT NULL").select("posting.*"), bad.unionByName(keyless)
