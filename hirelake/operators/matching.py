"""Employer matching by normalised name."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hirelake.functions.text import normalize_company


def name_mapping(
    companies: DataFrame, status: DataFrame, drop_empty_keys: bool = False
) -> DataFrame:
    """One employer per company whose normalised names agree, the smallest name on ties.

    Employers are reduced to one per normalised name before the join, so a name
    shared by many on both sides gives no pairs to throw away again.
    ``drop_empty_keys`` keeps names that normalise to '' from matching.
    """
    left = (
        companies.select("company_name").dropna().distinct()
        .withColumn("clean_name", normalize_company(F.col("company_name")))
    )
    right = (
        status.select("employer_name").dropna()
        .withColumn("clean_name", normalize_company(F.col("employer_name")))
    )
    if drop_empty_keys:
        left, right = (d.filter("clean_name <> ''") for d in (left, right))
    right = right.groupBy("clean_name").agg(F.min("employer_name").alias("employer_name"))
    return left.join(right, "clean_name").select("company_name", "employer_name")


def sponsor_companies(companies: DataFrame, mapping: DataFrame, status: DataFrame) -> DataFrame:
    """Companies whose matched employer has sponsored."""
    sponsors = status.filter("ever_sponsored_h1b = true")
    return (
        companies.join(mapping, "company_name")
        .join(sponsors, "employer_name")
        .select(
            "company_id",
            "company_name",
            F.col("employer_name").alias("h1b_official_name"),
            F.col("ever_sponsored_h1b").alias("is_sponsor"),
            "last_updated_fiscal_year",
        )
    )
