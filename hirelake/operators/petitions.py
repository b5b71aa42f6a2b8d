"""Visa petition counts and the sponsorship status of employers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from hirelake.functions.times import null_aware_greatest
from hirelake.operators.upsert import upsert

INITIAL = ["new_employment", "new_concurrent", "change_of_employer"]
CONTINUING = ["continuation", "change_with_same_employer", "amended"]


def _total(kinds: list[str], outcome: str) -> Column:
    """Sum of counters, a missing one counting as zero."""
    return reduce(Column.__add__, [F.coalesce(f"{kind}_{outcome}", F.lit(0)) for kind in kinds])


def zip_text(code: Column, pad: bool = False) -> Column:
    """Zip code stored as a float, as text; ``pad`` restores leading zeros."""
    text = code.cast("bigint").cast("string")
    return F.lpad(text, 5, "0") if pad else text


def clean_petitions(raw: DataFrame, pad_zip: bool = False) -> DataFrame:
    return raw.select(
        "fiscal_year",
        F.col("employer_petitioner_name").alias("employer_name"),
        F.col("industry_naics_code").alias("naics_code"),
        F.col("petitioner_city").alias("city"),
        F.col("petitioner_state").alias("state"),
        zip_text(F.col("petitioner_zip_code"), pad_zip).alias("zip_code"),
        _total(INITIAL, "approval").alias("total_initial_approvals"),
        _total(INITIAL, "denial").alias("total_initial_denials"),
        _total(CONTINUING, "approval").alias("total_continuing_approvals"),
        _total(CONTINUING, "denial").alias("total_continuing_denials"),
    )


def sponsorship_batch(raw: DataFrame) -> DataFrame:
    """One row per employer: latest year, and whether any petition was approved."""
    approved = _total(INITIAL + CONTINUING, "approval") > 0
    return (
        raw.select(F.col("employer_petitioner_name").alias("employer_name"), "fiscal_year",
                   approved.alias("approved"))
        .groupBy("employer_name")
        .agg(F.max("fiscal_year").alias("fiscal_year"), F.bool_or("approved").alias("is_sponsor"))
    )


def merge_sponsorship(status: DataFrame, batch: DataFrame, unique_source: bool = False) -> DataFrame:
    """Upsert a batch: a sponsor stays a sponsor, the year only grows (null if either is null).

    ``unique_source`` says that the batch has one row per employer, as :func:`sponsorship_batch` gives it.
    """
    source = batch.select(
        "employer_name",
        F.col("is_sponsor").alias("ever_sponsored_h1b"),
        F.col("fiscal_year").alias("last_updated_fiscal_year"),
    )
    rules = {
        "ever_sponsored_h1b": lambda old, new: F.when(old | new, True).otherwise(old),
        "last_updated_fiscal_year": null_aware_greatest,
    }
    return upsert(status, source, ["employer_name"], rules=rules, unique_source=unique_source)
