"""Petition reload, sponsorship status, and the companies that sponsor."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hirelake import schemas
from hirelake.operators.matching import name_mapping, sponsor_companies
from hirelake.operators.petitions import clean_petitions, merge_sponsorship, sponsorship_batch
from hirelake.sources.landing import replace, replace_if_any
from hirelake.sources.tables import merge_into, read_table


def load_petitions(
    spark: SparkSession, raw: DataFrame, tables: str, pad_zip: bool = False, buckets: int | None = None
) -> None:
    """Reload the cleaned petitions, then merge the batch into the sponsorship status."""
    base = tables.rstrip("/")
    replace(clean_petitions(raw, pad_zip), f"{base}/h1b_petitions")
    merge_into(
        spark, f"{base}/company_sponsorship_status", schemas.SPONSORSHIP_STATUS,
        sponsorship_batch(raw), ["employer_name"], lambda t, s: merge_sponsorship(t, s, unique_source=True), buckets,
    )


def match_sponsors(spark: SparkSession, tables: str, drop_empty_keys: bool = False) -> None:
    """Rebuild the name mapping and the sponsor companies.

    Without any match the mapping keeps its last content.
    """
    base = tables.rstrip("/")
    companies = read_table(spark, f"{base}/companies", schemas.COMPANIES)
    status = read_table(spark, f"{base}/company_sponsorship_status", schemas.SPONSORSHIP_STATUS)
    path = f"{base}/temp_name_mapping"
    replace_if_any(name_mapping(companies, status, drop_empty_keys), path)
    mapping = read_table(spark, path, schemas.NAME_MAPPING)
    replace(sponsor_companies(companies, mapping, status), f"{base}/sponsor_companies")
