"""Physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from hirelake import schemas
from hirelake.functions.tagging import tag_phrases
from hirelake.operators import enrichment, marts, matching, petitions
from hirelake.operators.dedup import latest_per_key, top_per_group
from hirelake.operators.lookup import lookup
from hirelake.operators.upsert import upsert
from hirelake.session import scratch_path, stage
from hirelake.sources import tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def big(spark):
    """A stored table too large to broadcast under the small threshold of these tests."""
    path = scratch_path(spark, "big")
    spark.range(200_000).select(
        F.col("id").cast("string").alias("job_id"), F.md5(F.col("id").cast("string")).alias("description"),
        (F.col("id") % 7).cast("string").alias("category_label"), F.lit("c").alias("company_id"),
        F.lit("l").alias("location_id"), F.col("id").alias("ts"),
    ).write.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100000")
    yield spark.read.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_newest_row_is_picked_before_the_shuffle(big):
    text = plan(latest_per_key(big, ["job_id"], "ts"))
    exchange = text.index("Exchange hashpartitioning")
    assert "partial_min" in text[exchange:] and text.count("Exchange") == 1


def test_best_rows_are_picked_before_the_shuffle(big):
    text = plan(top_per_group(big, ["category_label"], [F.desc("ts")], 5))
    exchange = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[exchange:] and text.count("Exchange") == 1


def test_small_increment_leaves_the_target_unshuffled(spark, big):
    """The target goes through two broadcast joins; what is exchanged is of the increment's size."""
    rows = big.limit(10).withColumn("description", F.lit("new"))
    text = plan(upsert(big, stage(rows, "increment"), ["job_id"], unique_source=True))
    assert re.search(r"BroadcastHashJoin \[job_id#\d+\], \[job_id#\d+\], LeftOuter", text)
    assert re.search(r"BroadcastHashJoin \[job_id#\d+\], \[job_id#\d+\], LeftSemi", text)
    assert not re.search(r"SortMergeJoin .*(LeftOuter|LeftSemi)", text)


def test_key_branch_of_an_upsert_reads_only_keys(spark, big):
    text = plan(upsert(big, stage(big.limit(10), "increment"), ["job_id"], unique_source=True))
    assert re.search(r"ReadSchema: struct<job_id:string>", text)


def test_open_jobs_are_found_by_key(spark, big):
    done = stage(big.filter("ts > 5").select("job_id"), "done")
    text = plan(enrichment.pending(big.select("job_id", "description"), done))
    assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text


def test_tagging_needs_no_shuffle(big):
    text = plan(tag_phrases(big, "description", ["sql", "apache spark"]))
    assert "Exchange" not in text and "Python" not in text


def test_filters_and_columns_reach_the_scan(spark, big):
    text = plan(marts.company_presence(big))
    assert "ReadSchema: struct<company_id:string,location_id:string>" in text
    status = spark.createDataFrame([("A", True, 2020)], schemas.SPONSORSHIP_STATUS)
    stored = stage(status, "status")
    companies = spark.createDataFrame([("A", "1")], schemas.COMPANIES)
    mapping = spark.createDataFrame([("A", "A")], schemas.NAME_MAPPING)
    text = plan(matching.sponsor_companies(companies, mapping, stored))
    assert "EqualTo(ever_sponsored_h1b,true)" in text


def test_counts_are_partial_before_the_shuffle(spark):
    raw = spark.createDataFrame([], schemas.RAW_PETITIONS)
    text = plan(petitions.sponsorship_batch(stage(raw, "raw")))
    assert "partial_max" in text and text.count("Exchange") == 1


def test_open_keys_are_not_exchanged(spark, big, rows):
    """Neither side moves: buckets meet where they are read, and a key added twice is one."""
    names = ["keys_of_jobs", "keys_done"]
    enrichment.add_keys(big, names[0], buckets=4)
    enrichment.add_keys(big.filter("ts < 199990"), names[1], buckets=4)
    enrichment.add_keys(big.filter("ts BETWEEN 5 AND 199995"), names[1], buckets=4)
    enrichment.add_keys(big.filter("ts > 199998"), names[0], buckets=4)
    found = enrichment.open_keys(spark, *names)
    assert "Exchange" not in plan(found)
    assert rows(found) == [(str(k),) for k in range(199_996, 200_000)]


def test_a_small_dimension_leaves_the_fact_in_place(spark, big):
    """Seven rows that Spark expects to be many, because they are made from a large table."""
    dimension = big.select("category_label").distinct().withColumn("category_id", F.md5("category_label"))
    found = lookup(big.select("job_id", "category_label"), dimension, ["category_label"], "category_id")
    assert "BroadcastHashJoin" in plan(found) and "Exchange hashpartitioning" not in plan(found)
    assert found.filter("category_id = md5(category_label)").count() == 200_000


def test_a_merge_into_an_empty_table_exchanges_nothing(spark, big):
    empty = tables.read_table(spark, scratch_path(spark, "none"), "job_id string, description string")
    merged = upsert(empty, big.select("job_id", "description"), ["job_id"], unique_source=True)
    assert "Exchange" not in plan(merged) and merged.count() == 200_000
