from datetime import datetime

import threading

import pytest
from pyspark.sql import functions as F

from hirelake import schemas
from hirelake.operators.upsert import insert_new, upsert
from hirelake.plans import enrichment, skills, sponsors, star
from hirelake.session import scratch_folder, scratch_path, shared_folder, stage
from hirelake.sources import landing
from hirelake.sources.tables import (
    changed_rows, current, merge_into, publish, read_table, refresh_derived, replace_parts, stale_parts, vacuum, write_version,
)
from hirelake.streaming.incremental import update_star
from tests.test_marts import petition_frame, raw_petition
from tests.test_star import posting, read

DAY1, DAY2 = datetime(2025, 1, 1, 12), datetime(2025, 1, 2, 12)


def drops(spark):
    first = [posting("1", description="SQL and 5+ years"), posting("2", company="Fabrikam Inc.", description="Apache Spark")]
    second = [posting("1", title="New", description="SQL and 5+ years", redirect_url="other"),
              posting("3", company="Tailwind", area=("US", "Utah", "Provo"), description="spark, sql")]
    return [(DAY1, star.build_star(read(spark, first), DAY1)), (DAY2, star.build_star(read(spark, second), DAY2))]


def check_star(spark, base, rows):
    jobs = read_table(spark, f"{base}/jobs", schemas.JOBS)
    assert rows(jobs, "job_id", "title", "redirected_url", "ingest_data") == [
        ("1", "New", "u1", "2025-01-01T12:00:00"), ("2", "Role 2", "u2", "2025-01-01T12:00:00"),
        ("3", "Role 3", "u3", "2025-01-02T12:00:00")]
    assert jobs.filter("company_id IS NULL OR category_id IS NULL OR location_id IS NULL").count() == 0
    assert read_table(spark, f"{base}/companies", schemas.COMPANIES).count() == 3
    assert read_table(spark, f"{base}/locations", schemas.LOCATIONS).count() == 2
    assert read_table(spark, f"{base}/jobstats", schemas.JOBSTATS).count() == 3


def test_load_star_in_batches(spark, tmp_path, rows):
    base = str(tmp_path)
    for _, frames in drops(spark):
        for _ in range(2):  # the second time changes nothing
            loaded = star.load_star(spark, frames, base, buckets=4)
    assert set(loaded) == set(frames)
    check_star(spark, base, rows)


def test_load_star_without_facts(spark, tmp_path):
    frames = drops(spark)[0][1]
    loaded = star.load_star(spark, {"companies": frames["companies"]}, str(tmp_path), buckets=2)
    assert loaded["companies"].count() == 2 and loaded["jobs"].count() == 0


def test_star_as_a_stream(spark, tmp_path, rows):
    base, land = f"{tmp_path}/tables", f"{tmp_path}/land"
    for day, frames in drops(spark):
        landing.land_frames(frames, land, day)
        for _ in range(2):  # the second run finds no new files
            update_star(spark, land, base, f"{tmp_path}/checkpoint", buckets=4)
    check_star(spark, base, rows)


def test_stream_that_breaks_off_between_frames(spark, tmp_path, rows):
    """The batch is applied again whole; jobs landed before their dimensions still find their keys."""
    land, base = str(tmp_path / "land"), str(tmp_path / "tables")

    def broken(session, frames, *rest):
        star.load_star(session, {name: df for name, df in frames.items() if name in ("companies", "jobs")}, *rest)
        raise RuntimeError("broken off")

    for day, frames in drops(spark):
        landing.land_frames({name: frames[name] for name in ("jobs", "jobstats")}, land, day)
        landing.land_frames({name: df for name, df in frames.items() if name not in ("jobs", "jobstats")}, land, day)
        with pytest.raises(Exception, match="broken off"):
            update_star(spark, land, base, f"{tmp_path}/checkpoint", buckets=4, load=broken)
        update_star(spark, land, base, f"{tmp_path}/checkpoint", buckets=4)
    check_star(spark, base, rows)
    versions = current(spark, f"{base}/jobs").number
    update_star(spark, land, base, f"{tmp_path}/checkpoint", buckets=4)
    assert current(spark, f"{base}/jobs").number == versions


def test_counts_of_what_was_written(spark, tmp_path):
    frames = {"companies": spark.range(7), "locations": spark.range(0)}
    paths, counts = landing.land_counted(frames, str(tmp_path), DAY1)
    assert counts == {"companies": 7, "locations": 0} and list(paths) == ["companies"]


def test_landing_paths_and_staging(spark, tmp_path, rows):
    frames = {"companies": spark.createDataFrame([("A",)], "company_name string"),
              "categories": spark.createDataFrame([], "category_label string")}
    paths = landing.land_frames(frames, str(tmp_path), DAY1)
    assert paths == {"companies": f"{tmp_path}/processed/companies/companies_20250101120000.parquet"}
    staged = landing.load_staging(spark, paths["companies"], "company_name string", f"{tmp_path}/staging")
    assert rows(staged) == [("A",)]
    with pytest.raises(ValueError):
        landing.land_frames({"categories": frames["categories"]}, str(tmp_path), DAY1)


def test_nanosecond_files(spark, tmp_path):
    import pandas as pd
    import pyarrow as pa
    import pyarrow.parquet as pq

    path = f"{tmp_path}/nanos.parquet"
    stamp = pa.array(pd.to_datetime(["2024-05-12T12:00:00.123456789"]), pa.timestamp("ns"))
    pq.write_table(pa.table({"job_id": ["1"], "created": stamp}), path, version="2.6")
    frame = landing.read_landed(spark, path, "job_id string, created bigint")
    assert frame.first().created == 1715515200123456789


def test_sinks(spark, tmp_path):
    path = f"{tmp_path}/t"
    count = lambda: read_table(spark, f"{path}-whole", "id bigint").count()
    landing.append(spark.range(10), path, max_records_per_file=4)
    landing.append(spark.range(3), path)
    assert landing.read_appended(spark, path, "id bigint").count() == 13
    landing.replace(spark.range(2), f"{path}-whole")
    assert count() == 2
    assert not landing.replace_if_any(spark.range(0), f"{path}-whole")
    assert landing.replace_if_any(spark.range(5), f"{path}-whole")
    assert count() == 5
    landing.replace(spark.range(0), f"{path}-whole")
    assert count() == 0
    for n in (3, 1):
        landing.replace_table(spark.range(n), "presence")
    assert spark.table("presence").count() == 1
    before = spark.table("presence")
    with pytest.raises(Exception):
        landing.replace_table(failing(spark.range(9)), "presence")
    assert spark.table("presence").count() == 1 and before.count() == 1
    landing.replace_table(spark.range(4).withColumn("n", F.lit(1)), "presence")
    assert spark.table("presence").columns == ["id", "n"]


def failing(df):
    """Rows of which some are written before the job fails."""
    return df.repartition(3).withColumn("id", F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("broken")).cast("bigint")))


def test_reload_that_breaks_off_is_not_seen(spark, tmp_path, rows):
    path = f"{tmp_path}/t"
    landing.replace(spark.range(5), path)
    with pytest.raises(Exception):
        landing.replace(failing(spark.range(20)), path)
    assert read_table(spark, path, "id bigint").count() == 5
    reading = read_table(spark, path, "id bigint")
    landing.replace(spark.range(7), path)
    assert reading.count() == 5 and read_table(spark, path, "id bigint").count() == 7  # the last readers keep their files
    for n in range(4):
        landing.replace(spark.range(n), path)
    assert len([x for x in (tmp_path / "t" / "data").iterdir()]) == 3 - 1  # and older files go


def test_tables_that_change_together(spark, tmp_path):
    path = f"{tmp_path}/t"
    replace_parts(spark, path, {"a": spark.range(2), "b": spark.range(3)})
    with pytest.raises(Exception):
        replace_parts(spark, path, {"a": spark.range(9), "b": failing(spark.range(20))})
    assert [read_table(spark, path, "id bigint", part).count() for part in "ab"] == [2, 3]


def test_appends_that_are_retried(spark, tmp_path, rows):
    path = f"{tmp_path}/t"
    landing.append(spark.range(3), path, batch="one")
    landing.append(spark.range(10, 12), path, batch="two")
    landing.append(spark.range(4), path, batch="one")
    with pytest.raises(Exception):
        landing.append(failing(spark.range(20)), path, batch="two")
    read = lambda without=None: rows(landing.read_appended(spark, path, "id bigint", without))
    assert read() == [(0,), (1,), (10,), (11,), (2,), (3,)]
    assert read("one") == [(10,), (11,)]
    landing.append(spark.range(0), path, batch="three")
    assert len(read()) == 6


def test_skill_pipeline(spark, tmp_path, rows):
    base = str(tmp_path)
    phrases = ["SQL", "Spark", "Apache Spark"]
    for _, frames in drops(spark):
        star.load_star(spark, frames, base, buckets=2)
        for _ in range(2):
            skills.extract_skills(spark, base, phrases, "2025-01-01", "v1", buckets=2)
    raw = landing.read_appended(spark, f"{base}/job_skills", schemas.JOB_SKILLS)
    assert rows(raw, "source_job_id", "skill_name") == [
        ("1", "5+ years experience"), ("1", "sql"), ("2", "apache spark"), ("3", "spark"), ("3", "sql")]
    dim = read_table(spark, f"{base}/skills", schemas.SKILLS)
    assert rows(dim, "skill_name") == [("5+ years experience",), ("apache spark",), ("spark",), ("sql",)]
    bridge = read_table(spark, f"{base}/job_skills_bridge", schemas.JOB_SKILLS_BRIDGE)
    assert bridge.count() == 5 and bridge.distinct().count() == 5
    overlap = read_table(spark, f"{base}/category_industry_overlap", schemas.CATEGORY_OVERLAP).collect()
    assert overlap[0].total_jobs == 3 and len(overlap[0].top_companies) == 3
    assert read_table(spark, f"{base}/company_presence", schemas.COMPANY_PRESENCE).count() == 3


def test_skill_run_that_is_retried(spark, tmp_path, rows):
    """The same batch again stores the same rows once; the next batch only adds what is new."""
    base = str(tmp_path)
    star.load_star(spark, drops(spark)[0][1], base, buckets=2)
    for batch in ("monday", "monday", "tuesday"):
        skills.extract_skills(spark, base, ["SQL", "Apache Spark"], "2025-01-01", "v1", buckets=2, batch=batch)
    raw = landing.read_appended(spark, f"{base}/job_skills", schemas.JOB_SKILLS)
    assert rows(raw, "source_job_id", "skill_name") == [("1", "5+ years experience"), ("1", "sql"), ("2", "apache spark")]


def test_skills_of_a_run_that_broke_off(spark, tmp_path, rows):
    """Rows stored without their links are linked by the next run, and nothing else is merged again."""
    base = str(tmp_path)
    star.load_star(spark, drops(spark)[0][1], base, buckets=2)
    jobs = read_table(spark, f"{base}/jobs", schemas.JOBS)
    landing.append(skills.skill_rows(jobs, ["SQL"], F.lit("2025-01-01"), "v1"), f"{base}/job_skills")
    skills.extract_skills(spark, base, ["SQL", "Apache Spark"], "2025-01-02", "v1", buckets=2)
    linked = read_table(spark, f"{base}/job_skills_bridge", schemas.JOB_SKILLS_BRIDGE)
    assert rows(linked, "job_id") == [("1",), ("1",), ("2",)]
    raw = landing.read_appended(spark, f"{base}/job_skills", schemas.JOB_SKILLS)
    assert rows(raw, "source_job_id", "skill_name") == [("1", "5+ years experience"), ("1", "sql"), ("2", "apache spark")]


def test_sponsor_pipeline(spark, tmp_path, rows):
    base = str(tmp_path)
    star.load_star(spark, drops(spark)[0][1], base, buckets=2)
    raw = petition_frame(
        spark, raw_petition("FABRIKAM LLC", 2020, amended_approval=1), raw_petition("FABRIKAM LLC", 2021),
        raw_petition("NORTHWIND CORP", 2021, amended_denial=1))
    for _ in range(2):
        sponsors.load_petitions(spark, raw, base, buckets=2)
        sponsors.match_sponsors(spark, base)
    assert read_table(spark, f"{base}/h1b_petitions", schemas.PETITIONS).count() == 3
    assert rows(read_table(spark, f"{base}/temp_name_mapping", schemas.NAME_MAPPING)) == [
        ("Fabrikam Inc.", "FABRIKAM LLC"), ("Northwind", "NORTHWIND CORP")]
    got = read_table(spark, f"{base}/sponsor_companies", schemas.SPONSOR_COMPANIES)
    assert rows(got, "company_name", "h1b_official_name", "is_sponsor", "last_updated_fiscal_year") == [
        ("Fabrikam Inc.", "FABRIKAM LLC", True, 2021)]


def test_enrichment_pipeline(spark, tmp_path, rows):
    base = str(tmp_path)
    for _, frames in drops(spark):
        star.load_star(spark, frames, base, buckets=2)
    answers = spark.createDataFrame(
        [("1", '{"skills": ["sql"]}'), ("2", "broken")], "job_id string, response string")
    vectors = spark.createDataFrame([("1", [1.0]), ("2", [2.0]), ("3", None)], "job_id string, vector array<double>")

    def run(at):
        return enrichment.enrich_jobs(
            spark, base, lambda todo: todo.join(answers, "job_id").select("job_id", "response"),
            lambda todo: todo.join(vectors, "job_id").select("job_id", "vector"), "m", at)

    assert run("t1") == "Wrote 1 rows to job_enrichment, 2 rows to job_embeddings."
    assert run("t2") == "No new jobs."
    answers = spark.createDataFrame([("2", '{"years_min": 3}')], "job_id string, response string")
    assert run("t3") == "Wrote 1 rows to job_enrichment, 0 rows to job_embeddings."
    done = landing.read_appended(spark, f"{base}/job_enrichment", schemas.JOB_ENRICHMENT)
    assert rows(done, "job_id", "processed_at") == [("1", "t1"), ("2", "t3")]
    vectors_done = landing.read_appended(spark, f"{base}/job_embeddings", schemas.JOB_EMBEDDINGS)
    assert rows(vectors_done, "job_id", "model_name") == [("1", "m"), ("2", "m")]


SCHEMA = "k string, v int"


def put(spark, path, *records, buckets=4, batch=None):
    merge_into(spark, path, SCHEMA, spark.createDataFrame(list(records), SCHEMA), ["k"],
               lambda t, s: upsert(t, s, ["k"]), buckets, batch=batch)


def test_merge_writes_only_touched_buckets(spark, tmp_path, rows):
    path = f"{tmp_path}/t"
    put(spark, path, *[(str(i), i) for i in range(40)], buckets=8)
    first = current(spark, path)
    put(spark, path, ("5", 500), buckets=8)
    second = current(spark, path)
    assert len(set(first.parts) - set(second.parts)) == len(set(second.parts) - set(first.parts)) == 1
    table = read_table(spark, path, SCHEMA)
    assert table.count() == 40 and table.filter("k = '5'").first().v == 500


def test_merge_that_breaks_off_is_not_seen(spark, tmp_path, rows):
    path = f"{tmp_path}/t"
    put(spark, path, ("1", 1), ("2", 2))
    source = spark.createDataFrame([("2", 20), ("3", 30)], SCHEMA)
    version = write_version(spark, path, SCHEMA, source, ["k"], lambda t, s: upsert(t, s, ["k"]))
    assert rows(read_table(spark, path, SCHEMA)) == [("1", 1), ("2", 2)]
    put(spark, path, ("2", 20), ("3", 30))
    assert rows(read_table(spark, path, SCHEMA)) == [("1", 1), ("2", 20), ("3", 30)]
    assert not publish(spark, path, version)  # a second writer of the same version


def test_merges_at_the_same_time(spark, tmp_path, rows):
    """Of writers that start from one version one is first, and the others start anew: every row is there once."""
    for trial in range(20):
        path = f"{tmp_path}/t{trial}"
        put(spark, path, ("0", 0), buckets=1)
        errors = []

        def write(k):
            try:
                put(spark, path, (str(k), k), ("0", 0), buckets=1)
            except Exception as error:
                errors.append(error)

        writers = [threading.Thread(target=write, args=(k,)) for k in (1, 2)]
        for writer in writers:
            writer.start()
        for writer in writers:
            writer.join()
        assert not errors
        assert rows(read_table(spark, path, SCHEMA)) == [("0", 0), ("1", 1), ("2", 2)]
        assert current(spark, path).number == 3


def merge_changed(spark, path, *records):
    merge_into(spark, path, SCHEMA, spark.createDataFrame(list(records), SCHEMA), ["k"],
               lambda t, s: upsert(t, s, ["k"], unique_source=True), 8, same=["v"])


def test_unchanged_rows_write_nothing(spark, tmp_path, rows):
    path = f"{tmp_path}/t"
    records = [(str(i), i if i % 5 else None) for i in range(40)]
    merge_changed(spark, path, *records)
    first = current(spark, path)
    merge_changed(spark, path, *records)
    assert current(spark, path) == first
    merge_changed(spark, path, *records[:38], ("38", 380), ("39", None), ("new", 1))
    second = current(spark, path)
    assert len(set(second.parts) - set(first.parts)) <= 3 < len(first.parts)
    expected = [*records[:38], ("38", 380), ("39", None), ("new", 1)]
    assert rows(read_table(spark, path, SCHEMA)) == sorted(expected, key=repr)
    source = spark.createDataFrame([("1", 1), ("5", None), ("5", 5), ("6", None), (None, 1), ("x", None)], SCHEMA)
    assert rows(changed_rows(spark, path, SCHEMA, source, ["k"], ["v"])) == sorted([("5", 5), ("6", None), (None, 1), ("x", None)], key=repr)


def test_derived_parts(spark, tmp_path, rows):
    """Only parts that were written since are read again, those of rows without key included."""
    path, derived = f"{tmp_path}/t", f"{tmp_path}/d"
    total = lambda df: df.groupBy("_bucket").agg(F.sum("v").alias("s"))
    refresh = lambda: refresh_derived(spark, path, SCHEMA, derived, total)
    value = lambda: read_table(spark, derived, "s bigint").agg(F.sum("s")).first()[0]
    assert refresh() == 0
    put(spark, path, *[(str(i), 1) for i in range(40)], buckets=8)
    assert refresh() == 8 and value() == 40
    assert refresh() == 0
    put(spark, path, ("5", 11), (None, 100), buckets=8)
    assert len(stale_parts(spark, path, derived)[0]) == 2
    assert refresh() == 2 and value() == 150
    put(spark, path, (None, 100), buckets=8)
    assert refresh() == 1 and value() == 250


def test_bucket_count_is_stored(spark, tmp_path):
    path = f"{tmp_path}/t"
    put(spark, path, *[(str(i), i) for i in range(40)], buckets=8)
    with pytest.raises(ValueError):
        put(spark, path, ("1", 2), buckets=64)
    put(spark, path, *[(str(i), -i) for i in range(40)], buckets=None)
    assert read_table(spark, path, SCHEMA).count() == 40


def test_retried_batch_adds_nothing_twice(spark, tmp_path, rows):
    path = f"{tmp_path}/t"
    for batch in ("a", "a", "b"):
        put(spark, path, ("1", 1), (None, 7), batch=batch)
    assert rows(read_table(spark, path, SCHEMA)) == sorted([("1", 1), (None, 7), (None, 7)], key=repr)


def test_old_versions_go(spark, tmp_path, rows):
    path = f"{tmp_path}/t"
    for i in range(4):
        put(spark, path, ("1", i), ("2", i), buckets=2)
    vacuum(spark, path, keep=1)
    assert rows(read_table(spark, path, SCHEMA)) == [("1", 3), ("2", 3)]
    assert len(list((tmp_path / "t" / "data").iterdir())) == len({folder for _, folder, _ in current(spark, path).parts})


def test_rows_without_key_are_appended(spark, tmp_path, rows):
    path = f"{tmp_path}/t"
    for _ in range(2):
        put(spark, path, ("1", 1), (None, 7))
    assert rows(read_table(spark, path, SCHEMA)) == sorted([("1", 1), (None, 7), (None, 7)], key=repr)


def test_merge_of_nothing(spark, tmp_path):
    put(spark, f"{tmp_path}/t")
    assert read_table(spark, f"{tmp_path}/t", SCHEMA).count() == 0


def test_upsert_properties(spark, rows):
    """Random tables: result keys are the union, target rows stay, a second run changes nothing."""
    import random
    draw = random.Random(11)
    for _ in range(3):
        target = [(str(k), draw.randrange(9)) for k in draw.sample(range(30), 15)]
        source = [(str(k), draw.randrange(9)) for k in draw.sample(range(30), 15)]
        t, s = (spark.createDataFrame(x, SCHEMA) for x in (target, source))
        once = upsert(t, s, ["k"])
        assert rows(once) == sorted({**dict(target), **dict(source)}.items(), key=repr)
        assert rows(upsert(once, s, ["k"], unique_source=True)) == rows(once)
        new = insert_new(t, s.select("k"), ["k"])
        assert rows(new, "k") == sorted({(k,) for k, _ in target + source}, key=repr)


def test_hot_key_in_every_place(spark, rows):
    """A third of all rows share one key, on the target and on the source side."""
    hot = [("hot", i) for i in range(300)]
    rest = [(str(i), i) for i in range(600)]
    target = spark.createDataFrame(hot + rest, SCHEMA)
    one = spark.createDataFrame([("hot", -1)], SCHEMA)
    merged = upsert(target, one, ["k"])
    assert merged.count() == 900 and merged.filter("k = 'hot' AND v = -1").count() == 300
    found = insert_new(spark.createDataFrame([], SCHEMA), target.select("k"), ["k"])
    assert found.count() == 601


def test_shared_folder_and_staging(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    keyed = stage(spark.range(5).withColumn("u", F.uuid()), "keys")
    assert keyed.join(keyed, "u").count() == 5
    assert scratch_path(spark, "x").startswith(scratch_folder(spark))
