import json
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hirelake import schemas
from hirelake.plans import star
from hirelake.sources import postings

NOW = datetime(2025, 1, 1, 12, 0, 0)


def posting(key, company="Northwind", category="Analysis", area=("US", "Ohio", "Dayton"), **more):
    record = {
        "id": key, "title": f"Role {key}", "description": "text", "created": "2024-05-12T12:00:00Z",
        "company": {"display_name": company}, "category": {"label": category},
        "salary_min": 1.0, "salary_max": 2.0, "redirect_url": f"u{key}",
        "contract_type": "full_time", "contract_time": "permanent",
        "location": {"area": list(area)},
    }
    record.update(more)
    return record


def read(spark, records):
    page = json.dumps({"results": records})
    pages = spark.createDataFrame([(page,)], "page string")
    return postings.explode_pages(postings.parse_pages(pages, "page"))


@pytest.fixture
def frames(spark):
    records = [
        posting("1"), posting("2"),
        posting("3", company="Fabrikam", category="Science", area=("US", "Utah", "Provo")),
    ]
    return star.build_star(read(spark, records), NOW)


def test_five_frames(frames):
    assert set(frames) == {"jobs", "jobstats", "companies", "locations", "categories"}


def test_jobs_columns_and_values(frames):
    jobs = frames["jobs"]
    assert [f"{f.name} {f.dataType.simpleString()}" for f in jobs.schema] == schemas.STAGING_JOBS.split(", ")
    first = jobs.filter("job_id = '1'").first()
    assert (first.city, first.state, first.company_name, first.category_label) == (
        "Dayton", "Ohio", "Northwind", "Analysis")
    assert first.created == 1715515200 * 10**9
    assert first.ingest_data == "2025-01-01T12:00:00"
    assert jobs.count() == 3


def test_dimensions_are_distinct(frames, rows):
    assert rows(frames["companies"]) == [("Fabrikam",), ("Northwind",)]
    assert rows(frames["categories"]) == [("Analysis",), ("Science",)]
    assert rows(frames["locations"]) == [("Dayton", "Ohio", "US"), ("Provo", "Utah", "US")]


def test_jobstats(frames, rows):
    assert frames["jobstats"].count() == 3
    assert rows(frames["jobstats"], "posting_week") == [("19",)] * 3


@pytest.mark.parametrize("area, expected", [
    (["US"], ("US", None, None)), ([], (None, None, None)),
    (["US", "Ohio", "Dayton", "East", "Block 9"], ("US", "Ohio", "Dayton")),
    ("Ohio", (None, None, None)),
])
def test_area_parts(spark, area, expected):
    flat = star.flatten(read(spark, [posting("1", location={"area": area})])).first()
    assert (flat.country, flat.state, flat.city) == expected


def test_gaps_give_nulls(spark, rows):
    records = [
        posting("1", company="", location={}), posting("2", company=None), posting("3"),
    ]
    records[1]["company"] = None
    del records[2]["category"], records[2]["location"]
    built = star.build_star(read(spark, records), NOW)
    assert rows(built["jobs"], "job_id", "company_name", "category_label", "city") == [
        ("1", "", "Analysis", None), ("2", None, "Analysis", "Dayton"), ("3", "Northwind", None, None)]
    assert rows(built["companies"]) == [("Northwind",)]
    assert rows(built["categories"]) == [("Analysis",)]
    assert rows(built["locations"]) == [("Dayton", "Ohio", "US")]


def test_country_alone_is_no_location(spark):
    built = star.build_star(read(spark, [posting("1", area=["US"])]), NOW)
    assert built["locations"].count() == 0


@pytest.mark.parametrize("created, week", [
    ("2021-01-03T00:00:00Z", "53"), ("2021-01-03T23:30:00-05:00", "53"), (None, None),
    ("", None), ("soon", None),
])
def test_posting_week(spark, created, week):
    built = star.build_star(read(spark, [posting("1", created=created)]), NOW)
    assert built["jobstats"].first().posting_week == week


def test_repeated_id_keeps_both_facts(spark):
    built = star.build_star(read(spark, [posting("1"), posting("1")]), NOW)
    assert built["jobs"].count() == built["jobstats"].count() == 2


def test_pages_from_files(spark, tmp_path, rows):
    pages = [
        json.dumps({"results": [posting("1"), posting("2")]}), '{"results": [{"id"',
        '{"count": 0}', '{"results": null}', '{"results": []}',
        json.dumps({"results": [posting("2")]}),
    ]
    (tmp_path / "pages.json").write_text("\n".join(pages))
    assert rows(postings.read_pages(spark, str(tmp_path)), "id") == [("1",), ("2",), ("2",)]


def test_bad_pages_are_kept_apart(spark, tmp_path, rows):
    good = json.dumps({"results": [posting("1"), {"title": "keyless"}, posting("2")]})
    (tmp_path / "a.json").write_text("\n".join([good, "not json", '{"results": null}', '{"results": []}', "", '{"count": 1}']))
    (tmp_path / "b.json").write_text('{"results": 5}\n' + json.dumps({"results": [posting("3")]}))
    found, bad = postings.split_pages(spark, str(tmp_path))
    assert rows(found, "id") == [("1",), ("2",), ("3",)] and "file" not in found.columns
    kept = sorted((r.file.rsplit("/", 1)[1], r.line, r.reason) for r in bad.collect())
    assert kept == [
        ("a.json", "not json", "malformed"), ("a.json", '{"count": 1}', "no results"), ("a.json", '{"results": null}', "no results"),
        ("a.json", '{"title":"keyless"}', "no id"), ("b.json", '{"results": 5}', "malformed")]


def test_pretty_printed_page_files(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"results": [posting("1")]}, indent=2))
    assert postings.read_pages(spark, str(tmp_path), multi_line=True).count() == 1


def staging(spark, *overrides):
    base = dict(
        job_id="1", title="t", description="d", salary_min=1.0, salary_max=2.0, created=10**18,
        redirected_url="u", ingest_data="i", ingest_ts=2 * 10**18, company_name="Northwind",
        category_label="Analysis", city="Dayton", state="Ohio")
    columns = list(base)
    return spark.createDataFrame(
        [tuple({**base, **o}[c] for c in columns) for o in overrides], schemas.STAGING_JOBS)


def dims(spark):
    return (
        spark.createDataFrame([("Northwind", "c1")], schemas.COMPANIES),
        spark.createDataFrame([("Analysis", "k1")], schemas.CATEGORIES),
        spark.createDataFrame(
            [("Dayton", "Ohio", "US", "l2"), ("Dayton", "Ohio", "CA", "l1"), (None, "Utah", "US", "l3")],
            schemas.LOCATIONS),
    )


def test_latest_row_wins_with_total_order(spark):
    rows = [dict(title="b", ingest_ts=5), dict(title="z", ingest_ts=9), dict(title="a", ingest_ts=9),
            dict(title="0", ingest_ts=None)]
    assert star.latest_jobs(staging(spark, *rows)).first().title == "a"


def test_lookup_adds_no_rows_and_blank_equals_null(spark):
    staged = staging(
        spark, {}, dict(job_id="2", city="", state="Utah", company_name="Nobody"),
        dict(job_id="3", city=None, state="Utah", company_name=None))
    keyed = {r.job_id: r for r in star.jobs_source(staged, *dims(spark)).collect()}
    assert len(keyed) == 3
    assert (keyed["1"].company_id, keyed["1"].category_id, keyed["1"].location_id) == ("c1", "k1", "l1")
    assert (keyed["2"].company_id, keyed["2"].location_id) == (None, "l3")
    assert (keyed["3"].company_id, keyed["3"].location_id) == (None, "l3")


@pytest.mark.parametrize("nanos, text", [
    (1715515200123456789, "2024-05-12 12:00:00.123457"), (0, None), (-5, None), (None, None)])
def test_nanoseconds(spark, nanos, text):
    from hirelake.functions.times import nanos_to_timestamp
    df = spark.createDataFrame([(nanos,)], "n bigint")
    shown = F.date_format(nanos_to_timestamp(F.col("n")), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    assert df.select(shown).first()[0] == text


def jobs_target(spark, *records):
    base = {f.split(" ")[0]: None for f in schemas.JOBS.split(", ")}
    return spark.createDataFrame(
        [tuple({**base, **r}.values()) for r in records], schemas.JOBS)


def test_merge_jobs_updates_keeps_and_inserts(spark):
    target = jobs_target(
        spark, dict(job_id="1", title="old", redirected_url="first", ingest_data="first"),
        dict(job_id="9", title="kept"), dict(job_id="1", title="twin"), dict(job_id=None, title="nokey"))
    source = star.jobs_source(staging(spark, {}, dict(job_id="2"), dict(job_id=None)), *dims(spark))
    merged = star.merge_jobs(target, source).collect()
    assert sorted((str(r.job_id), r.title) for r in merged) == [
        ("1", "t"), ("1", "t"), ("2", "t"), ("9", "kept"), ("None", "nokey"), ("None", "t")]
    first = [r for r in merged if r.job_id == "1" and r.redirected_url == "first"]
    assert len(first) == 1 and first[0].ingest_data == "first" and first[0].company_id == "c1"


def test_merge_jobs_twice_equals_once(spark, rows):
    source = star.jobs_source(staging(spark, {}, dict(job_id="2", created=None)), *dims(spark))
    once = star.merge_jobs(jobs_target(spark, dict(job_id="1"), dict(job_id="7")), source)
    assert rows(star.merge_jobs(once, source)) == rows(once)


def stats(spark, *records):
    return spark.createDataFrame(list(records), schemas.JOBSTATS)


def test_repeated_source_key_is_an_error_only_when_matched(spark, rows):
    target = stats(spark, ("1", "a", "b", "1"))
    twice = stats(spark, ("1", "x", "b", "2"), ("1", "y", "b", "3"))
    with pytest.raises(PySparkException, match="several source rows"):
        star.merge_jobstats(target, twice, deduplicate=False).collect()
    assert rows(star.merge_jobstats(target, twice)) == [("1", "x", "b", "2")]
    new = stats(spark, ("2", "x", "b", "2"), ("2", "y", "b", "3"))
    assert star.merge_jobstats(target, new, deduplicate=False).count() == 3


def test_insert_only_merge(spark, rows):
    target = spark.createDataFrame([("Northwind", "old")], schemas.COMPANIES)
    staged = spark.createDataFrame([("Northwind",), ("Fabrikam",), ("Fabrikam",), (None,)], "company_name string")
    merged = star.merge_companies(target, staged)
    ids = {r.company_name: r.company_id for r in merged.collect()}
    assert ids["Northwind"] == "old" and len(ids["Fabrikam"]) == 36 and len(ids) == 2
    hashed = star.merge_companies(target, staged, "hash")
    assert rows(hashed) == rows(star.merge_companies(hashed, staged, "hash"))


def test_surrogate_keys_are_unique(spark):
    names = spark.range(1000).select(F.col("id").cast("string").alias("company_name"))
    empty = spark.createDataFrame([], schemas.COMPANIES)
    assert star.merge_companies(empty, names).select("company_id").distinct().count() == 1000


def test_locations_treat_blank_as_null(spark, rows):
    target = spark.createDataFrame([("", "Utah", "US", "l1")], schemas.LOCATIONS)
    staged = spark.createDataFrame(
        [(None, "Utah", "US"), (None, "Ohio", "US"), ("", "Ohio", "US"), (None, None, None),
         (None, None, "CA"), ("Dayton", "Ohio", "US"), ("Dayton", "Ohio", "CA")],
        schemas.STAGING_LOCATIONS)
    merged = star.merge_locations(target, staged, "hash")
    assert rows(merged, "city", "state", "country") == sorted([
        ("", "Utah", "US"), ("", "Ohio", "US"), (None, None, "CA"), ("Dayton", "Ohio", "US"),
        ("Dayton", "Ohio", "CA")], key=repr)
    assert rows(star.merge_locations(merged, staged, "hash")) == rows(merged)


def test_skill_catalogue_upsert(spark, rows):
    columns = schemas.SKILLS
    old = spark.createDataFrame([("1", "a") + (None,) * 8, ("2", "b") + (None,) * 8], columns)
    new = spark.createDataFrame([("2", "c") + (None,) * 5 + (True, None, None),
                                 ("3", "d") + (None,) * 8], columns)
    assert rows(star.merge_skill_catalogue(old, new), "skill_id", "skill_name", "is_soft_skill") == [
        ("1", "a", None), ("2", "c", True), ("3", "d", None)]
