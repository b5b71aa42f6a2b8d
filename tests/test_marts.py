import pytest
from pyspark.sql import functions as F

from hirelake import schemas
from hirelake.operators import enrichment, marts, matching, petitions
from hirelake.plans.enrichment import jobs_to_enrich


def raw_petition(employer="ACME LLC", year=2020, zip_code=2139.0, **counters):
    names = [f.split(" ")[0] for f in schemas.RAW_PETITIONS.split(", ")]
    values = dict(
        fiscal_year=year, employer_petitioner_name=employer, industry_naics_code="54",
        petitioner_city="Boston", petitioner_state="MA", petitioner_zip_code=zip_code, **counters)
    return tuple(values.get(n) for n in names)


def petition_frame(spark, *records):
    return spark.createDataFrame(list(records), schemas.RAW_PETITIONS)


def test_clean_petitions(spark):
    raw = petition_frame(
        spark, raw_petition(new_employment_approval=1, new_concurrent_approval=2,
                            change_of_employer_denial=3, continuation_approval=4, amended_denial=5),
        raw_petition(zip_code=None))
    first, second = petitions.clean_petitions(raw).collect()
    assert tuple(first) == (2020, "ACME LLC", "54", "Boston", "MA", "2139", 3, 3, 4, 5)
    assert second.zip_code is None and second.total_initial_approvals == 0
    assert petitions.clean_petitions(raw, pad_zip=True).first().zip_code == "02139"
    declared = schemas.PETITIONS.split(", ")
    assert [f"{f.name} {f.dataType.simpleString()}" for f in petitions.clean_petitions(raw).schema] == declared


def test_sponsorship_batch(spark, rows):
    raw = petition_frame(
        spark, raw_petition("A", 2019, amended_approval=1), raw_petition("A", 2021),
        raw_petition("B", 2020, amended_denial=9), raw_petition(None, 2018), raw_petition("C", None))
    assert rows(petitions.sponsorship_batch(raw)) == sorted([
        ("A", 2021, True), ("B", 2020, False), (None, 2018, False), ("C", None, False)], key=repr)


@pytest.mark.parametrize("old, new, expected", [
    ((True, 2019), (False, 2021), (True, 2021)), ((False, 2019), (True, 2018), (True, 2019)),
    ((None, 2019), (False, 2021), (None, 2021)), ((None, 2019), (True, 2021), (True, 2021)),
    ((False, None), (False, 2021), (False, None)), ((False, 2020), (False, None), (False, None)),
])
def test_sticky_sponsorship(spark, old, new, expected):
    status = spark.createDataFrame([("A",) + old], schemas.SPONSORSHIP_STATUS)
    batch = spark.createDataFrame([("A", new[1], new[0])], "employer_name string, fiscal_year int, is_sponsor boolean")
    assert [tuple(r) for r in petitions.merge_sponsorship(status, batch).collect()] == [("A",) + expected]


def test_sponsorship_merge_keeps_and_inserts(spark, rows):
    status = spark.createDataFrame([("A", True, 2019), (None, True, 2010)], schemas.SPONSORSHIP_STATUS)
    batch = spark.createDataFrame(
        [("B", 2020, False), (None, 2020, True)], "employer_name string, fiscal_year int, is_sponsor boolean")
    assert rows(petitions.merge_sponsorship(status, batch)) == sorted([
        ("A", True, 2019), ("B", False, 2020), (None, True, 2010), (None, True, 2020)], key=repr)


@pytest.fixture
def names(spark):
    companies = spark.createDataFrame(
        [("Leidos", "1"), ("Leidos", "1b"), ("Acme Co", "2"), ("Services LLC", "3"), ("Nobody", "4"), (None, "5")],
        schemas.COMPANIES)
    status = spark.createDataFrame(
        [("LEIDOS LLC", True, 2020), ("LEIDOS INC", False, 2021), ("ACME, INC.", True, 2019),
         ("GROUP, INC.", True, 2018), (None, True, 2017)], schemas.SPONSORSHIP_STATUS)
    return companies, status


def test_name_mapping(names, rows):
    assert rows(matching.name_mapping(*names)) == [
        ("Acme Co", "ACME, INC."), ("Leidos", "LEIDOS INC"), ("Services LLC", "GROUP, INC.")]
    assert rows(matching.name_mapping(*names, drop_empty_keys=True)) == [
        ("Acme Co", "ACME, INC."), ("Leidos", "LEIDOS INC")]


def test_sponsor_companies(names, rows):
    companies, status = names
    mapping = matching.name_mapping(companies, status)
    got = matching.sponsor_companies(companies, mapping, status)
    assert rows(got, "company_id", "h1b_official_name") == [("2", "ACME, INC."), ("3", "GROUP, INC.")]
    assert got.columns == [f.split(" ")[0] for f in schemas.SPONSOR_COMPANIES.split(", ")]


def job(spark, *records):
    return spark.createDataFrame(
        list(records), "job_id string, category_label string, company_id string, location_id string")


def test_category_overlap(spark):
    companies = spark.createDataFrame([(f"n{i}", f"c{i}") for i in range(7)] + [("n0", "c0b"), (None, "cx")], schemas.COMPANIES)
    jobs = [(f"j{i}-{k}", "A", f"c{i}", "l") for i in range(7) for k in range(i + 1)]
    jobs += [("j0-b", "A", "c0b", "l"), ("j", None, "c1", "l"), ("k", "A", "cx", "l"), ("m", "A", None, "l"),
             ("j6-0", "A", "c6", "l"), ("b", "B", "c1", "l")]
    overlap = marts.by_total(marts.category_overlap(job(spark, *jobs), companies)).collect()
    assert [r.category_label for r in overlap] == ["A", "B"]
    assert [(c.company_name, c["count"]) for c in overlap[0].top_companies] == [
        ("n6", 7), ("n5", 6), ("n4", 5), ("n3", 4), ("n2", 3)]
    assert overlap[0].total_jobs == 29 and overlap[1].total_jobs == 1


def test_company_presence(spark, rows):
    jobs = job(spark, ("1", "A", "c", "l"), ("2", "A", "c", "l"), ("3", "A", None, "l"), ("4", "A", "c", None))
    assert rows(marts.company_presence(jobs)) == [("c", "l")]


def test_row_counts(spark, rows):
    assert rows(marts.row_counts({"a": spark.range(3), "b": spark.range(0)})) == [("a", 3), ("b", 0)]


def test_unprocessed_keeps_null_keys(spark, rows):
    jobs = spark.createDataFrame([("1",), ("2",), (None,)], "job_id string")
    done = spark.createDataFrame([("1",), ("1",), (None,)], "source_job_id string")
    assert rows(enrichment.unprocessed(jobs, done, "job_id", "source_job_id")) == sorted([("2",), (None,)], key=repr)


def test_parse_responses(spark, rows):
    good = '{"skills": ["a"], "years_min": 1, "years_max": 2, "education": "MS", "benefits": null, "x": 1}'
    df = spark.createDataFrame(
        [("1", good), ("2", "{}"), ("3", "[1]"), ("4", '{"skills"'), ("5", '{"years_min": "three"}'),
         ("6", None), ("7", ""), ("8", '[{"skills": []}]'), ("9", "7")], "job_id string, response string")
    parsed = enrichment.parse_responses(df, F.lit("now"))
    assert rows(parsed) == [("1", ["a"], 1, 2, "MS", [], [], "now"), ("2", [], None, None, None, [], [], "now"),
                            ("5", [], None, None, None, [], [], "now")]
    assert [f.name for f in parsed.schema] == [f.split(" ")[0] for f in schemas.JOB_ENRICHMENT.split(", ")]


def test_fields_of_other_types(spark, rows):
    """A field that can't be read does not take the rest of its record with it."""
    texts = ['{"skills": ["a", 1], "years_min": "5", "years_max": 5.7, "education": 3}',
             '{"skills": "sql", "years_min": 5.0, "benefits": {"x": 1}}', '{"skills": null, "years_max": [1], "tech_stack": []}']
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "job_id string, response string")
    assert rows(enrichment.parse_responses(df, F.lit("now"))) == [
        ("0", ["a", "1"], 5, 5, "3", [], [], "now"), ("1", ["sql"], 5, None, None, [], [], "now"),
        ("2", [], None, None, None, [], [], "now")]


def test_jobs_to_enrich(spark, rows):
    jobs = spark.createDataFrame(
        [("1", "t", "d"), ("2", None, "d"), ("3", "t", None)], "job_id string, title string, description string")
    done = spark.createDataFrame([("1",)], "job_id string")
    assert rows(jobs_to_enrich(jobs, done)) == [("2", "Title: None\nDescription: d")]


def test_blank_guard(spark):
    df = spark.createDataFrame([(" \n ",), (None,), ("x",)], "t string")
    vector = F.array(F.lit(1.0), F.lit(2.0))
    got = [r[0] for r in df.select(enrichment.guard_blank(F.col("t"), vector, 2)).collect()]
    assert got == [[0.0, 0.0], [0.0, 0.0], [1.0, 2.0]]
