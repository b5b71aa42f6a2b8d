"""One query per operator. Each takes (spark, folder of the test tables)."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import TimestampType

from pyspark.ml.functions import array_to_vector, vector_to_array

from hirelake import schemas
from hirelake.functions import tagging, text, times
from hirelake.functions.vectors import squared_distance
from hirelake.operators import (
    clustering, dictionary, enrichment, marts, matching, petitions, tfidf,
)
from hirelake.operators.dedup import latest_per_key
from hirelake.operators.upsert import upsert
from hirelake.plans import clusters as cluster_plan
from hirelake.plans import enrichment as enrichment_plan
from hirelake.plans import skills as skill_plan
from hirelake.plans import sponsors as sponsor_plan
from hirelake.plans import star
from hirelake.session import configure, scratch_path, stage
from hirelake.sources import landing, postings, tables
from hirelake.streaming.incremental import FRAMES, apply_new_files, update_star
from workload.views import CUTOFF, Views, nanos

INGEST_TIME = datetime(2025, 1, 1, 12, 0, 0)
PHRASES = ["the", "of", "and", "of the", "the of", "the and", "and the", "the the", "the the the"]
SPLIT_PHRASES = ["of-the", "and/the", "the", "of", "and", "to the"]
STOP_WORDS = ["the", "of", "and", "to", "in", "la", "le", "de", "und", "der"]
EXTRACTED = "2025-01-01T12:00:00"
MODEL = "phrases-1"


def plain(df: DataFrame) -> DataFrame:
    """Timestamps as text, for comparison across engines."""
    stamps = [f.name for f in df.schema if isinstance(f.dataType, TimestampType)]
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in stamps})


def six(column: str):
    return F.round(column, 6).alias(column)


def listed(column: str):
    return F.array_join(column, ",").alias(column)


# --- star schema ------------------------------------------------------------

def star_frame(name: str):
    def run(v: Views) -> DataFrame:
        return star.star_frames(star.flatten(v.raw_postings()), INGEST_TIME)[name]
    return run


def row_counts(v: Views) -> DataFrame:
    """Counted while the five frames are written."""
    flat = stage(star.flatten(v.raw_postings()), "postings")
    _, counts = landing.land_counted(star.star_frames(flat, INGEST_TIME), _stored(v, "counted"), INGEST_TIME)
    return marts.counted_rows(v.spark, counts)


def page_quarantine(v: Views) -> DataFrame:
    """Pages as files: the postings read, and the lines left out with the reason."""
    path = _stored(v, "pages")
    v.pages().select(F.col("page").alias("value")).write.text(path)
    good, bad = postings.split_pages(v.spark, path)
    return good.select("id", F.lit(None).cast("string").alias("line"), F.lit("read").alias("reason")).unionByName(
        bad.select(F.lit(None).cast("string").alias("id"), "line", "reason"))


def page_explode(v: Views) -> DataFrame:
    pages = postings.parse_pages(v.pages(), "page")
    return postings.explode_pages(pages).select("page_id", "id", "title", "salary_max")


def nanos_to_timestamp(v: Views) -> DataFrame:
    raw = (
        F.when(F.col("o_orderstatus") == "P", -nanos("o_orderdate"))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(0).cast("bigint"))
        .when(F.col("o_orderpriority") != "1-URGENT", nanos("o_orderdate") + F.col("o_custkey") * 7)
    )
    return plain(v.table("orders").select(
        "o_orderkey", times.nanos_to_timestamp(raw).alias("created")))


def latest_per_job(v: Views) -> DataFrame:
    return star.latest_jobs(v.staging_jobs())


def dim_key_lookup(v: Views) -> DataFrame:
    staged = v.staging_jobs().select(
        "job_id", "redirected_url", "company_name", "category_label", "city", "state")
    keyed = star.with_dimension_keys(staged, v.companies(), v.categories(), v.locations())
    return keyed.select("job_id", "redirected_url", "company_id", "category_id", "location_id")


def _jobs_source(v: Views) -> DataFrame:
    return star.jobs_source(v.staging_jobs(), v.companies(), v.categories(), v.locations())


def merge_companies(v: Views) -> DataFrame:
    return star.merge_companies(v.companies_known(), v.staging_jobs(), "hash")


def merge_categories(v: Views) -> DataFrame:
    return star.merge_categories(v.categories_known(), v.staging_jobs(), "hash")


def merge_locations(v: Views) -> DataFrame:
    return star.merge_locations(v.locations_known(), v.locations_staging(), "hash")


def merge_jobs(v: Views) -> DataFrame:
    return plain(star.merge_jobs(v.jobs_known(), stage(_jobs_source(v), "jobs-source"), unique_source=True))


def merge_idempotent(v: Views) -> DataFrame:
    source = stage(_jobs_source(v), "jobs-source")
    once = stage(star.merge_jobs(v.jobs_known(), source, unique_source=True), "jobs-once")
    return plain(star.merge_jobs(once, source, unique_source=True))


def merge_interrupted(v: Views) -> DataFrame:
    """A stored merge that breaks off before it is published, and is run again."""
    spark, path = v.spark, scratch_path(v.spark, "interrupted")
    source = stage(_jobs_source(v), "jobs-source")

    def merge(target: DataFrame, rows: DataFrame) -> DataFrame:
        return star.merge_jobs(target, rows, unique_source=True)

    tables.merge_into(spark, path, schemas.JOBS, v.jobs_known(), ["job_id"], merge, buckets=4)
    tables.write_version(spark, path, schemas.JOBS, source, ["job_id"], merge)  # never published
    tables.merge_into(spark, path, schemas.JOBS, source, ["job_id"], merge)
    return plain(tables.read_table(spark, path, schemas.JOBS))


PRICES = "order_id string, price double, status string"


def merge_changed(v: Views) -> DataFrame:
    """Orders stored and merged again with one price in twenty changed: the stored rows, and which source rows were taken as changed."""
    spark, path = v.spark, scratch_path(v.spark, "changed")
    rows = v.table("orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_totalprice").alias("price"),
        F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderstatus")).alias("status"))
    later = rows.withColumn("price", F.when(F.col("order_id").cast("long") % 20 == 0, F.col("price") + 1).otherwise(F.col("price")))

    def merge(source: DataFrame) -> None:
        tables.merge_into(spark, path, PRICES, source, ["order_id"], lambda t, s: upsert(t, s, ["order_id"], unique_source=True),
                          buckets=8, same=["price", "status"])

    merge(rows)
    changed = stage(tables.changed_rows(spark, path, PRICES, later, ["order_id"], ["price", "status"]), "changed")
    merge(later)
    merge(later)  # nothing is left to write
    flagged = changed.select("order_id", F.lit(True).alias("changed"))
    return tables.read_table(spark, path, PRICES).join(flagged, "order_id", "left").fillna(False, ["changed"])


def _broken(df: DataFrame, column: str) -> DataFrame:
    """Rows whose computation fails after some of them."""
    fails = F.when(F.pmod(F.xxhash64(column), F.lit(50)) == 0, F.raise_error(F.lit("broken off")).cast("string"))
    return df.withColumn(column, F.coalesce(fails, F.col(column).cast("string")))


def replace_interrupted(v: Views) -> DataFrame:
    """A table reloaded, and a second reload that fails on the way: the rows of the first."""
    path = _stored(v, "replaced")
    landing.replace(v.company_names().select("company_id", "company_name"), path)
    try:
        landing.replace(_broken(v.company_names().select("company_id", F.lit("new").alias("company_name")), "company_id"), path)
    except Exception:  # the failure that is meant
        pass
    return tables.read_table(v.spark, path, "company_id string, company_name string")


def append_retried(v: Views) -> DataFrame:
    """Two batches of documents, one of them appended twice."""
    path, docs = _stored(v, "appended"), v.table("documents").select("doc_id", "lang")
    for batch, rest in (("a", 0), ("b", 1), ("a", 0)):
        landing.append(docs.filter(F.col("doc_id") % 3 == rest), path, batch=batch)
    return landing.read_appended(v.spark, path, "doc_id bigint, lang string")


def merge_jobstats(v: Views) -> DataFrame:
    source = stage(latest_per_key(v.jobstats_staging(), ["job_id"]), "jobstats")
    return upsert(v.jobstats_known(), source, ["job_id"], unique_source=True)


def merge_skills_catalogue(v: Views) -> DataFrame:
    return plain(star.merge_skill_catalogue(v.skill_catalogue(True), v.skill_catalogue(False)))


# --- marts ------------------------------------------------------------------

def company_presence(v: Views) -> DataFrame:
    return marts.company_presence(_jobs_source(v))


def category_overlap(v: Views) -> DataFrame:
    overlap = marts.by_total(marts.category_overlap(_jobs_source(v), v.companies()))
    return overlap.select(
        "category_label", "total_jobs", F.posexplode("top_companies").alias("rank", "c")
    ).select("category_label", "rank", F.col("c.company_name").alias("company_name"),
             F.col("c.count").alias("jobs"), "total_jobs")


def overlap_incremental(v: Views) -> DataFrame:
    """The overlap kept up to date over two merges of jobs, from counts per part of the jobs table."""
    spark, base = v.spark, _stored(v, "marts")
    source = stage(_jobs_source(v), "jobs-source")
    _store(v, base, "companies", schemas.COMPANIES, v.companies(), "company_name")
    for half in (0, 1):
        _store(v, base, "jobs", schemas.JOBS, source.filter(F.col("job_id").cast("long") % 2 == half), "job_id")
        skill_plan.refresh_marts(spark, base)
    overlap = marts.by_total(tables.read_table(spark, f"{base}/category_industry_overlap", schemas.CATEGORY_OVERLAP))
    return overlap.select(
        "category_label", "total_jobs", F.posexplode("top_companies").alias("rank", "c")
    ).select("category_label", "rank", F.col("c.company_name").alias("company_name"),
             F.col("c.count").alias("jobs"), "total_jobs")


def petitions_clean(v: Views) -> DataFrame:
    return petitions.clean_petitions(v.petitions())


def sponsorship_batch(v: Views) -> DataFrame:
    return petitions.sponsorship_batch(v.petitions())


def sponsorship_merge(v: Views) -> DataFrame:
    raw = v.petitions()
    before = petitions.sponsorship_batch(raw.filter("fiscal_year <= 1998"))
    status = before.select(
        "employer_name", F.nullif("is_sponsor", F.lit(False)).alias("ever_sponsored_h1b"),
        F.col("fiscal_year").alias("last_updated_fiscal_year"))
    batch = stage(petitions.sponsorship_batch(raw.filter("fiscal_year > 1998")), "batch")
    return petitions.merge_sponsorship(status, batch, unique_source=True)


def normalize_names(v: Views) -> DataFrame:
    name = F.col("company_name")
    return v.company_names().select("company_id", text.normalize_company(name).alias("clean_name"))


def name_mapping(v: Views) -> DataFrame:
    return matching.name_mapping(v.company_names(), v.sponsor_status())


def sponsor_companies(v: Views) -> DataFrame:
    companies, status = v.company_names(), v.sponsor_status()
    return matching.sponsor_companies(companies, matching.name_mapping(companies, status), status)


# --- skills -----------------------------------------------------------------

def unprocessed_jobs(v: Views) -> DataFrame:
    jobs = v.table("documents").select("doc_id", "lang", "n_chars")
    return enrichment.unprocessed(jobs, v.table("labels"), "doc_id")


def open_keys_bucketed(v: Views) -> DataFrame:
    """Documents and labelled ones as tables of keys in the same buckets, the labelled added in two runs; the open ones."""
    names = [f"{label}_{uuid.uuid4().hex}" for label in ("jobs", "done")]
    labels = v.table("labels").select("doc_id")
    enrichment.add_keys(v.table("documents"), names[0], "doc_id", buckets=8)
    for half in (0, 1):
        enrichment.add_keys(labels.filter(F.col("doc_id") % 2 == half), names[1], "doc_id", buckets=8)
    return enrichment.open_keys(v.spark, *names, key="doc_id")


def experience_years(v: Views) -> DataFrame:
    return v.experience_texts().select("event_id", text.experience(F.col("text")).alias("years"))


def skill_ngrams(v: Views) -> DataFrame:
    return tagging.phrase_hits(v.documents(), "job_id", "text", PHRASES)


def skill_tags(v: Views) -> DataFrame:
    tagged = tagging.tag_phrases(v.documents().select("job_id", "text"), "text", PHRASES)
    return tagged.select("job_id", F.array_join(F.array_sort("skills"), ",").alias("skills"))


def skill_tags_full_tokens(v: Views) -> DataFrame:
    joined = F.replace(F.replace("text", F.lit("of the"), F.lit("of-the")),
                       F.lit("and the"), F.lit("and/the"))
    docs = v.documents().select("job_id", joined.alias("text"))
    for output, full in (("by_spaces", False), ("by_tokens", True)):
        docs = tagging.tag_phrases(docs, "text", SPLIT_PHRASES, output, full)
    return docs.select(
        "job_id", *[F.array_join(F.array_sort(c), ",").alias(c) for c in ("by_spaces", "by_tokens")])


def _phrase_table(v: Views) -> DataFrame:
    """The phrases, and the name of every part, of which the texts have none."""
    return v.spark.createDataFrame([(p,) for p in PHRASES], "phrase string").unionByName(
        v.table("part").select(F.concat("p_name", F.lit(" "), "p_partkey").alias("phrase")))


def skill_tags_table(v: Views) -> DataFrame:
    """Documents tagged with a dictionary that grows with the parts."""
    docs = v.documents().select("job_id", "text")
    found = dictionary.tag_with(docs, "job_id", "text", _phrase_table(v)).groupBy("job_id").agg(
        F.array_join(F.array_sort(F.collect_set("phrase")), ",").alias("skills"))
    return docs.select("job_id").join(found, "job_id", "left").fillna("", ["skills"])


def skill_rows(v: Views) -> DataFrame:
    return skill_plan.skill_rows(v.descriptions(), PHRASES, F.lit(EXTRACTED), MODEL)


def _skills_known(v: Views) -> DataFrame:
    """Every other known skill name is one the extraction does not find."""
    return v.table("documents").groupBy(F.col("lang").alias("skill_name")).agg(
        F.concat(F.lit("L-"), F.first("lang")).alias("skill_id")
    ).unionByName(v.table("region").filter("r_name = 'ASIA'").select(
        F.lit("the").alias("skill_name"), F.lit("S-the").alias("skill_id")))


def skills_dimension(v: Views) -> DataFrame:
    return skill_plan.merge_skills(_skills_known(v), skill_rows(v), "hash")


def skill_bridge(v: Views) -> DataFrame:
    rows = stage(skill_rows(v), "skill-rows")
    skills = skill_plan.merge_skills(_skills_known(v), rows, "hash")
    known = v.documents().filter("lang = 'en'").select("job_id", F.lit("S-the").alias("skill_id"))
    return skill_plan.merge_bridge(known, skill_plan.bridge_source(rows, skills))


# --- enrichment -------------------------------------------------------------

def _flat_enrichment(df: DataFrame) -> DataFrame:
    lists = ("extracted_skills", "benefits", "tech_stack")
    return df.withColumns({c: F.array_join(c, ",") for c in lists})


def enrichment_parse(v: Views) -> DataFrame:
    return _flat_enrichment(enrichment.parse_responses(v.responses(), F.lit(EXTRACTED)))


def enrich_incremental(v: Views) -> DataFrame:
    jobs = v.documents().select(
        "job_id", F.col("source").alias("title"), F.col("text").alias("description"))
    done = v.table("labels").select(F.col("doc_id").cast("string").alias("job_id"))
    todo = enrichment_plan.jobs_to_enrich(jobs, done)
    answers = todo.join(v.responses(), "job_id").select("job_id", "response")
    return _flat_enrichment(enrichment.parse_responses(answers, F.lit(EXTRACTED)))


def prompt_text(v: Views) -> DataFrame:
    jobs = v.descriptions()
    title, body = F.col("title"), F.col("description")
    return jobs.select("job_id", text.prompt_text(title, body).alias("prompt"),
                       text.title_and_description(title, body).alias("cluster_text"))


# --- clustering -------------------------------------------------------------

def clean_text(v: Views) -> DataFrame:
    return v.documents().select("job_id", text.clean_text(F.col("text")).alias("clean_text"))


def _weighted(df: DataFrame):
    worded = tfidf.prepare_words(
        df.withColumn("clean_text", text.clean_text(F.col("text"))), "clean_text", STOP_WORDS)
    worded = stage(worded.drop("text", "clean_text"), "words")
    vocab = tfidf.vocabulary(worded, "words")
    return tfidf.add_weights(worded, "words", vocab), vocab


def tfidf_terms(v: Views) -> DataFrame:
    weighted, vocab = _weighted(v.documents().select("job_id", "text"))
    return tfidf.document_terms(weighted, "job_id", vocab).select("job_id", "term", six("weight"))


def cluster_keywords(v: Views) -> DataFrame:
    weighted, vocab = _weighted(v.documents().select("lang", "text"))
    return tfidf.cluster_keywords(weighted, "lang", vocab).select("lang", "rank", "term", six("weight"))


def cluster_names(v: Views) -> DataFrame:
    weighted, vocab = _weighted(v.documents().select("lang", "text"))
    keywords = tfidf.cluster_keywords(weighted, "lang", vocab)
    given = v.documents().filter("lang = 'de'").select(
        "lang", F.lit('"German roles"').alias("cluster_name")).distinct()
    return clustering.cluster_names(keywords, "lang", given)


def one_hot(v: Views) -> DataFrame:
    return clustering.one_hot(clustering.categorical_pairs(v.descriptions()))


def kmeans_vectors(v: Views) -> DataFrame:
    """Every vector with whether the centre it was assigned is the nearest of all."""
    df = v.vectors().select("vec_id", "vector", array_to_vector("vector").alias("features"))
    model = clustering.fit_kmeans(df)
    centers = F.array(*[F.lit([float(x) for x in center]) for center in model.clusterCenters()])
    off = F.transform(centers, lambda c: squared_distance(F.col("vector"), c))
    return model.transform(df).select(
        "vec_id", (F.get(off, F.col("cluster_id")) <= F.array_min(off) + 1e-9).alias("nearest"))


def _categorical_clusters(v: Views) -> DataFrame:
    return clustering.categorical_kmeans(stage(clustering.categorical_pairs(v.descriptions()), "pairs"))


def kmeans_categories(v: Views) -> DataFrame:
    """Every pair with its jobs and whether its cluster's centre is the nearest, measured against every centre."""
    a, b, k = "category_label", "company_name", "cluster_id"
    found = _categorical_clusters(v)
    sizes = found.groupBy(k).agg(F.sum("jobs").alias("size"))

    def shares(column: str) -> DataFrame:
        counts = found.groupBy(k, column).agg(F.sum("jobs").alias("n")).join(sizes, k)
        return counts.select(F.col(k).alias("other"), F.col(column).alias(f"_{column}"), (F.col("n") / F.col("size")).alias(f"{column}_share"))

    norms = shares(a).union(shares(b)).groupBy("other").agg(F.sum(F.col(f"{a}_share") ** 2).alias("norm"))
    every = found.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(clustering.N_CLUSTERS - 1)))).join(norms, "other")
    for column in (a, b):
        same = [F.col("other") == F.col("_other"), F.col(column).eqNullSafe(F.col(f"_{column}"))]
        every = every.join(shares(column).withColumnRenamed("other", "_other"), same, "left").drop("_other", f"_{column}")
    off = F.col("norm") + 2 - 2 * (F.coalesce(f"{a}_share", F.lit(0.0)) + F.coalesce(f"{b}_share", F.lit(0.0)))
    measured = every.withColumn("far", off).groupBy(a, b, "jobs").agg(
        F.max(F.when(F.col("other") == F.col(k), F.col("far"))).alias("own"), F.min("far").alias("least"))
    return measured.select(a, b, "jobs", (F.col("own") <= F.col("least") + 1e-6).alias("nearest"))


def kmeans_rounds(v: Views) -> DataFrame:
    """Two rounds from the means of the labels: the cluster of every vector and its distance."""
    points = v.vectors()
    start = sorted((r["cluster_id"], list(r["center"])) for r in clustering.centers_of(points, "vector").collect())
    centers = clustering.refine_centers(points.drop("cluster_id"), "vector", start, rounds=2)
    found = clustering.assign_vectors(points.drop("cluster_id"), "vector", centers)
    return found.select("vec_id", "cluster_id", six("off"))


def kmeans_category_rounds(v: Views) -> DataFrame:
    """Two rounds from the four most frequent pairs: the cluster of every pair and its squared distance."""
    pairs = stage(clustering.categorical_pairs(v.descriptions()), "pairs")
    first = pairs.orderBy(F.desc("jobs"), "category_label", F.asc_nulls_last("company_name")).limit(4)
    start = [(r["category_label"], r["company_name"]) for r in first.collect()]
    found = clustering.categorical_kmeans(pairs, rounds=2, first=start)
    return found.select("category_label", "company_name", "jobs", "cluster_id", six("off"))


def _one_row(v: Views, schema: str, *values) -> DataFrame:
    return v.spark.createDataFrame([values], schema)


def silhouette_exact(v: Views) -> DataFrame:
    """By Euclidean distance, from sums over blocks of vectors and from counts."""
    lengths = F.least(F.floor(F.col("n_chars") / 1000), F.lit(8)).cast("int")
    clustered = v.descriptions().withColumn("cluster_id", lengths).fillna({"category_label": clustering.UNKNOWN}).groupBy(
        "category_label", "company_name", "cluster_id").agg(F.count(F.lit(1)).alias("jobs"))
    by_category = clustering.categorical_silhouette(clustered, squared=False)
    by_vector = clustering.silhouette_exact(v.vectors(), "vector", "cluster_id", block_bytes=1 << 18)
    return by_vector.select(F.lit("vectors").alias("model"), six("silhouette")).unionByName(
        by_category.select(F.lit("categories").alias("model"), six("silhouette")))


def _vector_silhouette(v: Views) -> float:
    df = v.vectors().withColumn("features", array_to_vector("vector"))
    return clustering.silhouette(df)


def silhouette_vectors(v: Views) -> DataFrame:
    return _one_row(v, "silhouette double", _vector_silhouette(v)).select(six("silhouette"))


def _categorical_silhouette(v: Views) -> DataFrame:
    """Of documents clustered by their length, by category and company."""
    lengths = F.least(F.floor(F.col("n_chars") / 1000), F.lit(8)).cast("int")
    clustered = v.descriptions().withColumn("cluster_id", lengths).fillna(
        {"category_label": clustering.UNKNOWN}
    ).groupBy("category_label", "company_name", "cluster_id").agg(F.count(F.lit(1)).alias("jobs"))
    return clustering.categorical_silhouette(clustered)


def silhouette_categories(v: Views) -> DataFrame:
    return _categorical_silhouette(v).select(six("silhouette"))


def model_select(v: Views) -> DataFrame:
    by_category = _categorical_silhouette(v).first()["silhouette"]
    winner, score = clustering.choose_model(_vector_silhouette(v), by_category)
    return _one_row(v, "winner string, score double", winner, score).select("winner", six("score"))


def _nearest(v: Views) -> DataFrame:
    points = v.vectors()
    centers = clustering.centers_of(points, "vector")
    return clustering.nearest_members(
        clustering.with_center_distance(points, "vector", centers).drop("vector"), "vec_id")


def nearest_members(v: Views) -> DataFrame:
    return _nearest(v).select("cluster_id", "rank", "vec_id", six("distance"))


def cluster_samples(v: Views) -> DataFrame:
    titled = _nearest(v).withColumn("title", F.concat(F.lit('job "'), F.col("vec_id"), F.lit('"')))
    return clustering.samples_text(titled, "cluster_id", "title")


def cluster_registry(v: Views) -> DataFrame:
    weighted, vocab = _weighted(v.members())
    keywords = tfidf.cluster_keywords(weighted, "cluster_id", vocab)
    names = clustering.cluster_names(keywords)
    registry = clustering.cluster_registry(
        v.members(), names, F.lit("Embeddings_20250101"), F.lit(EXTRACTED))
    return registry.withColumns({c: F.round(c, 6) for c in ("avg_salary_min", "avg_salary_max")})


def hybrid_clusters(v: Views) -> DataFrame:
    """The whole clustering: for each job, whether its cluster counts as many jobs as are in it, and whether the better model won."""
    jobs = v.descriptions().withColumns({
        "title": F.coalesce("title", F.lit("untitled")), "salary_min": F.lit(None).cast("double"),
        "salary_max": F.col("n_chars").cast("double")})
    day = F.lit(INGEST_TIME).cast("timestamp")
    result = cluster_plan.cluster_jobs(jobs, stop_words=STOP_WORDS, day=day, now=day)
    sizes = result.job_clusters.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))
    counted = result.registry.join(sizes, "cluster_id", "left").select(
        "cluster_id", (F.col("job_count") == F.coalesce("size", F.lit(0))).alias("counted"))
    best = result.scores[result.winner] >= max(result.scores.values())
    version = F.lit(f"{result.winner}_20250101")
    return result.job_clusters.join(counted, "cluster_id").select(
        "job_id", "counted", F.lit(best).alias("best"), (F.col("model_version") == version).alias("named"))


def blank_vector(v: Views) -> DataFrame:
    body = F.when(F.col("lang") == "fr", F.lit(" \n ")).when(F.col("lang") != "es", F.col("text"))
    docs = v.documents().select("job_id", body.alias("text"))
    vectors = clustering.text_vectors(docs, "text", "vector")
    guarded = enrichment.guard_blank(F.col("text"), vector_to_array("vector"))
    norm = F.sqrt(F.aggregate("guarded", F.lit(0.0), lambda t, x: t + x * x))
    return vectors.select("job_id", guarded.alias("guarded")).select(
        "job_id", F.size("guarded").alias("n_dims"), F.round(norm, 6).alias("norm"))


# --- streaming --------------------------------------------------------------

def stream_upsert(v: Views) -> DataFrame:
    """Two drops of staged jobs, landed and applied as a stream one after the other."""
    spark = v.spark
    base = scratch_path(spark, "stream")
    staged = v.staging_jobs()
    late = F.col("ingest_data") >= CUTOFF
    dims = (v.companies(), v.categories(), v.locations())

    def apply(rows: DataFrame, batch: str) -> None:
        tables.merge_into(
            rows.sparkSession, f"{base}/jobs", schemas.JOBS, star.jobs_source(rows, *dims),
            ["job_id"], lambda t, s: star.merge_jobs(t, s, unique_source=True), buckets=8, batch=batch)

    for day, drop in enumerate((staged.filter(~late), staged.filter(late)), start=1):
        landing.land_frames({"jobs": drop}, base, datetime(2025, 1, day))
        apply_new_files(
            spark, f"{base}/processed/jobs", schemas.STAGING_JOBS, apply, f"{base}/checkpoint")
    return plain(tables.read_table(spark, f"{base}/jobs", schemas.JOBS))


def stream_star(v: Views) -> DataFrame:
    """Postings landed in two drops and streamed into the five tables; the first run breaks off between two frames."""
    spark, base = v.spark, scratch_path(v.spark, "stream-star")
    frames = star.star_frames(stage(star.flatten(v.raw_postings()), "postings"), INGEST_TIME)
    early = F.col("job_id").cast("long") % 2 == 0
    drops = [frames | {"jobs": frames["jobs"].filter(early), "jobstats": frames["jobstats"].filter(early)},
             {name: frames[name].filter(~early) for name in ("jobs", "jobstats")}]

    def broken(spark: SparkSession, given: dict[str, DataFrame], *rest) -> None:
        star.load_star(spark, {name: df for name, df in given.items() if name != "jobstats"}, *rest)
        raise RuntimeError("broken off")

    for day, drop in enumerate(drops, start=1):
        landing.land_frames(drop, base, datetime(2025, 1, day))
        for load in (broken, star.load_star):
            try:
                update_star(spark, base, f"{base}/tables", f"{base}/checkpoint", "hash", 4, load)
            except Exception as error:
                if "broken off" not in str(error):
                    raise
    return _star_rows({name: tables.read_table(spark, f"{base}/tables/{name}", schema) for name, schema in STAR.items()})


# --- stored results of the pipelines ----------------------------------------

def _stored(v: Views, label: str) -> str:
    return scratch_path(v.spark, label)


def _store(v: Views, base: str, name: str, schema: str, rows: DataFrame, key: str) -> None:
    """A table as an earlier run left it."""
    tables.merge_into(v.spark, f"{base}/{name}", schema, rows, [key], lambda t, s: upsert(t, s, [key], unique_source=True), buckets=4)


def star_stored(v: Views) -> DataFrame:
    """Postings landed as files, loaded into staging and merged into the five tables; the jobs with their dimensions."""
    spark, base = v.spark, _stored(v, "star")
    frames = star.star_frames(stage(star.flatten(v.raw_postings()), "postings"), INGEST_TIME)
    paths = landing.land_frames(frames, f"{base}/land", INGEST_TIME)
    staging = {name: landing.load_staging(spark, paths[name], FRAMES[name], f"{base}/staging/{name}") for name in paths}
    loaded = star.load_star(spark, staging, f"{base}/tables", "hash", buckets=4)
    return _star_rows(loaded)


STAR = {"jobs": schemas.JOBS, "jobstats": schemas.JOBSTATS, "companies": schemas.COMPANIES, "categories": schemas.CATEGORIES,
        "locations": schemas.LOCATIONS}


def _star_rows(loaded: dict[str, DataFrame]) -> DataFrame:
    """The stored jobs with their dimensions."""
    jobs = loaded["jobs"].join(loaded["companies"].withColumnRenamed("company_name", "company"), "company_id", "left")
    places = loaded["locations"].select("location_id", F.col("country"))
    stats = loaded["jobstats"].select("job_id", "contract_type")
    return jobs.join(places, "location_id", "left").join(stats, "job_id").select(
        "job_id", "title", "redirected_url", "company", "category_label", F.col("category_id").isNotNull().alias("categorized"),
        "city", "state", "country", "contract_type", "ingest_data")


def skills_stored(v: Views) -> DataFrame:
    """Stored jobs tagged, and the bridge with the names of its skills."""
    spark, base = v.spark, _stored(v, "skills")
    jobs = v.descriptions()
    missing = [f.split(" ") for f in schemas.JOBS.split(", ")]
    rows = jobs.select(*[(F.col(c) if c in jobs.columns else F.lit(None)).cast(kind).alias(c) for c, kind in missing])
    _store(v, base, "jobs", schemas.JOBS, rows, "job_id")
    skill_plan.extract_skills(spark, base, PHRASES, EXTRACTED, MODEL, "hash", buckets=4)
    bridge = tables.read_table(spark, f"{base}/job_skills_bridge", schemas.JOB_SKILLS_BRIDGE)
    skills = tables.read_table(spark, f"{base}/skills", schemas.SKILLS)
    return bridge.join(skills, "skill_id").select("job_id", "skill_name")


def sponsors_stored(v: Views) -> DataFrame:
    """Petitions loaded and merged into the status, suppliers as companies matched with the employers."""
    spark, base = v.spark, _stored(v, "sponsors")
    companies = v.table("supplier").select(
        F.concat("s_name", F.lit(", Inc.")).alias("company_name"), F.md5("s_name").alias("company_id"))
    _store(v, base, "companies", schemas.COMPANIES, companies, "company_name")
    sponsor_plan.load_petitions(spark, v.petitions(), base, buckets=4)
    sponsor_plan.match_sponsors(spark, base)
    return tables.read_table(spark, f"{base}/sponsor_companies", schemas.SPONSOR_COMPANIES)


def enrichment_stored(v: Views) -> DataFrame:
    """Stored jobs enriched and embedded by stored answers, twice; both outputs side by side."""
    spark, base = v.spark, _stored(v, "enrichment")
    jobs = v.documents().select(*[
        (F.col({"job_id": "job_id", "title": "source", "description": "text"}[c]) if c in ("job_id", "title", "description")
         else F.lit(None)).cast(kind).alias(c) for c, kind in [f.split(" ") for f in schemas.JOBS.split(", ")]])
    _store(v, base, "jobs", schemas.JOBS, jobs, "job_id")
    vectors = v.vectors().select(F.col("vec_id").cast("string").alias("job_id"), "vector")
    for _ in range(2):
        enrichment_plan.enrich_jobs(
            spark, base, lambda todo: todo.join(v.responses(), "job_id").select("job_id", "response"),
            lambda todo: todo.join(vectors, "job_id").select("job_id", "vector"), "m", EXTRACTED)
    records = landing.read_appended(spark, f"{base}/job_enrichment", schemas.JOB_ENRICHMENT)
    embedded = landing.read_appended(spark, f"{base}/job_embeddings", schemas.JOB_EMBEDDINGS)
    return records.select("job_id", "years_experience_min", F.array_join("extracted_skills", ",").alias("skills")).join(
        embedded.select("job_id", F.size("embedding_vector").alias("n_dims"), "model_name"), "job_id", "full")


def files_stored(v: Views) -> DataFrame:
    """Dimension rows landed, loaded, and appended to once more."""
    base = _stored(v, "files")
    paths = landing.land_frames({"companies": v.companies().select("company_name")}, base, INGEST_TIME)
    rows = landing.load_staging(v.spark, paths["companies"], schemas.STAGING_COMPANIES, f"{base}/staging")
    landing.append(rows, f"{base}/appended", max_records_per_file=7)
    landing.append(rows, f"{base}/appended")
    return v.spark.read.parquet(f"{base}/appended").groupBy("company_name").agg(F.count(F.lit(1)).alias("copies"))


def dictionary_file(v: Views) -> DataFrame:
    """Phrases of one label from a file, and whether the names of the nations hold them."""
    path = f"{_stored(v, 'dictionary')}/phrases.csv"
    label = F.when(F.col("n_regionkey") < 3, "SKILL").otherwise("PLACE")
    v.table("nation").select(F.col("n_name").alias("phrase"), label.alias("label")).write.option("header", True).csv(path)
    phrases = tagging.read_dictionary(v.spark, path)
    tagged = tagging.tag_phrases(v.table("nation").select("n_nationkey", "n_name"), "n_name", phrases)
    return tagged.select("n_nationkey", F.array_join("skills", ",").alias("skills"))


def pages_stored(v: Views) -> DataFrame:
    """Pages written as JSON lines and read as postings."""
    path = _stored(v, "pages")
    v.pages().select(F.col("page").alias("value")).write.text(path)
    return postings.read_pages(v.spark, path).select("id", "title", "salary_max")


def version_tag(v: Views) -> DataFrame:
    """Compact and ISO stamps of every order's date."""
    at = F.col("o_orderdate").cast("timestamp")
    return v.table("orders").select(
        "o_orderkey", F.concat(F.lit("Embeddings_"), times.compact_stamp(at, with_time=False)).alias("model_version"),
        times.compact_stamp(at).alias("stamp"), times.iso_text(at).alias("updated_at"))


QUERIES = {
    "star_jobs": star_frame("jobs"),
    "star_jobstats": star_frame("jobstats"),
    "star_companies": star_frame("companies"),
    "star_categories": star_frame("categories"),
    "star_locations": star_frame("locations"),
    "row_counts": row_counts,
    "page_quarantine": page_quarantine,
    "page_explode": page_explode,
    "nanos_to_timestamp": nanos_to_timestamp,
    "latest_per_job": latest_per_job,
    "dim_key_lookup": dim_key_lookup,
    "merge_companies": merge_companies,
    "merge_categories": merge_categories,
    "merge_locations": merge_locations,
    "merge_jobs": merge_jobs,
    "merge_idempotent": merge_idempotent,
    "merge_interrupted": merge_interrupted,
    "merge_changed": merge_changed,
    "replace_interrupted": replace_interrupted,
    "append_retried": append_retried,
    "merge_jobstats": merge_jobstats,
    "merge_skills_catalogue": merge_skills_catalogue,
    "company_presence": company_presence,
    "category_overlap": category_overlap,
    "overlap_incremental": overlap_incremental,
    "petitions_clean": petitions_clean,
    "sponsorship_batch": sponsorship_batch,
    "sponsorship_merge": sponsorship_merge,
    "normalize_names": normalize_names,
    "name_mapping": name_mapping,
    "sponsor_companies": sponsor_companies,
    "unprocessed_jobs": unprocessed_jobs,
    "open_keys_bucketed": open_keys_bucketed,
    "experience_years": experience_years,
    "skill_ngrams": skill_ngrams,
    "skill_tags": skill_tags,
    "skill_tags_table": skill_tags_table,
    "skill_tags_full_tokens": skill_tags_full_tokens,
    "skill_rows": skill_rows,
    "skills_dimension": skills_dimension,
    "skill_bridge": skill_bridge,
    "enrichment_parse": enrichment_parse,
    "enrich_incremental": enrich_incremental,
    "prompt_text": prompt_text,
    "clean_text": clean_text,
    "tfidf_terms": tfidf_terms,
    "cluster_keywords": cluster_keywords,
    "cluster_names": cluster_names,
    "one_hot": one_hot,
    "kmeans_vectors": kmeans_vectors,
    "kmeans_categories": kmeans_categories,
    "kmeans_rounds": kmeans_rounds,
    "kmeans_category_rounds": kmeans_category_rounds,
    "silhouette_vectors": silhouette_vectors,
    "silhouette_categories": silhouette_categories,
    "silhouette_exact": silhouette_exact,
    "model_select": model_select,
    "nearest_members": nearest_members,
    "cluster_samples": cluster_samples,
    "cluster_registry": cluster_registry,
    "hybrid_clusters": hybrid_clusters,
    "blank_vector": blank_vector,
    "stream_upsert": stream_upsert,
    "stream_star": stream_star,
    "star_stored": star_stored,
    "skills_stored": skills_stored,
    "sponsors_stored": sponsors_stored,
    "enrichment_stored": enrichment_stored,
    "files_stored": files_stored,
    "dictionary_file": dictionary_file,
    "pages_stored": pages_stored,
    "version_tag": version_tag,
}


def bind(query):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(Views(configure(spark), folder))
    return run


def all_queries():
    return {name: bind(query) for name, query in QUERIES.items()}
