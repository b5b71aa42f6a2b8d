import math
import random
from collections import Counter

import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from hirelake import schemas
from hirelake.session import stage
from hirelake.operators import clustering, tfidf
from hirelake.plans.clusters import cluster_jobs, read_clustering, save_clustering

DOCS = ["red apple red", "green apple pear", "blue sky", "the sky the sea", "", "pear pear apple sky"]


@pytest.fixture
def weighted(spark):
    df = spark.createDataFrame([(i, d, i % 2) for i, d in enumerate(DOCS)], "i int, clean string, cluster_id int")
    worded = tfidf.prepare_words(df, "clean", ["the"])
    vocab = tfidf.vocabulary(worded, "words", 5)
    return tfidf.add_weights(worded, "words", vocab), vocab


def expected_weights():
    docs = [[w for w in d.split() if len(w) >= 2 and w != "the"] for d in DOCS]
    counts = Counter(w for d in docs for w in d)
    vocab = sorted(counts, key=lambda w: (-counts[w], w))[:5]
    idf = {w: math.log((1 + len(docs)) / (1 + sum(w in d for d in docs))) + 1 for w in vocab}
    out = []
    for d in docs:
        raw = {w: d.count(w) * idf[w] for w in vocab if w in d}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        out.append({w: x / norm for w, x in raw.items()})
    return vocab, out


def test_tfidf(weighted):
    frame, vocab = weighted
    terms, expected = expected_weights()
    assert vocab.terms == sorted(terms)
    got = {(r.i, r.term): r.weight for r in tfidf.document_terms(frame, "i", vocab).collect()}
    flat = {(i, w): x for i, d in enumerate(expected) for w, x in d.items()}
    assert got == pytest.approx(flat)


def test_keywords_count_zeros(weighted):
    frame, vocab = weighted
    terms, expected = expected_weights()
    got = tfidf.cluster_keywords(frame, "cluster_id", vocab).orderBy("cluster_id", "rank").collect()
    for c in (0, 1):
        members = expected[c::2]
        means = {w: sum(m.get(w, 0) for m in members) / len(members) for w in terms}
        best = sorted(means, key=lambda w: (-means[w], w))[:5]
        assert [r.term for r in got if r.cluster_id == c] == best


def test_default_stop_words(spark):
    assert "the" in tfidf.default_stop_words()


def test_dense_index(spark):
    values = spark.createDataFrame([(x,) for x in ["b", "a", None, "c", "a"]] * 20, "v string")
    index = clustering.dense_index(values, "v", "n").collect()
    assert sorted(r.n for r in index) == [0, 1, 2, 3]
    assert [r.v for r in sorted(index, key=lambda r: r.n)] == ["a", "b", "c", None]


def test_one_hot(spark):
    jobs = spark.createDataFrame([("x", "p"), ("x", None), (None, "p"), ("x", "p")],
                                 "category_label string, company_name string")
    pairs = clustering.one_hot(clustering.categorical_pairs(jobs))
    got = {(r.category_label, r.company_name): (r.jobs, r.category_place, r.company_place) for r in pairs.collect()}
    assert got == {("x", "p"): (2, 1, 2), ("x", None): (1, 1, 3), ("Unknown", "p"): (1, 0, 2)}


def test_score_counts_jobs_and_not_pairs(spark):
    """Five pairs, 125 jobs: the same score as the evaluator gives the single jobs."""
    units = [("a", "p", 0, 40), ("a", "q", 0, 35), ("b", "p", 1, 25), ("b", "r", 1, 15), ("c", "s", 2, 10)]
    schema = "category_label string, company_name string, cluster_id int, jobs bigint"
    got = clustering.categorical_silhouette(spark.createDataFrame(units, schema)).first()[0]
    places = {name: i for i, name in enumerate(["a", "b", "c", "p", "q", "r", "s"])}
    jobs = [([float(i in (places[a], places[b])) for i in range(7)], c) for a, b, c, n in units for _ in range(n)]
    rows = spark.createDataFrame(jobs, "v array<double>, cluster_id int").withColumn("features", array_to_vector("v"))
    assert got == pytest.approx(clustering.silhouette(rows))


def objective(pairs):
    """Sum of the squared distances of jobs to the mean of their cluster."""
    total = 0.0
    for cluster in {c for _, _, _, c in pairs}:
        own = [(a, b, n) for a, b, n, c in pairs if c == cluster]
        size = sum(n for _, _, n in own)
        share = Counter()
        for a, b, n in own:
            share["a", a] += n / size
            share["b", b] += n / size
        norm = sum(x * x for x in share.values())
        total += sum(n * (2 - 2 * (share["a", a] + share["b", b]) + norm) for a, b, n in own)
    return total


def test_categorical_kmeans_never_gets_worse(spark):
    draw = random.Random(8)
    counts = Counter((draw.choice("abcdef"), draw.choice(["p", "q", None, "r", "s", "t"])) for _ in range(400))
    pairs = spark.createDataFrame([(a, b, n) for (a, b), n in counts.items()],
                                  "category_label string, company_name string, jobs bigint").cache()
    found, before = None, math.inf
    for rounds in (0, 1, 2, 3, 100):
        found = [tuple(r) for r in clustering.categorical_kmeans(pairs, 5, 3, rounds).select(
            "category_label", "company_name", "jobs", "cluster_id").collect()]
        assert objective(found) <= before + 1e-9
        before = objective(found)
    assert len(found) == len(counts) and {c for _, _, _, c in found} <= set(range(5))
    # At the end no pair is nearer to another centre.
    again = clustering.assign_categories(pairs, spark.createDataFrame(found, "category_label string, company_name string, jobs bigint, cluster_id int"))
    assert {(r.category_label, r.company_name): r.cluster_id for r in again.collect()} == {(a, b): c for a, b, _, c in found}


def exact_silhouette(points, labels, far):
    scores = []
    for i, p in enumerate(points):
        means = {}
        for c in set(labels):
            others = [far(p, q) for j, q in enumerate(points) if labels[j] == c and j != i]
            means[c] = sum(others) / len(others) if others else None
        inside = means.pop(labels[i])
        outside = min(means.values())
        scores.append(0.0 if inside is None else (outside - inside) / max(inside, outside)
                      if max(inside, outside) else 0.0)
    return sum(scores) / len(scores)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_categorical_silhouette_equals_all_pairs(spark, seed):
    draw = random.Random(seed)
    points = [(draw.choice("ab" if seed < 3 else "abcdefg"), draw.choice(["p", "q", None, "r", "s"])) for _ in range(40)]
    labels = [draw.randrange(4) if seed < 3 else min("abcdefg".index(p[0]), 5) for p in points]
    far = lambda p, q: 2.0 * ((p[0] != q[0]) + (p[1] != q[1]))
    df = spark.createDataFrame([(a, b, c) for (a, b), c in zip(points, labels)],
                               "category_label string, company_name string, cluster_id int")
    grouped = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("jobs"))
    got = clustering.categorical_silhouette(grouped).first()[0]
    assert got == pytest.approx(exact_silhouette(points, labels, far))


def test_vector_silhouette_equals_all_pairs(spark):
    draw = random.Random(5)
    points = [[draw.random() for _ in range(3)] for _ in range(30)]
    labels = [i % 3 for i in range(30)]
    far = lambda p, q: sum((x - y) ** 2 for x, y in zip(p, q))
    df = spark.createDataFrame([(p, c) for p, c in zip(points, labels)], "v array<double>, cluster_id int")
    got = clustering.silhouette(df.withColumn("features", array_to_vector("v")))
    assert got == pytest.approx(exact_silhouette(points, labels, far))


def test_exact_silhouettes_equal_all_pairs(spark):
    """More blocks than one; a cluster of one, rows without vector or cluster, and equal vectors."""
    draw = random.Random(4)
    points = [([draw.gauss(3 * (k % 3), 1), draw.gauss(0, 1)], k % 3) for k in range(70)]
    points += [points[0], points[0], ([9.0, 9.0], 7), (None, 1), ([1.0, 1.0], None)]
    df = spark.createDataFrame(points, "vector array<double>, cluster_id int").repartition(3)
    known = [p for p in points if None not in p]
    off = lambda x, y: math.dist(x[0], y[0])

    def score(i):
        means = {}
        for c in {p[1] for p in known}:
            others = [off(known[i], p) for j, p in enumerate(known) if p[1] == c and j != i]
            means[c] = sum(others) / len(others) if others else None
        own = means.pop(known[i][1])
        return 0.0 if own is None else (min(means.values()) - own) / max(own, min(means.values()))

    expected = sum(map(score, range(len(known)))) / len(known)
    for size in (64, 16 * 20, 1 << 20):
        assert clustering.silhouette_exact(df, "vector", "cluster_id", size).first()[0] == pytest.approx(expected, abs=1e-9)
    assert clustering.silhouette_exact(df.filter("false"), "vector", "cluster_id").first()[0] is None
    assert clustering.silhouette_exact(df.filter("cluster_id = 1"), "vector", "cluster_id").first()[0] == 0.0


def test_blocks_meet_without_sending_the_vectors(spark, monkeypatch):
    """However many blocks there are, only sums are exchanged, at most eight for each vector and cluster."""
    plans = {}

    def noted(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return stage(df, label)

    monkeypatch.setattr(clustering, "stage", noted)
    df = spark.range(100).selectExpr("array(double(id), 1.0D) AS vector", "int(id % 2) AS cluster_id")
    before = spark.conf.get(clustering.BATCH_SETTING)
    sums = clustering.distance_sums(df, "vector", "cluster_id", 64)
    assert sums.count() == 200 and spark.conf.get(clustering.BATCH_SETTING) == before
    exchanged = plans["distance-sums"].split("Exchange")
    assert len(exchanged) == 2 and "far" in exchanged[1] and "CartesianProduct" in exchanged[1]
    assert "Generate" not in plans["distance-sums"]


def test_choose_model():
    assert clustering.choose_model(0.5, 0.5) == ("Embeddings", 0.5)
    assert clustering.choose_model(0.1, 0.2) == ("Categorical", 0.2)


def test_categorical_distance(spark):
    pairs = spark.createDataFrame(
        [("a", "p", 0, 3), ("a", None, 0, 1), ("b", "p", 1, 2)],
        "category_label string, company_name string, cluster_id int, jobs bigint")
    got = {(r.category_label, r.company_name): r.distance for r in clustering.categorical_distance(pairs).collect()}
    # Cluster 0 has the centre (a: 1, p: 3/4, null: 1/4).
    assert got["a", "p"] == pytest.approx(math.sqrt(2) / 4)
    assert got["a", None] == pytest.approx(math.sqrt(2) * 3 / 4)
    assert got["b", "p"] == pytest.approx(0.0)


def test_nearest_members(spark, rows):
    points = spark.createDataFrame(
        [(1, [0.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, [9.0, 0.0], 1), (4, [5.0, 0.0], 0)], "k int, v array<double>, cluster_id int")
    centers = spark.createDataFrame([(0, [0.0, 0.0]), (1, [10.0, 0.0])], "cluster_id int, center array<double>")
    measured = clustering.with_center_distance(points, "v", centers)
    assert rows(clustering.nearest_members(measured, "k", 2), "cluster_id", "rank", "k") == [
        (0, 1, 1), (0, 2, 2), (1, 1, 3)]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_center_distances_exchange_no_rows(spark):
    """Neither by the model, for sparse and dense vectors and an empty batch, nor by a table of centres."""
    draw = random.Random(5)
    points = [[draw.choice([0.0, 0.0, draw.random()]) for _ in range(7)] for _ in range(600)]
    rows = [(i, Vectors.dense(p) if i % 3 else Vectors.sparse(7, [(k, x) for k, x in enumerate(p) if x])) for i, p in enumerate(points)]
    df = stage(spark.createDataFrame(rows, ["i", "v"]).repartition(2), "points")
    model = clustering.fit_kmeans(df, "v", 4)
    clustered = stage(model.transform(df), "clustered")
    by_model = clustering.model_distance(clustered, "v", model)
    assert "Exchange" not in _plan(by_model)
    for r in by_model.collect():
        assert r.distance == pytest.approx(math.dist(points[r.i], model.clusterCenters()[r.cluster_id]), abs=1e-12)
    assert clustering.model_distance(clustered.filter("i < 0"), "v", model).count() == 0
    listed = clustered.select("i", "cluster_id", vector_to_array("v").alias("a"))
    by_table = clustering.with_center_distance(listed, "a", clustering.centers_of(listed, "a"))
    assert "hashpartitioning" not in _plan(by_table)
    same = by_table.select("i", F.col("distance").alias("d")).join(by_model, "i").filter("abs(d - distance) > 1e-9")
    assert by_table.count() == 600 and same.count() == 0


def test_few_pairs_exchange_no_jobs(spark, rows):
    jobs = stage(spark.createDataFrame(
        [(1, "a", "p"), (2, "a", None), (3, "b", "p"), (4, "a", "p")], "i int, category_label string, company_name string"), "jobs")
    pairs = clustering.categorical_pairs(jobs).withColumn("cluster_id", F.col("jobs").cast("int"))
    joined = clustering.join_pairs(jobs, pairs)
    assert "hashpartitioning" not in _plan(joined)
    assert rows(joined, "i", "cluster_id") == [(1, 2), (2, 1), (3, 1), (4, 2)]


def test_term_statistics(spark, rows):
    df = spark.createDataFrame([(["a", "b", "a"],), (["b"],), ([],), (None,), (["c", None, "c"],)], "words array<string>")
    stats = tfidf.term_statistics(df, "words")
    assert rows(stats, "term", "tf", "df") == sorted([("a", 2, 1), ("b", 2, 2), ("c", 2, 1), (None, 1, 1)], key=repr)


def test_one_term_names_a_cluster(spark):
    keywords = spark.createDataFrame([(0, 1, "sql")], "cluster_id int, rank int, term string")
    assert clustering.cluster_names(keywords).first().cluster_name == "Cluster_sql"


def test_many_clusters(spark):
    """More than a thousand centres, on as many jobs as have vectors of their own."""
    draw = random.Random(2)
    jobs = postings(spark, 1300)
    vectors = spark.createDataFrame([(str(i), [draw.random() for _ in range(3)]) for i in range(1300)], "job_id string, vector array<double>")
    result = cluster_jobs(jobs, vectors, k=1200, day=F.lit("2025-01-02").cast("timestamp"))
    assert result.registry.count() == 1200 and result.registry.agg(F.sum("job_count")).first()[0] == 1300


def test_names_and_registry(spark):
    keywords = spark.createDataFrame(
        [(0, 1, "sql"), (0, 2, "etl"), (1, 1, "nurse"), (1, 2, "care")], "cluster_id int, rank int, term string")
    given = spark.createDataFrame([(1, '"Clinical Care" ')], "cluster_id int, cluster_name string")
    names = clustering.cluster_names(keywords, named=given)
    members = spark.createDataFrame([(0, 1.0, None), (0, None, None), (1, 3.0, 4.0)],
                                    "cluster_id int, salary_min double, salary_max double")
    registry = clustering.cluster_registry(members, names, F.lit("v"), F.lit("t"), 3).orderBy("cluster_id").collect()
    assert [tuple(r) for r in registry] == [
        (0, "Cluster_sql_etl", "sql, etl", 2, 1.0, None, "v", "t"),
        (1, "Clinical Care", "nurse, care", 1, 3.0, 4.0, "v", "t"),
        (2, "Unpopulated Cluster", "", 0, None, None, "v", "t")]
    assert [f.name for f in clustering.cluster_registry(members, names, F.lit("v"), F.lit("t")).schema] == [
        f.split(" ")[0] for f in schemas.CLUSTER_REGISTRY.split(", ")]


def test_text_vectors(spark):
    df = spark.createDataFrame([("a b a",), (" ",), (None,)], "t string")
    got = [r[0] for r in clustering.text_vectors(df, "t", "v", 16).select(vector_to_array("v")).collect()]
    assert sum(x * x for x in got[0]) == pytest.approx(1.0)
    assert got[1] == got[2] == [0.0] * 16


def postings(spark, n=60):
    draw = random.Random(3)
    kinds = [("data", "sql pipelines warehouse"), ("care", "nurse patients ward"), ("food", "kitchen chef menu")]
    records = []
    for i in range(n):
        label, words = kinds[i % 3]
        text = " ".join(draw.choices(words.split(), k=8))
        records.append((str(i), f"{label} role", text, label if i % 5 else None, f"co{i % 4}", float(i), None))
    return spark.createDataFrame(
        records + [("x", "t", None, "data", "co1", 1.0, 1.0)],
        "job_id string, title string, description string, category_label string, company_name string, "
        "salary_min double, salary_max double")


@pytest.mark.parametrize("with_vectors", [False, True])
def test_cluster_jobs_end_to_end(spark, tmp_path, with_vectors):
    jobs = postings(spark)
    vectors = None
    if with_vectors:  # vectors without any structure, so that the categories win
        draw = random.Random(1)
        vectors = spark.createDataFrame(
            [(str(i), [draw.random() for _ in range(8)]) for i in range(60)], "job_id string, vector array<double>")
    result = cluster_jobs(jobs, vectors, k=3, day=F.lit("2025-01-02").cast("timestamp"))
    assert result.winner == ("Categorical" if with_vectors else "Embeddings")
    assigned = result.job_clusters.collect()
    assert sorted(r.job_id for r in assigned) == sorted(str(i) for i in range(60))
    assert {r.cluster_id for r in assigned} <= {0, 1, 2}
    assert {r.model_version for r in assigned} == {f"{result.winner}_20250102"}
    registry = result.registry.collect()
    assert len(registry) == 3 and sum(r.job_count for r in registry) == 60
    assert max(r["rank"] for r in result.representatives.collect()) <= 5
    save_clustering(result, str(tmp_path))
    stored, saved = read_clustering(spark, str(tmp_path))
    assert stored.count() == result.job_clusters.count()
    assert saved.count() == 3
    if not with_vectors:
        by_kind = {}
        for r in assigned:
            by_kind.setdefault(int(r.job_id) % 3, set()).add(r.cluster_id)
        assert all(len(c) == 1 for c in by_kind.values())


def test_no_jobs_is_an_error(spark):
    with pytest.raises(ValueError):
        cluster_jobs(postings(spark).filter("description IS NULL"))
