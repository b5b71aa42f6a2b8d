"""Hybrid clustering: two models, the better one described in a registry."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hirelake import schemas
from hirelake.functions.text import title_and_description
from hirelake.functions.times import compact_stamp, iso_text
from hirelake.operators import clustering as c
from hirelake.operators import tfidf
from hirelake.session import stage
from hirelake.sources.tables import read_table, replace_parts


class Clustering(NamedTuple):
    winner: str
    scores: dict[str, float]
    job_clusters: DataFrame
    registry: DataFrame
    representatives: DataFrame


def cluster_jobs(
    jobs: DataFrame,
    vectors: DataFrame | None = None,
    k: int = c.N_CLUSTERS,
    seed: int = c.SEED,
    stop_words: list[str] | None = None,
    max_terms: int = 500,
    names: DataFrame | None = None,
    day: Column | None = None,
    now: Column | None = None,
    exact: bool = False,
) -> Clustering:
    """Cluster described jobs by text vector and by category and company; keep the better model.

    Better is the higher mean silhouette of single jobs for squared Euclidean distance, for both models, or with ``exact`` for
    the distance itself, which compares every two vectors in blocks and is meant for inputs of some 100,000 jobs at most.
    ``vectors`` (job_id, vector array) replaces the built-in hashed text vectors;
    jobs without one are then left out. ``names`` (cluster_id, cluster_name) can
    override the generated cluster names.
    """
    now = now if now is not None else F.current_timestamp()
    day = day if day is not None else now
    wanted = ["job_id", "title", "description", "category_label", "company_name",
              "salary_min", "salary_max"]
    base = jobs.select(*wanted).filter("description IS NOT NULL")
    base = base.withColumn("clean_text", title_and_description(F.col("title"), F.col("description")))
    base = base.fillna({"category_label": c.UNKNOWN}).drop("description")
    if vectors is None:
        base = c.text_vectors(base, "clean_text", "vector")
    else:
        point = array_to_vector(F.col("vector").cast("array<double>")).alias("vector")
        base = base.join(vectors.select("job_id", point), "job_id")
    base = stage(base, "clustering")
    if base.isEmpty():
        raise ValueError("no jobs to cluster")

    text_model = c.fit_kmeans(base, "vector", k, seed)
    by_text = text_model.transform(base)
    if exact:
        text_score = c.silhouette_exact(by_text.withColumn("_point", vector_to_array("vector")), "_point", "cluster_id").first()["silhouette"]
    else:
        text_score = c.silhouette(by_text, "vector")

    pairs = stage(c.categorical_pairs(base), "pairs")
    pair_clusters = c.categorical_kmeans(pairs, k, seed)
    pair_score = c.categorical_silhouette(pair_clusters, squared=not exact).first()["silhouette"]

    winner, _ = c.choose_model(text_score, pair_score)
    scores = {"Embeddings": text_score, "Categorical": pair_score}
    if winner == "Embeddings":
        members = c.model_distance(by_text, "vector", text_model)
    else:
        members = c.join_pairs(base, c.categorical_distance(pair_clusters))
    members = stage(members.drop("vector"), "members")

    vocab_base = tfidf.prepare_words(members, "clean_text", stop_words or tfidf.default_stop_words())
    vocab_base = stage(vocab_base.select("cluster_id", "words"), "words")
    vocab = tfidf.vocabulary(vocab_base, "words", max_terms)
    weighted = tfidf.add_weights(vocab_base, "words", vocab)
    keywords = tfidf.cluster_keywords(weighted, "cluster_id", vocab)
    version = F.concat(F.lit(f"{winner}_"), compact_stamp(day, with_time=False))
    registry = c.cluster_registry(
        members, c.cluster_names(keywords, named=names), version, iso_text(now), k
    )
    return Clustering(
        winner, scores, c.job_clusters(members, version, now), registry,
        c.nearest_members(members.select("cluster_id", "job_id", "title", "distance"), "job_id"),
    )


def save_clustering(result: Clustering, tables: str) -> None:
    """Replace the assignment and registry tables together: readers see both of one run, or both of the one before."""
    replace_parts(result.registry.sparkSession, f"{tables.rstrip('/')}/clustering",
                  {"job_clusters": result.job_clusters, "cluster_registry": result.registry})


def read_clustering(spark: SparkSession, tables: str) -> tuple[DataFrame, DataFrame]:
    """The assignments and the registry as last saved."""
    path = f"{tables.rstrip('/')}/clustering"
    return (read_table(spark, path, schemas.JOB_CLUSTERS, "job_clusters"),
            read_table(spark, path, schemas.CLUSTER_REGISTRY, "cluster_registry"))
