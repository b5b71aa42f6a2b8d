"""TF-IDF weights over a bounded vocabulary, and the keywords of clusters.

Finding the vocabulary is one aggregation over terms. The weights themselves are
row-local: count vector, times idf, divided by its length. No document is
shuffled, and a cluster is only ever a partial mean vector.
"""

from __future__ import annotations

from math import log
from typing import NamedTuple

from pyspark.ml.feature import (
    CountVectorizerModel, ElementwiseProduct, Normalizer, StopWordsRemover,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from hirelake.functions.text import word_list
from hirelake.operators.dedup import top_per_group


class Vocabulary(NamedTuple):
    terms: list[str]
    idf: list[float]


def default_stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def term_statistics(df: DataFrame, words: str) -> DataFrame:
    """Corpus count (tf) and document count (df) per term, in one scan and one partial sum."""
    every = df.select(F.size(words).alias("_size"), F.posexplode(F.concat(words, F.array_distinct(words))).alias("_at", "term"))
    own = F.col("_at") < F.col("_size")  # behind the words of a row are its distinct ones
    return every.groupBy("term").agg(F.count(F.when(own, 1)).alias("tf"), F.count(F.when(~own, 1)).alias("df"))


def vocabulary(df: DataFrame, words: str, max_terms: int = 500) -> Vocabulary:
    """The ``max_terms`` most frequent terms (ties by term) with their smoothed idf.

    At most ``max_terms`` rows reach the driver.
    """
    n_docs = df.count()
    top = (
        term_statistics(df, words).orderBy(F.desc("tf"), F.asc("term")).limit(max_terms).collect()
    )
    top.sort(key=lambda r: r.term)
    return Vocabulary([r.term for r in top], [log((1 + n_docs) / (1 + r.df)) + 1 for r in top])


def add_weights(df: DataFrame, words: str, vocab: Vocabulary, output: str = "tfidf") -> DataFrame:
    """Add the unit-length TF-IDF vector of each row; all zeros if no term occurs."""
    counts = CountVectorizerModel.from_vocabulary(vocab.terms, inputCol=words, outputCol="_counts")
    scaled = ElementwiseProduct(
        scalingVec=Vectors.dense(vocab.idf), inputCol="_counts", outputCol="_scaled"
    )
    unit = Normalizer(p=2.0, inputCol="_scaled", outputCol=output)
    for step in (counts, scaled, unit):
        df = step.transform(df)
    return df.drop("_counts", "_scaled")


def prepare_words(df: DataFrame, cleaned: str, stop_words: list[str], output: str = "words") -> DataFrame:
    return df.withColumn(output, word_list(F.col(cleaned), stop_words))


def _long(vector: str, vocab: Vocabulary):
    """(term, weight) pairs of a vector column."""
    terms = F.array(*[F.lit(t) for t in vocab.terms])
    return F.arrays_zip(terms.alias("term"), vector_to_array(vector).alias("weight"))


def document_terms(weighted: DataFrame, key: str, vocab: Vocabulary, vector: str = "tfidf") -> DataFrame:
    """Long form (key, term, weight) of the non-zero weights."""
    pairs = F.filter(_long(vector, vocab), lambda p: p["weight"] > 0)
    return weighted.select(key, F.inline(pairs))


def cluster_terms(weighted: DataFrame, cluster: str, vocab: Vocabulary, vector: str = "tfidf") -> DataFrame:
    """Mean weight of every term per cluster; rows without the term count as zero."""
    means = weighted.groupBy(cluster).agg(Summarizer.mean(F.col(vector)).alias("_mean"))
    return means.select(cluster, F.inline(_long("_mean", vocab)))


def cluster_keywords(
    weighted: DataFrame, cluster: str, vocab: Vocabulary, vector: str = "tfidf", n: int = 5
) -> DataFrame:
    """The ``n`` heaviest terms per cluster: (cluster, rank, term, weight)."""
    terms = cluster_terms(weighted, cluster, vocab, vector)
    return top_per_group(terms, [cluster], [F.desc("weight"), F.asc("term")], n)
