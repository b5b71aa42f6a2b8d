"""A corpus prepared for training: language, quality by host, near-duplicates, packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``docs``. Each result is written as Parquet and read again as the next stage's ``docs``. Columns of any
other name pass through; rows with a null id or text and repeated rows are handled as each stage says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm import language, minhash, packing, rules
from hirelake.llm.arrow import importable, whole_row
from hirelake.session import stage


#: The least cosine of a text with its language, and how much nearer that must be than the next one. A text in none of the labelled
#: languages, in other letters above all, has cosines of about 0.04 with all of them; texts of a word or two may fail as well.
LEAST_SCORE = 0.1
LEAST_MARGIN = 0.005


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are near one of the labelled languages, and nearer than to the others.

    Rejects null and empty texts, texts without letters, and those with a score below LEAST_SCORE or a margin below LEAST_MARGIN.
    """
    importable(spark)
    predicted = language.predict(docs, language.fit(docs), row=whole_row(docs))
    near = (F.col("score") >= LEAST_SCORE) & (F.col("margin") >= LEAST_MARGIN)
    return predicted.where((F.col("lang_pred") != language.UNKNOWN) & near).select("row.*")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and come from no rejected host; the host is the ``source``, null for none."""
    importable(spark)
    measured = stage(rules.measure(docs, host="source", row=whole_row(docs)), "measured-rows")
    return rules.judge(measured).where("kept").select("row.*")


def no_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, texts whose sets of 5-word shingles have a similarity of 0.8: that of the least id.

    If an id is null or repeated, rows are numbered first and written with their numbers, so that each row has its own; the row of
    the least number then stays.
    """
    importable(spark)
    keyed = docs.select(whole_row(docs).alias("row"), F.col("doc_id").cast("long").alias("key"), F.col("text").alias("text"))
    if not docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty():
        keyed = stage(keyed.withColumn("key", F.monotonically_increasing_id()), "numbered")
    found = minhash.near_duplicates(keyed, minhash.Plan(words=5), id_col="key")
    copies = stage(found.where(~F.col("kept")).select(F.col("doc_id").alias("key")), "copies")
    if copies.count() <= minhash.BROADCAST_IDS:
        copies = F.broadcast(copies)
    return keyed.join(copies, "key", "left_anti").select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and the sequences that hold them."""
    importable(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, tokens=1024)


STAGES = [
    ("language", known_language),
    ("rules", good_quality),
    ("near-duplicates", no_near_duplicates),
    ("packing", packed),
]

# Hashed vectors, signatures and tokenizers have no SQL twin; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = importable(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
