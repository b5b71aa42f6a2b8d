"""Operator 2: a quality classifier by nearest neighbours in a latent-semantic space.

A text's terms are pairs of neighbouring character classes (each punctuation mark is a
class, letters are upper, lower or other) and pairs of neighbouring words that are equal, so
they say how a text is written and not what about. A truncated singular value decomposition of
the labelled texts gives the latent space. The labelled vectors are broadcast; every
document's cosine with all of them is computed exactly, in blocks, and the labels
of the nearest vote with their similarity as weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.llm.arrow import map_texts, text_of
from hirelake.llm.scan import ASCII_WHITE, fingerprints, runs, slices, text_bytes


def _classes() -> tuple[np.ndarray, int]:
    """Class of each byte: lower, upper, digit, control, space, line end, other letters, and every mark its own."""
    classes = np.full(256, 6, np.int64)
    classes[:32] = 3
    classes[127] = 3
    classes[32], classes[10] = 4, 5
    classes[ord("a"):ord("z") + 1], classes[ord("A"):ord("Z") + 1], classes[ord("0"):ord("9") + 1] = 0, 1, 2
    count = 7
    for byte in range(33, 127):
        if not chr(byte).isalnum():
            classes[byte] = count
            count += 1
    return classes, count


_CLASS, _CLASSES = _classes()
PAIRS = _CLASSES * _CLASSES
#: Pairs of classes, then the shares of words equal to the word one and two before.
TERMS = PAIRS + 2
#: Repeated words weigh as much as so many times their share of character pairs.
REPEAT_WEIGHT = 4
#: Documents whose cosines with all labelled vectors are held at once.
BLOCK = 256


class Neighbours(NamedTuple):
    """The projection into the latent space, and the labelled vectors there (unit rows) with their labels."""

    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray


def term_rows(texts: pa.Array) -> np.ndarray:
    """A row of terms per text: square roots of their relative frequencies; all 0 for an empty text."""
    data, offsets = text_bytes(texts)
    out = np.zeros((len(texts), TERMS), np.float32)
    words = np.zeros(len(texts))
    for first, bounds, part in slices(data, offsets):
        count = len(bounds) - 1
        if not len(part):
            continue
        place = np.searchsorted(bounds, np.arange(len(part)), "right") - 1
        classes = _CLASS[part]
        inside = place[1:] == place[:-1]
        pairs = place[1:] * PAIRS + classes[:-1] * _CLASSES + classes[1:]
        out[first:first + count, :PAIRS] += np.bincount(pairs[inside], minlength=count * PAIRS).reshape(count, PAIRS)
        starts, ends = runs(~ASCII_WHITE[part], bounds)
        prints, text = fingerprints(part, starts, ends), np.searchsorted(bounds, starts, "right") - 1
        words[first:first + count] += np.bincount(text, minlength=count)
        for step in (1, 2):
            same = (prints[step:] == prints[:-step]) & (text[step:] == text[:-step])
            out[first:first + count, PAIRS + step - 1] += np.bincount(text[step:][same], minlength=count)
    total = out[:, :PAIRS].sum(axis=1, keepdims=True)
    out[:, :PAIRS] /= np.maximum(total, 1)
    out[:, PAIRS:] *= REPEAT_WEIGHT / np.maximum(words, 1)[:, None]
    return np.sqrt(out, out=out)


def fit(df: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = 6000, dimensions: int = 32,
        id_col: str = "doc_id", text_col: str = "text") -> Neighbours:
    """The labelled vectors from documents joined with their labels (0 or 1) by id.

    ``sample`` bounds what is learnt from: of more labels than that, about that many are drawn by a
    hash of the id. So the labels that are broadcast to the join, the rows that reach
    the driver and the vectors that are broadcast for scoring have a bound that does not grow with
    the input. Labels other than 0 and 1, null ids, ids with
    both labels, and ids without a document teach nothing; a repeated label or document teaches once.
    """
    known = labels.select(labels[id_col].cast("long").alias("label_id"), labels[label_col].cast("int").alias("label")) \
        .where("label_id is not null and label in (0, 1)") \
        .groupBy("label_id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").drop("other")
    count = known.count()
    parts = 1 << 20
    drawn = known.where(F.pmod(F.xxhash64("label_id"), F.lit(parts)) < min(parts, -(-parts * sample // max(count, 1))))
    docs = df.select(df[id_col].cast("long").alias("doc_id"), text_of(df, text_col).alias("text"))
    rows = docs.join(F.broadcast(drawn), F.col("doc_id") == F.col("label_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = term_rows(batch.column(2))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([row.tobytes() for row in found], pa.binary())],
                                  ["doc_id", "label", "terms"])

    columns = {"doc_id": F.col("doc_id"), "label": F.col("label"), "text": F.col("text")}
    termed = map_texts(rows, columns, "doc_id long, label int, terms binary", run)
    # Of documents that repeat an id, one teaches, so that what is collected has no more rows than labels were drawn.
    found = sorted(termed.groupBy("doc_id", "label").agg(F.min("terms").alias("terms")).collect())
    if not found:
        return Neighbours(np.zeros((TERMS, dimensions)), np.zeros((0, dimensions)), np.zeros(0))
    terms = np.array([np.frombuffer(row["terms"], np.float32) for row in found], np.float64)
    seen = (terms > 0).sum(axis=0)
    weights = np.log((1 + len(terms)) / (1 + seen)) + 1  # rarer terms weigh more
    _, directions = np.linalg.eigh((terms * weights).T @ (terms * weights))
    projection = weights[:, None] * directions[:, ::-1][:, :dimensions]
    vectors = _unit(terms @ projection)
    return Neighbours(projection, vectors, np.array([row["label"] for row in found], float))


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length == 0, 1, length)


def vote(rows: np.ndarray, model: Neighbours, neighbours: int, sharpness: float) -> np.ndarray:
    """Scores of term rows: the share of label 1 among the nearest, each with its cosine to the power ``sharpness`` as weight."""
    prior = model.labels.mean() if len(model.labels) else 0.0
    out = np.full(len(rows), prior)
    if not len(model.labels):
        return out
    nearest = min(neighbours, len(model.labels))
    for at in range(0, len(rows), BLOCK):
        part = rows[at:at + BLOCK].astype(float)
        cosine = _unit(part @ model.projection) @ model.vectors.T
        least = np.partition(cosine, -nearest, axis=1)[:, -nearest][:, None]
        weight = np.where(cosine >= least, np.maximum(cosine, 0), 0) ** sharpness  # ties with the last all vote
        total = weight.sum(axis=1)
        voted = (part.any(axis=1)) & (total > 0)
        out[at:at + BLOCK][voted] = (weight @ model.labels)[voted] / total[voted]
    return np.clip(out, 0, 1)


def score(df: DataFrame, model: Neighbours, neighbours: int = 15, sharpness: float = 8.0, text_col: str = "text", **kept: Column) -> DataFrame:
    """The ``kept`` expressions of every row and ``score`` (0 to 1, higher: label 1 likelier) for its whole text.

    An empty or null text, and every text if nothing is labelled, gets the share of label 1 among the labelled (0
    without any). One row per input row; other columns are not read. No shuffle.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)  # sample x dimensions numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = vote(term_rows(batch.column(batch.num_columns - 1)), shared.value, neighbours, sharpness)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores)], names=[*batch.schema.names[:-1], "score"])

    fields = df.select(*[expression.alias(name) for name, expression in kept.items()]).schema.add("score", "double")
    return map_texts(df, kept | {"text": text_of(df, text_col)}, fields, run)
