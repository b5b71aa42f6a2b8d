"""Operator 6: language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1. A trigram is the product of its three
letters' vectors, rotated by two, one and no places (so order counts); a text is the sum of its
trigrams, a language the sum of its labelled texts. A text has the language whose vector
makes the smallest angle with its own.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.llm.arrow import map_texts, text_of, with_texts
from hirelake.llm.scan import KeyTable, mix, slices, text_bytes, tool

UNKNOWN = "und"
#: Trigram vectors kept per Python worker (2 KB each at 512 dimensions) before the table is emptied.
KEPT_TRIGRAMS = 50_000
#: Bytes of text looked at at once; each takes some 100 bytes of numbers.
SLICE_BYTES = 1 << 18


class Profiles(NamedTuple):
    """Languages in order of name, and the vector of each as a row."""

    languages: tuple[str, ...]
    vectors: np.ndarray


class TrigramVectors:
    """Vectors of texts, with the trigrams met so far kept as rows of a matrix."""

    def __init__(self, dimensions: int, seed: int):
        self.dimensions, self.seed = dimensions, seed
        self.lower = np.full(0x110000, -1, np.int32)  # lower case of a letter, 0 for what is no letter, -1 not looked up yet
        self.letter = functools.lru_cache(4096)(self._letter)
        self._empty()

    def _empty(self) -> None:
        self.rows = KeyTable()
        self.vectors = np.zeros((1024, self.dimensions), np.float32)

    def _letter(self, code: int) -> np.ndarray:
        """The vector of a letter; 0 is the edge of a word."""
        return np.random.default_rng([self.seed, code]).integers(0, 2, self.dimensions).astype(np.float32) * 2 - 1

    def _symbols(self, codes: np.ndarray) -> np.ndarray:
        symbols = self.lower[codes]
        if (symbols < 0).any():
            for code in np.unique(codes[symbols < 0]).tolist():
                letter = chr(code)
                self.lower[code] = ord(letter.lower()[0]) if letter.isalpha() else 0
            symbols = self.lower[codes]
        return symbols

    def _known(self, keys: np.ndarray, letters: np.ndarray) -> np.ndarray:
        rows = self.rows.find(keys)
        if (rows < 0).any():
            fresh, first = np.unique(keys[rows < 0], return_index=True)
            at = np.flatnonzero(rows < 0)[first]
            used = self.rows.used
            if used and used + len(fresh) > KEPT_TRIGRAMS:
                self._empty()
                return self._known(keys, letters)
            if used + len(fresh) > len(self.vectors):
                more = np.zeros((max(used + len(fresh), 2 * len(self.vectors)), self.dimensions), np.float32)
                more[:used] = self.vectors[:used]
                self.vectors = more
            for k, (a, b, c) in enumerate(letters[:, at].T.tolist()):
                self.vectors[used + k] = np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(c)
            self.rows.add(fresh, np.arange(used, used + len(fresh), dtype=np.int32))
            rows = self.rows.find(keys)
        return rows

    def texts(self, texts: pa.Array) -> np.ndarray:
        """The vector of each text as a row; all zero where there is no letter.

        Trigrams are centred on the letters, with an edge symbol where a neighbour is no letter.
        """
        data, offsets = text_bytes(texts)
        out = np.zeros((len(texts), self.dimensions))
        for first, bounds, part in slices(data, offsets, SLICE_BYTES):
            codes = np.frombuffer(part.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
            begins = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])[bounds]
            symbols = self._symbols(codes)
            before, after = np.zeros_like(symbols), np.zeros_like(symbols)
            before[1:], after[:-1] = symbols[:-1], symbols[1:]
            edges = begins[(begins > 0) & (begins < len(symbols))]
            before[edges], after[edges - 1] = 0, 0
            at = np.flatnonzero(symbols)
            if not len(at):
                continue
            letters = np.stack([before[at], symbols[at], after[at]])
            wide = letters.astype(np.uint64)
            keys = mix((wide[0] << np.uint64(42)) | (wide[1] << np.uint64(21)) | wide[2])
            rows = self._known(keys, letters)
            ends = np.searchsorted(at, begins)
            for k in np.flatnonzero(ends[1:] > ends[:-1]).tolist():
                distinct, counts = np.unique(rows[ends[k]:ends[k + 1]], return_counts=True)
                out[first + k] += counts.astype(np.float32) @ self.vectors[distinct]
        return out


def _vectors(dimensions: int, seed: int) -> TrigramVectors:
    return tool(("language", dimensions, seed), lambda: TrigramVectors(dimensions, seed))


def fit(labelled: DataFrame, dimensions: int = 512, seed: int = 7, per_language: int = 4000,
        id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Language profiles of labelled texts; rows with a null language or id teach nothing.

    From a language with more than ``per_language`` rows, about that many are drawn by a hash of the
    id: a bound on the sample, whatever the input. Each task sums its own texts, and the
    driver gets one vector per language. Without labelled rows there is no language.
    """
    rows = labelled.select(labelled[id_col].cast("long").alias("doc_id"), labelled[lang_col].cast("string").alias("lang"),
                           text_of(labelled, text_col).alias("text")).where("doc_id is not null and lang is not null")
    counts = {row["lang"]: row["count"] for row in rows.groupBy("lang").count().collect()}  # a row per language
    if not counts:
        return Profiles((), np.zeros((0, dimensions)))
    parts = 1 << 20
    drawn = F.lit(parts)
    for lang, count in counts.items():
        drawn = F.when(F.col("lang") == lang, min(parts, -(-parts * per_language // count))).otherwise(drawn)
    sample = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) < drawn)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = _vectors(dimensions, seed)
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            found = vectors.texts(batch.column(1))
            langs = np.array(batch.column(0).to_pylist(), object)
            for lang in dict.fromkeys(langs):
                sums[lang] = sums.get(lang, 0) + found[langs == lang].sum(axis=0)
        for lang, vector in sums.items():
            yield pa.record_batch([pa.array([lang]), pa.array([np.rint(vector).astype(np.int64)], pa.list_(pa.int64()))], ["lang", "vector"])

    partial = map_texts(sample, {"lang": F.col("lang"), "text": F.col("text")}, "lang string, vector array<bigint>", run)
    summed = partial.select("lang", F.posexplode("vector").alias("place", "value")).groupBy("lang", "place").agg(F.sum("value").alias("value"))
    profiles: dict[str, np.ndarray] = {}
    for row in summed.collect():  # languages x dimensions rows
        profiles.setdefault(row["lang"], np.zeros(dimensions))[row["place"]] = row["value"]
    languages = tuple(sorted(profiles))
    return Profiles(languages, np.array([profiles[lang] for lang in languages]))


def predict(df: DataFrame, profiles: Profiles, seed: int = 7, text_col: str = "text", **kept: Column) -> DataFrame:
    """The ``kept`` expressions of every row with ``lang_pred``, ``score`` and ``margin`` for its whole text.

    ``score`` is the cosine with the chosen language, at least 0 and at most 1; a tie goes to the first
    by name. ``margin`` is how much smaller the cosine with the next language is (the score if there is none). A text that is null or has no letter, and any text without profiles, is :data:`UNKNOWN` with score and margin 0.
    No shuffle; the profiles (languages x dimensions numbers) go to the tasks with the function.
    """
    dimensions = profiles.vectors.shape[1]
    lengths = np.linalg.norm(profiles.vectors, axis=1, keepdims=True)
    unit = profiles.vectors / np.where(lengths == 0, 1, lengths)
    names = np.array([*profiles.languages, UNKNOWN], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = _vectors(dimensions, seed)
        for batch in batches:
            found = vectors.texts(texts(batch))
            length = np.linalg.norm(found, axis=1)
            best, score, margin = np.full(len(found), len(names) - 1), np.zeros(len(found)), np.zeros(len(found))
            known = np.flatnonzero(length > 0)
            if len(unit) and len(known):
                cosine = found[known] @ unit.T / length[known, None]
                best[known] = cosine.argmax(axis=1)
                score[known] = np.clip(cosine.max(axis=1), 0, 1)
                second = np.partition(cosine, -2, axis=1)[:, -2] if len(unit) > 1 else np.zeros(len(known))
                margin[known] = score[known] - np.clip(second, 0, 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(through)], pa.array(names[best], pa.string()), pa.array(score), pa.array(margin)],
                names=[*through, "lang_pred", "score", "margin"])

    columns, texts = with_texts(df, text_col, kept)
    through = list(kept)
    schema = df.select(*[expression.alias(name) for name, expression in kept.items()]).schema
    fields = schema.add("lang_pred", "string").add("score", "double").add("margin", "double")
    return map_texts(df, columns, fields, run)
