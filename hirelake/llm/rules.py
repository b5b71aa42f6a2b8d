"""Operator 3: quality rules, judged per document and per host.

Every document is measured; hosts are judged by the share of their documents that fail a
rule. The shares of small hosts are drawn towards the mean by a beta prior whose two parameters
come from all hosts (method of moments), and a host whose shrunken share is too high is
rejected with all its documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.llm.arrow import map_texts, with_texts
from hirelake.llm.scan import ASCII_WHITE, ascii_white_mask, fingerprints, mix, no_tool, runs, slices, text_bytes
from hirelake.session import stage

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
WINDOW = 5
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_KEY = np.uint64(0x9E3779B97F4A7C15)


class Limits(NamedTuple):
    """When a document fails: too few words, too many of them in repeated windows, too many symbols a word, too many repeated lines.

    A host is rejected if its shrunken share of failures is over ``host_percent`` and over ``host_times`` the mean of all documents.
    """

    least_words: int = 10
    repeat_percent: int = 20
    symbol_percent: int = 50
    dup_line_percent: int = 30
    host_percent: int = 25
    host_times: float = 2.0


def _per_text(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _repeated(words: np.ndarray, text: np.ndarray, count: int) -> np.ndarray:
    """Per text, the words in windows of :data:`WINDOW` words that occur at least twice in it; ``text`` is each word's text."""
    if len(words) < WINDOW:
        return np.zeros(count, np.int64)
    windows = len(words) - WINDOW + 1
    key = text[:windows].astype(np.uint64)
    for step in range(WINDOW):
        key = mix(key * _KEY + words[step:step + windows])
    inside = np.flatnonzero(text[:windows] == text[WINDOW - 1:])
    order = np.argsort(key[inside])
    ordered = key[inside][order]
    same = np.zeros(len(ordered), bool)
    same[1:] = ordered[1:] == ordered[:-1]
    same[:-1] |= ordered[1:] == ordered[:-1]
    edges = np.zeros(len(words) + 1, np.int64)
    first = inside[order[same]]
    edges[:len(words)] += np.bincount(first, minlength=len(words))
    edges -= np.bincount(first + WINDOW, minlength=len(words) + 1)
    return np.bincount(text[np.cumsum(edges[:-1]) > 0], minlength=count)


def _word_prints(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all words, and the text of each."""
    starts, ends = runs(~ASCII_WHITE[data], bounds)
    return fingerprints(data, starts, ends), np.searchsorted(bounds, starts, "right") - 1


def _line_repeats(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text, the lines with a word that equal an earlier line, and all lines with a word."""
    starts, ends = runs(data != 10, bounds)
    words = np.concatenate([[0], np.cumsum(~ASCII_WHITE[data])])
    full = words[ends] > words[starts]
    starts, ends = starts[full], ends[full]
    text = np.searchsorted(bounds, starts, "right") - 1
    key = mix(fingerprints(data, starts, ends) + text.astype(np.uint64) * _KEY)
    _, first = np.unique(key, return_index=True)
    count = len(bounds) - 1
    lines = np.bincount(text, minlength=count)
    return lines - np.bincount(text[first], minlength=count), lines


def _long_line_repeats(data: np.ndarray) -> tuple[int, int]:
    """:func:`_line_repeats` of one long text, a line at a time."""
    seen: set[bytes | int] = set()
    repeats = lines = 0
    breaks = np.flatnonzero(data == 10)
    for low, high in zip(np.concatenate([[0], breaks + 1]).tolist(), np.append(breaks, len(data)).tolist()):
        line = data[low:high]
        if ASCII_WHITE[line].all():
            continue
        key = line.tobytes()
        if len(key) > 64:
            key = hashlib.blake2b(key, digest_size=16).digest()
        if key in seen:
            repeats += 1
        lines += 1
        seen.add(key)
    return repeats, lines


def measure_texts(texts: pa.Array) -> np.ndarray:
    """The :data:`MEASURES` of each text, a row per text."""
    data, offsets = text_bytes(texts)
    out = np.zeros((len(texts), len(MEASURES)), np.int64)
    long_words: dict[int, list[np.ndarray]] = {}
    for first, bounds, part in slices(data, offsets, white=ascii_white_mask):
        count = len(bounds) - 1
        here = out[first:first + count]
        whole = int(offsets[first + count] - offsets[first]) == len(part)
        words, text = _word_prints(part, bounds)
        inside = ~ASCII_WHITE[part]
        here[:, 0] += np.bincount(text, minlength=count)
        here[:, 1] += _per_text(inside & ((part & 0xC0) != 0x80), bounds)
        here[:, 2] += _per_text(_SYMBOL[part], bounds)
        if whole:
            here[:, 3], here[:, 5] = _line_repeats(part, bounds)
            here[:, 4] = _repeated(words, text, count)
        else:
            long_words.setdefault(first, []).append(words)
    for row, parts in long_words.items():
        words = np.concatenate(parts)
        out[row, 3], out[row, 5] = _long_line_repeats(data[offsets[row]:offsets[row + 1]])
        out[row, 4] = _repeated(words, np.zeros(len(words), np.int64), 1)[0]
    return out


def measure(df: DataFrame, text_col: str = "text", host: str | None = None, **kept: Column) -> DataFrame:
    """The ``kept`` expressions, ``host`` (an SQL expression over ``df``) and the :data:`MEASURES` of every whole text.

    Words are runs of anything but the six ASCII white space characters. ``word_chars`` are the characters in words,
    ``n_symbols`` characters among ``#*$%&|<>``, ``n_dup_lines`` lines with a word that equal an earlier line,
    ``n_repeat_words`` words in windows of five that occur at least twice, ``n_lines`` lines with a word. One row per input row, repeated
    rows and null ids included; a null text measures as empty (all 0). Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_tool()
        for batch in batches:
            found = measure_texts(texts(batch))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(through)], *(pa.array(column) for column in found.T)],
                                             names=[*through, *MEASURES])

    kept = kept | {"host": (F.expr(host) if host else F.lit(None)).cast("string")}
    columns, texts = with_texts(df, text_col, kept)
    through = list(kept)
    fields = df.select(*[expression.alias(name) for name, expression in kept.items()]).schema
    for name in MEASURES:
        fields = fields.add(name, "long")
    return map_texts(df, columns, fields, run)


def base_failed(limits: Limits) -> Column:
    """Too short or too repetitive, by the measures."""
    return (F.col("n_words") < limits.least_words) | (100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words"))


def any_failed(limits: Limits) -> Column:
    """Any rule failed, by the measures: what a host's share counts."""
    return (base_failed(limits) | (100 * F.col("n_symbols") > limits.symbol_percent * F.col("n_words"))
            | (100 * F.col("n_dup_lines") > limits.dup_line_percent * F.col("n_lines")))


def beta_prior(hosts: DataFrame) -> tuple[float, float | None]:
    """Mean and strength of the beta distribution that the shares of all hosts have, from their ``documents`` and ``failures``.

    The variance is that between hosts: what chance adds for the size of each host is taken off. Without any left, no
    two hosts can be told apart: the strength is None, and all are pooled. Without hosts, the prior is (0.5, 2).
    """
    share = F.col("failures") / F.col("documents")
    row = hosts.agg(
        F.count("*").alias("hosts"), F.sum("documents").alias("documents"), F.sum("failures").alias("failures"),
        F.sum(F.col("documents") * share * share).alias("squares"),
    ).first()
    if not row["hosts"]:
        return 0.5, 2.0
    mean = row["failures"] / row["documents"]
    spread = row["squares"] / row["documents"] - mean * mean - mean * (1 - mean) * row["hosts"] / row["documents"]
    return mean, None if spread <= 0 else max(1.0, mean * (1 - mean) / spread - 1)


def host_verdicts(measured: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``host``, ``documents``, ``failures``, ``failure_rate`` (shrunken) and ``host_kept``, by ``limits``.

    Documents without a host make no host. A hot host is one row after the map-side part of the sum.
    """
    counted = measured.where("host is not null").groupBy("host").agg(
        F.count("*").alias("documents"), F.sum(any_failed(limits).cast("long")).alias("failures"))
    hosts = stage(counted, "hosts")
    mean, strength = beta_prior(hosts)
    rate = F.lit(mean) if strength is None else (F.col("failures") + F.lit(mean * strength)) / (F.col("documents") + F.lit(strength))
    most = max(limits.host_percent / 100, limits.host_times * mean)
    return hosts.withColumn("failure_rate", rate).withColumn("host_kept", F.col("failure_rate") <= most)


def judge(measured: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of a stored :func:`measure` with ``base_failed`` and ``kept``: not failed, and the host not rejected.

    Only rejected hosts are joined back, so the joined side is small; Spark broadcasts it if its size is
    below the session's threshold, and otherwise splits the partition of a hot host (adaptive skew join).
    A document without a host is judged alone.
    """
    rejected = host_verdicts(measured, limits).where(~F.col("host_kept")).select("host", F.lit(True).alias("host_rejected"))
    failed = base_failed(limits)
    return (
        measured.join(rejected, "host", "left")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & F.col("host_rejected").isNull())
        .drop("host_rejected")
    )
