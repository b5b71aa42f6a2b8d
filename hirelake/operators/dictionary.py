"""Dictionary phrase tagging with a dictionary that is a table of any size.

The n-grams of a text are looked up in a Bloom filter inside the row, as numbers put together from the hashes of their words, so
only what passes becomes a row with a string. Those rows are written once. Their distinct forms are compared with the dictionary, and
the hits of a text are put in order again for the rule "longest first, ties to the earliest start, no overlaps". The filter
has at most :data:`FILTER_BITS` bits and is broadcast; so the plan is the same for ten
phrases and for a million. For a short list, :func:`hirelake.functions.tagging.tag_phrases` needs no exchange at all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hirelake import schemas
from hirelake.functions.tagging import tokens
from hirelake.session import broadcast_few, stage

#: The largest filter: 16 MB. Smaller dictionaries take 16 bits a phrase.
FILTER_BITS = 1 << 27
ROW_BITS = 32768
#: Odd numbers of 64 bits: one that puts the hashes of words together, and one for each bit of an n-gram in the filter.
_JOIN = 0x9E3779B97F4A7C15
_SPREAD = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def read_phrases(spark: SparkSession, path: str, label: str = "SKILL") -> DataFrame:
    """Distinct phrases of one label from a two-column CSV (phrase, label), as a table."""
    rows = spark.read.schema(schemas.DICTIONARY).csv(path, header=True)
    return rows.filter((F.col("label") == label) & (F.trim("phrase") != "")).select("phrase").distinct()


def phrase_forms(phrases: DataFrame, tokenize: bool = False) -> DataFrame:
    """``form`` (what a text must have), ``n_words`` and ``phrase`` of each distinct lower-case phrase; blank ones are left out.

    Forms are the phrases split at spaces, or with ``tokenize`` the tokens a text is split into, as for ``tag_phrases``.
    """
    lower = F.array_join(F.filter(F.split(F.lower("phrase"), r"[\s\x0B\x1C-\x1F\x85\p{Z}]+"), lambda w: w != ""), " ")
    # Distinct first: a table in one file is dealt out before its phrases are split.
    plain = phrases.select("phrase").distinct().select(lower.alias("phrase")).filter("phrase != ''").distinct()
    form = F.array_join(tokens(F.col("phrase")), " ") if tokenize else F.col("phrase")
    formed = plain.select(form.alias("form"), "phrase").filter("form != ''")
    return formed.select("form", F.size(F.split("form", " ", -1)).alias("n_words"), "phrase")


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _place(grams: np.ndarray, k: int, bits: int) -> np.ndarray:
    """The k-th bit of each n-gram in a filter of so many bits, a power of two."""
    return (grams * np.uint64(_SPREAD[k])) >> np.uint64(65 - bits.bit_length())


def _flat(hashes: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all rows one after the other, and how many each row has."""
    return (hashes.flatten().to_numpy(zero_copy_only=False).view(np.uint64),
            pc.fill_null(pc.list_value_length(hashes), 0).to_numpy(zero_copy_only=False).astype(np.int64))


def form_filter(forms: DataFrame, bits: int) -> bytes:
    """The filter: four bits of each form, set in the executors, of which only the bytes that have any come here."""

    @F.arrow_udf("array<bigint>")
    def places(hashes: pa.Array) -> pa.Array:
        flat, sizes = _flat(hashes)
        first, grams = np.cumsum(sizes) - sizes, np.zeros(len(sizes), np.uint64)
        for k in range(int(sizes.max(initial=0))):
            longer = sizes > k
            grams[longer] = grams[longer] * np.uint64(_JOIN) + flat[first[longer] + k]
        every = np.stack([_place(grams, k, bits) for k in range(len(_SPREAD))], axis=1).astype(np.int64)
        return pa.ListArray.from_arrays(np.arange(len(sizes) + 1, dtype=np.int32) * len(_SPREAD), every.ravel())

    rows = forms.select(F.explode(places(_hashes(F.split("form", " ", -1)))).alias("place")).groupBy(
        F.floor(F.col("place") / ROW_BITS).cast("int").alias("filter_row")).agg(
        F.bitmap_construct_agg(F.col("place") % ROW_BITS).alias("packed"))
    held = np.zeros((bits // ROW_BITS, ROW_BITS // 8), np.uint8)
    for row in rows.toLocalIterator():
        held[row["filter_row"]] = np.frombuffer(row["packed"], np.uint8)
    return held.tobytes()


def _spots(found: Callable[[], bytes], lengths: list[int], bits: int):
    """``start`` and ``n_words`` of the n-grams that pass the filter, for the hashes of the words of each text."""

    @F.arrow_udf("array<struct<start int, n_words int>>")
    def spots(hashes: pa.Array) -> pa.Array:
        held = np.frombuffer(found(), np.uint8)
        flat, sizes = _flat(hashes)
        ends = np.cumsum(sizes)
        left = np.repeat(ends, sizes) - np.arange(len(flat))
        grams, starts, counts = np.zeros(len(flat), np.uint64), [], []
        for n in range(1, min(lengths[-1], int(sizes.max(initial=0))) + 1):
            grams = grams[:len(flat) - n + 1] * np.uint64(_JOIN) + flat[n - 1:]
            if n not in lengths:
                continue
            at = np.flatnonzero(left[:len(grams)] >= n)
            for k in range(len(_SPREAD)):
                place = _place(grams[at], k, bits)
                at = at[(held[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1]
            starts.append(at)
            counts.append(np.full(len(at), n, np.int32))
        at, n = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, counts))
        order = np.argsort(at, kind="stable")
        at, n = at[order], n[order].astype(np.int32)
        row = np.searchsorted(ends, at, "right")
        start = (at - (ends - sizes)[row]).astype(np.int32)
        offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(sizes)))]).astype(np.int32)
        return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(start), pa.array(n)], ["start", "n_words"]))

    return spots


def _hits(df: DataFrame, key: str, text: str, forms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The places of dictionary forms in the texts, and the rows of ``forms`` (form, n_words, phrase) that were found at all."""
    spark = df.sparkSession
    distinct = forms.select("form", "n_words").distinct()
    lengths = sorted(row[0] for row in distinct.select("n_words").distinct().collect())  # a number per phrase length
    if not lengths:
        nothing = df.select(key, F.lit(0).alias("start"), F.lit(0).alias("n_words"), F.lit("").alias("form")).filter("false")
        return nothing, forms
    bits = min(FILTER_BITS, max(ROW_BITS, 1 << (16 * distinct.count() - 1).bit_length()))
    held = spark.sparkContext.broadcast(form_filter(distinct, bits))
    words = df.filter(F.col(key).isNotNull()).select(key, tokens(F.col(text)).alias("_words"))

    def gram(spot: Column) -> Column:
        form = F.lit(None).cast("string")
        for n in lengths:
            whole = F.concat_ws(" ", *[F.get("_words", spot["start"] + k) for k in range(n)])
            form = F.when(spot["n_words"] == n, whole).otherwise(form)
        return F.struct(spot["start"].alias("start"), spot["n_words"].alias("n_words"), form.alias("form"))

    spots = _spots(lambda: held.value, lengths, bits)(_hashes(F.col("_words")))
    passed = stage(words.select(key, F.inline(F.transform(spots, gram))), "passed")
    # The distinct forms are few for most dictionaries; then no hit is exchanged by its form.
    met = passed.select("form", "n_words").distinct()
    known = stage(forms.join(met, ["form", "n_words"]).select("form", "n_words", "phrase"), "known")
    return passed.join(broadcast_few(known.select("form", "n_words").distinct()), ["form", "n_words"]).select(
        key, "start", "n_words", "form"), known


def dictionary_hits(df: DataFrame, key: str, text: str, phrases: DataFrame, tokenize: bool = False) -> DataFrame:
    """Every dictionary hit before the overlap rule: ``key``, ``start`` (a token), ``n_words``, ``form``, one row per place and form."""
    return _hits(df, key, text, stage(phrase_forms(phrases, tokenize), "forms"))[0]


def tag_with(df: DataFrame, key: str, text: str, phrases: DataFrame, tokenize: bool = False) -> DataFrame:
    """``key`` and ``phrase``: the distinct phrases of a table (column ``phrase``) chosen in each text.

    The rows are those of ``tag_phrases``. ``key`` must tell the rows of ``df`` apart; rows with a null key or text have no phrases. The
    hits of a text pass through one task in order of their start, which keeps only those that overlap in a
    chain, so neither a long text nor a frequent phrase is held as a group.
    """
    found, known = _hits(df, key, text, stage(phrase_forms(phrases, tokenize), "forms"))
    kind = found.schema[key].dataType.simpleString()

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def picked(chain: list[tuple]) -> Iterator[str]:
            if len(chain) == 1:
                yield chain[0][2]
                return
            taken: set[int] = set()
            for n_words, start, form in sorted(chain, key=lambda hit: (-hit[0], hit[1])):
                span = range(start, start + n_words)
                if taken.isdisjoint(span):
                    taken.update(span)
                    yield form

        now, end, chain = None, -1, []
        for batch in batches:
            keys, forms = [], []
            for at, start, n_words, form in zip(*(column.to_pylist() for column in batch.columns)):
                if at != now or start >= end:
                    for chosen in picked(chain):
                        keys.append(now)
                        forms.append(chosen)
                    now, end, chain = at, -1, []
                chain.append((n_words, start, form))
                end = max(end, start + n_words)
            yield pa.record_batch([pa.array(keys, batch.schema.field(0).type), pa.array(forms, pa.string())], [key, "form"])
        rest = [*picked(chain)]
        if rest:
            yield pa.record_batch([pa.array([now] * len(rest), batch.schema.field(0).type), pa.array(rest, pa.string())], [key, "form"])

    ordered = found.repartition(key).sortWithinPartitions(key, "start")
    chosen = ordered.mapInArrow(choose, f"`{key}` {kind}, form string").distinct()
    # The found forms, with all phrases that have them.
    return chosen.join(broadcast_few(known.select("form", "phrase")), "form").select(key, "phrase").distinct()
