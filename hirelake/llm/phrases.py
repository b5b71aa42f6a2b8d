"""Operator 11: phrase collocations by best-first branch and bound.

A phrase is grown word by word from its first word. Its score is at most what one cut gives, and a cut after a prefix of
count l gives at most 1000 n / l, because the rest is at least as frequent as the whole. So the counts of prefixes bound
the scores of all that grows from them, and the rarer a first word, the higher is its bound. The frontier (words
and phrases that were not grown yet) is expanded in batches, highest bounds first, until in every language the 2000th
surviving score exceeds every bound left; a bound equal to it is expanded too, for the sake of ties.

A batch is grown a word at a time, in two passes over the texts, which are kept as numbers of frequent words. The first counts
the 64-bit keys of all phrases that are one word longer than one of the frontier; the second counts those that reach the
least count word by word, together with the rests of phrases found before. Keys are looked up in filters of bounded size, whose
false hits cost time and change nothing, as what they let through is counted exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm.arrow import map_texts, small, text_of
from hirelake.llm.scan import ascii_white_mask, fingerprints, mix, runs, slices, text_bytes
from hirelake.session import stage

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CUT = np.zeros(256, bool)
_CUT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_OUTSIDE = _CUT.copy()
_OUTSIDE[[0x20, 0x09]] = True
_KEY = np.uint64(0x9E3779B97F4A7C15)
#: Bits of a filter at most (16 MB); smaller ones have 16 bits a key.
FILTER_BITS = 1 << 27
#: Bits in a row of a filter while it is put together, as Spark's bitmap aggregate has them.
ROW_BITS = 32768
#: Word numbers looked at together in a pass.
BLOCK = 1 << 19
GRAM = "lang string, words array<bigint>, a long, left_least long, left_most long, right_least long, right_most long"


class Plan(NamedTuple):
    """Words of a phrase, its least count, phrases wanted per language, and shares of all word occurrences whose first words make the first batches."""

    longest: int = 5
    least: int = 100
    wanted: int = 2000
    batches: tuple[float, ...] = (0.3,)


class Filter(NamedTuple):
    """A Bloom filter of 64-bit keys with two places per key; a power of two of bits, at most :data:`FILTER_BITS`."""

    bits: np.ndarray

    @classmethod
    def of(cls, keys: DataFrame) -> "Filter":
        """The filter of the column ``key``, put together by Spark; what comes to the driver is at most its bits."""
        size = min(FILTER_BITS, max(ROW_BITS, 1 << (16 * max(keys.count(), 1) - 1).bit_length()))
        place = F.explode(F.array(F.col("key"), F.shiftrightunsigned("key", 32))).alias("place")
        rows = (
            keys.select(place).select((F.col("place").bitwiseAND(F.lit(size - 1))).alias("place"))
            .groupBy((F.col("place") / ROW_BITS).cast("int").alias("row"))
            .agg(F.bitmap_construct_agg((F.col("place") % ROW_BITS)).alias("bits")).collect()
        )
        bits = np.zeros(size // 8, np.uint8)
        for row in rows:
            at = row["row"] * (ROW_BITS // 8)
            bits[at:at + ROW_BITS // 8] = np.frombuffer(row["bits"], np.uint8)
        return cls(bits)

    def has(self, keys: np.ndarray) -> np.ndarray:
        last = np.uint64(len(self.bits) * 8 - 1)
        hit = np.ones(len(keys), bool)
        for place in (keys & last, (keys >> np.uint64(32)) & last):
            hit &= (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return hit


def _language_of(df: DataFrame, lang_col: str) -> Column:
    return F.coalesce(df[lang_col].cast("string"), F.lit("und"))


def _language_keys(languages: pa.Array) -> np.ndarray:
    codes = languages.dictionary_encode()
    keys = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in codes.dictionary.to_pylist()], np.uint64)
    return keys[np.asarray(codes.indices)] if len(languages) else np.zeros(0, np.uint64)


def _first_keys(languages: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(words ^ languages)


def _longer_keys(keys: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(keys * _KEY ^ words)


def _words(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, bytes, starts and ends of words, number of the piece of each, bounds of texts in words), long texts in parts.

    Pieces of a long text are numbered on from part to part. The text is in lower case as far as A to Z go.
    """
    data, offsets = text_bytes(texts)
    before, last = 0, -1
    for first, bounds, part in slices(data, offsets, white=ascii_white_mask):
        part = _LOWER[part]
        starts, ends = runs(~_OUTSIDE[part], bounds)
        cuts = np.cumsum(_CUT[part])
        before = before if first == last and len(bounds) == 2 else 0
        pieces = (cuts[starts] if len(starts) else np.zeros(0, np.int64)) + before
        before, last = before + (int(cuts[-1]) if len(cuts) else 0), first
        yield first, part, starts, ends, pieces, np.searchsorted(starts, bounds)


def _numbers(part: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """The number of each word, not 0; a seed above 0 takes another hash."""
    if seed:
        raw = part.tobytes()
        found = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts))
    else:
        found = fingerprints(part, starts, ends)
    return np.where(found == 0, np.uint64(1), found)


def word_counts(df: DataFrame, seed: int, lang_col: str, text_col: str) -> DataFrame:
    """``lang``, ``id`` (a number by hash), ``word`` and ``n`` of all words; counts are added up per batch before they are exchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages = batch.column(0).dictionary_encode()
            of_text = np.asarray(languages.indices)
            names = languages.dictionary.to_pylist()
            for first, part, starts, ends, _, bounds in _words(batch.column(1)):
                if not len(starts):
                    continue
                ids = _numbers(part, starts, ends, seed)
                owner = of_text[first + np.searchsorted(bounds, np.arange(len(starts)), "right") - 1]
                raw = part.tobytes()
                for language in np.unique(owner).tolist():
                    own = np.flatnonzero(owner == language)
                    found, at, times = np.unique(ids[own], return_index=True, return_counts=True)
                    at = own[at]
                    words = [raw[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist())]
                    unlike = _unlike(part, starts[own], ends[own], np.searchsorted(found, ids[own]), starts[at], ends[at])
                    if len(unlike):  # two words of one number: let the numbers be found out as no good
                        other = own[unlike[0]]
                        words.append(raw[starts[other]:ends[other]].decode())
                        found, times = np.append(found, ids[other]), np.append(times, 1)
                    yield pa.record_batch([pa.array([names[language]] * len(found), pa.string()), pa.array(found.astype(np.int64)),
                                           pa.array(words, pa.string()), pa.array(times)], ["lang", "id", "word", "n"])

    parts = map_texts(df, {"lang": _language_of(df, lang_col), "text": text_of(df, text_col)}, "lang string, id long, word string, n long", run)
    return parts.groupBy("lang", "id", "word").agg(F.sum("n").alias("n"))


def _unlike(part: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: np.ndarray, first_starts: np.ndarray, first_ends: np.ndarray) -> np.ndarray:
    """Ranges whose length or first eight bytes differ from those of the range they are counted with."""
    lanes = np.ndarray(len(part) + 1, "<u8", np.concatenate([part, np.zeros(8, np.uint8)]), strides=(1,))
    mask = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)[np.minimum(ends - starts, 8)]
    return np.flatnonzero((ends - starts != (first_ends - first_starts)[which]) | (((lanes[starts] ^ lanes[first_starts][which]) & mask) != 0))


def sequences(df: DataFrame, frequent: Broadcast, seed: int, lang_col: str, text_col: str) -> DataFrame:
    """``lang`` and ``ids`` of every text with a frequent word: their numbers, 0 for whatever is between (rare words, ends of pieces)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Filter(frequent.value)
        for batch in batches:
            language = _language_keys(batch.column(0))
            ids: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
            pieces: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
            for first, part, starts, ends, piece, bounds in _words(batch.column(1)):
                number = _numbers(part, starts, ends, seed)
                owner = first + np.searchsorted(bounds, np.arange(len(starts)), "right") - 1
                number = np.where(known.has(_first_keys(language[owner], number)), number, np.uint64(0))
                for k, (a, b) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
                    if b > a:
                        ids[first + k].append(number[a:b])
                        pieces[first + k].append(piece[a:b])
            kept, out = [], []
            for k, parts in enumerate(ids):
                if not parts:
                    continue
                number, piece = np.concatenate(parts), np.concatenate(pieces[k])
                # A 0 goes before each word that begins a piece; runs of 0 become one.
                spaced = np.insert(number, np.flatnonzero(np.diff(piece)) + 1, np.uint64(0))
                doubled = np.zeros(len(spaced), bool)
                doubled[1:] = (spaced[1:] == 0) & (spaced[:-1] == 0)
                spaced = spaced[~doubled]
                if spaced.any():
                    kept.append(k)
                    out.append(spaced.astype(np.int64))
            offsets = np.cumsum([0, *map(len, out)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(out) if out else np.zeros(0, np.int64)))
            yield pa.record_batch([batch.column(0).take(pa.array(kept, pa.int64())), lists], ["lang", "ids"])

    return map_texts(df, {"lang": _language_of(df, lang_col), "text": text_of(df, text_col)}, "lang string, ids array<bigint>", run)


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(numbers, language of each by place in the batch, key of that language, how many phrases may start), in blocks.

    Number 0 stands before each text and at the ends; a block begins one number before its first
    phrase start and holds enough numbers for the phrases that start in it.
    """
    lists = batch.column(1)
    offsets = np.asarray(lists.offsets).astype(np.int64)
    values = np.asarray(lists.values).astype(np.uint64)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    numbers = np.concatenate([np.insert(values, offsets[:-1], np.uint64(0)), np.zeros(8, np.uint64)])
    row = np.concatenate([np.repeat(np.arange(batch.num_rows), np.diff(offsets) + 1), np.zeros(8, np.int64)])
    key = _language_keys(batch.column(0))
    for at in range(0, len(numbers) - 8, BLOCK):
        count = min(BLOCK, len(numbers) - 8 - at)
        part = numbers[at:at + count + 8]
        owner = row[at:at + count + 8]
        yield part, owner, key[owner] if len(key) else np.zeros(len(owner), np.uint64), count


def _phrase_keys(numbers: np.ndarray, language: np.ndarray, count: int, longest: int, path: Filter) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words, starts, keys) of phrases of 1, 2, ... words that start at places 1 to ``count``; those in ``path`` are lengthened."""
    starts = np.flatnonzero(numbers[1:count + 1] != 0) + 1
    keys = _first_keys(language[starts], numbers[starts])
    size = 1
    while True:
        yield size, starts, keys
        if size == longest or not len(starts):
            return
        on = np.flatnonzero(numbers[starts + size] != 0)
        on = on[path.has(keys[on])]
        starts = starts[on]
        keys = _longer_keys(keys[on], numbers[starts + size])
        size += 1


#: Groups a task adds up before it hands them on.
HELD = 300_000


def longer_keys(texts: DataFrame, path: Broadcast, size: int, plan: Plan) -> DataFrame:
    """``key`` of the phrases of ``size`` + 1 words all of whose prefixes are in the filter, at least ``plan.least`` times in a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Filter(path.value)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def added_up() -> tuple[np.ndarray, np.ndarray]:
            keys, at = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
            return keys, np.bincount(at, np.concatenate([x for _, x in held])).astype(np.int64)

        def batch_of(keys: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
            return pa.record_batch([pa.array(keys.astype(np.int64)), pa.array(times)], ["key", "n"])

        for batch in small(batches):
            for numbers, _, language, count in _blocks(batch):
                for words, _, keys in _phrase_keys(numbers, language, count, size + 1, known):
                    if words == size + 1 and len(keys):
                        held.append(np.unique(keys, return_counts=True))
            if sum(len(x) for x, _ in held) > HELD:
                held = [added_up()]
                if 2 * len(held[0][0]) > HELD:
                    yield batch_of(*held.pop())
        if held:
            yield batch_of(*added_up())

    counted = texts.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= plan.least).select("key")


_SIDES = [("before", "min"), ("before", "max"), ("after", "min"), ("after", "max")]


def exact_counts(texts: DataFrame, wanted: Broadcast, path: Broadcast, plan: Plan) -> DataFrame:
    """The phrases of two words and more whose keys are in ``wanted``, by their words, with counts of at least ``plan.least``.

    All their prefixes are in ``path``. Of the words right before and after its occurrences (0: none or a rare one) a phrase has
    the least and the greatest number; where these are equal and not 0, every occurrence is part of the same longer phrase.
    """
    word = [f"w{k}" for k in range(plan.longest)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, along = Filter(wanted.value), Filter(path.value)
        held: dict[int, list[pa.Table]] = {}

        def added_up(size: int) -> pa.Table:
            table = pa.concat_tables(held[size]).group_by(["lang", *word[:size]]).aggregate(
                [("a", "sum"), *((f"{side}_{end}", end) for side, end in _SIDES)])
            return table.rename_columns([name.removesuffix("_sum").replace("_min_min", "_min").replace("_max_max", "_max") for name in table.column_names])

        def batch_of(size: int, table: pa.Table) -> pa.RecordBatch:
            flat = np.stack([table[name].to_numpy() for name in word[:size]], axis=1).ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(table.num_rows + 1, dtype=np.int32) * size), pa.array(flat))
            rest = [table[name].combine_chunks() for name in ("a", "before_min", "before_max", "after_min", "after_max")]
            return pa.record_batch([table["lang"].combine_chunks(), lists, *rest], [x.split()[0] for x in GRAM.split(", ")])

        for batch in small(batches):
            names = batch.column(0).dictionary_encode()
            for numbers, owner, language, count in _blocks(batch):
                for size, starts, keys in _phrase_keys(numbers, language, count, plan.longest, along):
                    starts = starts[known.has(keys)] if size > 1 else starts[:0]
                    if not len(starts):
                        continue
                    columns = {name: numbers[starts + k].astype(np.int64) for k, name in enumerate(word[:size])}
                    columns["lang"] = np.asarray(names.indices)[owner[starts]]
                    before, after = numbers[starts - 1].astype(np.int64), numbers[starts + size].astype(np.int64)
                    table = pa.table(columns | {"before": before, "after": after, "a": np.ones(len(starts), np.int64)})
                    table = table.group_by(["lang", *word[:size]]).aggregate([("a", "sum"), *_SIDES])
                    table = table.rename_columns([name.removesuffix("_sum") for name in table.column_names])
                    spelled = names.dictionary.take(pa.array(table["lang"].to_numpy()))
                    held.setdefault(size, []).append(table.set_column(table.column_names.index("lang"), "lang", spelled))
            for size in [size for size, tables in held.items() if sum(t.num_rows for t in tables) > HELD]:
                held[size] = [added_up(size)]
                if 2 * held[size][0].num_rows > HELD:
                    yield batch_of(size, held.pop(size)[0])
        for size in held:
            yield batch_of(size, added_up(size))

    return (
        texts.mapInArrow(run, GRAM).groupBy("lang", "words")
        .agg(F.sum("a").alias("a"), F.min("left_least").alias("left_least"), F.max("left_most").alias("left_most"),
             F.min("right_least").alias("right_least"), F.max("right_most").alias("right_most"))
        .where(F.col("a") >= plan.least)
    )


def _keys_of(phrases: DataFrame) -> DataFrame:
    """``key`` of phrases given as ``lang`` and ``words``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            language, lists = _language_keys(batch.column(0)), batch.column(1)
            offsets, values = np.asarray(lists.offsets), np.asarray(lists.values).astype(np.uint64)
            sizes = np.diff(offsets)
            keys = np.zeros(len(sizes), np.uint64)
            for k in range(int(sizes.max(initial=0))):
                rows = np.flatnonzero(sizes > k)
                words = values[offsets[rows] + k]
                keys[rows] = _longer_keys(keys[rows], words) if k else _first_keys(language[rows], words)
            yield pa.record_batch([pa.array(keys.astype(np.int64))], ["key"])

    return phrases.select("lang", "words").mapInArrow(run, "key long")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _floor(a: Column, n: Column, rest: Column) -> Column:
    """floor(1000 a n / rest), exact up to 10^38."""
    wide = lambda x: x.cast("decimal(38,0)")
    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * (a.cast("decimal(17,0)") * n.cast("decimal(17,0)")), wide(rest))


def scored(phrases: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """The phrases with ``l``, ``r``, ``n`` and ``score`` of their lowest cut; without those of which a part has no count yet."""
    size = F.size("words")
    cut = F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
    cuts = phrases.select("*", cut).select("*", F.slice("words", F.lit(1), F.col("k")).alias("head"),
                                           F.slice("words", F.col("k") + 1, size - F.col("k")).alias("tail"))
    left = counts.select("lang", F.col("words").alias("head"), F.col("a").alias("l"))
    right = counts.select("lang", F.col("words").alias("tail"), F.col("a").alias("r"))
    product = F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(19,0)")
    known = cuts.join(left, ["lang", "head"]).join(right, ["lang", "tail"]).join(totals, "lang").select(
        *phrases.columns, "k", "l", "r", "n", _floor(F.col("a"), F.col("n"), product).alias("score"))
    best = F.min(F.struct("score", "k", "l", "r"))
    return (
        known.groupBy(*phrases.columns, "n").agg(best.alias("cut"), F.count("*").alias("cuts")).where(F.col("cuts") == size - 1)
        .select(*phrases.columns, F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    )


def survives(plan: Plan) -> Column:
    """Whether no longer phrase has all occurrences of this one.

    If one does, so does one that is a single word longer; it has the same count, so its words and itself are frequent.
    """
    same = lambda side: (F.col(f"{side}_least") == F.col(f"{side}_most")) & (F.col(f"{side}_most") != 0)
    return (F.size("words") == plan.longest) | ~(same("left") | same("right"))


def _last_score(phrases: DataFrame, plan: Plan) -> DataFrame:
    """``lang`` and ``last``, the score of the last wanted phrase, of languages that have so many."""
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score")))
    return phrases.select("lang", "score", place.alias("place")).where(F.col("place") <= plan.wanted).where(
        F.col("place") == plan.wanted).select("lang", F.col("score").alias("last"))


def _roots(frequent: DataFrame, totals: DataFrame, plan: Plan) -> DataFrame:
    """Frequent words with their bound and batch: the batch holds the rarest words that make up a share of the occurrences."""
    band = F.floor(2 * F.log2("a")).cast("int")
    mass = frequent.groupBy("lang", band.alias("band")).agg(F.sum("a").alias("mass"))
    window = Window.partitionBy("lang").orderBy("band")
    upto = F.sum("mass").over(window) / F.sum("mass").over(Window.partitionBy("lang"))
    below = [(upto > share).cast("int") for share in plan.batches]
    batch = reduce(Column.__add__, below) if below else F.lit(0)
    bands = mass.select("lang", "band", F.when(F.row_number().over(window) == 1, 0).otherwise(batch).alias("batch"))
    rows = frequent.select("lang", "words", "a", band.alias("band")).join(bands, ["lang", "band"]).join(totals, "lang")
    return rows.select("lang", "words", _floor(F.lit(1), F.col("n"), F.col("a")).alias("bound"), "batch")


class Mined(NamedTuple):
    """Phrases with their scores, the words of their numbers, and how many batches were expanded."""

    phrases: DataFrame
    words: DataFrame
    rounds: int


def mine(df: DataFrame, plan: Plan = Plan(), lang_col: str = "lang", text_col: str = "text") -> Mined:
    """Grow phrases until the wanted ones of every language are settled; see :func:`phrase_report` for the rules."""
    seed = 0
    while True:
        words = stage(word_counts(df, seed, lang_col, text_col), "words")
        # Two words of one number, at least one of them frequent: take another hash.
        if words.groupBy("lang", "id").agg(F.count("*").alias("c"), F.sum("n").alias("n")).where((F.col("c") > 1) & (F.col("n") >= plan.least)).isEmpty():
            break
        seed += 1
    totals = stage(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    dictionary = stage(words.where(F.col("n") >= plan.least).select("lang", F.array("id").alias("words"), F.col("n").alias("a"), "word"), "dictionary")
    single = dictionary.select("lang", "words", "a")
    frequent = df.sparkSession.sparkContext.broadcast(Filter.of(_keys_of(single)).bits)
    texts = stage(sequences(df, frequent, seed, lang_col, text_col), "sequences")
    frequent.destroy()
    roots = stage(_roots(single, totals, plan), "roots")
    spark = df.sparkSession
    grams: list[DataFrame] = [spark.createDataFrame([], GRAM)]
    settled = spark.createDataFrame([], "lang string")
    rounds = 0

    def broadcast(keys: DataFrame) -> Broadcast:
        return spark.sparkContext.broadcast(Filter.of(keys).bits)

    def missing(phrases: DataFrame) -> DataFrame:
        """Phrases without a count so far."""
        return phrases.join(_union(grams).select("lang", "words"), ["lang", "words"], "left_anti")

    def parts(phrases: DataFrame, expression: str) -> DataFrame:
        return phrases.select("lang", F.explode(F.expr(expression)).alias("words"))

    for batch in range(len(plan.batches) + 1):
        first = stage(roots.where(F.col("batch") == batch).join(settled, "lang", "left_anti").select("lang", "words"), "first-words")
        if first.isEmpty():
            continue
        rounds += 1
        frontier = [stage(_keys_of(first), "frontier")]
        fresh = grams[0]
        for size in range(1, plan.longest + 1):
            # Every part behind a cut of what was found last is counted, whether or not it is grown itself.
            rests = fresh.select("lang", "words")  # up to two words have no such part
            if size > 2:
                tails = parts(fresh.where(F.size("words") > 2), "transform(sequence(2, size(words) - 1), k -> slice(words, k, size(words)))")
                rests = stage(missing(tails.distinct()), "rests")
            else:
                rests = rests.where("false")
            wanted = _keys_of(rests)
            if size < plan.longest:
                path = broadcast(_union(frontier))
                wanted = wanted.union(longer_keys(texts, path, size, plan))
            wanted = stage(wanted, "keys")
            if size < plan.longest:
                path.destroy()
            if wanted.isEmpty():
                break
            before = parts(rests, "transform(sequence(1, size(words) - 1), k -> slice(words, 1, k))").distinct()
            filters = broadcast(wanted), broadcast(_union(frontier).union(_keys_of(before)))
            fresh = stage(missing(exact_counts(texts, *filters, plan)), "phrases")
            for filter_bits in filters:
                filter_bits.destroy()
            grams.append(fresh)
            # To be grown next: phrases of one more word that begin with a word of this batch, found now or as a rest before.
            longer = _union(grams).where(F.size("words") == size + 1).select("lang", F.slice("words", 1, 1).alias("first"), "words")
            frontier.append(stage(_keys_of(longer.join(first.withColumnRenamed("words", "first"), ["lang", "first"], "left_semi")), "frontier"))
        if batch < len(plan.batches):
            known = stage(_union(grams), "phrases")
            grams = [known]
            done = scored(known, single.union(known.select("lang", "words", "a")), totals)
            last = _last_score(done.where(survives(plan)), plan)
            highest = roots.where(F.col("batch") > batch).groupBy("lang").agg(F.max("bound").alias("bound"))
            settled = stage(last.join(highest, "lang", "left").where(F.col("bound").isNull() | (F.col("bound") < F.col("last"))).select("lang"), "settled")
    known = _union(grams)
    return Mined(scored(known, single.union(known.select("lang", "words", "a")), totals), dictionary, rounds)


def phrase_report(df: DataFrame, plan: Plan = Plan(), lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: the first phrases of each language by score, count and phrase.

    Texts, A-Z in lower case, are split at ``[.,;:!?`` and line ends ``]`` into pieces and these at spaces and tabs into words. Within a
    language (null: ``und``) ``n`` counts all words, ``a`` the occurrences of a phrase of 2 to 5 words within pieces, if at least
    100. A cut gives ``floor(1000 a n / (l r))`` with the counts of both parts; the lowest cut is the score, the shortest first part
    on ties. A phrase is left out if a longer one has all its occurrences. A null text has no words; repeated rows count
    again; an empty table gives no rows. Other columns are not read.
    """
    mined = mine(df, plan, lang_col, text_col)
    alive = stage(mined.phrases.where(survives(plan)).select("lang", "words", "a", "l", "r", "n", "score"), "surviving")
    first = alive.join(_last_score(alive, plan), "lang", "left").where(F.col("last").isNull() | (F.col("score") >= F.col("last"))).drop("last")
    spelled = mined.words.select("lang", F.col("words")[0].alias("id"), "word")
    placed = first.select("*", F.posexplode("words").alias("place", "id")).join(spelled, ["lang", "id"])
    named = placed.groupBy("lang", "words", "a", "l", "r", "n", "score").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return named.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= plan.wanted).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
