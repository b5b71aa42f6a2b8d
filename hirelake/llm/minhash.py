"""Operator 7: near-duplicate texts by SuperMinHash, banding, verification and union-find.

SuperMinHash gives every element of a set a random permutation of the signature's
places; in round j the element puts j plus a random fraction into its j-th place, and
each place keeps its least value. So the places are correlated (each element takes
every place once), which lowers the variance, and an element can stop as soon as no place holds
a value of its round or later. Equal bands of places name candidates, and full sets decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.arrow import map_texts, text_of
from hirelake.llm.components import UnionFind, components
from hirelake.llm.scan import ASCII_WHITE, ascii_white_mask, fingerprints, mix, no_tool, runs, slices, text_bytes
from hirelake.session import stage

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_KEY = np.uint64(0x9E3779B97F4A7C15)
_UNSET = np.uint64(2**64 - 1)
#: Elements whose permutations are held at once.
BLOCK = 1 << 16
#: Texts that are held at once, where a bucket is not settled by its leader, of so many shingles on average (8 bytes each, 16 MB in all).
COMPARED = 2000
SHINGLES = 1000
#: Texts that pass by the held ones in one task.
SLICE = 20_000
#: So many ids are broadcast to the scan of the texts (8 bytes each, about 60 MB in a hash table); more are joined by a shuffle.
BROADCAST_IDS = 2_000_000


class Plan(NamedTuple):
    """Words per shingle, least similarity in percent, and the bands of the signature with the places of each.

    At a similarity of 0.8, all 24 bands of 4 places differ with a chance of 3 in a million.
    """

    words: int = 4
    percent: int = 80
    bands: int = 24
    rows: int = 4


def _shingles(words: np.ndarray, size: int) -> np.ndarray:
    """The distinct shingles of a text as ascending 64-bit numbers; a shorter text is one shingle."""
    if not len(words):
        return np.zeros(0, np.uint64)
    width = min(size, len(words))
    count = len(words) - width + 1
    key = np.full(count, width, np.uint64)
    for step in range(width):
        key = mix(key * _KEY + words[step:step + count])
    return np.unique(key)


def word_prints(texts: pa.Array) -> list[np.ndarray]:
    """Fingerprints of the words of each text, A-Z in lower case; words are runs of anything but ASCII white space."""
    data, offsets = text_bytes(texts)
    out: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(texts)
    for first, bounds, part in slices(data, offsets, white=ascii_white_mask):
        part = _LOWER[part]
        starts, ends = runs(~ASCII_WHITE[part], bounds)
        prints = fingerprints(part, starts, ends)
        cuts = np.searchsorted(starts, bounds).tolist()
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            before = out[first + k]
            out[first + k] = np.concatenate([before, prints[a:b]]) if len(before) else prints[a:b]
    return out


def super_minhash(sets: list[np.ndarray], places: int) -> np.ndarray:
    """The signature of each set (of distinct 64-bit numbers) as a row; empty sets keep the largest number everywhere.

    A value has its round in the top 8 bits and 56 random bits below.
    """
    if not 0 < places <= 255:
        raise ValueError("a signature has 1 to 255 places")
    out = np.full((len(sets), places), _UNSET, np.uint64)
    flat = out.reshape(-1)
    block: list[tuple[int, np.ndarray]] = []
    size = 0

    def take() -> None:
        elements = np.concatenate([x for _, x in block])
        owner = np.repeat([k for k, _ in block], [len(x) for _, x in block])
        order = np.tile(np.arange(places, dtype=np.uint8), (len(elements), 1))
        live = np.arange(len(elements))
        for turn in range(places):
            last = out[[k for k, _ in block]].max(axis=1) >> np.uint64(56)
            waiting = np.zeros(len(out), bool)
            waiting[[k for k, _ in block]] = last >= turn
            live = live[waiting[owner[live]]]
            if not len(live):
                break
            draw = mix(elements[live] + np.uint64((turn + 1) * int(_KEY) % 2**64))
            other = (turn + (((draw >> np.uint64(32)) * np.uint64(places - turn)) >> np.uint64(32)).astype(np.int64))
            place = order[live, other]
            order[live, other] = order[live, turn]
            value = (np.uint64(turn) << np.uint64(56)) | (mix(draw + _KEY) >> np.uint64(8))
            np.minimum.at(flat, owner[live] * places + place, value)

    for k, elements in enumerate(sets):
        for at in range(0, len(elements), BLOCK):  # a very large set in parts: later parts stop early
            part = elements[at:at + BLOCK]
            if size + len(part) > BLOCK and block:
                take()
                block, size = [], 0
            block.append((k, part))
            size += len(part)
            if len(elements) > BLOCK:
                take()
                block, size = [], 0
    if block:
        take()
    return out


def band_keys(signatures: np.ndarray, plan: Plan) -> np.ndarray:
    """A 64-bit key per band, a row per signature."""
    parts = signatures.reshape(len(signatures), plan.bands, plan.rows)
    key = np.arange(plan.bands, dtype=np.uint64)[None, :].repeat(len(signatures), 0)
    for k in range(plan.rows):
        key = mix(key * _KEY + parts[:, :, k])
    return key


def sketch(df: DataFrame, plan: Plan, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``content`` (a 128-bit digest of the words; null without words) and ``bands`` of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_tool()
        for batch in batches:
            words = word_prints(batch.column(1))
            sets = [_shingles(x, plan.words) for x in words]
            bands = band_keys(super_minhash(sets, plan.bands * plan.rows), plan).astype(np.int64)
            content = [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in words]
            flat = pa.array(bands.reshape(-1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(bands) + 1, dtype=np.int32) * plan.bands), flat)
            yield pa.record_batch([batch.column(0), pa.array(map(len, sets), pa.int64()), pa.array(content, pa.binary()), lists],
                                  ["doc_id", "n_shingles", "content", "bands"])

    return map_texts(df, {"doc_id": df[id_col].cast("long"), "text": text_of(df, text_col)},
                     "doc_id long, n_shingles long, content binary, bands array<bigint>", run)


def shingle_sets(df: DataFrame, plan: Plan, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``shingles`` (ascending 64-bit numbers) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_tool()
        for batch in batches:
            sets = [_shingles(x, plan.words).astype(np.int64) for x in word_prints(batch.column(1))]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64)))
            yield pa.record_batch([batch.column(0), lists], ["doc_id", "shingles"])

    return map_texts(df, {"doc_id": df[id_col].cast("long"), "text": text_of(df, text_col)}, "doc_id long, shingles array<bigint>", run)


def _similar(shared, first, second, percent: int):
    return 100 * shared >= percent * (first + second - shared)


def _sized(small, large, percent: int):
    """What two sizes must fulfil for their sets to be similar enough."""
    return 100 * F.least(small, large) >= percent * F.greatest(small, large)


class _Held:
    """The strays of a block: texts of a bucket that are not in its largest group, found again by their shingles."""

    def __init__(self, texts: list[int], groups: list[int], sets: list[np.ndarray]):
        self.texts, self.groups = np.array(texts, np.int64), groups
        self.sizes = np.array([len(x) for x in sets], np.int64)
        shingles = np.concatenate(sets)
        order = np.argsort(shingles, kind="stable")
        self.owners = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.shingles, starts = np.unique(shingles[order], return_index=True)
        self.bounds = np.append(starts, len(shingles))
        self.merged = UnionFind()
        self.open = True  # whether the strays are in several groups still

    def links(self, text: int, group: int, shingles: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
        """Links of a text with strays of other groups; at most one for each two groups that come together."""
        roots = self.merged
        if not self.open and roots.root(self.groups[0]) == roots.root(group):
            return
        at = np.minimum(np.searchsorted(self.shingles, shingles), len(self.shingles) - 1)
        at = at[self.shingles[at] == shingles]
        if not len(at):
            return
        lengths = self.bounds[at + 1] - self.bounds[at]
        first = np.repeat(self.bounds[at] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
        common = np.bincount(self.owners[first + np.arange(int(lengths.sum()))], minlength=len(self.texts))
        for k in np.flatnonzero(_similar(common, self.sizes, len(shingles), percent)).tolist():
            if roots.join(self.groups[k], group):
                yield text, int(self.texts[k])
                self.open = len({roots.root(x) for x in self.groups}) > 1


def _settle_sorted(plan: Plan):
    """Links between groups in each run of rows with one bucket, block and slice: first the strays of the block, then the slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_tool()
        now, strays, held = None, [], None
        for batch in batches:
            found = []
            lists = batch.column(6)
            ends, values = np.asarray(lists.offsets), np.asarray(lists.values)
            for k, (band, block, part, streamed, text, group) in enumerate(zip(*(column.to_pylist() for column in batch.columns[:6]))):
                if (band, block, part) != now:
                    now, strays, held = (band, block, part), [], None
                shingles = values[ends[k]:ends[k + 1]].view(np.uint64)
                if not streamed:
                    strays.append((text, group, shingles.copy()))
                    continue
                if strays and held is None:
                    held, strays = _Held(*(list(x) for x in zip(*strays))), []
                if held is not None:
                    found.extend(held.links(text, group, shingles, plan.percent))
            yield pa.record_batch([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return run


def near_duplicates(df: DataFrame, plan: Plan = Plan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (least id reachable by links) and ``kept`` (its own id) of every row.

    Two texts are linked if their sets of shingles have the given similarity; candidates share a
    band, and the full sets confirm. Exact copies (equal words) are one text from the start, so a group of
    copies costs one sum. In each bucket all texts are compared with the one of the least id; where
    they are then still in several groups, the texts outside the largest group are compared with all others of the bucket, in
    blocks of :data:`COMPARED` texts, and only links between groups leave a block.

    A text without words has an empty set and is alone. A row without id is alone: its component is null, and it is
    kept. Rows that repeat an id each follow their own text. An empty table gives no rows. Other columns are not read.
    """
    rows = stage(sketch(df, plan, id_col, text_col), "sketches")
    texts = stage(
        rows.where("doc_id is not null and content is not null").groupBy("content")
        .agg(F.min_by(F.struct("doc_id", "n_shingles", "bands"), "doc_id").alias("first"), F.count("*").alias("copies"))
        .select("content", "first.*", "copies"), "texts")
    banded = texts.select(F.col("doc_id").alias("text_id"), "n_shingles", F.explode("bands").alias("band"))
    leaders = (
        banded.groupBy("band").agg(F.min(F.struct("text_id", "n_shingles")).alias("leader"), F.count("*").alias("size"))
        .where("size > 1").select("band", F.col("leader.text_id").alias("leader"), F.col("leader.n_shingles").alias("leader_size"), "size")
    )
    shared = stage(banded.join(leaders, "band"), "buckets")
    pairs = stage(
        shared.where((F.col("text_id") != F.col("leader")) & _sized(F.col("n_shingles"), F.col("leader_size"), plan.percent))
        .select("leader", "text_id").distinct(), "pairs")
    in_buckets = stage(shared.where("size > 2").select("text_id")
                       .union(pairs.select("text_id")).union(pairs.select("leader")).distinct(), "candidates")
    docs = df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"))
    wanted = in_buckets.withColumnRenamed("text_id", "doc_id")
    if in_buckets.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    sets = stage(shingle_sets(docs.join(wanted, "doc_id", "left_semi"), plan), "sets")
    one, two = (sets.select(F.col("doc_id").alias(name), F.col("shingles").alias(f"{name}_set")) for name in ("leader", "text_id"))
    common = F.size(F.array_intersect("leader_set", "text_id_set"))
    links = stage(
        pairs.join(two, "text_id").join(one, "leader")
        .where(_similar(common, F.size("leader_set"), F.size("text_id_set"), plan.percent))
        .select(F.col("leader").alias("a"), F.col("text_id").alias("b")), "links")
    found = components(links)
    more = _within_buckets(shared, found, sets, plan)
    if not more.isEmpty():
        found = components(found.union(more))
    grouped = (
        texts.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").where("copies > 1 or low is not null")
        .select("content", F.coalesce("low", "doc_id").alias("low"))
    )
    result = rows.select("doc_id", "n_shingles", "content").join(grouped, "content", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("low", "doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _within_buckets(shared: DataFrame, found: DataFrame, sets: DataFrame, plan: Plan) -> DataFrame:
    """Links between texts of one bucket that are still in different groups, those with its leader aside.

    Texts of one group need no comparison. So the strays, those outside a bucket's largest group, are held in blocks, and the
    others pass by them once per block, in slices; those of no fitting size stay away. A bucket with one large group costs about
    as many rows as it has texts; only one of many groups costs a row per text and block of strays.
    """
    group = F.coalesce("low", "text_id")
    member = (
        shared.where("size > 2 and text_id != leader").join(found.withColumnRenamed("node", "text_id"), "text_id", "left")
        .select("band", "text_id", "n_shingles", group.alias("group"))
    )
    members = stage(member, "members")
    groups = stage(members.groupBy("band", "group").agg(
        F.count("*").alias("texts"), F.sum("n_shingles").alias("shingles"), F.min("n_shingles").alias("least"),
        F.max("n_shingles").alias("most"), F.sum(F.xxhash64("text_id").cast("decimal(38,0)")).alias("digest")), "groups")
    open_buckets = (  # buckets of the same texts are looked at once
        groups.groupBy("band").agg(F.max(F.struct("texts", "group")).alias("main"), F.sum("texts").alias("size"),
                                   F.count("*").alias("groups"), F.sum("digest").alias("digest"))
        .where("groups > 1").groupBy("size", "digest").agg(F.min(F.struct("band", F.col("main.group").alias("main"))).alias("first"))
        .select("first.*", F.ceil(F.col("size") / SLICE).cast("int").alias("slices"))
    )
    blocks = F.ceil(F.greatest(F.sum("texts") / COMPARED, F.sum("shingles") / (COMPARED * SHINGLES))).cast("int")
    strays = (
        groups.join(open_buckets, "band").where(F.col("group") != F.col("main")).groupBy("band", "main", "slices")
        .agg(blocks.alias("blocks"), F.min("least").alias("least"), F.max("most").alias("most"))
    )
    stray = F.col("group") != F.col("main")
    fits = (plan.percent * F.col("least") <= 100 * F.col("n_shingles")) & (plan.percent * F.col("n_shingles") <= 100 * F.col("most"))
    number = F.xxhash64("text_id")
    own = F.when(stray, F.pmod(number, F.col("blocks"))).otherwise(0).cast("int")
    part = F.pmod(F.shiftright(number, 20), F.col("slices")).cast("int")
    place = lambda block, part, streamed: F.struct(block.alias("block"), part.alias("part"), F.lit(streamed).alias("streamed"))
    numbers = lambda first, count: F.sequence(first, F.col(count) - 1)
    passes = F.transform(numbers(F.col("own"), "blocks"), lambda block: place(block, F.col("part"), True))
    waits = F.transform(numbers(F.lit(0), "slices"), lambda slice_: place(F.col("own"), slice_, False))
    dealt = (
        members.join(strays, "band").where(stray | fits).withColumn("own", own).withColumn("part", part)
        .select("band", "text_id", "group", F.inline(F.when(stray, F.concat(passes, waits)).otherwise(passes)))
    )
    key = ["band", "block", "part"]
    with_sets = dealt.join(sets.withColumnRenamed("doc_id", "text_id"), "text_id").select(*key, "streamed", "text_id", "group", "shingles")
    return stage(with_sets.repartition(*key).sortWithinPartitions(*key, "streamed").mapInArrow(_settle_sorted(plan), "a long, b long"), "more-links")
