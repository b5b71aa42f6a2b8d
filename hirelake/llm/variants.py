"""Operator 12: grouping spelling variants by range searches in k-d trees over letter counts.

A word is the vector of how often it has each letter. One letter inserted or deleted moves the
vector by an L1 distance of one, one replaced by at most two, so near words of a word are among the
words of its length within two, and those of the length below (or above) within one. The words of each length
are dealt into cells by the upper levels of a k-d tree; a word is a guest in every cell whose box is within its range (of
two cells of one length, in one only, as what is found there counts for both words).
In a cell, a k-d tree of the words that live there is searched for all guests at once, boxes out of range are
pruned, and the letters themselves confirm what is found.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.arrow import map_texts, small, text_of
from hirelake.llm.scan import ascii_white_mask, runs, slices, text_bytes
from hirelake.session import stage

#: Axes of the vectors. Letters beyond a to z share some, which only brings vectors nearer.
AXES = 32
_AXIS = np.array([x - 97 if 97 <= x <= 122 else 26 + x % (AXES - 26) for x in range(256)])
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), 0xC3]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: About so many words, drawn by hash, from which the upper levels of the trees are laid out; every word is put into them.
SAMPLE = 100_000
#: Words that live in a cell, about; a tree is split until it has so few, whatever the number of words.
CELL_WORDS = 20_000
#: Words at a leaf of the tree within a cell, and guests searched for at once.
LEAF_WORDS = 128
GUESTS = 4096


class Plan(NamedTuple):
    """Letters a word must have, how often it must occur, the share of runs that lose a letter, and how much more frequent a form is."""

    letters: int = 7
    occurrences: int = 2
    losing: int = 31
    ratio: int = 10


def _runs_of(texts: pa.Array) -> Iterator[tuple[int, list[bytes], list[int]]]:
    """(first text, lower-cased letter runs of some texts, the number of runs before each text and in all), long texts in parts."""
    data, offsets = text_bytes(texts)
    for first, bounds, part in slices(data, offsets, white=ascii_white_mask):
        inside = _LETTER[part]
        inside[1:] |= part[:-1] == 0xC3  # in UTF-8, C3 and its follower are U+00C0 to U+00FF
        starts, ends = runs(inside, bounds)
        raw = _LOWER[part].tobytes()
        yield first, [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())], np.searchsorted(starts, bounds).tolist()


def word_counts(df: DataFrame, plan: Plan = Plan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word`` and ``n`` of all words of whole texts with enough letters and occurrences.

    Runs of A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case. Of a share of the runs, chosen by the crc32 of the id (empty if
    null), a colon and the run, one letter is left out. A null text has none. Counts are added up per Arrow batch and
    per partition before they are exchanged, so that a frequent word is no hot key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[bytes] = Counter()
            ids = ["" if x is None else str(x) for x in batch.column(0).to_pylist()]
            for first, found, bounds in _runs_of(batch.column(1)):
                for k, (low, high) in enumerate(zip(bounds, bounds[1:])):
                    start = zlib.crc32(f"{ids[first + k]}:".encode())
                    for word in found[low:high]:
                        if len(word) < plan.letters:
                            continue
                        h = zlib.crc32(word, start)
                        if h % plan.losing == 0:
                            letters = word.decode()
                            at = h % len(letters)
                            word = (letters[:at] + letters[at + 1:]).encode()
                        counts[word] += 1
            words = [word.decode() for word in counts]
            kept = [k for k, word in enumerate(words) if len(word) >= plan.letters]
            totals = list(counts.values())
            yield pa.record_batch([pa.array([words[k] for k in kept], pa.string()), pa.array([totals[k] for k in kept], pa.int64())], ["word", "n"])

    parts = map_texts(df, {"doc_id": df[id_col].cast("string"), "text": text_of(df, text_col)}, "word string, n long", run)
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= plan.occurrences)


def letter_counts(words: np.ndarray) -> np.ndarray:
    """The vectors of words of one length, given as rows of letters."""
    count, length = words.shape
    flat = (np.arange(count)[:, None] * AXES + _AXIS[words]).ravel()
    return np.bincount(flat, minlength=count * AXES).reshape(count, AXES).astype(np.int8 if length <= 100 else np.int32)


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places in the list, rows of letters) of the words of each length."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        yield length, at, np.frombuffer("".join(words[k] for k in at.tolist()).encode("latin-1"), np.uint8).reshape(len(at), length)


class _Split(NamedTuple):
    axis: int
    most: int  # vectors up to this go low
    low: object  # a split, or the number of a cell
    high: object


def _halves(vectors: np.ndarray) -> tuple[int, int] | None:
    """The axis and the count that divide the vectors most evenly, None if they are all the same."""
    best = None
    for axis in np.argsort(-vectors.std(axis=0))[:4].tolist():
        values = np.sort(vectors[:, axis])
        if values[0] == values[-1]:
            continue
        middle = int(values[(len(values) - 1) // 2])
        for most in {middle, middle - 1}:
            low = int(np.searchsorted(values, most, "right"))
            if 0 < low < len(values) and (best is None or abs(2 * low - len(values)) < best[0]):
                best = abs(2 * low - len(values)), axis, most
    return None if best is None else best[1:]


def _upper(vectors: np.ndarray, leaf: float, counter: list[int]) -> object:
    halves = _halves(vectors) if len(vectors) > leaf else None
    if halves is None:
        counter[0] += 1
        return counter[0] - 1
    axis, most = halves
    low = vectors[:, axis] <= most
    return _Split(axis, most, _upper(vectors[low], leaf, counter), _upper(vectors[~low], leaf, counter))


def upper_levels(sample: list[str], share: float) -> dict[int, object]:
    """The splits for each length, from a sample of ``share`` of all words; a length without any is one cell."""
    return {length: _upper(letter_counts(rows), CELL_WORDS * share, [0]) for length, _, rows in _by_length(sample)}


def cells_within(tree: object, vectors: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray]]:
    """(cell, rows) of all vectors whose L1 distance to the box of a cell is at most ``reach``."""
    spent = np.zeros((len(vectors), AXES), vectors.dtype)
    stack = [(tree, np.arange(len(vectors)), spent)]
    while stack:
        node, rows, spent = stack.pop()
        if not isinstance(node, _Split):
            yield node, rows
            continue
        value = vectors[rows, node.axis]
        for side, over in ((node.low, value - node.most), (node.high, node.most + 1 - value)):
            here = spent.copy()
            here[:, node.axis] = np.maximum(here[:, node.axis], over)
            near = here.sum(axis=1, dtype=np.int64) <= reach
            if near.any():
                stack.append((side, rows[near], here[near]))


def codes_of(vectors: np.ndarray) -> np.ndarray:
    """Vectors as two 64-bit numbers: a count c is c ones in four bits, so that an L1 distance is a number of different bits.

    Counts above four are taken as four, which only brings vectors nearer.
    """
    unary = np.array([0, 1, 3, 7, 15], np.uint64)[np.minimum(vectors, 4)]
    shifts = np.arange(16, dtype=np.uint64) * np.uint64(4)
    return np.stack([np.bitwise_or.reduce(unary[:, half:half + 16] << shifts, axis=1) for half in (0, 16)])


class CellTree:
    """A k-d tree of vectors with the box of each node, as the least and the greatest counts in :func:`codes_of`."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.codes = codes_of(vectors)
        self.nodes: list[tuple] = []  # (least, greatest, places at a leaf or None, low child, high child)
        self.root = self._grow(np.arange(len(vectors)))

    def _grow(self, at: np.ndarray) -> int:
        here = self.vectors[at]
        halves = _halves(here) if len(at) > LEAF_WORDS else None
        number = len(self.nodes)
        self.nodes.append(())
        below = (at, -1, -1)
        if halves is not None:
            low = here[:, halves[0]] <= halves[1]
            below = (None, self._grow(at[low]), self._grow(at[~low]))
        codes = self.codes[:, at]
        self.nodes[number] = (np.bitwise_and.reduce(codes, axis=1), np.bitwise_or.reduce(codes, axis=1), *below)
        return number

    def within(self, guests: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(guest, place) of all pairs with an L1 distance of at most ``reach`` by their codes, in parts; guests are codes."""
        stack = [(self.root, np.arange(guests.shape[1]))]
        while stack:
            number, rows = stack.pop()
            least, greatest, at, low, high = self.nodes[number]
            away = np.zeros(len(rows), np.uint8)
            for half in (0, 1):
                here = guests[half, rows]
                away += np.bitwise_count(least[half] & ~here) + np.bitwise_count(here & ~greatest[half])
            rows = rows[away <= reach]
            if not len(rows):
                continue
            if at is None:
                stack += [(low, rows), (high, rows)]
                continue
            for part in range(0, len(at), LEAF_WORDS):  # equal vectors cannot be split, so a leaf may be larger
                own = at[part:part + LEAF_WORDS]
                distance = np.bitwise_count(guests[0, rows][:, None] ^ self.codes[0, own])
                distance += np.bitwise_count(guests[1, rows][:, None] ^ self.codes[1, own])
                guest, place = np.nonzero(distance <= reach)
                if len(guest):
                    yield rows[guest], own[place]


def one_edit(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Which rows of letters differ by exactly one replaced letter, or by one more letter in the first."""
    length = second.shape[1]
    if first.shape[1] == length:
        return (first != second).sum(axis=1) == 1
    same = np.ones((len(first), length + 1), bool)
    same[:, 1:] = np.logical_and.accumulate(first[:, :length] == second, axis=1)
    tail = np.ones((len(first), length + 1), bool)
    tail[:, :length] = np.logical_and.accumulate((first[:, 1:] == second)[:, ::-1], axis=1)[:, ::-1]
    return (same & tail).any(axis=1)  # equal up to some place, and again after one more letter


class _Near:
    """Near words so far: how many a word has, and the most frequent, the smallest of several."""

    def __init__(self):
        self.found: dict[str, list] = {}

    def add(self, word: str, other: str, n: int) -> None:
        entry = self.found.get(word)
        if entry is None:
            self.found[word] = [1, n, other]
            return
        entry[0] += 1
        if n > entry[1] or n == entry[1] and other < entry[2]:
            entry[1:] = n, other

    def batch(self) -> pa.RecordBatch:
        rows = list(self.found.items())
        self.found = {}
        return pa.record_batch(
            [pa.array([word for word, _ in rows], pa.string()), *(pa.array([x[k] for _, x in rows], kind)
                                                                 for k, kind in enumerate((pa.int64(), pa.int64(), pa.string())))],
            ["word", "n_near", "best_n", "best"])


#: What a word is to a cell: it lives there, comes from a later cell of its length, or has one more letter.
_LIVES, _GUEST, _LONGER = 0, 1, 2


def _search_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words within each cell and between it and its guests; rows come cell by cell, those who live there first.

    Every two words meet once, and each becomes a near word of the other.
    """
    now, tree, letters = None, None, None
    living: tuple[list, list] = ([], [])
    near = _Near()

    def search(rows: np.ndarray, words: list[str], times: list[int], inside: bool) -> None:
        reach = 2 if rows.shape[1] == letters.shape[1] else 1
        for at in range(0, len(words), GUESTS):
            part = rows[at:at + GUESTS]
            for guest, place in tree.within(codes_of(letter_counts(part)), reach):
                if inside:
                    later = place > guest + at
                    guest, place = guest[later], place[later]
                real = one_edit(part[guest], letters[place])
                for a, b in zip((guest[real] + at).tolist(), place[real].tolist()):
                    near.add(words[a], living[0][b], living[1][b])
                    near.add(living[0][b], words[a], times[a])

    def plant() -> None:
        """The tree of those who live in the cell, once all of them have come."""
        nonlocal tree, letters
        _, _, letters = next(_by_length(living[0]))
        tree = CellTree(letter_counts(letters))
        search(letters, *living, inside=True)

    for batch in small(batches, GUESTS):
        cells, kind = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        edges = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]
        for low, high in zip(edges, edges[1:]):
            if cells[low] != now:
                if living[0] and tree is None:
                    plant()
                now, tree, living = cells[low], None, ([], [])
            words, times = (batch.column(k).slice(low, high - low).to_pylist() for k in (2, 3))
            own = int((kind[low:high] == _LIVES).sum())
            living[0].extend(words[:own])
            living[1].extend(times[:own])
            if own == len(words) or not living[0]:
                continue
            if tree is None:
                plant()
            for _, at, rows in _by_length(words[own:]):
                search(rows, [words[own + k] for k in at.tolist()], [times[own + k] for k in at.tolist()], inside=False)
        if near.found:
            yield near.batch()
    if living[0] and tree is None:
        plant()
    if near.found:
        yield near.batch()


def near_words(words: DataFrame, letters: int) -> DataFrame:
    """``word``, ``n_near``, ``best_n`` and ``best`` (the near word of largest ``n``, ties to the smallest) of words that have near ones.

    ``words`` (``word``, ``n``) is a stored table of distinct words. The upper levels of the trees come from about :data:`SAMPLE` words
    drawn by hash. How many cells a word visits grows with the square of the depth, at most.
    """
    total = words.count()
    share = min(1.0, SAMPLE / max(total, 1))
    drawn = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30))
    trees = upper_levels([r.word for r in words.where(drawn).select("word").collect()], share)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, GUESTS):
            cells, guest, row = [], [], []

            def put(length: int, cell: int, kind: int, places: np.ndarray) -> None:
                cells.append(np.full(len(places), (length << 32) + cell, np.int64))
                guest.append(np.full(len(places), kind, np.int32))
                row.append(places)

            for length, at, letters_of in _by_length(batch.column(0).to_pylist()):
                vectors = letter_counts(letters_of)
                home = np.zeros(len(at), np.int64)
                for cell, rows in cells_within(trees.get(length, 0), vectors, 0):
                    home[rows] = cell
                    put(length, cell, _LIVES, at[rows])
                for cell, rows in cells_within(trees.get(length, 0), vectors, 2):
                    put(length, cell, _GUEST, at[rows[home[rows] > cell]])
                if length > letters:
                    for cell, rows in cells_within(trees.get(length - 1, 0), vectors, 1):
                        put(length - 1, cell, _LONGER, at[rows])
            if row:
                taken = batch.take(pa.array(np.concatenate(row)))
                yield pa.record_batch([pa.array(np.concatenate(cells)), pa.array(np.concatenate(guest)), *taken.columns], ["cell", "guest", "word", "n"])

    dealt = words.select("word", "n").mapInArrow(deal, "cell long, guest int, word string, n long")
    found = (
        dealt.repartition(max(8, total // (CELL_WORDS // 4)), "cell").sortWithinPartitions("cell", "guest")
        .mapInArrow(_search_cells, "word string, n_near long, best_n long, best string")
    )
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), "best"))
    return (
        found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("least"))
        .select("word", "n_near", (-F.col("least.minus")).alias("best_n"), F.col("least.best").alias("best"))
    )


def variant_groups(df: DataFrame, plan: Plan = Plan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of all distinct words of :func:`word_counts`.

    Two words are near if they differ by exactly one inserted, deleted or replaced letter. ``form`` is the near word of largest ``n``
    (ties: the smallest in code-point order) if that is at least ``plan.ratio`` times the word's own, else null; ``root`` is where following forms ends.
    As ``n`` grows tenfold at each step, chains are short; they are followed by joins that double what is
    known. Rows that repeat an id count again; a null text has no words; an empty table gives no rows. Other columns are not read.
    """
    words = stage(word_counts(df, plan, id_col, text_col), "words")
    known = stage(words.join(near_words(words, plan.letters), "word", "left"), "near-words")
    formed = F.col("best_n") >= plan.ratio * F.col("n")
    current = stage(known.where(formed).select("word", F.col("best").alias("root")), "forms")
    while True:
        further = current.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = current.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved"))
        moved = stage(moved, "roots")
        current = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return known.join(current, "word", "left").select(
        "word", F.when(formed, F.col("best")).alias("form"), F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(formed, F.col("best_n")).alias("form_n"))
