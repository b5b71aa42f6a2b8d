"""Numpy scans of Arrow text batches, shared by the operators that read whole texts.

A text is looked at as UTF-8 bytes. A *unit* is a run of white space with the
characters after it, up to the next run; tokenizers that split at white space
encode a text as the sum of its units, so each distinct unit is encoded once per
Python worker and then found by its 64-bit fingerprint (:class:`UnitTable`).
Texts are taken in slices of about a megabyte, cut between units (or between words, where
those are split at ASCII white space only), so a very
long text needs no more memory than many short ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 1 << 20

ASCII_WHITE = np.zeros(256, dtype=bool)
ASCII_WHITE[[9, 10, 11, 12, 13, 32]] = True


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and its n + 1 offsets; null counts as empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def white_mask(data: np.ndarray) -> np.ndarray:
    """True at each byte of a white space character, Unicode's included."""
    mask = ASCII_WHITE[data]
    lead = np.flatnonzero((data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3))
    if len(lead):
        padded = np.concatenate([data[:], np.zeros(2, np.uint8)])
        one, two, three = data[lead], padded[lead + 1], padded[lead + 2]
        pair = (one == 0xC2) & ((two == 0x85) | (two == 0xA0))
        triple = (
            ((one == 0xE1) & (two == 0x9A) & (three == 0x80))
            | ((one == 0xE2) & (two == 0x80)
               & (((three >= 0x80) & (three <= 0x8A)) | (three == 0xA8) | (three == 0xA9) | (three == 0xAF)))
            | ((one == 0xE2) & (two == 0x81) & (three == 0x9F))
            | ((one == 0xE3) & (two == 0x80) & (three == 0x80))
        )
        for width, found in ((2, pair), (3, triple)):
            for step in range(width):
                mask[lead[found] + step] = True
    return mask


def ascii_white_mask(data: np.ndarray) -> np.ndarray:
    """True at each byte of an ASCII white space character."""
    return ASCII_WHITE[data]


def _cut(data: np.ndarray, at: int, end: int, white: Callable[[np.ndarray], np.ndarray]) -> int:
    """The first start of a run of ``white`` at or after ``at``, else ``end``."""
    while at < end:
        stop = min(at + 65536, end)
        window = white(data[at - 4:stop])
        starts = np.flatnonzero(window[4:] & ~window[3:-1])
        if len(starts):
            return at + int(starts[0])
        at = stop
    return end


def slices(data: np.ndarray, offsets: np.ndarray, limit: int = SLICE_BYTES,
           white: Callable[[np.ndarray], np.ndarray] = white_mask) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, bounds of texts, bytes) of consecutive texts of about ``limit`` bytes together.

    A longer text comes in several slices, each with bounds of one text, cut where a run of ``white`` starts.
    """
    first, count = 0, len(offsets) - 1
    while first < count:
        low = int(offsets[first])
        last = max(int(np.searchsorted(offsets, low + limit, "right")) - 1, first + 1)
        end = int(offsets[last])
        if end - low <= limit:
            yield first, offsets[first:last + 1] - low, data[low:end]
        else:
            while low < end:
                high = _cut(data, low + limit, end, white) if end - low > limit else end
                yield first, np.array([0, high - low]), data[low:high]
                low = high
        first = last


def unit_starts(data: np.ndarray, bounds: np.ndarray, white: np.ndarray | None = None) -> np.ndarray:
    """Where units start: at each text and each run of white space."""
    white = white_mask(data) if white is None else white
    start = white.copy()
    start[1:] &= ~white[:-1]
    start[bounds[:-1][bounds[:-1] < len(data)]] = True
    return np.flatnonzero(start)


def runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, split at the bounds of texts."""
    edge = bounds[:-1][bounds[:-1] < len(inside)]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    start[edge] = inside[edge]
    end[:-1] &= ~inside[1:]
    before = edge[edge > 0] - 1
    end[before] = inside[before]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


_ODD = np.uint64(0x9E3779B97F4A7C15)
#: The first bytes of an 8-byte number, by how many of them belong to a range.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Longer ranges are hashed one by one.
LANE_BYTES = 256


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of the byte ranges; equal ranges have equal fingerprints anywhere.

    A range is taken eight bytes at a time through :func:`mix`, which is not linear, so no structure of the
    bytes makes fingerprints equal; ranges of over :data:`LANE_BYTES` bytes take xxh3.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    left = ends - starts
    state = mix((lanes[starts] & _FIRST[np.minimum(left, 8)]) ^ mix(left.astype(np.uint64) * _ODD))
    live = np.flatnonzero((left > 8) & (left <= LANE_BYTES))
    done = 8
    while len(live):
        lane = lanes[starts[live] + done] & _FIRST[np.minimum(left[live] - done, 8)]
        state[live] = mix(state[live] * _ODD ^ lane)
        done += 8
        live = live[left[live] > done]
    for k in np.flatnonzero(left > LANE_BYTES).tolist():
        state[k] = xxhash.xxh3_64_intdigest(data[starts[k]:ends[k]].tobytes(), 0x5BD1)
    return state


def spread_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one range after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


_tool: list = [None, None]


def tool(key: tuple, build: Callable[[], object]) -> object:
    """What ``build`` makes, kept by the Python worker until it asks for another key.

    A worker lives for many tasks; with one tool at a time, an operator's tables do not stay in memory
    beside those of the next.
    """
    if _tool[0] != key:
        _tool[:] = [None, None]
        _tool[:] = [key, build()]
    return _tool[1]


def no_tool() -> None:
    """Let go what :func:`tool` kept: for tasks of operators without a tool, which may follow one that has in the same worker."""
    _tool[:] = [None, None]


class KeyTable:
    """Numbers of 64-bit keys: an open-addressed hash table whose operations take arrays."""

    def __init__(self):
        self.used = 0
        self._slots(1 << 15)

    def _slots(self, size: int) -> None:
        self.last = size - 1
        self.keys = np.zeros(size, np.uint64)
        self.entry = np.full(size, -1, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for an unknown one."""
        found = np.full(len(keys), -1, np.int32)
        live, wanted = np.arange(len(keys)), keys
        slot = (wanted & np.uint64(self.last)).astype(np.int64)
        while len(live):
            entry = self.entry[slot]
            hit = (self.keys[slot] == wanted) & (entry >= 0)
            found[live[hit]] = entry[hit]
            on = ~hit & (entry >= 0)
            live, wanted, slot = live[on], wanted[on], (slot[on] + 1) & self.last
        return found

    def add(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        """Enter distinct keys that are not in the table."""
        self.used += len(keys)
        numbers = numbers.astype(np.int32)
        if 5 * self.used > 3 * self.last:
            full = self.entry >= 0
            keys, numbers = np.append(self.keys[full], keys), np.append(self.entry[full], numbers)
            self._slots(1 << int(2 * self.used).bit_length())
        slot = (keys & np.uint64(self.last)).astype(np.int64)
        # Several keys may want one free slot; the one that stands there after writing has it.
        while len(keys):
            free = self.entry[slot] < 0
            at = np.arange(len(keys))
            self.entry[slot[free]] = at[free]
            mine = free & (self.entry[slot] == at)
            self.entry[slot[mine]], self.keys[slot[mine]] = numbers[mine], keys[mine]
            keys, numbers, slot = keys[~mine], numbers[~mine], (slot[~mine] + 1) & self.last


def grown(array: np.ndarray, size: int) -> np.ndarray:
    """The array with room for ``size`` items."""
    if size <= len(array):
        return array
    more = np.zeros(max(size, len(array) * 3 // 2), array.dtype)
    more[:len(array)] = array
    return more


class UnitTable:
    """Values of distinct units by fingerprint, computed on demand and kept for later batches.

    ``encode`` takes distinct units as bytes and returns their values end to end with
    the length of each. The table is emptied when it would hold more than ``limit`` units
    (about 60 bytes each and their own) or ``most_bytes`` of them, which costs time but changes no
    result. The bytes of a found unit are compared with those it was entered with, so a
    collision of fingerprints costs only another call of ``encode``.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], dtype, limit: int = 1_500_000,
                 most_bytes: int = 64 << 20):
        self.encode, self.dtype, self.limit, self.most_bytes = encode, dtype, limit, most_bytes
        self._empty()

    def _empty(self) -> None:
        self.filled = self.spelled = 0
        self.keys = KeyTable()
        self.values = np.zeros(1 << 16, self.dtype)
        self.start = np.zeros(1 << 14, np.int64)
        self.length = np.zeros(1 << 14, np.int32)
        self.spelling = np.zeros(1 << 16, np.uint8)
        self.spelling_start = np.zeros(1 << 14, np.int64)
        self.spelling_length = np.zeros(1 << 14, np.int32)

    def _add(self, prints: np.ndarray, units: list[bytes], values: np.ndarray, lengths: np.ndarray) -> None:
        used = self.keys.used
        total, filled = used + len(prints), self.filled + len(values)
        self.values, self.start, self.length = grown(self.values, filled), grown(self.start, total), grown(self.length, total)
        self.values[self.filled:filled] = values
        self.start[used:total] = self.filled + np.cumsum(lengths) - lengths
        self.length[used:total] = lengths
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        spelled = self.spelled + int(sizes.sum())
        self.spelling, self.spelling_start, self.spelling_length = (
            grown(self.spelling, spelled), grown(self.spelling_start, total), grown(self.spelling_length, total))
        self.spelling[self.spelled:spelled] = np.frombuffer(b"".join(units), np.uint8)
        self.spelling_start[used:total] = self.spelled + np.cumsum(sizes) - sizes
        self.spelling_length[used:total] = sizes
        self.keys.add(prints, np.arange(used, total, dtype=np.int32))
        self.filled, self.spelled = filled, spelled

    def _others(self, entry: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The ranges whose entry was made from other bytes."""
        size = ends - starts
        other = self.spelling_length[entry] != size
        if other.any():
            entry, starts, size = entry[~other], starts[~other], size[~other]
            where = np.flatnonzero(~other)
        else:
            where = None
        unlike = self.spelling[spread_ranges(self.spelling_start[entry], size)] != data[spread_ranges(starts, size)]
        if not unlike.any():
            return np.flatnonzero(other)
        rows = np.unique(np.searchsorted(np.cumsum(size), np.flatnonzero(unlike), "right"))
        return np.union1d(np.flatnonzero(other), rows if where is None else where[rows])

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of the units at these byte ranges, end to end, and the length of each."""
        prints = fingerprints(data, starts, ends)
        entry = self.keys.find(prints)
        missing = np.flatnonzero(entry < 0)
        if len(missing):
            more = int((ends[missing] - starts[missing]).sum())
            if self.keys.used and (self.keys.used + len(missing) > self.limit or self.spelled + more > self.most_bytes):
                self._empty()
                missing = np.arange(len(prints))
            fresh, first = np.unique(prints[missing], return_index=True)
            at = missing[first]
            raw = data.tobytes()
            units = [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())]
            self._add(fresh, units, *self.encode(units))
            entry[missing] = self.keys.find(prints[missing])
        lengths = self.length[entry].astype(np.int64)
        others = self._others(entry, data, starts, ends)
        if not len(others):
            return self.values[spread_ranges(self.start[entry], lengths)], lengths
        values, counts = self.encode([data[starts[k]:ends[k]].tobytes() for k in others.tolist()])
        begin = self.start[entry]
        begin[others] = self.filled + np.cumsum(counts) - counts
        lengths[others] = counts
        return np.append(self.values[:self.filled], values.astype(self.dtype))[spread_ranges(begin, lengths)], lengths

    def texts(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first text, values, bounds of each text's values) slice by slice; a long text comes in several."""
        data, offsets = text_bytes(texts)
        for first, bounds, part in slices(data, offsets):
            starts = unit_starts(part, bounds)
            values, lengths = self.find(part, starts, np.append(starts[1:], len(part)))
            ends = np.concatenate([[0], np.cumsum(lengths)])
            yield first, values, ends[np.searchsorted(starts, bounds)]

    def each(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """(text number, its values) in order; a long text comes in several consecutive parts."""
        for first, values, bounds in self.texts(texts):
            for k in range(len(bounds) - 1):
                yield first + k, values[bounds[k]:bounds[k + 1]]
