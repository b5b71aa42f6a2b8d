"""Operator 1: byte-level BPE encoding and decoding with numpy.

Texts are split by the vocabulary's pattern; distinct pieces are grouped by
length into padded matrices of token ids. Each round, every row merges its
leftmost pair of least rank (pairs are found in a hash table), the gap is closed,
and rows without a pair left leave the matrix.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from hirelake.llm.arrow import map_texts, text_of
from hirelake.llm.scan import KeyTable, UnitTable, mix, spread_ranges, tool

#: Pieces of more bytes than this are merged one by one with a heap; a matrix would need a round per byte.
MATRIX_BYTES = 256
NO_RANK = np.int32(2**31 - 1)


class PairTable:
    """Rank of the token that two tokens make together, by open hashing; also the id of that token."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, made = [], [], []
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    made.append(rank)
        self.table = KeyTable()
        self.table.add(self._key(np.array(left, np.int64), np.array(right, np.int64)), np.array(made, np.int32))

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return mix(((left.astype(np.int64) << 32) | right).astype(np.uint64))

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs, :data:`NO_RANK` where they make no token or one side is padding (-1)."""
        shape, left, right = left.shape, left.ravel(), right.ravel()
        found = np.full(len(left), NO_RANK, np.int32)
        live = np.flatnonzero((left >= 0) & (right >= 0))
        rank = self.table.find(self._key(left[live], right[live]))
        found[live] = np.where(rank < 0, NO_RANK, rank)
        return found.reshape(shape)


class Bpe:
    """Encoder and decoder of a rank file: a line per token, base64 of its bytes and its rank."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        # Python's \s also has the separators 1C to 1F, which are no white space to Unicode.
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.pairs = PairTable(self.ranks)
        self.single = np.full(256, -1, np.int32)
        for byte in range(256):
            self.single[byte] = self.ranks.get(bytes([byte]), -1)
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.token_length = np.fromiter(map(len, tokens), np.int64, size)
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.table = UnitTable(self.encode_units, np.uint32)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of all tokens, one after the other."""
        return self.token_bytes[spread_ranges(self.token_start[ids], self.token_length[ids])].tobytes()

    def encode_units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units end to end, and how many each has."""
        find = self.pattern.findall
        pieces = [find(unit.decode()) for unit in units]
        distinct = {piece: k for k, piece in enumerate(dict.fromkeys(p for unit in pieces for p in unit))}
        flat, lengths = self.encode_pieces([piece.encode() for piece in distinct])
        starts = np.cumsum(lengths) - lengths
        counts = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order = np.fromiter((distinct[p] for unit in pieces for p in unit), np.int64, int(counts.sum()))
        ends = np.concatenate([[0], np.cumsum(lengths[order])])
        bounds = np.concatenate([[0], np.cumsum(counts)])
        return flat[spread_ranges(starts[order], lengths[order])], ends[bounds[1:]] - ends[bounds[:-1]]

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces end to end, and how many each has. A piece that is a token is that token."""
        ids: list[np.ndarray | None] = [None] * len(pieces)
        by_width: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                ids[k] = np.array([rank], np.int32)
            elif len(piece) > MATRIX_BYTES:
                ids[k] = self.merge_long(piece)
            else:
                by_width.setdefault(max(4, 1 << (len(piece) - 1).bit_length()), []).append(k)
        for width, members in by_width.items():
            step = max(1, (1 << 20) // width)
            for at in range(0, len(members), step):
                rows = members[at:at + step]
                for k, row in zip(rows, self.merge_rows([pieces[k] for k in rows], width)):
                    ids[k] = row
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return (np.concatenate(ids) if ids else np.zeros(0, np.int32)).astype(np.uint32), lengths

    def merge_rows(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        """Merge pieces of at most ``width`` bytes, all at once."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        tokens = np.full((len(pieces), width), -1, np.int32)
        inside = np.arange(width) < lengths[:, None]
        tokens[inside] = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = self.pairs.find(tokens[:, :-1], tokens[:, 1:])
        number, out = np.arange(len(pieces)), [None] * len(pieces)
        while True:
            row = np.arange(len(number))
            at = ranks.argmin(axis=1)  # the leftmost of the least
            best = ranks[row, at]
            done = best == NO_RANK
            if done.any():
                for k, ids, count in zip(number[done].tolist(), tokens[done], lengths[done].tolist()):
                    out[k] = ids[:count]
                tokens, ranks, number, lengths, at, best = (x[~done] for x in (tokens, ranks, number, lengths, at, best))
                row = np.arange(len(number))
            if not len(number):
                return out
            tokens[row, at] = best
            lengths = lengths - 1
            columns = np.arange(tokens.shape[1] - 1)
            tokens = np.take_along_axis(tokens, columns + (columns > at[:, None]), 1)
            if ranks.shape[1] == 1:
                ranks = np.full((len(number), 1), NO_RANK, np.int32)
                continue
            columns = columns[:-1]
            ranks = np.take_along_axis(ranks, columns + (columns >= at[:, None]), 1)
            for left in (at - 1, at):
                valid = np.flatnonzero((left >= 0) & (left < ranks.shape[1]))
                place = left[valid]
                ranks[valid, place] = self.pairs.find(tokens[valid, place], tokens[valid, place + 1])

    def merge_long(self, piece: bytes) -> np.ndarray:
        """Merge one long piece: the same merges from a heap of (rank, place)."""
        pair = lambda a, b: int(self.pairs.find(np.array([a]), np.array([b]))[0])
        find = functools.lru_cache(1 << 16)(pair)
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        count = len(ids)
        after, before = [*range(1, count), -1], [-1, *range(count - 1)]
        heap = [(rank, k) for k in range(count - 1) if (rank := find(ids[k], ids[k + 1])) != NO_RANK]
        heapq.heapify(heap)
        while heap:
            rank, k = heapq.heappop(heap)
            follower = after[k]
            if ids[k] < 0 or follower < 0 or find(ids[k], ids[follower]) != rank:
                continue  # one of the two has been merged meanwhile
            ids[k], ids[follower] = rank, -1
            after[k] = after[follower]
            if after[k] >= 0:
                before[after[k]] = k
            for left in (before[k], k):
                if left >= 0 and after[left] >= 0:
                    rank = find(ids[left], ids[after[left]])
                    if rank != NO_RANK:
                        heapq.heappush(heap, (rank, left))
        return np.array([k for k in ids if k >= 0], np.int32)


def load(path: str, pattern: str) -> Bpe:
    """The encoder of a file, built once per Python worker."""
    return tool(("bpe", path, pattern), lambda: Bpe(path, pattern))


def encode_texts(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every whole text: ``doc_id``, ``ids`` (little-endian unsigned 32-bit integers in a binary).

    ``path`` is read on the executors and must exist there. One row per input row, repeated
    rows and null ids included; a null text counts as empty and has no ids. Other columns,
    whatever their names, are not read. There is no shuffle; a row depends on its text alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = load(path, pattern).table
        for batch in batches:
            parts: list[list[bytes]] = [[] for _ in range(batch.num_rows)]
            for k, ids in table.each(batch.column(1)):
                parts[k].append(ids.astype("<u4").tobytes())
            yield pa.record_batch([batch.column(0), pa.array(map(b"".join, parts), pa.binary())], ["doc_id", "ids"])

    return map_texts(df, {"doc_id": df[id_col].cast("long"), "text": text_of(df, text_col)}, "doc_id long, ids binary", run)


def decode_ids(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id`` and ``decoded`` (the bytes of the tokens) of ids as :func:`encode_texts` gives them.

    Null ids give null bytes; an id outside the vocabulary is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batches:
            out = [None if ids is None else bpe.decode(np.frombuffer(ids, "<u4")) for ids in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "decoded"])

    return map_texts(df, {"doc_id": df[id_col].cast("long"), "ids": df[ids_col]}, "doc_id long, decoded binary", run)


def round_trip_digests(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text, decode its ids, and return digests of both.

    ``doc_id``, ``n_tokens``, ``ids_sha256`` (of the ids as little-endian unsigned 32-bit
    integers), ``decoded_sha256`` (of the decoded bytes). A long text is digested part by
    part, so neither its ids nor its bytes are held as a whole. Rows as in :func:`encode_texts`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batches:
            count = np.zeros(batch.num_rows, np.int64)
            coded = [hashlib.sha256() for _ in range(batch.num_rows)]
            decoded = [hashlib.sha256() for _ in range(batch.num_rows)]
            for k, ids in bpe.table.each(batch.column(1)):
                count[k] += len(ids)
                coded[k].update(ids.astype("<u4").tobytes())
                decoded[k].update(bpe.decode(ids))
            yield pa.record_batch(
                [batch.column(0), pa.array(count), pa.array(x.hexdigest() for x in coded), pa.array(x.hexdigest() for x in decoded)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return map_texts(df, {"doc_id": df[id_col].cast("long"), "text": text_of(df, text_col)},
                     "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", run)
