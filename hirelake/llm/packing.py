"""Operator 10: packing documents into token sequences by vector best-fit.

A sequence has three capacities: tokens, documents, and attention cost (the sum of the
squared lengths, as attention within documents costs). Pieces are taken longest first; each
goes into the open sequence that can hold it under all three and scores best, else into
a new one. Every residual and demand is a share of its capacity.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm import library
from hirelake.llm.arrow import map_texts, text_of
from hirelake.session import stage

#: Pieces packed together in one task. A larger group wastes fewer places and takes longer per piece.
GROUP_PIECES = 16384
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pack(lengths: np.ndarray, tokens: int, documents: int | None = None, cost: float | None = None,
         weights: tuple[float, float, float] = (1.0, 1e-6, 1e-6), rule: str = "norm") -> tuple[np.ndarray, np.ndarray, int]:
    """(sequence of each piece, its offset there, number of sequences) for pieces of these lengths, longest first.

    ``rule="norm"`` takes the sequence whose weighted residual is shortest after the piece is
    in; ``rule="dot"`` the one with the least weighted dot product of its residual and the
    piece. Ties go to the sequence opened first. ``documents`` and ``cost`` of None set no bound.
    A piece that exceeds the cost alone is an error, as is one of more than ``tokens``.
    """
    documents = tokens if documents is None else documents
    cost = float(tokens) ** 2 if cost is None else float(cost)
    sequence = np.empty(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    least = int(lengths.min(initial=tokens))
    demand = np.stack([lengths / tokens, np.full(len(lengths), 1 / documents), lengths.astype(float) ** 2 / cost])
    if (demand > 1 + 1e-9).any():
        raise ValueError("a piece exceeds a capacity of an empty sequence")
    wide = np.array(weights, float)[:, None]
    room = np.zeros((3, 1024))  # residuals of the open sequences, in the order they were opened
    name = np.zeros(1024, np.int64)
    used = np.zeros(1024, np.int64)
    count = opened = 0
    for k, length in enumerate(lengths.tolist()):
        need = demand[:, k:k + 1]
        best = -1
        if length < tokens and count:
            # The residual of tokens decides most; the others are looked at where it suffices.
            able = np.flatnonzero(used[:count] <= tokens - length)
            able = able[(room[1:, able] >= need[1:] - 1e-12).all(axis=0)]
            if len(able):
                left = room[:, able]
                score = ((left - need) ** 2 * wide).sum(axis=0) if rule == "norm" else (left * need * wide).sum(axis=0)
                best = int(able[score.argmin()])
        if best < 0:
            sequence[k] = opened
            opened += 1
            if tokens - length < least:
                continue
            if count == len(name):
                room, name, used = np.concatenate([room, np.zeros_like(room)], 1), np.append(name, name * 0), np.append(used, used * 0)
            room[:, count], name[count], used[count] = 1 - need[:, 0], opened - 1, length
            count += 1
            continue
        sequence[k], offset[k] = name[best], used[best]
        used[best] += length
        room[:, best] -= need[:, 0]
        if tokens - used[best] < least or room[1, best] < 0.5 / documents:  # full: it leaves the open ones
            for array in (name, used):
                array[best:count - 1] = array[best + 1:count]
            room[:, best:count - 1] = room[:, best + 1:count]
            count -= 1
    return sequence, offset, opened


def cut_pieces(df: DataFrame, path: str, end_id: int, tokens: int, keep_ids: bool = False,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode whole texts, append ``end_id``, and cut those of more than ``tokens`` ids into pieces of that many.

    ``doc_id``, ``piece`` (from 0), ``start`` (ids of the document before it), ``length``, ``ids_crc32`` and, with
    ``keep_ids``, ``ids`` as little-endian unsigned 32-bit integers. Of a cut document the first piece may be
    shorter. A null text counts as empty and gives one piece with ``end_id`` alone; repeated rows and null
    ids each give their own pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = library.load(path).table
        end = np.array([end_id], "<u4")
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]

            def cut(row: int, parts: list[np.ndarray]) -> None:
                ids = np.concatenate([*parts, end]).astype("<u4").tobytes()
                total = len(ids) // 4
                first = (total - 1) % tokens + 1
                for piece, stop in enumerate(range(first, total + 1, tokens)):
                    start = max(0, stop - tokens) if piece else 0
                    raw = ids[4 * start:4 * stop]
                    for column, value in zip(out, (row, piece, start, stop - start, zlib.crc32(raw), raw if keep_ids else None)):
                        column.append(value)

            waiting, parts = 0, []
            for k, ids in table.each(batch.column(1)):
                while waiting < k:
                    cut(waiting, parts)
                    waiting, parts = waiting + 1, []
                parts.append(ids)
            while waiting < batch.num_rows:
                cut(waiting, parts)
                waiting, parts = waiting + 1, []
            columns = [batch.column(0).take(pa.array(out[0], pa.int64())), pa.array(out[1], pa.int32()),
                       *(pa.array(column, pa.int64()) for column in out[2:5])]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(out[5], pa.binary()))
                names.append("ids")
            yield pa.record_batch(columns, names)

    return map_texts(df, {"doc_id": df[id_col].cast("long"), "text": text_of(df, text_col)},
                     PIECE + (", ids binary" if keep_ids else ""), run)


def pack_documents(df: DataFrame, path: str, end_id: int, tokens: int, documents: int | None = None, cost: float | None = None,
                   weights: tuple[float, float, float] = (1.0, 1e-6, 1e-6), rule: str = "norm", keep_ids: bool = False,
                   group_pieces: int = GROUP_PIECES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of :func:`cut_pieces` with ``sequence_id`` (any number) and ``offset`` (place there, gapless from 0).

    Pieces are written once (without texts) and dealt by hash into groups of about ``group_pieces``, so a group's
    size does not grow with the input; each group is packed by :func:`pack` on its own. A piece as long as
    a sequence is one. Rows without id and rows that repeat one are dealt out by their content; only copies of the same
    text without id share a group. An empty table gives no rows.
    """
    pieces = stage(cut_pieces(df, path, end_id, tokens, keep_ids, id_col, text_col), "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))
    names = pieces.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        whole = pa.Table.from_batches([batch for batch in batches if batch.num_rows] or [pa.record_batch([[]] * len(names), names)])
        if not whole.num_rows:
            return
        # Ids stay Arrow integers: a null among them must not turn them into floating-point numbers.
        order = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")]
        whole = whole.take(pc.sort_indices(whole, order))
        sequence, offset, _ = pack(whole["length"].to_numpy(), tokens, documents, cost, weights, rule)
        whole = whole.append_column("sequence_id", pa.array((number << 32) + sequence)).append_column("offset", pa.array(offset))
        yield from whole.to_batches()

    schema = PIECE + (", ids binary" if keep_ids else "") + ", sequence_id long, offset long"
    # The checksum is part of the hash, so that rows without id are dealt out like all others.
    return pieces.repartition(groups, F.xxhash64("doc_id", "piece", "start", "ids_crc32")).select(*names).mapInArrow(run, schema)
