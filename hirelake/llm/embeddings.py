"""Operator 5: near-duplicate embeddings by an exact metric range join.

On the unit sphere, a cosine of at least c is a distance of at most r = sqrt(2 - 2c), a
metric. Vectors belong to the cell of their nearest pivot. A pair is found in the cell of
the lower number of the two, so a vector is also sent to every lower cell that could hold a neighbour of
it. By the triangle inequality that needs its distance to that pivot to be at most the cell's radius
plus r, and its distance to the plane halfway between both pivots (which a neighbour there lies beyond)
to be at most r. Cells then join independently, large ones in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.arrow import map_texts
from hirelake.llm.components import components
from hirelake.session import stage

#: Vectors a cell has on average, and the most that a block of a cell holds on either side.
CELL = 4096
BLOCK = 8192
#: Pivots at least, whatever the number of vectors.
FEWEST_PIVOTS = 8
#: A bound on the pivots, which go to all tasks. With more vectors than cells of CELL hold, cells are larger and have more blocks.
MOST_PIVOTS = 1024
#: Vectors from which the pivots are chosen, about; all vectors are put into cells.
SAMPLE = 2048
#: Cosines computed at once in a block.
CHUNK = 256
#: Rounding of distances never decides where a vector is sent.
MARGIN = 1e-9


def unit_rows(raw: list[bytes], dtype: str) -> np.ndarray:
    """Vectors of equal width as rows of length 1, in double precision."""
    rows = np.frombuffer(b"".join(raw), dtype).reshape(len(raw), -1).astype(float)
    rows /= np.abs(rows).max(axis=1, keepdims=True)  # no overflow or underflow in the length
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _read_vectors(df: DataFrame, id_col: str, vector_col: str, dtype: str) -> DataFrame:
    """``vec_id``, ``raw`` (null where a vector can't be compared), its ``width`` and a 128-bit ``digest``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            values = lists.flatten()
            holes = np.asarray(values.is_null())
            numbers = np.asarray(values.fill_null(0)).astype(dtype)
            sound = np.isfinite(numbers) & ~holes
            raw, width, digest = [], [], []
            at = 0
            for size in (x or 0 for x in lists.value_lengths().to_pylist()):
                part = numbers[at:at + size]
                if size and sound[at:at + size].all() and part.any():
                    raw.append(part.tobytes())
                    digest.append(xxhash.xxh3_128_digest(raw[-1]))
                else:
                    raw.append(None)
                    digest.append(None)
                width.append(size)
                at += size
            yield pa.record_batch([batch.column(0), pa.array(raw, pa.binary()), pa.array(width, pa.int32()), pa.array(digest, pa.binary())],
                                  ["vec_id", "raw", "width", "digest"])

    columns = {"vec_id": df[id_col].cast("long"), "vector": df[vector_col]}
    return map_texts(df, columns, "vec_id long, raw binary, width int, digest binary", run)


def _cell_number(width: int, pivot: int) -> int:
    return width * (MOST_PIVOTS + 1) + pivot


def _assign(vectors: DataFrame, pivots: dict[int, np.ndarray], dtype: str) -> DataFrame:
    """The nearest pivot of each vector as ``home``, and its ``distance``. A width without pivots is one cell."""
    schema = "vec_id long, copies long, raw binary, width int, home long, distance double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            frame["home"], frame["distance"] = frame["width"].map(lambda width: _cell_number(width, 0)), 0.0
            for width, rows in frame.groupby("width").groups.items():
                if width in pivots:
                    distance = _distances(unit_rows(frame.loc[rows, "raw"].tolist(), dtype), pivots[width])
                    frame.loc[rows, "home"] = [_cell_number(width, k) for k in distance.argmin(axis=1).tolist()]
                    frame.loc[rows, "distance"] = distance.min(axis=1)
            yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    return map_texts(vectors, {name: F.col(name) for name in ("vec_id", "copies", "raw", "width")}, schema, run)


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (rows @ pivots.T)))


def _replicate(assigned: DataFrame, pivots: dict[int, np.ndarray], radius: dict[int, float], reach: float, dtype: str) -> DataFrame:
    """Every vector in its own cell, and as a guest in every lower cell that may hold a neighbour."""
    schema = "vec_id long, copies long, raw binary, cell long, guest boolean"
    between = {width: _distances(points, points) for width, points in pivots.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            own = frame[["vec_id", "copies", "raw"]].assign(cell=frame["home"], guest=False)
            out = [own]
            for width, rows in frame.groupby("width").groups.items():
                if width not in pivots:
                    continue
                part = frame.loc[rows]
                distance = _distances(unit_rows(part["raw"].tolist(), dtype), pivots[width])
                home = part["home"].to_numpy() - _cell_number(width, 0)
                reached = np.array([radius.get(_cell_number(width, k), -1.0) for k in range(len(pivots[width]))])
                gap = between[width][home]
                plane = (distance ** 2 - part["distance"].to_numpy()[:, None] ** 2) / np.where(gap == 0, 1, 2 * gap)
                near = (reached >= 0) & (distance <= reached + reach + MARGIN) & ((plane <= reach + MARGIN) | (gap == 0))
                near &= np.arange(len(pivots[width])) < home[:, None]
                row, cell = np.nonzero(near)
                out.append(part[["vec_id", "copies", "raw"]].iloc[row].assign(cell=cell + _cell_number(width, 0), guest=True))
            yield pa.RecordBatch.from_pandas(pd.concat(out), preserve_index=False)

    return map_texts(assigned, {name: F.col(name) for name in assigned.columns}, schema, run)


def _exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    return math.fsum(a * b) / math.sqrt(math.fsum(a * a) * math.fsum(b * b))


def _unite(low: np.ndarray, first: np.ndarray, second: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """Groups of places after more links; ``low`` is the least place of each place's group, ``linked`` says which of both lists are linked.

    Whole groups are joined, so links of earlier calls hold on.
    """
    most = len(low)
    while True:
        a, b = low[first], low[second]
        near_a = np.where(linked, b[None, :], most).min(axis=1)
        near_b = np.where(linked, a[:, None], most).min(axis=0)
        if (near_a >= a).all() and (near_b >= b).all():
            return low
        low = low.copy()
        np.minimum.at(low, a, near_a)
        np.minimum.at(low, b, near_b)
        while (low[low] != low).any():
            low = low[low]


def _join_block(least: float, dtype: str):
    """Links within a block pair: how many each vector has there, and a star per local group."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        left, right = frame[frame["is_left"]], frame[~frame["is_left"]]
        same = bool(frame["same"].iloc[0])  # a block with itself comes as left only
        if same:
            right = left
        if not len(left) or not len(right):
            return pd.DataFrame({"vec_id": [], "links": [], "low": []}).astype("int64")
        x, y = unit_rows(left["raw"].tolist(), dtype), unit_rows(right["raw"].tolist(), dtype)
        ids = [side["vec_id"].to_numpy() for side in (left, right)]
        copies = [side["copies"].to_numpy() for side in (left, right)]
        counts = [np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)]
        every = np.concatenate(ids[:1] if same else ids)
        by_id = np.argsort(every, kind="stable")
        place = np.empty(len(every), np.int64)  # in order of id, so the least place of a group has its least id
        place[by_id] = np.arange(len(every))
        places = [place[:len(left)], place if same else place[len(left):]]
        low = np.arange(len(every))
        for at in range(0, len(x), CHUNK):
            rows = slice(at, min(at + CHUNK, len(x)))
            begin = at if same else 0
            cosine = x[rows] @ y[begin:].T
            linked = cosine >= least
            for a, b in zip(*np.nonzero(np.abs(cosine - least) < MARGIN)):
                linked[a, b] = _exact_cosine(x[at + a], y[begin + b]) >= least
            if same:
                linked &= np.arange(len(y) - begin)[None, :] > np.arange(linked.shape[0])[:, None]
            hit_rows = np.flatnonzero(linked.any(axis=1))
            if not len(hit_rows):
                continue
            hit_columns = np.flatnonzero(linked.any(axis=0))
            linked = linked[np.ix_(hit_rows, hit_columns)]
            a, b = hit_rows + at, hit_columns + begin
            counts[0][a] += linked @ copies[1][b]
            counts[1][b] += linked.T @ copies[0][a]
            low = _unite(low, places[0][a], places[1][b], linked)
        lows = every[by_id[low[np.concatenate(places)]]]
        out = pd.DataFrame({"vec_id": np.concatenate(ids), "links": np.concatenate(counts), "low": lows})
        return out[(out["links"] > 0) | (out["low"] != out["vec_id"])]

    return run


def _far_apart(rows: np.ndarray, count: int) -> np.ndarray:
    """Rows of which each is as far as can be from those taken before it."""
    taken = [0]
    nearest = _distances(rows, rows[:1])[:, 0]
    while len(taken) < count and nearest.max() > 0:
        taken.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(rows, rows[taken[-1:]])[:, 0])
    return rows[taken]


def _members(distinct: DataFrame, reach: float, dtype: str) -> DataFrame:
    """The stored ``distinct`` vectors in their own cells and as guests wherever a neighbour within ``reach`` may live.

    There is one pivot per :data:`CELL` vectors, but at least :data:`FEWEST_PIVOTS` and at most :data:`MOST_PIVOTS`. They are taken
    from about :data:`SAMPLE` vectors drawn by hash, each as far as can be from those before it, so that cells are narrow.
    """
    total = distinct.count()
    most = min(MOST_PIVOTS, max(FEWEST_PIVOTS, -(-total // CELL)))
    drawn = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < min(1 << 30, (SAMPLE << 30) // max(total, 1))
    sample: dict[int, list[bytes]] = {}
    for row in distinct.where(drawn).select("vec_id", "width", "raw").sort("vec_id").collect():
        sample.setdefault(row["width"], []).append(bytes(row["raw"]))
    size = sum(map(len, sample.values()))
    pivots = {width: _far_apart(unit_rows(raw, dtype), -(-most * len(raw) // size)) for width, raw in sample.items()}
    assigned = stage(_assign(distinct, pivots, dtype), "assigned")
    radius = {row["home"]: row["radius"] for row in assigned.groupBy("home").agg(F.max("distance").alias("radius")).collect()}
    return stage(_replicate(assigned, pivots, radius, reach, dtype), "members")


def near_duplicates(df: DataFrame, least: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id``, ``n_links`` (other rows linked directly), ``component_id`` and ``kept`` (its own id) of every row.

    Rows whose vectors have a cosine of at least ``least`` are linked. A vector that is null, empty, zero, or has null or
    non-finite components links with nothing, nor do vectors of different widths. Equal vectors are
    joined as one. A row without id links with nothing, has a null component and is kept; rows that repeat an id count as
    vectors of their own. An empty table gives no rows. Other columns, labels among them, are not read.
    """
    kind = dict(df.dtypes)[vector_col]
    dtype = "<f4" if kind == "array<float>" else "<f8"
    rows = stage(_read_vectors(df, id_col, vector_col, dtype), "vectors")
    distinct = stage(
        rows.where("vec_id is not null and digest is not null").groupBy("digest")
        .agg(F.min_by(F.struct("vec_id", "raw", "width"), "vec_id").alias("first"), F.count("*").alias("copies"))
        .select("digest", "first.*", "copies"), "distinct")
    members = _members(distinct, math.sqrt(2 - 2 * least), dtype)
    sizes = members.groupBy("cell").agg(
        F.ceil(F.sum(F.when(F.col("guest"), 0).otherwise(1)) / BLOCK).cast("int").alias("own_blocks"),
        F.ceil(F.sum(F.when(F.col("guest"), 1).otherwise(0)) / BLOCK).cast("int").alias("guest_blocks"))
    # Blocks of a cell are numbered, the guests' after its own; each own block meets itself and the later ones.
    blocks = F.when(F.col("guest"), F.col("guest_blocks")).otherwise(F.col("own_blocks"))
    number = F.pmod(F.xxhash64("vec_id"), blocks).cast("int") + F.when(F.col("guest"), F.col("own_blocks")).otherwise(0)
    dealt = (
        members.join(sizes, "cell").withColumn("block", number)
        .withColumn("other", F.explode(F.when(F.col("guest"), F.sequence(F.lit(0), F.col("own_blocks") - 1))
                                       .otherwise(F.sequence(F.lit(0), F.col("own_blocks") + F.col("guest_blocks") - 1))))
        .select("vec_id", "copies", "raw", "cell", F.least("block", "other").alias("first_block"), F.greatest("block", "other").alias("second_block"),
                (F.col("block") <= F.col("other")).alias("is_left"), (F.col("block") == F.col("other")).alias("same"))
    )
    joined = stage(dealt.groupBy("cell", "first_block", "second_block")
                   .applyInPandas(_join_block(least, dtype), "vec_id long, links long, low long"), "joined")
    counts = joined.groupBy("vec_id").agg(F.sum("links").alias("links"))
    groups = components(joined.select("vec_id", "low"))
    by_digest = (
        distinct.join(counts, "vec_id", "left").join(groups, F.col("vec_id") == F.col("node"), "left")
        .select("digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("low", "vec_id").alias("low"))
        .where("n_links > 0")
    )
    listed = rows.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("digest")).alias("digest"))
    component = F.coalesce("low", "vec_id")
    return listed.join(by_digest, "digest", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"))
