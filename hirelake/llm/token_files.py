"""Operator 9: token ids in seekable zstandard files.

A file holds the ids of consecutive documents, each as one independent zstandard frame
of little-endian unsigned 32-bit integers. Then come two skippable frames: the document
ids, and the seek table of the public zstandard seekable format (sizes of each frame before
and after compression, and the low half of XXH64 of its content). So ``zstd -d`` reads a file
whole, and a reader of some documents reads the table and only their frames.

Each task writes one file under a name of its attempt, and the manifest, written by
Spark, names the files of the attempts that counted; what a lost executor left is never read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm import library
from hirelake.llm.arrow import small, text_of

# Fixed values of the zstandard seekable format.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
WITH_CHECKSUMS = 0x80

#: Stands for a null document id in a file.
NULL_ID = np.iinfo(np.int64).min
READ_BYTES = 8 << 20
MANIFEST = "number long, file string, first_doc long, last_doc long, documents long, tokens long"


def open_fs(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system and path of a URI or an absolute path."""
    return pyarrow.fs.FileSystem.from_uri(uri)


class TokenFileWriter:
    """Writes one file; documents must come in the order they are to have."""

    def __init__(self, uri: str, level: int = 3):
        system, path = open_fs(uri)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out = system.open_output_stream(path, compression=None)
        self.packer = zstandard.ZstdCompressor(level=level)
        self.entries: list[tuple[int, int, int]] = []
        self.documents: list[int] = []
        self.tokens = 0

    def add(self, document: int | None, parts: Iterable[np.ndarray]) -> None:
        """Append a document as one frame; its ids may come in parts."""
        packer, digest = self.packer.compressobj(), xxhash.xxh64()
        size = written = 0
        for part in parts:
            raw = part.astype("<u4").tobytes()
            digest.update(raw)
            size += len(raw)
            written += self.out.write(packer.compress(raw))
        written += self.out.write(packer.flush())
        self.entries.append((written, size, digest.intdigest() & 0xFFFFFFFF))
        self.documents.append(NULL_ID if document is None else document)
        self.tokens += size // 4

    def close(self) -> None:
        index = self.packer.compress(np.array(self.documents, "<i8").tobytes())
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index) + 8) + index + struct.pack("<Q", len(index)))
        table = np.array(self.entries, "<u4").reshape(-1, 3).tobytes()
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(table) + 9) + table)
        self.out.write(struct.pack("<IBI", len(self.entries), WITH_CHECKSUMS, SEEKABLE_MAGIC))
        self.out.close()


class TokenFileReader:
    """Reads the tables of one file and then the frames asked for."""

    def __init__(self, uri: str):
        system, path = open_fs(uri)
        self.file = system.open_input_file(path)
        end = self.file.size()
        count, flags, magic = struct.unpack("<IBI", self.file.read_at(9, end - 9))
        if magic != SEEKABLE_MAGIC or flags != WITH_CHECKSUMS:
            raise ValueError(f"{uri} has no seek table with checksums")
        table_at = end - 9 - 12 * count
        entries = np.frombuffer(self.file.read_at(12 * count, table_at), "<u4").reshape(-1, 3).astype(np.int64)
        self.packed, self.size, self.checksum = entries.T
        self.start = np.cumsum(self.packed) - self.packed
        index_end = table_at - 8
        (index_size,) = struct.unpack("<Q", self.file.read_at(8, index_end - 8))
        index = self.file.read_at(index_size, index_end - 8 - index_size)
        self.documents = np.frombuffer(zstandard.ZstdDecompressor().decompress(index), "<i8")
        self.tokens = self.size // 4
        self.token_start = np.cumsum(self.tokens) - self.tokens

    def frames(self, wanted: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """(place in the file, content) of the frames at these ascending places; neighbours are read together."""
        unpacker = zstandard.ZstdDecompressor()
        k = 0
        while k < len(wanted):
            last = k + 1
            while last < len(wanted) and wanted[last] == wanted[last - 1] + 1 \
                    and self.start[wanted[last]] - self.start[wanted[k]] < READ_BYTES:
                last += 1
            low = int(self.start[wanted[k]])
            high = int(self.start[wanted[last - 1]] + self.packed[wanted[last - 1]])
            block = memoryview(self.file.read_at(high - low, low))
            for place in wanted[k:last].tolist():
                at = int(self.start[place]) - low
                raw = unpacker.decompressobj().decompress(block[at:at + int(self.packed[place])])
                if len(raw) != self.size[place] or xxhash.xxh64(raw).intdigest() & 0xFFFFFFFF != self.checksum[place]:
                    raise ValueError(f"frame {place} is damaged")
                yield place, raw
            k = last


def write_token_files(df: DataFrame, folder: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text, append ``end_id``, write the ids to ``folder`` in ascending order of document id.

    ``path`` is a file of the ``tokenizers`` library and must exist on the executors; ``folder`` is
    a new folder that all executors share. One range exchange by document id and a hash of the text; a file per
    partition, so its size follows the session's partition settings. The texts are encoded after it, so
    that sampling for the ranges does not encode. Returns the manifest, written into the folder: a
    row per file with its number in the order, name, first and last document, documents and tokens.
    Repeated ids stay, ordered by a hash of their text; null ids come first; a null text counts as empty (only ``end_id``).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = library.load(path).table
        context = TaskContext.get()
        number = context.partitionId()
        writer = uri = None
        for batch in small(batches):
            if not batch.num_rows:
                continue
            if writer is None:
                uri = f"{folder}/files/tokens-{number:08d}-{context.taskAttemptId()}.zst"
                writer = TokenFileWriter(uri)
            documents = batch.column(0).to_pylist()
            waiting, parts = 0, []
            for k, ids in table.each(batch.column(1)):
                while waiting < k:
                    writer.add(documents[waiting], [*parts, np.array([end_id])])
                    waiting, parts = waiting + 1, []
                parts.append(ids)
            while waiting < len(documents):
                writer.add(documents[waiting], [*parts, np.array([end_id])])
                waiting, parts = waiting + 1, []
        if writer is not None:
            writer.close()
            first, last = (None if x == NULL_ID else x for x in (writer.documents[0], writer.documents[-1]))
            row = {"number": number, "file": uri, "first_doc": first, "last_doc": last,
                   "documents": len(writer.documents), "tokens": writer.tokens}
            yield pa.RecordBatch.from_pylist([row], pa.schema([
                ("number", pa.int64()), ("file", pa.string()), ("first_doc", pa.int64()),
                ("last_doc", pa.int64()), ("documents", pa.int64()), ("tokens", pa.int64()),
            ]))

    spark = df.sparkSession
    docs = df.select(df[id_col].cast("long").alias("doc_id"), text_of(df, text_col).alias("text"))
    # Ranges are cut by id and hash, so rows of one id, or without any, need not share a file; no text is sampled for them.
    hashed = docs.withColumn("hash", F.xxhash64("text"))
    ordered = hashed.repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash", "text").select("doc_id", "text")
    ordered.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def with_starts(manifest: DataFrame) -> list[dict]:
    """The manifest's rows in order, each with ``start``, the ids of all files before. One row per file."""
    rows = [row.asDict() for row in manifest.orderBy("number").collect()]
    start = 0
    for row in rows:
        row["start"] = start
        start += row["tokens"]
    return rows


DOCUMENT = "doc_id long, start long, n_tokens long, ids binary"


def _read(files: DataFrame, every: bool, digest: bool) -> DataFrame:
    """Rows of (file, start, wanted) turned into documents; ``wanted`` is only there if not ``every``."""
    schema = DOCUMENT.replace("ids binary", "ids_crc32 long") if digest else DOCUMENT

    def rows(reader: TokenFileReader, start: int, wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
        step = 2048
        for at in range(0, len(wanted), step):
            out = []
            for place, raw in reader.frames(wanted[at:at + step]):
                out.append((place, zlib.crc32(raw) if digest else raw))
            place = np.array([x[0] for x in out])
            documents = reader.documents[place]
            yield pa.record_batch([
                pa.array(documents, mask=documents == NULL_ID), pa.array(start + reader.token_start[place]),
                pa.array(reader.tokens[place]), pa.array([x[1] for x in out], pa.int64() if digest else pa.binary()),
            ], ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader = TokenFileReader(row["file"])
                wanted = np.arange(len(reader.documents)) if every else np.flatnonzero(np.isin(reader.documents, row["wanted"]))
                yield from rows(reader, row["start"], wanted)

    return files.mapInArrow(run, schema)


def read_token_files(manifest: DataFrame, digest: bool = False) -> DataFrame:
    """All documents of the files: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids``.

    With ``digest``, ``ids_crc32`` (unsigned, of the ids as stored) replaces ``ids``. Checksums are
    verified. An empty manifest gives no rows. A file is read by one task.
    """
    rows = with_starts(manifest)
    spark = manifest.sparkSession
    files = spark.createDataFrame([(row["file"], row["start"]) for row in rows], "file string, start long")
    return _read(files.repartition(max(1, len(rows))), every=True, digest=digest)


def read_documents(manifest: DataFrame, wanted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents of :func:`read_token_files` whose ids are in ``wanted``; only their frames are decompressed.

    Ids that no file has give no row, repeated ids in ``wanted`` count once, null ids match nothing.
    """
    spark: SparkSession = manifest.sparkSession
    rows = [(row["file"], row["start"], row["first_doc"], row["last_doc"]) for row in with_starts(manifest)]
    files = spark.createDataFrame(rows, "file string, start long, first_doc long, last_doc long")
    ids = wanted.select(wanted[id_col].cast("long").alias("wanted_id")).where("wanted_id is not null").distinct()
    # One row per file, so the side that is broadcast grows with the files and not with the documents.
    found = ids.join(F.broadcast(files), F.col("wanted_id").between(F.coalesce("first_doc", F.lit(int(NULL_ID))), F.col("last_doc")))
    return _read(found.groupBy("file", "start").agg(F.collect_list("wanted_id").alias("wanted")), every=False, digest=False)
