"""Parquet tables that are replaced or merged into, and seen whole or not at all.

A writer puts files into a new folder and then, as its last step, publishes a version: one small
file that names the folder of every part of the table. It appears at once and only if no other writer was
faster, who then takes the new version as its start. Readers take the newest version. A write that breaks
off before leaves a folder nobody reads, and running it again gives the same table.

A keyed table is cut into hash buckets of its key, and a merge writes the buckets its source changes. Where
a catalog has tables with row-level updates, ``DataFrame.mergeInto`` does the same.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from hirelake.functions.keys import blank
from hirelake.session import create_once, files, read_text, remove, staged

BUCKET = "_bucket"
NO_KEY = -1
DEFAULT_BUCKETS = 64
#: Two hashes of the columns in which a stored row is compared with a source row.
DIGESTS = ("_digest_a", "_digest_b")
#: So many times a writer starts anew because others were faster.
TRIES = 50

Merge = Callable[[DataFrame, DataFrame], DataFrame]


class Version(NamedTuple):
    """A state of a table: (part, folder, batch) of all its parts, and the bucket count it was made with.

    A part is a bucket of a keyed table, or the name of a table among several that are replaced together.
    """

    number: int
    parts: tuple[tuple[int | str, str, str | None], ...] = ()
    buckets: int | None = None


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The columns of ``schema`` of the Parquet files under ``path``; no rows if nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path).select(*StructType.fromDDL(schema).names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return no_rows(spark, schema)


def no_rows(spark: SparkSession, schema: str) -> DataFrame:
    """An empty frame that Spark's optimizer knows to be empty: joins with it are left out, and their other side is not exchanged."""
    return spark.createDataFrame([], schema).filter(F.lit(False))


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """The versions published, oldest first, from the names of their files."""
    return sorted(int(name) for name in files(spark, f"{path}/versions") if name.isdigit())


def _version(spark: SparkSession, path: str, number: int) -> Version:
    stored = json.loads(read_text(spark, f"{path}/versions/{number:010d}"))
    return Version(number, tuple(tuple(part) for part in stored["parts"]), stored["buckets"])


def current(spark: SparkSession, path: str) -> Version:
    """The newest published version; no other one is read."""
    numbers = _numbers(spark, path)
    return _version(spark, path, numbers[-1]) if numbers else Version(0)


def _folder(path: str, part: int | str, folder: str) -> str:
    return f"{path}/data/{folder}/{BUCKET}={part}"


def _rows(spark: SparkSession, path: str, schema: str, parts) -> DataFrame:
    if not parts:
        return no_rows(spark, schema)
    return spark.read.schema(schema).parquet(*[_folder(path, part, folder) for part, folder, _ in parts])


def read_table(spark: SparkSession, path: str, schema: str, part: str | None = None) -> DataFrame:
    """The table as last published, or one of several replaced together; empty if nothing was."""
    return _rows(spark, path, schema, [p for p in current(spark, path).parts if p[1] and part in (None, p[0])])


def publish(spark: SparkSession, path: str, version: Version) -> bool:
    """Make a written version the current one; False if another writer has published one of this number."""
    text = json.dumps({"buckets": version.buckets, "parts": version.parts})
    return create_once(spark, f"{path}/versions/{version.number:010d}", text)


def replace_parts(spark: SparkSession, path: str, parts: dict[str, DataFrame], keep: int = 2) -> None:
    """Replace the content of ``path`` by one or several named frames, all at once.

    Until the last step readers see the old content; a writer that fails changes nothing. Then the files of the version that is
    the ``keep``-th before the new one are deleted, so readers of the last ones are not disturbed.
    """
    folder = uuid.uuid4().hex
    try:
        for name, df in parts.items():
            df.write.parquet(_folder(path, name, folder))
    except Exception:
        remove(next(iter(parts.values())).sparkSession, f"{path}/data/{folder}")
        raise
    written = tuple((name, folder, None) for name in parts)
    for _ in range(TRIES):
        if publish(spark, path, Version(current(spark, path).number + 1, written)):
            return vacuum(spark, path, keep, newest_only=True)
    raise RuntimeError(f"{path}: other writers were always faster")


def _bucket(keys: list[str], buckets: int, blank_is_null: bool) -> Column:
    form = blank if blank_is_null else F.col
    hashed = F.pmod(F.xxhash64(*[form(k) for k in keys]), F.lit(buckets)).cast("int")
    if blank_is_null:
        return hashed
    for k in keys:
        hashed = F.when(F.col(k).isNull(), NO_KEY).otherwise(hashed)
    return hashed


def merge_into(
    spark: SparkSession,
    path: str,
    schema: str,
    source: DataFrame,
    keys: list[str],
    merge: Merge,
    buckets: int | None = None,
    blank_is_null: bool = False,
    max_records_per_file: int = 5_000_000,
    batch: str | None = None,
    same: list[str] | None = None,
) -> None:
    """Apply ``merge(target rows, source rows)`` to the table at ``path``.

    ``buckets`` is fixed at the first write of a table (:data:`DEFAULT_BUCKETS` if not given) and
    another number later is an error; choose it so that one bucket is about a gigabyte. Source rows with a
    null key match nothing, so they are added to a part of their own instead of meeting in a bucket.
    ``batch`` names what is merged: a retried batch does not add its rows without key again.

    ``same`` names the columns that a merge takes over from the source. Source rows that equal the stored row of their key in
    all of these are left out beforehand, so they touch no bucket, and if no others are left, nothing is written. With
    an empty list, a known key is enough. The source must then have one row per key. The stored rows carry hashes of these columns, and only those are read for it.
    """
    with staged(source, "merge") as increment:
        for _ in range(TRIES):
            version = write_version(
                spark, path, schema, increment, keys, merge, buckets, blank_is_null, max_records_per_file, batch, same)
            if version is None or publish(spark, path, version):
                return
            remove(spark, f"{path}/data/{version.parts[-1][1]}")  # the folder just written
    raise RuntimeError(f"{path}: other writers were always faster")


def _digests(columns: list[str], schema: str) -> list[Column]:
    kinds = {field.name: field.dataType for field in StructType.fromDDL(schema)}
    values = [F.col(c).cast(kinds[c]) for c in columns]
    # A null is skipped by the hash, so it is noted beside the value.
    return [F.xxhash64(F.lit(seed), *[x for value in values for x in (value, value.isNull())]).alias(name)
            for seed, name in enumerate(DIGESTS)]


def changed_rows(
    spark: SparkSession, path: str, schema: str, source: DataFrame, keys: list[str], same: list[str],
    blank_is_null: bool = False, parts=None,
) -> DataFrame:
    """The rows of ``source`` without a stored row of their key that equals them in the columns ``same``.

    Rows with a null key equal none. Only keys and hashes are read, of the parts given or of all.
    """
    parts = current(spark, path).parts if parts is None else parts
    form = blank if blank_is_null else F.col
    names = [f"_same{i}" for i in range(len(keys))]
    digests = _digests(same, schema) if same else []
    stored = _rows(spark, path, f"{schema}, {', '.join(f'{name} bigint' for name in DIGESTS)}", parts)
    known = stored.select(*[form(k).alias(n) for k, n in zip(keys, names)], *(DIGESTS if same else ())).distinct()
    marked = source.select("*", *[form(k).alias(n) for k, n in zip(keys, names)], *digests)
    return marked.join(known, [*names, *(DIGESTS if same else ())], "left_anti").select(*source.columns)


def write_version(
    spark: SparkSession,
    path: str,
    schema: str,
    source: DataFrame,
    keys: list[str],
    merge: Merge,
    buckets: int | None = None,
    blank_is_null: bool = False,
    max_records_per_file: int = 5_000_000,
    batch: str | None = None,
    same: list[str] | None = None,
) -> Version | None:
    """Write the touched buckets of a merge and return the version to :func:`publish`; None if there is nothing to write."""
    before = current(spark, path)
    if None not in (buckets, before.buckets) and buckets != before.buckets:
        raise ValueError(f"{path} has {before.buckets} buckets, not {buckets}")
    buckets = before.buckets or buckets or DEFAULT_BUCKETS
    bucket = _bucket(keys, buckets, blank_is_null)

    def touched_by(rows: DataFrame) -> set[int]:
        return {r[0] for r in rows.select(bucket.alias(BUCKET)).distinct().collect()}  # at most one per bucket

    touched = touched_by(source)
    if same is not None and touched - {NO_KEY} and before.parts:
        parts = [part for part in before.parts if part[0] in touched and part[0] != NO_KEY]
        with staged(changed_rows(spark, path, schema, source, keys, same, blank_is_null, parts), "changed") as rest:
            return _write(spark, path, schema, rest, keys, merge, before, buckets, bucket, touched_by(rest), max_records_per_file, batch, same)
    return _write(spark, path, schema, source, keys, merge, before, buckets, bucket, touched, max_records_per_file, batch, same)


def _write(
    spark: SparkSession, path: str, schema: str, source: DataFrame, keys: list[str], merge: Merge, before: Version,
    buckets: int, bucket: Column, touched: set[int], max_records_per_file: int, batch: str | None, same: list[str] | None,
) -> Version | None:
    if batch is not None and any(b == NO_KEY and name == batch for b, _, name in before.parts):
        touched -= {NO_KEY}
    hashed = touched - {NO_KEY}
    results = []
    if hashed:
        target = _rows(spark, path, schema, [part for part in before.parts if part[0] in hashed])
        merged = merge(target, source.filter(bucket != NO_KEY)).withColumn(BUCKET, bucket)
        results.append(merged.hint("rebalance", BUCKET))
    if NO_KEY in touched:
        added = merge(no_rows(spark, schema), source.filter(bucket == NO_KEY))
        results.append(added.withColumn(BUCKET, F.lit(NO_KEY)))
    if not results:
        return None
    folder = uuid.uuid4().hex
    for result in results:
        if same:
            result = result.select("*", *_digests(same, schema))
        result.write.mode("append").option("maxRecordsPerFile", max_records_per_file).partitionBy(BUCKET).parquet(f"{path}/data/{folder}")
    written = [int(name.split("=")[1]) for name in files(spark, f"{path}/data/{folder}") if name.startswith(f"{BUCKET}=")]
    kept = [part for part in before.parts if part[0] not in hashed]
    return Version(before.number + 1, (*kept, *((b, folder, batch) for b in sorted(written))), buckets)


def stale_parts(spark: SparkSession, source: str, path: str) -> tuple[list, list]:
    """Parts of the keyed table ``source`` that :func:`refresh_derived` has not derived yet, and parts of ``path`` that are up to date."""
    now = {f"{part}.{folder}": (part, folder, batch) for part, folder, batch in current(spark, source).parts}
    kept = [part for part in current(spark, path).parts if part[0] in now]
    have = {name for name, _, _ in kept}
    return [part for name, part in now.items() if name not in have], kept


def refresh_derived(
    spark: SparkSession, source: str, schema: str, path: str, derive: Callable[[DataFrame], DataFrame]
) -> int:
    """Bring ``path`` up to date with a keyed table, part by part; returns how many parts were read.

    ``derive`` maps rows of ``source`` to rows that depend on one part alone; it gets and returns the column :data:`BUCKET`, the
    part of a row, and groups by it. Parts whose files did not change since the last call are not read.
    """
    for _ in range(TRIES):
        before = current(spark, path)
        stale, kept = stale_parts(spark, source, path)
        if not stale and len(kept) == len(before.parts):
            return 0
        folder = uuid.uuid4().hex
        if stale:
            file = F.col("_metadata.file_path")
            name = F.concat(F.regexp_extract(file, rf"/{BUCKET}=(-?\d+)/", 1), F.lit("."), F.regexp_extract(file, rf"/([^/]+)/{BUCKET}=", 1))
            rows = _rows(spark, source, schema, stale).select("*", name.alias(BUCKET))
            derive(rows).write.partitionBy(BUCKET).parquet(f"{path}/data/{folder}")
        written = set(files(spark, f"{path}/data/{folder}"))
        # A part of which nothing is derived has no folder; it is noted, so that it counts as done.
        names = [f"{bucket}.{source_folder}" for bucket, source_folder, _ in stale]
        fresh = [(name, folder if f"{BUCKET}={name}" in written else "", None) for name in names]
        if publish(spark, path, Version(before.number + 1, (*kept, *fresh))):
            return len(stale)
    raise RuntimeError(f"{path}: other writers were always faster")


def vacuum(spark: SparkSession, path: str, keep: int = 2, newest_only: bool = False) -> None:
    """Delete the files that only versions before the newest ``keep`` use, or with ``newest_only`` the newest of these.

    The names of the versions stay, so that no late writer can take one of them again.
    """
    numbers = _numbers(spark, path)
    used = {folder for number in numbers[-keep:] for _, folder, _ in _version(spark, path, number).parts}
    old = numbers[:-keep]
    for number in old[-1:] if newest_only else old:
        for folder in {folder for _, folder, _ in _version(spark, path, number).parts} - used - {""}:
            remove(spark, f"{path}/data/{folder}")
