"""Time expressions. All of them assume a UTC session."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def nanos_to_timestamp(nanos: Column) -> Column:
    """Nanoseconds since the epoch to a timestamp; null, zero and negative values give null."""
    micros = F.round(nanos / 1000).cast("bigint")
    return F.when(nanos > 0, F.timestamp_micros(micros))


def timestamp_to_nanos(ts: Column) -> Column:
    return F.unix_micros(ts) * F.lit(1000).cast("bigint")


def parse_created(text: Column) -> Column:
    """Timestamp of an ISO-8601 text, null where it cannot be read."""
    return text.try_cast("timestamp")


def posting_week(text: Column) -> Column:
    """ISO week of the posting date as written, that is in the text's own offset."""
    return F.weekofyear(text.try_cast("timestamp_ntz")).cast("string")


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def compact_stamp(ts: Column, with_time: bool = True) -> Column:
    return F.date_format(ts, "yyyyMMddHHmmss" if with_time else "yyyyMMdd")


def null_aware_greatest(a: Column, b: Column) -> Column:
    """Greater of two values; null if either is null (Spark's ``greatest`` skips nulls)."""
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))
