"""Join-key and surrogate-key expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def blank(column: Column | str) -> Column:
    """Key form in which null and the empty string are equal."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def surrogate_key(columns: list[str], mode: str = "uuid") -> Column:
    """Key of a newly inserted dimension row.

    ``uuid`` draws a random key, so the result has to be written before it is
    used twice. ``hash`` gives the same key for the same natural key on every
    run; null and '' count as the same value. Each part is hashed with its
    length, so that no two keys run together.
    """
    if mode == "uuid":
        return F.uuid()
    if mode == "hash":
        parts = [F.concat(F.length(blank(c)).cast("string"), F.lit(":"), blank(c)) for c in columns]
        return F.md5(F.concat(*parts))
    raise ValueError(f"unknown key mode {mode!r}")
