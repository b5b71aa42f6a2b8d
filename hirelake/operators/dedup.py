"""One row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType


def latest_per_key(
    df: DataFrame, keys: list[str], newest: str | None = None, ties: list[str] | None = None
) -> DataFrame:
    """Keep the row with the greatest ``newest`` per key; ``ties`` (ascending) make the order total.

    Without ``ties`` all other columns are compared, so rows that still tie are
    equal. A null ``newest`` loses; in ``ties`` nulls come first. The choice is a
    minimum over the whole row, an aggregate: each map task forwards one row per
    key, however hot the key.
    """
    rest = ties if ties is not None else [c for c in df.columns if c not in keys and c != newest]
    order = []
    if newest:
        value = F.col(newest)
        if isinstance(df.schema[newest].dataType, (TimestampType, TimestampNTZType)):
            value = F.unix_micros(value.cast("timestamp"))
        order = [F.col(newest).isNull().alias("_unknown"), (-value).alias("_age")]
    others = [c for c in df.columns if c not in keys and c not in rest]
    first = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest, *others)).alias("_first"))
    return first.select(*[F.col(c) if c in keys else F.col(f"_first.{c}") for c in df.columns])


def top_per_group(
    df: DataFrame, group: list[str], order: list, n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each group, with their rank.

    Spark keeps at most ``n`` rows per group in each map task before the
    shuffle, so group size does not matter.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)
