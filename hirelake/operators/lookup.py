"""Key lookups from a fact to its dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hirelake.functions.keys import blank
from hirelake.session import broadcast_few, stage


def lookup(
    fact: DataFrame,
    dimension: DataFrame,
    on: list[str],
    value: str,
    blank_is_null: bool = False,
    prefer: list[str] = (),
) -> DataFrame:
    """Left join that adds ``value`` from the dimension and never adds rows.

    Dimension rows that share a key (one city and state in two countries) are
    reduced to one, the first by ``prefer`` and then by ``value``. The entries are
    written and counted first: few enough are broadcast, so the fact stays where it is,
    whatever size the plan expects. Otherwise Spark splits a hot key of the fact at run time.
    """
    form = blank if blank_is_null else F.col
    keys = [f"_key{i}" for i in range(len(on))]
    order = F.struct(*[F.col(c) for c in prefer], F.col(value))
    entries = (
        dimension.select(*[form(c).alias(k) for c, k in zip(on, keys)], value, *prefer)
        .dropna(how="any", subset=keys)
        .groupBy(*keys).agg(F.min(order)[value].alias(value))
    )
    entries = broadcast_few(stage(entries, "entries"))
    keyed = fact.withColumns({k: form(c) for c, k in zip(on, keys)})
    return keyed.join(entries, keys, "left").drop(*keys)
