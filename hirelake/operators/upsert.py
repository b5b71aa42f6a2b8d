"""MERGE semantics as DataFrame joins, for tables without row-level updates.

The full upsert is two branches instead of one full outer join:

* updated rows: ``target LEFT JOIN source`` - when the source increment is small
  Spark broadcasts it and the (large) target is never shuffled;
* inserted rows: source rows whose key is not among the matched keys. Those keys
  come from a semi join that reads only the key columns of the target and yields
  at most one row per source key.

A hot or null key in the target therefore never has to meet in one task: the
left join can be split by Spark on the target side, and null keys match nothing.
Pass a staged source (``session.stage``) when computing it is expensive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from hirelake.functions.keys import blank, surrogate_key

Rule = Callable[[Column, Column], Column]


def insert_new(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    id_column: str | None = None,
    key_mode: str = "uuid",
    blank_is_null: bool = False,
) -> DataFrame:
    """Target plus the source's distinct unknown keys; existing rows stay as they are.

    ``blank_is_null`` compares null and '' as equal and also folds their
    spellings in the source, so one run cannot insert the same key twice.
    """
    form = blank if blank_is_null else F.col
    joined = [f"_key{i}" for i in range(len(keys))]
    forms = [form(k).alias(j) for k, j in zip(keys, joined)]
    known = target.select(*forms).distinct()
    wanted = source.select(*keys).dropna(how="all" if blank_is_null else "any", subset=keys)
    if blank_is_null:
        spellings = [F.max(k).alias(k) for k in keys]
        wanted = wanted.groupBy(*forms).agg(*spellings)
    else:
        wanted = wanted.distinct().select(*keys, *forms)
    new = wanted.join(known, joined, "left_anti").select(*keys)
    if id_column:
        new = new.withColumn(id_column, surrogate_key(keys, key_mode))
    return target.unionByName(new.select(*_known_columns(target, new)), allowMissingColumns=True)


def _known_columns(target: DataFrame, new: DataFrame) -> list[str]:
    return [c for c in target.columns if c in new.columns]


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    rules: dict[str, Rule] | None = None,
    frozen: list[str] = (),
    unique_source: bool = False,
) -> DataFrame:
    """Update matched target rows, keep the others, insert unmatched source rows.

    Every source column that the target has is taken over on a match, but for
    ``frozen`` ones, which are written at insert only, and those with a rule
    ``(target value, source value) -> new value``.

    A target row matched by several source rows is an error, raised when the
    result is computed. Set ``unique_source`` when the source is known to hold
    one row per key; the check is left out then.
    """
    rules = rules or {}
    changed = [c for c in target.columns if c in source.columns and c not in keys and c not in frozen]

    incoming = source.select(*keys, *changed)
    if unique_source:
        incoming = incoming.withColumn("_copies", F.lit(1))
    else:
        # Aggregated per key before the join: a repeated key costs one row here.
        picked = [F.first(c).alias(c) for c in changed]
        incoming = incoming.groupBy(*keys).agg(*picked, F.count(F.lit(1)).alias("_copies"))
    incoming = incoming.select(
        *keys, "_copies", *[F.col(c).alias(f"_new_{c}") for c in changed]
    )
    joined = target.join(incoming, keys, "left")
    matched = F.col("_copies").isNotNull()

    def value(c: str) -> Column:
        if c not in changed:
            return F.col(c)
        rule = rules.get(c, lambda old, new: new)
        return F.when(matched, rule(F.col(c), F.col(f"_new_{c}"))).otherwise(F.col(c)).alias(c)

    if not unique_source:
        joined = joined.filter(_single_match(keys))
    updated = joined.select(*[value(c) for c in target.columns])

    matched_keys = target.select(*keys).join(source.select(*keys), keys, "left_semi").distinct()
    inserted = source.join(matched_keys, keys, "left_anti")
    inserted = inserted.select(*_known_columns(target, source))
    return updated.unionByName(inserted, allowMissingColumns=True)


def _single_match(keys: list[str]) -> Column:
    """True, or an error for a target row that several source rows match."""
    where = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    return F.when(
        F.coalesce(F.col("_copies"), F.lit(0)) > 1,
        F.raise_error(F.concat(F.lit("several source rows match key "), where)).cast("boolean"),
    ).otherwise(F.lit(True))
