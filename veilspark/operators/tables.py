"""MERGE, UPDATE and column projections over DataFrames.

Each function returns the new state of a table; `sources.tables` writes it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from veilspark.operators.joins import is_small, keyed_join
from veilspark.sources.scratch import materialise


def _same(names: Sequence[str], null_safe: bool) -> Column:
    pairs = [(F.col(f"s.{name}"), F.col(f"t.{name}")) for name in names]
    return reduce(and_, [s.eqNullSafe(t) if null_safe else s == t for s, t in pairs])


def missing_from(
    source: DataFrame, target: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Source rows whose keys the target does not hold.

    The target is reduced to its distinct keys, so copies in it cost nothing. For a
    small source it is first cut down to the source keys without being shuffled.
    """
    held = target.select(*keys)
    wanted = source.select(*keys).distinct()
    if is_small(source):
        found = _same(keys, null_safe)
        held = held.alias("s").join(F.broadcast(wanted).alias("t"), found, "left_semi")
    held = held.distinct()
    return source.alias("s").join(held.alias("t"), _same(keys, null_safe), "left_anti")


def merge_insert_only(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Target plus the distinct source rows it does not hold yet.

    As in SQL MERGE, a null in a key never matches and its row is inserted again;
    `null_safe` treats nulls as equal.
    """
    new = missing_from(source.distinct(), target, keys or source.columns, null_safe)
    return target.unionByName(new, allowMissingColumns=True)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    on_repeat: str = "fail",
    latest_by: Sequence[str] = (),
) -> DataFrame:
    """Target with `update_cols` taken from the source where keys match, plus its new rows.

    A key that the source repeats raises, as in MERGE, or with `on_repeat="latest"` its row with
    the largest `latest_by` counts. A matched row takes the source value also where that is
    null; columns outside `update_cols` stay. The source is stored once.
    """
    if on_repeat == "latest":
        if not latest_by:
            raise ValueError("on_repeat='latest' needs the columns that say which row is the latest")
        source = latest_rows(source, keys, latest_by)
    elif on_repeat != "fail":
        raise ValueError("on_repeat is 'fail' or 'latest'")
    source = materialise(source, "upsert")
    if on_repeat == "fail" and (again := repeated_keys(source, keys).head()):
        raise ValueError(f"the source repeats the key {again.asDict()}")
    fresh = [name.lower() for name in update_cols]
    changes = source.select(
        *keys, *[F.col(name).alias(f"_new_{name.lower()}") for name in update_cols]
    ).withColumn("_hit", F.lit(True))
    updated = keyed_join(target, changes, keys, "left").select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{name.lower()}")).otherwise(F.col(name)).alias(name)
            if name.lower() in fresh
            else F.col(name)
            for name in target.columns
        ]
    )
    return updated.unionByName(missing_from(source, target, keys), allowMissingColumns=True)


def latest_rows(source: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """The row of each key with the largest `latest_by`, ties by the other columns."""
    rest = [name for name in source.columns if name not in (*keys, *latest_by)]
    row = F.max(F.struct(*latest_by, *rest)).alias("_row")
    return source.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*source.columns)


def repeated_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; an upsert needs this to be empty for its source."""
    counted = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter(F.col("n_rows") > 1)


def _assigned(df: DataFrame, hit: Column, values: Mapping[str, Column]) -> list[Column]:
    new = {name.lower(): value for name, value in values.items()}
    unknown = new.keys() - {name.lower() for name in df.columns}
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return [
        F.when(hit, new[name.lower()]).otherwise(F.col(name)).alias(name)
        if name.lower() in new
        else F.col(name)
        for name in df.columns
    ]


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """UPDATE … SET values WHERE condition."""
    return df.select(*_assigned(df, condition, values))


def update_exists(
    df: DataFrame,
    other: DataFrame,
    on: Mapping[str, str],
    values: Mapping[str, Column],
    condition: Column | None = None,
) -> DataFrame:
    """UPDATE … WHERE EXISTS (a row of `other` with equal keys): `on` maps own to other columns."""
    found = other.select(*[F.col(theirs).alias(own) for own, theirs in on.items()]).distinct()
    found = found.withColumn("_found", F.lit(True))
    flagged = keyed_join(df, found, list(on), "left", sized_by=other)
    hit = F.coalesce("_found", F.lit(False))
    if condition is not None:
        hit &= condition
    return flagged.select(*_assigned(df, hit, values))


def insert_select(
    df: DataFrame, columns: Sequence[str], stamps: Mapping[str, Column] | None = None
) -> DataFrame:
    """INSERT … SELECT: the named columns in order, then constant or time stamps."""
    stamps = stamps or {}
    return df.select(*columns, *[value.alias(name) for name, value in stamps.items()])


def drop_and_order(df: DataFrame, drop: Sequence[str]) -> DataFrame:
    """All columns but the named ones, in their order."""
    gone = {name.lower() for name in drop}
    return df.select(*[name for name in df.columns if name.lower() not in gone])


def move_last(df: DataFrame, position: int) -> DataFrame:
    """Move the last column in front of the one at `position` (from 0)."""
    *rest, last = df.columns
    return df.select(*rest[:position], last, *rest[position:])
