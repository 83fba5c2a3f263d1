"""Frequency tables of original and de-identified data, and their long form."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from veilspark.functions.parsing import float_sql, quoted
from veilspark.operators.rules import Rule, apply_rules
from veilspark.sources.scratch import materialise


@dataclass(frozen=True)
class Variable:
    """One summary variable: its sequence number, column and declared type."""

    seq: int
    column: str
    is_number: bool


def frequency_table(df: DataFrame, columns: Sequence[str], count: str = "cnt") -> DataFrame:
    """Rows per combination of the columns: the sizes of the equivalence classes.

    Include the page columns for one table per delivered file.
    """
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(count))


def roll_up(table: DataFrame, columns: Sequence[str], count: str = "cnt") -> DataFrame:
    """A frequency table over fewer columns, from one over more."""
    return table.groupBy(*columns).agg(F.sum(count).alias(count))


def changed_pages(before: DataFrame, after: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Keys of pages that two inventories don't list with the same measures, and `change`: added, changed or gone."""
    was = before.select(*keys, F.struct(*measures).alias("_was"))
    now = after.select(*keys, F.struct(*measures).alias("_now"))
    both = was.join(now, list(keys), "full").filter(~F.col("_was").eqNullSafe(F.col("_now")))
    change = F.when(F.col("_was").isNull(), "added").when(F.col("_now").isNull(), "gone").otherwise("changed")
    return both.select(*keys, change.alias("change"))


def moved_counts(gone: DataFrame, come: DataFrame, columns: Sequence[str], count: str = "cnt") -> DataFrame:
    """What to add to a frequency table over `columns` when the rows of `come` take the place of those of `gone`."""
    less = gone.select(*columns, (-F.col(count)).alias(count))
    return roll_up(come.select(*columns, count).unionByName(less), columns, count).filter(F.col(count) != 0)


def with_counts(table: DataFrame, moved: DataFrame, columns: Sequence[str], count: str = "cnt") -> DataFrame:
    """A frequency table with counts added and subtracted; combinations without rows go, and a count below none raises."""
    summed = roll_up(table.select(*columns, count).unionByName(moved.select(*columns, count)), columns, count)
    wrong = F.raise_error(F.lit("more rows are subtracted than were counted")).cast("bigint")
    sound = F.when(F.col(count) < 0, wrong).otherwise(F.col(count)).alias(count)
    return summed.filter(F.col(count) != 0).select(*columns, sound)


def deidentified_table(
    table: DataFrame,
    rules: Sequence[Rule],
    on_invalid: str = "suppress",
    missing_column: str = "skip",
    count: str = "cnt",
) -> DataFrame:
    """Frequency table of the de-identified data, from that of the original data.

    Rules act on single cells, so applying them to the distinct combinations and
    adding up the counts gives what a second pass over the rows would.
    """
    changed = apply_rules(table, rules, on_invalid, missing_column)
    return roll_up(changed, [name for name in table.columns if name != count], count)


def ordinal(
    df: DataFrame,
    order: Sequence[str],
    within: Sequence[str] = (),
    name: str = "datum_seq",
) -> DataFrame:
    """Number rows 1..n in sort order, per `within` group, without one task per group.

    Rows are range-partitioned and sorted, and that arrangement is written once, as
    range bounds are sampled and would differ in a second run. A group that spans
    partitions starts in each where it stopped in the one before. `order` has to be
    unique within a group for the numbers to be determined.
    """
    keys = [*within, *order]
    place = F.monotonically_increasing_id()
    placed = materialise(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_slice", F.spark_partition_id())
        .withColumn("_place", place),
        "ordinal",
    )
    group = [*within, "_slice"]
    runs = placed.groupBy(*group).agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    before = Window.partitionBy(*within).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        *[F.col(c).alias(f"_s_{c}") for c in group],
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in group]
    return (
        placed.join(starts, same, "left")
        .select((F.col("_place") + F.col("_shift")).alias(name), *df.columns)
    )


def to_eav(
    table: DataFrame,
    variables: Sequence[Variable],
    ids: Sequence[str],
    cnt_seq: int,
    count: str = "cnt",
) -> DataFrame:
    """One row per table row and variable, the count being one more numeric variable.

    Text variables fill `str_datatp_val` (empty when missing), numeric ones
    `num_datatp_val` (null when missing or not a number).
    """
    return table.selectExpr(*map(quoted, ids), f"inline({_lines(variables, cnt_seq, count)})")


def to_eav_by(
    table: DataFrame,
    kind: str,
    kinds: Sequence[tuple[Sequence[Variable], int]],
    ids: Sequence[str],
    count: str = "cnt",
) -> DataFrame:
    """As `to_eav`, of a table whose column `kind` has for each row the place in `kinds` of its variables and count number."""
    cases = " ".join(f"when {i} then {_lines(variables, cnt_seq, count)}" for i, (variables, cnt_seq) in enumerate(kinds))
    return table.selectExpr(*map(quoted, ids), f"inline(case {quoted(kind)} {cases} end)")


def _lines(variables: Sequence[Variable], cnt_seq: int, count: str) -> str:
    lines = []
    for v in [*variables, Variable(cnt_seq, count, True)]:
        cell = f"string({quoted(v.column)})"
        text = "cast(null AS string)" if v.is_number else f"coalesce({cell}, '')"
        number = float_sql(cell) if v.is_number else "cast(null AS double)"
        lines.append(f"struct({int(v.seq)} AS var_dscr_seq, {text} AS str_datatp_val, {number} AS num_datatp_val)")
    return f"array({', '.join(lines)})"
