"""The equi join of this package: a checked broadcast, else a plain join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from veilspark.functions.parsing import quoted

LOOKUP_ROWS = 100_000
LOOKUP_BYTES = 16 << 20


def is_small(df: DataFrame, rows: int = LOOKUP_ROWS, size: int = LOOKUP_BYTES) -> bool:
    """Whether `df` has at most `rows` rows of together `size` bytes; reads no more rows than that.

    The bytes are those of the rows as JSON, so long texts and arrays count with their length.
    """
    width = F.octet_length(F.to_json(F.struct(*[F.col(quoted(name)) for name in df.columns])))
    held = df.select(width.alias("width")).limit(rows + 1)
    found = held.agg(F.count(F.lit(1)).alias("rows"), F.sum("width").alias("bytes")).first()
    return found["rows"] <= rows and (found["bytes"] or 0) <= size


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    at_most: int | None = None,
    sized_by: DataFrame | None = None,
    small: int = LOOKUP_ROWS,
) -> DataFrame:
    """Equi join that keeps or filters left rows.

    A right side measured to have at most `small` rows and `LOOKUP_BYTES` is broadcast, so the left
    side is not shuffled at all. `at_most` gives a bound of its rows that is known without
    counting, `sized_by` a frame with no fewer rows that is cheaper to count, such as the
    one the right side is the distinct rows of; either is for narrow right sides.

    Beyond that this is a plain join, and keys that own many rows of either side are left to
    adaptive execution, which cuts their partitions.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"keyed_join keeps left rows, so it cannot run a {how} join")
    on = list(on)
    counted = right if sized_by is None else sized_by
    if is_small(counted, small) if at_most is None else at_most <= small:
        return left.join(F.broadcast(right), on, how)
    return left.join(right, on, how)
