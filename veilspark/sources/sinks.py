"""Writing delimited files and bundles of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from veilspark.functions.parsing import quoted
from veilspark.sources.scratch import scratch_path

ROWS_PER_PART = 5_000_000


def _write(
    df: DataFrame,
    path: str,
    folders: Sequence[str],
    order: Sequence[str],
    compression: str | None,
    mode: str,
    line_breaks: str,
) -> None:
    if line_breaks == "refuse":
        df = _without_line_breaks(df, folders)
    elif line_breaks != "quote":
        raise ValueError("line_breaks is 'refuse' or 'quote'")
    if folders:
        # Rebalancing brings the rows of a file together, but cuts a very large file.
        df = df.hint("rebalance", *folders)
    if order:
        df = df.sortWithinPartitions(*folders, *order)
    writer = df.write.mode("overwrite" if mode == "replace" else mode).options(
        header=True, emptyValue="", nullValue="", escape='"', maxRecordsPerFile=ROWS_PER_PART,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    if mode == "replace":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if compression:
        writer = writer.option("compression", compression)
    writer.partitionBy(*folders).csv(path)


def write_delimited(
    df: DataFrame,
    path: str,
    file_column: str | None = None,
    order: Sequence[str] = (),
    mode: str = "errorifexists",
    line_breaks: str = "refuse",
) -> None:
    """Write with header and null as empty text; a quote within a cell is doubled.

    A cell with a line break raises, as readers by line would see two rows; with
    `line_breaks="quote"` it is written in quotes, for readers that take those. Mode `replace`
    replaces the folders of the files written and leaves other files.

    With `file_column`, each of its values becomes a folder `<column>=<name>`, the
    delivered file of that name, holding as many parts as its size needs. `order`
    sorts the rows of each part.
    """
    _write(df, path, [file_column] if file_column else [], order, None, mode, line_breaks)


def _without_line_breaks(df: DataFrame, folders: Sequence[str]) -> DataFrame:
    """`df`, which raises where a cell has a line break."""
    cells = []
    for name, kind in df.dtypes:
        cell = F.col(quoted(name))
        if kind == "string" and name not in folders:
            refused = F.raise_error(F.lit(f"column {name} has a cell with a line break"))
            broken = F.contains(cell, F.lit("\n")) | F.contains(cell, F.lit("\r"))
            cell = F.when(broken, refused).otherwise(cell).alias(name)
        cells.append(cell)
    return df.select(*cells)


def write_bundles(
    df: DataFrame,
    path: str,
    file_column: str = "file_nm",
    mode: str = "errorifexists",
    line_breaks: str = "refuse",
) -> None:
    """Write compressed, one folder per interface id, dataset and file."""
    _write(df, path, ["ifid", "cat_cd", file_column], (), "gzip", mode, line_breaks)


def deliver(df: DataFrame, label: str, file_column: str | None = None) -> str:
    """Write to a new scratch path and return the path."""
    path = scratch_path(df.sparkSession, label)
    write_delimited(df, path, file_column)
    return path
