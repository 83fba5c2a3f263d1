"""Putting files with known defects into the standard shape of a data file."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from veilspark.columns import KEY
from veilspark.functions.names import dash_study, split_packed_key


def dash_ask_id(df: DataFrame, column: str = "ask_id") -> DataFrame:
    """Put the dash behind the year of the study id."""
    return df.withColumn(column, dash_study(F.col(column)))


def drop_dummy_last(df: DataFrame) -> DataFrame:
    """Without the empty last column that a comma at the end of the line makes."""
    return df.select(*[F.col(f"`{name}`") for name in df.columns[:-1]])


def add_dataset_column(df: DataFrame, dataset: str, position: int = 4) -> DataFrame:
    """With the constant dataset as column `cat_cd` at the fifth place."""
    names = [F.col(f"`{name}`") for name in df.columns]
    return df.select(*names[:position], F.lit(dataset).alias("cat_cd"), *names[position:])


def unpack_keys(df: DataFrame, dashed: bool, dataset: str | None = None) -> DataFrame:
    """Replace a packed first column by the four key columns, and add the dataset if given."""
    first, *rest = df.columns
    parts = split_packed_key(F.col(f"`{first}`"), dashed)
    unpacked = df.select(
        *[parts[name].alias(name) for name in KEY], *[F.col(f"`{name}`") for name in rest]
    )
    return add_dataset_column(unpacked, dataset) if dataset else unpacked
