"""Helpers that several of the operators use."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DataType, StructType

CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it; a path that isn't there does no harm."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def partitions(df: DataFrame) -> int:
    """How many partitions a shuffle of `df` gets: the session's setting."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_columns(df: DataFrame, **kinds: str | DataType) -> StructType:
    """The schema of `df` with further columns, by name and type."""
    schema = StructType(list(df.schema.fields))
    for name, kind in kinds.items():
        schema = schema.add(name, kind)
    return schema


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each behind as many underscores as it needs to be no column of `df`, in either case."""
    taken, out = {name.lower() for name in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def in_chunks(batches: Iterable[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of `batches` in order, in slices of about `limit` bytes of `column`.

    A slice has one row at least, so a longer text makes a slice of its own.
    """
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
        begin = held = 0
        for row, size in enumerate(sizes):
            if row > begin and held + (size or 0) > limit:
                yield batch.slice(begin, row - begin)
                begin, held = row, 0
            held += size or 0
        if begin < len(sizes):
            yield batch.slice(begin)


def running_start(df: DataFrame, group: str, value: str, to: str) -> DataFrame:
    """`df` with `to`, the sum of `value` over all rows of smaller `group`.

    `group` is a partition number, so `df` has few rows. Sums go up in two levels:
    one window holds the sums of 1024 groups each, the others 1024 groups.
    """
    thousand = F.floor(F.col(group) / 1024)
    upper = df.groupBy(thousand.alias("_upper")).agg(F.sum(value).alias("_sum"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    upper = upper.select("_upper", F.coalesce(F.sum("_sum").over(before.orderBy("_upper")), F.lit(0)).alias("_base"))
    inner = F.coalesce(F.sum(value).over(before.partitionBy("_upper").orderBy(group)), F.lit(0))
    return df.withColumn("_upper", thousand).join(upper, "_upper").withColumn(to, F.col("_base") + inner).drop("_upper", "_base")
