"""Small tables whose versions lie side by side: a new one is seen as a whole or not at all."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from veilspark.sources.tables import file_system


def versions(spark: SparkSession, path: str) -> list[str]:
    """The names of the versions at `path`, oldest first."""
    store, make = file_system(spark, path)
    folder = make(path)
    if not store.exists(folder):
        return []
    names = [status.getPath().getName() for status in store.listStatus(folder)]
    return sorted(name for name in names if name.startswith("v"))


def add_version(df: DataFrame, path: str, after: int) -> str:
    """Store `df` as the version behind the `after` ones that it was made from, and return its name.

    It is written beside the others and gets its name in one step. Where another writer was faster it raises.
    """
    spark, name = df.sparkSession, f"v{after + 1:09d}"
    store, make = file_system(spark, path)
    staged, place = f"{path}/_new-{uuid.uuid4().hex}", make(f"{path}/{name}")
    df.write.parquet(staged)
    if store.exists(place) or not store.rename(make(staged), place):
        raise OSError(f"version {name} of {path} could not be published; what belongs to it is not seen")
    return name
