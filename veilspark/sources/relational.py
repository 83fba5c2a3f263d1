"""Reading the study database over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    driver: str,
    properties: dict[str, str] | None = None,
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    connections: int = 4,
    fetch_rows: int = 10_000,
) -> DataFrame:
    """A table or sub-query, read over several connections when a split column is named.

    Filters and columns reach the database by themselves. Credentials belong in
    `properties`, filled from the secret store of the cluster.
    """
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=query, driver=driver, fetchsize=fetch_rows, **(properties or {})
    )
    if split_on:
        if bounds is None:
            raise ValueError("a split column needs its bounds")
        reader = reader.options(
            partitionColumn=split_on,
            lowerBound=bounds[0],
            upperBound=bounds[1],
            numPartitions=connections,
        )
    return reader.load()
