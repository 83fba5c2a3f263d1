"""Key tables stored by key: bucketed and sorted, so that joins on the key do not shuffle them.

Key tables of a study are written once and joined with every delivery. Stored by key, only the delivered
rows are exchanged, into as many partitions as the table has buckets.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from veilspark.functions.parsing import quoted
from veilspark.sources.tables import file_system

NOTE = "_by_key.json"


def store_by_key(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write the distinct rows of `df` to `path`, a sorted file for each bucket, and open them."""
    spark, path = df.sparkSession, path.rstrip("/")
    name = f"by_key_{uuid.uuid4().hex}"
    shaped = df.distinct().repartition(buckets, *keys)
    shaped.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    store, make = file_system(spark, path)
    out = store.create(make(f"{path}/{NOTE}"), True)
    out.write(json.dumps({"keys": list(keys), "buckets": buckets, "schema": df.schema.jsonValue()}).encode())
    out.close()
    return open_by_key(spark, path)


def open_by_key(spark: SparkSession, path: str) -> DataFrame:
    """A table that `store_by_key` wrote, in this or another session."""
    path = path.rstrip("/")
    store, make = file_system(spark, path)
    source = store.open(make(f"{path}/{NOTE}"))
    told = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
    source.close()
    columns = ", ".join(f"{quoted(f['name'])} {_kind(f)}" for f in told["schema"]["fields"])
    keys = ", ".join(map(quoted, told["keys"]))
    name, place = f"by_key_{uuid.uuid4().hex}", path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {told['buckets']} BUCKETS LOCATION '{place}'")
    return spark.table(name)


def _kind(field: dict) -> str:
    from pyspark.sql.types import StructField

    return StructField.fromJson(field).dataType.simpleString()


def join_by_key(rows: DataFrame, table: DataFrame, key: str, how: str = "left") -> DataFrame:
    """`rows` joined with a table stored by `key`, which is not exchanged.

    Rows without a key are spread and match nothing. A key that owns a large share of the rows goes through one
    task, as adaptive execution cuts only partitions of two exchanges: use a plain join there.
    """
    if how not in ("left", "inner"):
        raise ValueError("how is 'left' or 'inner'")
    if how == "inner":
        return rows.where(F.col(quoted(key)).isNotNull()).join(table, key)
    # Within a partition of rows the places differ, so rows without a key go to many tasks.
    spread = F.concat(F.lit("\x00"), F.monotonically_increasing_id().cast("string"))
    marked = rows.withColumn("_key", F.coalesce(F.col(quoted(key)), spread)).alias("r")
    others = [F.col(f"t.{quoted(name)}") for name in table.columns if name != key]
    return marked.join(table.alias("t"), F.col("_key") == F.col(f"t.{quoted(key)}"), "left").select(*[F.col(f"r.{quoted(name)}") for name in rows.columns], *others)
