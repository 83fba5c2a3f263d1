"""Partitioned Parquet tables: replace, truncate, append and rewrite.

The year- and study-sharded tables of a study database become one table with
partition columns.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from veilspark.columns import STUDY_PROVIDER
from veilspark.operators.joins import keyed_join
from veilspark.operators.tables import latest_rows, update_where, upsert
from veilspark.sources.delimited import read_delimited
from veilspark.sources.scratch import materialise

#: Fixed value: where Spark puts rows whose partition column is null or empty.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
KEY_SET_PARTITIONS = ("ask_year", *STUDY_PROVIDER)


def _write(df: DataFrame, path: str, partitions: Sequence[str], mode: str, scope: str) -> None:
    # Rebalancing keeps the files of a partition few and cuts a very large one.
    shaped = df.hint("rebalance", *partitions) if partitions else df
    writer = shaped.write.mode(mode).option("partitionOverwriteMode", scope)
    writer.partitionBy(*partitions).parquet(path)


def append_rows(df: DataFrame, path: str, partitions: Sequence[str] = ()) -> None:
    """INSERT the rows of `df`."""
    _write(df, path, partitions, "append", "static")


def replace_partition(
    df: DataFrame, path: str, partitions: Sequence[str], scope: DataFrame | None = None
) -> None:
    """Replace every partition that `df` has rows for; others stay.

    This is delete-then-insert in one step. `scope` has the partitions that are replaced as
    a whole, such as the studies of a run: those without rows in `df` are emptied, after the
    rows are written. It is collected, so it has a row for each partition and not for each key.
    """
    if scope is not None:
        df = materialise(df, "replacement")
        columns = [F.col(name).cast("string").alias(name) for name in partitions]
        held = df.select(*columns).distinct()
        same = [F.col(f"s.{name}").eqNullSafe(F.col(f"h.{name}")) for name in partitions]
        emptied = scope.select(*columns).distinct().alias("s").join(held.alias("h"), same, "left_anti").collect()
    _write(df, path, partitions, "overwrite", "dynamic")
    if scope is not None:
        for row in emptied:
            _delete_partition(df.sparkSession, path, row.asDict())


def file_system(spark: SparkSession, path: str):
    """The store that holds `path`, and a maker of its paths."""
    jvm = spark.sparkContext._jvm
    make = jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def _delete_partition(spark: SparkSession, path: str, values: Mapping[str, str | None]) -> bool:
    """Delete the folder of one partition; false if there is none."""
    store, make = file_system(spark, path)
    names = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    folders = [
        f"{name}={NULL_FOLDER if value in (None, '') else names.escapePathName(value)}" for name, value in values.items()
    ]
    return store.delete(make("/".join([path.rstrip("/"), *folders])), True)


def truncate_partition(spark: SparkSession, path: str, values: Mapping[str, str]) -> None:
    """Empty one partition, `values` naming its columns in table order; raise if there is none."""
    if not _delete_partition(spark, path, values):
        raise ValueError(f"{path} has no partition {dict(values)}")


def rewrite(state: DataFrame, path: str, partitions: Sequence[str] = ()) -> None:
    """Make `state` the content of the table at `path`, which it may itself read.

    The state is written to a sibling folder, and then the two change names. The old table
    stays complete until the new one is; an error between the two renames names the folders
    that hold them.
    """
    spark, path = state.sparkSession, path.rstrip("/")
    store, make = file_system(spark, path)
    mark = uuid.uuid4().hex
    new, old = f"{path}.new-{mark}", f"{path}.old-{mark}"
    _write(state, new, partitions, "errorifexists", "static")
    if store.exists(make(path)) and not store.rename(make(path), make(old)):
        raise OSError(f"{path} could not be set aside; it is as before, the new content is in {new}")
    if not store.rename(make(new), make(path)):
        raise OSError(f"{path} is not there now: the new content is in {new}, the old in {old}")
    store.delete(make(old), True)
    spark.catalog.refreshByPath(path)


def upsert_files(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    update_cols: Sequence[str],
    partitions: Sequence[str] = (),
    on_repeat: str = "fail",
    latest_by: Sequence[str] = (),
) -> int:
    """MERGE `source` into the table at `path`, as `upsert` does, and rewrite only files that hold one of its keys.

    Returns how many files were rewritten. New rows go to files of their own. Run again after a failure,
    it gives the same table: see `rewrite_files`.
    """
    spark = source.sparkSession
    finish_rewrites(spark, path)
    if on_repeat == "latest":
        source = latest_rows(source, keys, latest_by)
    source = materialise(source, "upsert")
    held = spark.read.parquet(path).select(*keys, F.col("_metadata.file_path").alias("_file"))
    touched = keyed_join(held, source.select(*keys).distinct(), keys, "left_semi", sized_by=source).select("_file")
    return rewrite_files(spark, path, touched, lambda rows: upsert(rows, source, keys, update_cols), partitions)


def update_files(
    spark: SparkSession, path: str, condition: Column, values: Mapping[str, Column], partitions: Sequence[str] = ()
) -> int:
    """UPDATE … SET values WHERE condition, which rewrites only files with such rows; returns how many."""
    finish_rewrites(spark, path)
    table = spark.read.parquet(path).withColumn("_file", F.col("_metadata.file_path"))
    touched = table.filter(condition).select("_file")
    return rewrite_files(spark, path, touched, lambda rows: update_where(rows, condition, values), partitions)


def rewrite_files(
    spark: SparkSession,
    path: str,
    touched: DataFrame,
    change: Callable[[DataFrame], DataFrame],
    partitions: Sequence[str] = (),
) -> int:
    """Put what `change` makes of the rows of some files in their place; the other files stay as they are.

    `touched` has their paths, as `_metadata.file_path` says, in its only column; they are collected. The new files
    are staged in the table's folder under a name that readers pass over. A journal, written as a whole, then
    names them and the files they replace: before it the table is the old one, and from then on
    `finish_rewrites` gives the new one, also after a failure. Between the two a reader may see some of both,
    as a folder of files has no snapshots.
    """
    path = path.rstrip("/")
    old = sorted(row[0] for row in touched.distinct().collect())
    store, make = file_system(spark, path)
    mark = uuid.uuid4().hex
    table = spark.read.parquet(path)
    rows = table.filter(F.col("_metadata.file_path").isin(old)) if old else table.limit(0)
    _write(change(rows), f"{path}/_staged-{mark}", partitions, "errorifexists", "static")
    hidden, journal = make(f"{path}/_part-{mark}"), make(f"{path}/_journal-{mark}")
    out = store.create(hidden, False)
    out.write(json.dumps(old).encode())
    out.close()
    if not store.rename(hidden, journal):
        raise OSError(f"{path} is as before: {journal} could not be written")
    finish_rewrites(spark, path)
    return len(old)


def finish_rewrites(spark: SparkSession, path: str) -> None:
    """Finish rewrites of the table at `path` that stopped behind their journal, and drop what others left.

    One writer at a time: what another is staging would be dropped.
    """
    path = path.rstrip("/")
    store, make = file_system(spark, path)
    jvm = spark.sparkContext._jvm
    if not store.exists(make(path)):
        return
    names = [status.getPath().getName() for status in store.listStatus(make(path))]
    for name in names:
        if not name.startswith("_journal-"):
            continue
        journal, staged = make(f"{path}/{name}"), make(f"{path}/_staged-{name.removeprefix('_journal-')}")
        source = store.open(journal)
        replaced = json.loads(jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
        source.close()
        if store.exists(staged):
            root = store.makeQualified(staged).toUri()
            found, files = store.listFiles(staged, True), []
            while found.hasNext():
                files.append(found.next().getPath())
            for file in files:
                if not file.getName().startswith(("_", ".")):
                    place = make(make(path), root.relativize(file.toUri()).getPath())
                    store.mkdirs(place.getParent())
                    if not store.rename(file, place):
                        raise OSError(f"{file} could not be moved to {place}; run finish_rewrites again")
        for name_ in replaced:
            store.delete(make(jvm.java.net.URI(name_)), False)
        store.delete(staged, True)
        store.delete(journal, False)
    for name in names:
        if name.startswith(("_staged-", "_part-")) and store.exists(make(f"{path}/{name}")):
            store.delete(make(f"{path}/{name}"), True)
    spark.catalog.refreshByPath(path)


def load_key_file(
    spark: SparkSession,
    source: str,
    path: str,
    study: Mapping[str, str],
    stamps: Mapping[str, Column] | None = None,
    replace: bool = True,
) -> None:
    """Load the keys of one delivered key file into the year-sharded key table.

    Only the hash column is taken from the file; study and provider are those of the
    delivery. A missing key becomes empty text.
    """
    file = read_delimited(spark, source, missing="keep")
    keys = file.select(F.col(f"`{file.columns[3]}`").alias("hash_did"))
    stamped = keys.select(
        F.lit(study["ask_id"][:4]).alias("ask_year"),
        *[F.lit(study[name]).alias(name) for name in STUDY_PROVIDER],
        "hash_did",
        *[value.alias(name) for name, value in (stamps or {}).items()],
    )
    if replace:
        one = spark.range(1).select(
            F.lit(study["ask_id"][:4]).alias("ask_year"), *[F.lit(study[name]).alias(name) for name in STUDY_PROVIDER]
        )
        replace_partition(stamped, path, KEY_SET_PARTITIONS, one)
    else:
        append_rows(stamped, path, KEY_SET_PARTITIONS)


def key_set(source: DataFrame, stamps: Mapping[str, Column] | None = None) -> DataFrame:
    """Keys of a received key table in the form of the working key table."""
    return source.select(
        F.substring("ask_id", 1, 4).alias("ask_year"),
        *STUDY_PROVIDER,
        F.coalesce("hash_did", F.lit("")).alias("hash_did"),
        *[value.alias(name) for name, value in (stamps or {}).items()],
    )


def copy_key_set(
    source: DataFrame,
    path: str,
    condition: Column,
    stamps: Mapping[str, Column] | None = None,
    studies: DataFrame | None = None,
) -> None:
    """Copy the keys of the selected studies, replacing their partitions in the target.

    `studies` has the study keys and the provider of all that were asked for; those for which
    the source has no key any more are emptied.
    """
    scope = None
    if studies is not None:
        scope = studies.select(F.substring("ask_id", 1, 4).alias("ask_year"), *STUDY_PROVIDER)
    replace_partition(key_set(source.filter(condition), stamps), path, KEY_SET_PARTITIONS, scope)
