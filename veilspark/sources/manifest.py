"""Releases of delimited files that one manifest publishes.

A release is written to a folder of its own, which nothing refers to yet. Its files are measured as they
lie there, and a new version of the manifest, the former one with these files in place of those of the same
names, is written beside the others and gets its name in one step. Readers take the files that the latest
version lists, so a release that fails half-way is not seen, and one that is run again adds a version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from veilspark.sources.delimited import logical_file, read_delimited
from veilspark.sources.scratch import materialise
from veilspark.sources.sinks import write_delimited
from veilspark.sources.tables import file_system
from veilspark.sources.versions import add_version, versions

ENTRY = "file_nm string, folder string, n_rows long, checksum string"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """file_nm, folder, n_rows and checksum of each released file; no rows before the first release."""
    path = path.rstrip("/")
    named = versions(spark, f"{path}/manifests")
    if not named:
        return spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in map(str.split, ENTRY.split(", "))])
    return spark.read.schema(ENTRY).parquet(f"{path}/manifests/{named[-1]}")


def _parts(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """The parts of a release as they lie in its folder: `_path`, `file_nm`, data rows, and a sum over all lines.

    Lines are summed by part, as names are only needed for parts, and in halves that fit a long.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(f"{path}/{folder}")
    found = lines.select(F.xxhash64("value").alias("hash"), "_metadata.file_path", "_metadata.file_name")
    parts = found.groupBy("file_path", "file_name").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.shiftright("hash", 32)).cast("decimal(38,0)").alias("high"),
        F.sum(F.col("hash").bitwiseAND(F.lit(0xFFFFFFFF))).cast("decimal(38,0)").alias("low"),
    )
    hashes = (F.col("high") * F.lit(1 << 32) + F.col("low")).cast("decimal(38,0)")
    name = logical_file("file_path", "file_name").alias("file_nm")
    return parts.select(F.col("file_path").alias("_path"), name, (F.col("lines") - 1).alias("rows"), hashes.alias("hashes"))


def _by_file(parts: DataFrame, *keys: str) -> DataFrame:
    """The files whose parts these are: data rows, and a sum over all lines that their order does not change."""
    return parts.groupBy("file_nm", *keys).agg(F.sum("rows").alias("n_rows"), F.sum("hashes").cast("string").alias("checksum"))


def _measured(spark: SparkSession, path: str, folder: str) -> DataFrame:
    return _by_file(_parts(spark, path, folder))


def publish(df: DataFrame, path: str, file_column: str = "file_nm") -> str:
    """Release the files that `file_column` names, in place of released ones of the same names; returns the version.

    One release at a time: of two, the later to finish raises and is not seen.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    before = versions(spark, f"{path}/manifests")
    folder = f"release-{uuid.uuid4().hex}"
    named = df.withColumnRenamed(file_column, "file_nm")
    write_delimited(named, f"{path}/{folder}", "file_nm")
    new = materialise(_measured(spark, path, folder).withColumn("folder", F.lit(folder)), "measured")
    kept = manifest(spark, path).join(new.select("file_nm"), "file_nm", "left_anti")
    columns = [part.split()[0] for part in ENTRY.split(", ")]
    return add_version(kept.select(*columns).unionByName(new.select(*columns)), f"{path}/manifests", len(before))


def _found(spark: SparkSession, path: str, listed: DataFrame) -> tuple[list[str], DataFrame | None]:
    """The folders that a manifest lists, and the parts in them, stored; None without any."""
    folders = [row["folder"] for row in listed.select("folder").distinct().orderBy("folder").collect()]
    found = None
    for folder in folders:
        some = _parts(spark, path, folder).withColumn("folder", F.lit(folder))
        found = some if found is None else found.unionByName(some)
    # Stored, as a join would have the names of parts checked for each line.
    return folders, None if found is None else materialise(found, "parts")


def _verdicts(listed: DataFrame, parts: DataFrame) -> DataFrame:
    found = _by_file(parts, "folder").withColumnsRenamed({"n_rows": "_rows", "checksum": "_sum"})
    same = (F.col("n_rows") == F.col("_rows")) & (F.col("checksum") == F.col("_sum"))
    met = listed.join(found, ["file_nm", "folder"], "left")
    return met.select("file_nm", "n_rows", F.coalesce(same, F.lit(False)).alias("intact"))


def verify(spark: SparkSession, path: str) -> DataFrame:
    """file_nm, n_rows and `intact` of each released file: whether its rows and checksum are those of the manifest."""
    path, listed = path.rstrip("/"), manifest(spark, path)
    _, parts = _found(spark, path, listed)
    if parts is None:
        return listed.select("file_nm", "n_rows", F.lit(True).alias("intact"))
    return _verdicts(listed, parts)


def read_release(spark: SparkSession, path: str, **options) -> DataFrame:
    """The rows of all released files, as `read_delimited` gives them; raises if a file isn't as the manifest says."""
    path, listed = path.rstrip("/"), manifest(spark, path)
    folders, parts = _found(spark, path, listed)
    if parts is None:
        raise ValueError(f"nothing is released at {path}")
    broken = [row["file_nm"] for row in _verdicts(listed, parts).where("not intact").limit(10).collect()]
    if broken:
        raise ValueError(f"files are not as released: {', '.join(sorted(broken))}")
    # Lines go by the parts that were verified, so replaced files are left out before they are parsed.
    parts = parts.join(listed.select("file_nm", "folder"), ["file_nm", "folder"], "left_semi")
    parts = materialise(parts.select("_path", "file_nm", "folder"), "released")
    rows = None
    for folder in folders:
        of_folder = parts.where(F.col("folder") == folder).select("_path", "file_nm")
        some = read_delimited(spark, f"{path}/{folder}", parts=of_folder, **options)
        rows = some if rows is None else rows.unionByName(some)
    return rows


def prune(spark: SparkSession, path: str) -> int:
    """Delete the folders that the latest version does not refer to; returns how many. Readers of older versions lose their files."""
    path = path.rstrip("/")
    store, make = file_system(spark, path)
    used = {row["folder"] for row in manifest(spark, path).select("folder").distinct().collect()}
    names = [status.getPath().getName() for status in store.listStatus(make(path))]
    gone = [name for name in names if name.startswith("release-") and name not in used]
    for name in gone:
        store.delete(make(f"{path}/{name}"), True)
    return len(gone)
