"""Inventory of produced files and their all-or-nothing release."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from veilspark.columns import OK, STUDY
from veilspark.operators.inventory import (
    expected_outputs,
    inventory_rows,
    inventory_status,
    merge_inventory,
)
from veilspark.operators.release import FILE, missing_outputs, releasable, release_verdicts
from veilspark.operators.tables import update_exists
from veilspark.sources.delimited import file_inventory
from veilspark.sources.manifest import publish
from veilspark.sources.scratch import materialise
from veilspark.sources.sinks import write_delimited


@dataclass(frozen=True)
class Inventory:
    """The refreshed inventory and a status row per expected file."""

    table: DataFrame
    detail: DataFrame


def inventory_job(
    spark: SparkSession,
    paths: str,
    register: DataFrame,
    inventory: DataFrame,
    stage: str,
    centre: Column | None = None,
    exec_seq: Column | None = None,
) -> Inventory:
    """Measure the files of a stage and merge the measures into the inventory."""
    files = materialise(file_inventory(spark, paths), "inventory")
    expected = expected_outputs(register, stage, centre, exec_seq)
    rows = inventory_rows(expected, files, stage)
    by_run = stage in ("deid", "deid_summary")
    if by_run:
        if exec_seq is None:
            raise ValueError("de-identified files are kept per run: pass exec_seq")
        rows = rows.withColumn("exec_seq", exec_seq)
    merged = merge_inventory(inventory, materialise(rows, "inventory-rows"), exec_seq=by_run)
    return Inventory(merged, inventory_status(expected, files))


@dataclass(frozen=True)
class Release:
    """Verdict per study and the files that are missing."""

    verdicts: DataFrame
    missing: DataFrame


def release_job(register: DataFrame, rows: DataFrame, path: str, centre: Column, with_manifest: bool = False) -> Release:
    """Write the registered files of every complete study; leave the others alone.

    `rows` carry the study keys and `out_nm`, the file each belongs to. A file that was
    released before is replaced, so a second run leaves what the first did. With `with_manifest` the files
    are released as `sources.manifest` does, all at once for its readers.

    Rows and register are evaluated once: verdicts and files come from their copies.
    """
    expected = materialise(expected_outputs(register, "deid", centre).select(*FILE), "expected")
    staged = materialise(rows, "release-rows")
    produced = materialise(staged.select(*FILE).distinct(), "produced")
    verdicts = materialise(release_verdicts(expected, produced), "release")
    ready = releasable(staged, verdicts, expected).withColumnRenamed("out_nm", "file_nm")
    if with_manifest:
        publish(ready, path)
    else:
        write_delimited(ready, path, file_column="file_nm", mode="replace")
    return Release(verdicts, missing_outputs(expected, produced))


def complete_requests(requests: DataFrame, verdicts: DataFrame, code: str = "440") -> DataFrame:
    """Requests whose original files are all in the inventory, moved to the next status."""
    done = verdicts.filter(F.col("status") == OK)
    keys = {"requestid": "ask_id", "hypoid": "rshp_id"}
    return update_exists(requests, done, keys, {"requeststatus": F.lit(code)})
