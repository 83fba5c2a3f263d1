"""Inventories of delivered and produced files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from veilspark.columns import DATASET, FAILED, OK
from veilspark.functions.names import output_name, parse_file_name
from veilspark.operators.joins import keyed_join
from veilspark.operators.tables import upsert
from veilspark.sources.scratch import materialise

INVENTORY_KEYS = (*DATASET, "org_mrg_tp_cd", "prsnt_pg_num", "tot_pg_num")
MEASURES = ("crt_ymd", "file_sz", "datum_cnt", "var_ea", "file_nm")

# Kind of content per stage: 1 original or de-identified data, 2 summaries (fixed values).
CONTENT = {"original": "1", "deid": "2", "summary": "2", "deid_summary": "2"}


def expected_outputs(
    register: DataFrame, stage: str, centre: Column | None = None, exec_seq: Column | None = None
) -> DataFrame:
    """The register with `out_nm`, the file that the stage makes of each delivered one.

    De-identified files go by the centre that asked, the others by their provider.
    """
    owner = F.col("prvdr_cd") if centre is None else centre
    name = output_name(F.col("file_nm"), stage, owner, F.col("cat_cd"), exec_seq)
    return register.withColumn("out_nm", name)


def outputs_of_rows(
    rows: DataFrame, stage: str, centre: Column | None = None, exec_seq: Column | None = None
) -> DataFrame:
    """`expected_outputs` of data rows, many of one file: a name is made once for each file, not for each row.

    The rows are read twice, so they are better stored.
    """
    given = [
        F.col("file_nm").alias("name"),
        (F.col("prvdr_cd") if centre is None else centre).alias("owner"),
        F.col("cat_cd").alias("cat"),
        (F.lit(None).cast("string") if exec_seq is None else exec_seq).alias("seq"),
    ]
    # As one column, in which nulls are equal.
    keyed = rows.drop("out_nm").withColumn("_file", F.struct(*given))
    file = F.col("_file")
    name = output_name(file["name"], stage, file["owner"], file["cat"], None if exec_seq is None else file["seq"])
    names = materialise(keyed.select("_file").distinct().withColumn("out_nm", name), "names")
    return keyed_join(keyed, names, ["_file"], "left").drop("_file")


def inventory_rows(expected: DataFrame, files: DataFrame, stage: str) -> DataFrame:
    """Inventory rows of the expected files that exist, `files` being their measures."""
    parts = parse_file_name(F.col("_given"))
    measured = files.withColumnRenamed("file_nm", "out_nm")
    found = keyed_join(expected.withColumnRenamed("file_nm", "_given"), measured, ["out_nm"])
    return found.withColumn("_parts", parts).select(
        *DATASET,
        F.lit(CONTENT[stage]).alias("org_mrg_tp_cd"),
        F.col("_parts.page").alias("prsnt_pg_num"),
        F.col("_parts.total").alias("tot_pg_num"),
        F.col("_parts.ymd").alias("crt_ymd"),
        "file_sz",
        "datum_cnt",
        "var_ea",
        F.col("out_nm").alias("file_nm"),
    )


def inventory_status(expected: DataFrame, files: DataFrame) -> DataFrame:
    """A detail row per expected file: ok if it was found, failed if not."""
    found = files.select(F.col("file_nm").alias("out_nm")).distinct().withColumn("_found", F.lit(1))
    status = F.when(F.col("_found").isNotNull(), OK).otherwise(FAILED)
    return keyed_join(expected, found, ["out_nm"], "left").select(
        *DATASET, F.col("out_nm").alias("file_nm"), status.alias("wk_exec_sts_cd")
    )


def merge_inventory(
    inventory: DataFrame,
    rows: DataFrame,
    update_cols: tuple[str, ...] = MEASURES,
    exec_seq: bool = False,
) -> DataFrame:
    """Upsert inventory rows; of several deliveries of a page the latest by its date and name counts.

    `exec_seq` adds the run to the keys, as for de-identified files.
    """
    keys = (*INVENTORY_KEYS, "exec_seq") if exec_seq else INVENTORY_KEYS
    latest_by = [name for name in ("crt_ymd", "file_nm") if name in rows.columns]
    return upsert(inventory, rows, keys, update_cols, "latest" if latest_by else "fail", latest_by)
