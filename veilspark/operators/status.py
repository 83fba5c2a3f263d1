"""Batches, executions and their detail rows: selection, counts and roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from veilspark.columns import FAILED, OK, STUDY, WARNING
from veilspark.operators.catalog import ordered_list
from veilspark.operators.joins import keyed_join


def count_by_status(detail: DataFrame, by: Sequence[str] = ("bt_seq", "bt_exec_seq")) -> DataFrame:
    """Detail rows per execution and status."""
    return detail.groupBy(*by, "wk_exec_sts_cd").agg(F.count(F.lit(1)).alias("cnt"))


def rollup_status(detail: DataFrame, by: Sequence[str] = ("bt_seq",)) -> DataFrame:
    """Failed if any detail row failed, else a warning if any warned, else ok."""
    code = F.col("wk_exec_sts_cd")
    status = (
        F.when(F.col("n_failed") > 0, FAILED).when(F.col("n_warned") > 0, WARNING).otherwise(OK)
    )
    return (
        detail.groupBy(*by)
        .agg(
            F.count_if(code == FAILED).alias("n_failed"),
            F.count_if(code == WARNING).alias("n_warned"),
        )
        .withColumn("status", status)
    )


def failed_files(register: DataFrame, by: Sequence[str]) -> DataFrame:
    """Files marked as failed, per parent."""
    return register.groupBy(*by).agg(F.count_if(F.col("prcs_fail_yn") == "Y").alias("cnt"))


def latest_execution(executions: DataFrame, by: Sequence[str] = ("bt_seq",)) -> DataFrame:
    """Highest execution number per batch."""
    return executions.groupBy(*by).agg(F.max("bt_exec_seq").alias("bt_exec_seq"))


def latest_row(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row that is last in an explicit order, per group, without sorting any group."""
    rest = [name for name in df.columns if name not in by]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*by).agg(last.alias("_row")).select(*by, "_row.*")


def next_sequence(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """The number after the highest one, per group."""
    return df.groupBy(*by).agg((F.max(column) + 1).alias(column))


def pending_batches(
    requests: DataFrame,
    batches: DataFrame,
    executions: DataFrame,
    program: str,
    task: str,
    strict: bool = False,
    request_columns: Sequence[str] = (),
    batch_columns: Sequence[str] = (),
) -> DataFrame:
    """Registered batches of a task that have not succeeded.

    By default a batch counts as pending through each execution of the program that
    is not ok, and through having none, so one with a failed and a good run is
    listed. `strict` lists each batch once, and only without any good run. Further columns
    may be taken along: of the request the override rule set, of the batch its paths.
    """
    known = requests.select(
        F.col("requestid").alias("ask_id"), F.col("hypoid").alias("rshp_id"), "cnorgcode", *request_columns
    )
    due = batches.filter(F.col("wk_dtl_tp_cd") == task).select("bt_seq", *STUDY, "exec_seq", *batch_columns)
    due = keyed_join(due, known, STUDY)
    due = due.select("bt_seq", *STUDY, "exec_seq", "cnorgcode", *request_columns, *batch_columns)
    runs = executions.filter(F.col("crt_pgm_id") == program).select("bt_seq", "wk_sts_cd")
    good = F.coalesce("wk_sts_cd", F.lit(FAILED)).isin(OK)
    if strict:
        return due.join(runs.filter(good).select("bt_seq").distinct(), "bt_seq", "left_anti")
    unfinished = keyed_join(runs.filter(~good).drop("wk_sts_cd"), due, ["bt_seq"])
    untried = due.join(runs.select("bt_seq").distinct(), "bt_seq", "left_anti")
    return untried.unionByName(unfinished)


def batch_datasets(
    requests: DataFrame, batches: DataFrame, chosen: DataFrame, task: str
) -> DataFrame:
    """Datasets chosen for the run of each requested batch of a task."""
    known = requests.select(F.col("requestid").alias("ask_id"), F.col("hypoid").alias("rshp_id"))
    due = batches.filter(F.col("wk_dtl_tp_cd") == task).select("bt_seq", *STUDY, "exec_seq")
    run = [*STUDY, "exec_seq"]
    found = keyed_join(keyed_join(due, known, STUDY), chosen.select(*run, "prvdr_cd", "cat_cd"), run)
    return found.select("bt_seq", "exec_seq", "prvdr_cd", "cat_cd")


def logged_outputs(log: DataFrame, batches: DataFrame, detail: DataFrame, task: str) -> DataFrame:
    """Outputs in the run log that a batch detail row of the same run confirms."""
    shown = [*STUDY, "exec_seq", "prvdr_cd", "cat_cd", "wk_exec_cnts", "di_wk_div_cnts"]
    due = batches.filter(F.col("wk_dtl_tp_cd") == task).select("bt_seq", *STUDY, "exec_seq")
    confirmed = detail.filter(F.col("wk_exec_sts_cd").isin(OK, WARNING))
    confirmed = confirmed.select("bt_seq", "wk_exec_cnts").distinct()
    done = keyed_join(confirmed, due, ["bt_seq"]).drop("bt_seq").distinct()
    logged = log.filter(F.col("di_wk_div_cnts") == task).select(*shown).distinct()
    return logged.join(done, [*STUDY, "exec_seq", "wk_exec_cnts"], "left_semi").select(*shown)


def dataset_listing(chosen: DataFrame, by: Sequence[str] = (*STUDY, "exec_seq")) -> DataFrame:
    """Per run a message `provider => datasets,provider => datasets`."""
    datasets = chosen.groupBy(*by, "prvdr_cd").agg(ordered_list("cat_cd", "cat_cd").alias("cat_cd"))
    lines = datasets.withColumn("line", F.concat("prvdr_cd", F.lit(" => "), "cat_cd"))
    return lines.groupBy(*by).agg(ordered_list("line", "prvdr_cd").alias("message"))

