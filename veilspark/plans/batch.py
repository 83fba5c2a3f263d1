"""Summary batches: from the catalog tables to stored summaries and status rows.

What to summarise, with which types, numbers and rules, comes from the tables: the batches and
their override rule sets, the datasets chosen for their runs, the summary variables of the
catalog. Only variables and rules are collected, a few hundred for a dataset.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from veilspark.columns import DATASET, FAILED, OK, STUDY, WARNING
from veilspark.functions.names import output_name
from veilspark.functions.parsing import quoted
from veilspark.operators.catalog import resolve_summary_rules, split_metadata, summary_metadata
from veilspark.operators.rules import Rule, apply_rules
from veilspark.operators.status import rollup_status
from veilspark.operators.summary import Variable, frequency_table, ordinal, roll_up, to_eav_by
from veilspark.plans.summarise import PAGE
from veilspark.sources.scratch import materialise, scratch_job
from veilspark.sources.sinks import write_delimited
from veilspark.sources.tables import replace_partition

NUMBER_TYPE = "숫자"  # the catalog's word for numbers (fixed value)
RUN = ("ask_year", *DATASET, "exec_seq")
EAV = (
    "datum_seq long, prsnt_pg_num int, tot_pg_num int, file_nm string, var_dscr_seq int, str_datatp_val string,"
    " num_datatp_val double, ask_year string, ask_id string, rshp_id string, prvdr_cd string, cat_cd string, exec_seq int"
)
STAGES = ("summary", "deid_summary")
DUE = f"bt_seq int, exec_seq int, {', '.join(f'{name} string' for name in DATASET)}, kind int"


@dataclass(frozen=True)
class SummaryBatch:
    """A detail row for each registered file, the run-log rows of those made, and the roll-up."""

    detail: DataFrame
    log: DataFrame
    status: DataFrame


def rules_of_batch(pending: DataFrame, rules: DataFrame, override: str = "rulesetseq2") -> DataFrame:
    """The rules of each pending batch: of its override rule set if it names one, else of its run."""
    due = pending.select("bt_seq", *STUDY, "exec_seq", override).withColumnRenamed("exec_seq", "_run")
    found = due.join(rules, list(STUDY))
    return found.filter(F.col("exec_seq") == F.coalesce(override, "_run")).drop("_run", override)


def dataset_plans(
    catalog: DataFrame, standard: DataFrame, run_rules: DataFrame
) -> dict[tuple, tuple[tuple[Variable, ...], int, tuple[Rule, ...]]]:
    """By dataset: its summary variables, the number of the count, and its rules."""
    variables, counts, rules = defaultdict(list), {}, defaultdict(list)
    metadata = split_metadata(summary_metadata(catalog, standard, run_rules))
    for row in metadata.orderBy(*DATASET, "pos").collect():
        key = tuple(row[name] for name in DATASET)
        variables[key].append(Variable(int(row["var_dscr_seq"]), row["var_cd"].lower(), row["datatp"] == NUMBER_TYPE))
        counts[key] = int(row["cnt"])
    for row in resolve_summary_rules(run_rules, catalog).distinct().orderBy(*DATASET, "var_cd").collect():
        rules[tuple(row[name] for name in DATASET)].append(Rule.parse(row["var_cd"].lower(), row["di_set_val"]))
    return {key: (tuple(variables[key]), counts[key], tuple(rules[key])) for key in variables}


def summary_job(
    batches: DataFrame,
    chosen: DataFrame,
    catalog: DataFrame,
    standard: DataFrame,
    rules: DataFrame,
    register: DataFrame,
    rows: DataFrame,
    store: str,
    task: str,
    centre: Column | None = None,
    on_invalid: str = "suppress",
) -> SummaryBatch:
    """Summaries of all datasets of some batches, original and de-identified, stored under `store`.

    `batches` are rows of `pending_batches` with `rulesetseq2`. `chosen` names the datasets of each
    run, `register` the files they should have, and `rows` are their data rows, with `file_nm`.
    The long tables go to `store/original_eav` and `store/deidentified_eav`, where the runs'
    partitions are replaced, and the wide ones to files named for their stage under
    `store/summary` and `store/deid_summary`. A registered file without rows fails; a dataset
    without summary variables is a warning for each of its files. All scratch is deleted.

    The rows of all datasets are read and counted together, and rules and variables go by the
    kind of a dataset: those that have the same are of one kind. So the number of jobs depends on
    the kinds of wide files and not on the number of datasets. Batches of the same study run in turn.
    """
    spark = rows.sparkSession
    details: DataFrame | None = None
    # Status rows only need the files, of which there are few; they outlive the job's scratch.
    made = materialise(rows.select(*DATASET, "file_nm").distinct(), "files")
    expected = materialise(register.select(*DATASET, "file_nm").distinct(), "expected")
    with scratch_job(spark, "summary-job"):
        for turn in _turns(batches.select("bt_seq", *STUDY, "exec_seq", F.col("rulesetseq2").cast("int")).collect()):
            runs = spark.createDataFrame(turn, "bt_seq int, ask_id string, rshp_id string, exec_seq int, rulesetseq2 int")
            known = catalog.join(F.broadcast(runs.select(*STUDY)), list(STUDY), "left_semi")
            plans = dataset_plans(known, standard, rules_of_batch(runs, rules).drop("bt_seq"))
            named = chosen.withColumn("exec_seq", F.col("exec_seq").cast("int")).join(F.broadcast(runs), [*STUDY, "exec_seq"])
            found = named.select("bt_seq", "exec_seq", *DATASET).distinct().collect()
            kinds = list(dict.fromkeys(plans[key] for row in found if (key := tuple(row[name] for name in DATASET)) in plans))
            placed = [(*row, kinds.index(plans[row[2:]]) if row[2:] in plans else None) for row in map(tuple, found)]
            due = spark.createDataFrame(placed, DUE)
            if kinds:
                _summaries(rows, due, kinds, store, centre, on_invalid)
            detail = _detail(expected, made, due)
            details = detail if details is None else details.unionByName(detail)
    if details is None:
        details = _detail(expected, made, spark.createDataFrame([], DUE))
    return SummaryBatch(details.drop("exec_seq"), run_log(details, task), rollup_status(details))


def _turns(batches: list) -> list[list]:
    """The batches so that each turn has one of a study at most, in order of their numbers."""
    turns: list[list] = []
    before: dict[tuple, int] = defaultdict(int)
    for row in sorted(batches, key=lambda row: row["bt_seq"]):
        study = tuple(row[name] for name in STUDY)
        if before[study] == len(turns):
            turns.append([])
        turns[before[study]].append(tuple(row))
        before[study] += 1
    return turns


def _summaries(rows: DataFrame, due: DataFrame, kinds: list[tuple], store: str, centre: Column | None, on_invalid: str) -> None:
    """Frequency tables of all datasets at once, their long forms and their files."""
    year = F.substring("ask_id", 1, 4).alias("ask_year")
    meta = [*DATASET, *PAGE, "file_nm"]
    run = ["ask_year", "exec_seq", *meta, "kind"]
    of = [[v.column for v in variables] for variables, _, _ in kinds]
    names = list(dict.fromkeys(name for own in of for name in own))
    # A cell that is no variable of its dataset does not tell its rows apart.
    cells = [F.when(F.col("kind").isin([i for i, own in enumerate(of) if name in own]), F.col(quoted(name))).alias(name) for name in names]
    wanted = due.where("kind is not null").select(*DATASET, "exec_seq", "kind")
    matched = rows.join(F.broadcast(wanted), list(DATASET))  # a row for each dataset, which the driver holds as well
    original = materialise(frequency_table(matched.select(year, "exec_seq", *meta, "kind", *cells), [*run, *names]), "summary")
    changed = None
    for i, (own, (_, _, rules)) in enumerate(zip(of, kinds)):
        part = apply_rules(original.where(F.col("kind") == i).select(*run, *map(quoted, own), "cnt"), rules, on_invalid, "skip")
        changed = part if changed is None else changed.unionByName(part, allowMissingColumns=True)
    deidentified = materialise(roll_up(changed, [*run, *names]), "deid-summary")
    scope = wanted.select(year, *DATASET, "exec_seq")
    counted = [(variables, cnt_seq) for variables, cnt_seq, _ in kinds]
    for stage, long, table in zip(STAGES, ("original_eav", "deidentified_eav"), (original, deidentified)):
        numbered = ordinal(table, names, within=["kind", *run[:-1]])
        eav = to_eav_by(numbered, "kind", counted, [*run[:-1], "datum_seq"])
        replace_partition(eav, f"{store}/{long}", RUN, scope)
        owner = F.col("prvdr_cd") if centre is None or stage == "summary" else centre
        wide = table.withColumn("file_nm", output_name(F.col("file_nm"), stage, owner, F.col("cat_cd"), F.col("exec_seq")))
        for i, own in enumerate(of):
            files = wide.where(F.col("kind") == i).select(*meta, *map(quoted, own), "cnt")
            write_delimited(files, f"{store}/{stage}", "file_nm", mode="replace")


def _detail(register: DataFrame, made: DataFrame, due: DataFrame) -> DataFrame:
    """A row for each registered file of the datasets, with exec_seq; `made` has the files with rows."""
    found = made.withColumn("_found", F.lit(1))
    expected = register.join(F.broadcast(due), list(DATASET))
    status = F.when(F.isnull("_found"), FAILED).when(F.isnull("kind"), WARNING).otherwise(OK)
    told = F.when(F.isnull("_found"), "no rows").when(F.isnull("kind"), "no summary variables")
    return expected.join(found, [*DATASET, "file_nm"], "left").select(
        "bt_seq", *DATASET, "file_nm", status.alias("wk_exec_sts_cd"), told.alias("message"), "exec_seq"
    )


def run_log(detail: DataFrame, task: str) -> DataFrame:
    """Run-log rows of the files that were made, as `logged_outputs` reads them; `detail` has `exec_seq`."""
    made = detail.filter(F.col("wk_exec_sts_cd") == OK)
    return made.select(
        *STUDY,
        "exec_seq",
        "prvdr_cd",
        "cat_cd",
        F.lit(task).alias("di_wk_div_cnts"),
        F.col("file_nm").alias("wk_exec_cnts"),
    )


def deid_detail(bt_seq: Column, keys: DataFrame, cells: DataFrame, by: Sequence[str] = ("file_nm",)) -> DataFrame:
    """Detail rows of a de-identification: the worse of its key report and its cell report, per file.

    `keys` and `cells` are those of `deidentify`; a file that failed has no cell report.
    """
    worst = cells.groupBy(*by).agg(F.max("status").alias("_cells"))
    status = F.greatest("status", F.coalesce("_cells", "status"))
    return keys.join(worst, list(by), "left").select(bt_seq.alias("bt_seq"), *by, status.alias("wk_exec_sts_cd"))


