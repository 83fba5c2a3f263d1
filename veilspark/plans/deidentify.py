"""Centre side: swap keys and apply the de-identification rules of a dataset."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from veilspark.columns import FAILED
from veilspark.operators.joins import keyed_join
from veilspark.operators.linkage import swap_key, swap_report
from veilspark.operators.rules import Rule, RuleError, apply_rules_with_states, checked_states, report_of_states
from veilspark.operators.tables import drop_and_order
from veilspark.sources.scratch import materialise


@dataclass(frozen=True)
class Deidentified:
    """The rows to publish, and the reports on keys (per file) and cells (per file and column)."""

    rows: DataFrame
    keys: DataFrame
    cells: DataFrame


def deidentify(
    rows: DataFrame,
    alternates: DataFrame,
    rules: Sequence[Rule],
    how: str = "left",
    on_invalid: str = "suppress",
    missing_column: str = "error",
    shift: str | None = None,
    files: Sequence[str] = ("file_nm",),
) -> Deidentified:
    """De-identify all files of a dataset in one plan.

    A file without any matching key is left out and reported as failed; the others go
    on. `shift` names the column of the alternate table with the date shift, which
    rules may read and which is not published. Rows are read, and rules evaluated, once: the changed rows
    are written with what became of each ruled cell, and the reports and the result read that copy. So no
    rule may change the alternate key or a column of `files`; one that would raises.
    """
    if not rules:
        raise RuleError("no rules: this would publish the data as it is")
    held = {"alter_id", *map(str.lower, files)}
    if ruled := sorted({rule.column for rule in rules if rule.column.lower() in held}):
        raise RuleError(f"the report goes by {', '.join(ruled)}, which no rule can change")
    extra = [shift] if shift else []
    swapped = swap_key(rows, alternates, how, extra)
    changed, columns = apply_rules_with_states(swapped, rules, on_invalid, missing_column, extra)
    stored = materialise(changed, "deidentified")
    keys = materialise(swap_report(stored, files), "key_report")
    usable = keys.filter(F.col("status") != FAILED).select(*files)
    good = keyed_join(stored, usable, files, "left_semi")
    cells = report_of_states(good, columns, files)
    return Deidentified(drop_and_order(checked_states(good, columns, on_invalid), extra), keys, cells)
