"""Centre side: frequency tables before and after de-identification, wide and long."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from veilspark.columns import DATASET
from veilspark.operators.rules import Rule
from veilspark.operators.summary import (
    Variable,
    deidentified_table,
    frequency_table,
    ordinal,
    to_eav,
)
from veilspark.sources.scratch import materialise

PAGE = ("prsnt_pg_num", "tot_pg_num")


@dataclass(frozen=True)
class Summary:
    """Frequency tables of the original and the de-identified data; long forms on demand."""

    original: DataFrame
    deidentified: DataFrame
    variables: Sequence[Variable]
    cnt_seq: int
    meta: Sequence[str]

    def _long(self, table: DataFrame) -> DataFrame:
        numbered = ordinal(table, [v.column for v in self.variables], within=self.meta)
        return to_eav(numbered, self.variables, [*self.meta, "datum_seq"], self.cnt_seq)

    def original_eav(self) -> DataFrame:
        return self._long(self.original)

    def deidentified_eav(self) -> DataFrame:
        return self._long(materialise(self.deidentified, "deid-summary"))


def summarise(
    rows: DataFrame,
    rules: Sequence[Rule],
    variables: Sequence[Variable],
    cnt_seq: int,
    meta: Sequence[str] = (*DATASET, *PAGE),
    on_invalid: str = "suppress",
) -> Summary:
    """Summaries per file page. Rows are read once: the second table comes from the first."""
    names = [v.column for v in variables]
    original = materialise(frequency_table(rows, [*meta, *names]), "summary")
    deidentified = deidentified_table(original, rules, on_invalid)
    return Summary(original, deidentified, variables, cnt_seq, meta)
