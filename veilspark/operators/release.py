"""All-or-nothing release of the files of a study."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from veilspark.columns import OK, STUDY
from veilspark.operators.checks import completeness, not_produced
from veilspark.operators.joins import keyed_join

FILE = (*STUDY, "out_nm")


def release_verdicts(expected: DataFrame, produced: DataFrame) -> DataFrame:
    """Per study the expected and found files; one missing file fails the study.

    Both sides have the study keys and `out_nm`.
    """
    return completeness(expected, produced, FILE, STUDY)


def missing_outputs(expected: DataFrame, produced: DataFrame) -> DataFrame:
    """The files that keep a study from being released."""
    return not_produced(expected.select(*FILE), produced, FILE)


def releasable(rows: DataFrame, verdicts: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Rows of the studies that are complete; with `expected`, only of the files it registers."""
    passed = verdicts.filter(F.col("status") == OK).select(*STUDY)
    ready = keyed_join(rows, passed, STUDY, "left_semi")
    return ready if expected is None else keyed_join(ready, expected.select(*FILE).distinct(), FILE, "left_semi")
