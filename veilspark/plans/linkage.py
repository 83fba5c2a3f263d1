"""Provider side: hash persons, match the requested keys, attach them to the data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from veilspark.columns import STUDY
from veilspark.operators import linkage
from veilspark.sources.scratch import materialise, scratch_job
from veilspark.sources.tables import replace_partition


@dataclass(frozen=True)
class Hashed:
    """All hashed persons, the file for the centre, and what could not be hashed."""

    persons: DataFrame
    key_file: DataFrame
    unsalted: DataFrame
    unhashable: DataFrame


def hash_job(persons: DataFrame, salts: DataFrame, null_text: str | None = None) -> Hashed:
    """Hash the persons of all studies at once."""
    hashed = materialise(linkage.hash_persons(persons, salts, null_text), "hashed")
    return Hashed(
        hashed,
        linkage.key_file(hashed),
        linkage.unsalted(persons, salts),
        linkage.unhashable(hashed),
    )


def store_hashed(hashed: DataFrame, path: str, studies: DataFrame | None = None) -> None:
    """Replace the studies' rows in the table of hashed persons.

    `studies` has the keys of all studies of the run, such as its salts; one whose persons were
    all withdrawn is emptied.
    """
    scope = None if studies is None else studies.select(*STUDY)
    replace_partition(hashed, path, STUDY, scope)


def hash_and_store(persons: DataFrame, salts: DataFrame, path: str, null_text: str | None = None) -> None:
    """Hash the persons of all salted studies, replace the studies in the table, keep no other copy."""
    with scratch_job(persons.sparkSession, "hash-job"):
        hashed = hash_job(persons, salts, null_text)
        store_hashed(hashed.persons, path, salts)


@dataclass(frozen=True)
class Matched:
    """Requested persons of the studies that passed, and the verdict on every study."""

    persons: DataFrame
    verdicts: DataFrame


def match_job(hashed: DataFrame, requested: DataFrame) -> Matched:
    """Match requested keys. A bad transfer code or no match at all holds back a study."""
    counts = linkage.request_match_counts(hashed, requested)
    verdicts = materialise(linkage.request_verdicts(counts), "verdicts")
    matched = linkage.match_requested(hashed, requested, verdicts)
    return Matched(materialise(matched, "matched"), verdicts)


@dataclass(frozen=True)
class Attached:
    """Provider rows with key instead of identity, and the verdict on every file."""

    rows: DataFrame
    report: DataFrame


def attach_job(rows: DataFrame, matched: DataFrame, files: Sequence[str] = ("file_nm",)) -> Attached:
    """Attach keys to the rows of all files at once."""
    attached = materialise(linkage.attach_hash(rows, matched, carry=files), "attached")
    return Attached(attached, linkage.attach_report(rows, attached, files))
