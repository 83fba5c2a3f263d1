"""Summaries that are kept and follow redeliveries: only pages that changed are read.

A folder holds the frequency table of every page and that of every dataset over its pages. Each run writes
those that it made to a folder of its own, and then one small version of the state, which says for each page the
measures of its file and the runs that hold its table and its dataset's. A run that fails leaves the
version before it, so it is simply run again; untouched tables are neither read nor written.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from veilspark.columns import DATASET
from veilspark.operators.inventory import MEASURES
from veilspark.operators.joins import keyed_join
from veilspark.operators.rules import Rule
from veilspark.operators.summary import changed_pages, deidentified_table, frequency_table, moved_counts, roll_up, with_counts
from veilspark.plans.summarise import PAGE
from veilspark.sources.scratch import materialise
from veilspark.sources.tables import file_system
from veilspark.sources.versions import add_version, versions

KEYS = (*DATASET, *PAGE)


@dataclass(frozen=True)
class Kept:
    """The summaries of the latest version: by page, by dataset, and the state that names them."""

    state: DataFrame
    pages: DataFrame
    datasets: DataFrame

    def deidentified(self, rules: Sequence[Rule], on_invalid: str = "suppress") -> DataFrame:
        """The table by page under rules of today: rules act on cells, so no row is read again."""
        return deidentified_table(self.pages, rules, on_invalid)


def kept_summary(spark: SparkSession, path: str) -> Kept | None:
    """The summaries kept at `path`, or None before the first run."""
    path = path.rstrip("/")
    named = versions(spark, f"{path}/state")
    if not named:
        return None
    state = spark.read.parquet(f"{path}/state/{named[-1]}")
    return Kept(state, _of_runs(state, path, KEYS, "page"), _of_runs(state, path, DATASET, "dataset"))


def _of_runs(state: DataFrame, path: str, keys: Sequence[str], kind: str) -> DataFrame:
    """The tables of one kind, of each the one that the state names; runs it doesn't name aren't read."""
    stored = state.sparkSession.read.parquet(f"{path}/{kind}")
    named = state.select(*keys, F.col(f"{kind}_run").alias("run")).distinct()
    return keyed_join(stored, named, [*keys, "run"], "left_semi", sized_by=state).drop("run")


def follow(
    inventory: DataFrame,
    read: Callable[[DataFrame], DataFrame],
    names: Sequence[str],
    path: str,
    measures: Sequence[str] = MEASURES,
) -> DataFrame:
    """Bring the summaries kept at `path` to what `inventory` lists, and return the pages that changed, with `change`.

    `inventory` has a row for each page, with the `measures` of its file; a page whose measures are as before
    counts as unchanged. `read` gets the added and changed pages, the inventory's columns, and gives
    their rows, with columns for the keys of the page and `names`; rows of other pages it gives are left out. Pages
    that are no longer listed go. The counts of a dataset are those before, less those its changed
    pages had, and those they have now. Other `names` than before need another folder. Nulls in the keys of
    a page and a page listed twice raise.
    """
    spark, path, run = inventory.sparkSession, path.rstrip("/"), f"r{uuid.uuid4().hex}"
    listed = materialise(inventory.select(*KEYS, *measures), "inventory")
    _check(listed)
    before, after = kept_summary(spark, path), len(versions(spark, f"{path}/state"))
    was = listed.limit(0) if before is None else before.state
    changed = materialise(changed_pages(was, listed, KEYS, measures), "changed")
    if before is not None and changed.isEmpty():
        return changed

    to_read = changed.filter("change <> 'gone'").select(*KEYS)
    rows = read(keyed_join(listed, to_read, KEYS, "left_semi"))
    come = frequency_table(keyed_join(rows, to_read, KEYS, "left_semi"), [*KEYS, *names])
    come.write.parquet(f"{path}/page/run={run}")
    come = spark.read.parquet(f"{path}/page/run={run}")

    columns, touched = [*DATASET, *names], changed.select(*DATASET).distinct()
    if before is None:
        totals = roll_up(come, columns)
    else:
        gone = keyed_join(before.pages, changed.select(*KEYS), KEYS, "left_semi", sized_by=changed)
        held = keyed_join(before.datasets, touched, DATASET, "left_semi", sized_by=changed)
        totals = with_counts(held, moved_counts(gone, come, columns), columns)
    totals.write.parquet(f"{path}/dataset/run={run}")

    runs = [F.lit(run).alias("page_run"), F.lit(run).alias("dataset_run")]
    if before is None:
        state = listed.select("*", *runs)
    else:
        same = keyed_join(before.state, changed.select(*KEYS), KEYS, "left_anti")
        of = keyed_join(same, touched.withColumn("_touched", F.lit(True)), DATASET, "left")
        same = of.withColumn("dataset_run", F.when(F.col("_touched"), F.lit(run)).otherwise(F.col("dataset_run"))).drop("_touched")
        state = same.unionByName(keyed_join(listed, to_read, KEYS, "left_semi").select("*", *runs))
    add_version(state, f"{path}/state", after)
    return changed


def prune(spark: SparkSession, path: str) -> int:
    """Delete the tables of runs that the latest version names no more, and of failed ones; returns how many."""
    path, gone = path.rstrip("/"), 0
    kept, (store, make) = kept_summary(spark, path), file_system(spark, path)
    for kind in ("page", "dataset"):
        used = set() if kept is None else {row[0] for row in kept.state.select(f"{kind}_run").distinct().collect()}
        folder = make(f"{path}/{kind}")
        for status in store.listStatus(folder) if store.exists(folder) else ():
            if status.getPath().getName().removeprefix("run=") not in used:
                gone += bool(store.delete(status.getPath(), True))
    return gone


def _check(listed: DataFrame) -> None:
    counts = listed.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    empty = F.greatest(*[F.col(name).isNull() for name in KEYS])
    bad = counts.filter(empty | (F.col("n") > 1)).limit(1).collect()
    if bad:
        raise ValueError(f"a page is listed more than once or has a null in its keys: {bad[0].asDict()}")
