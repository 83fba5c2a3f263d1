"""Registered queries against their SQL, and the pipeline against plain versions of its stages."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.compare import connect, difference
from tests.llm.helpers import CLASHING, ODD, SF_DIR, documents, no_docs, odd_docs
from tests.llm.test_groups import fingerprint, plain_roots
from veilspark.llm.credentials import find_secrets, redact
from veilspark.llm.language import letters
from veilspark.llm.queries import QUERIES, SQL


def test_all_queries_are_registered():
    names = entry.queries().keys()
    assert {*QUERIES, "pipeline"} <= names and SQL.keys() <= entry.oracle_sql().keys()
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), SQL[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_url_filter_runs_no_python(spark):
    plan = QUERIES["op7_url_lists"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def stages(spark, docs):
    found = []
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF_DIR).collect(), stage(spark, docs, SF_DIR).schema)
        found.append(docs)
    return found


def test_stages_against_plain_versions(spark):
    columns = documents(spark).columns
    first, second, third, last = stages(spark, documents(spark))
    assert first.columns == second.columns == third.columns == columns
    rows = documents(spark).collect()
    assert sorted(first.collect()) == sorted(row for row in rows if letters(row.text) is not None)
    kept = sorted(first.collect(), key=lambda row: row.doc_id)
    label = plain_roots(np.array([fingerprint(row.text) for row in kept], np.uint64), 2)
    ids = sorted(kept[root].doc_id for root in set(label.tolist()))
    assert sorted(row.doc_id for row in second.collect()) == ids
    cleaned = {row.doc_id: redact(row.text, find_secrets(row.text)) for row in second.collect()}
    assert {row.doc_id: row.text for row in third.collect()} == cleaned
    assert all(row.n_chars == len(row.text) for row in third.collect())
    assert {row.doc_id for row in last.collect()} == set(ids)


def test_stages_on_odd_and_no_rows(spark):
    for frame in stages(spark, odd_docs(spark))[:3]:
        assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars", *CLASHING]
    assert [frame.count() for frame in stages(spark, no_docs(spark))] == [0, 0, 0, 0]


def test_stages_keep_columns_and_their_kinds(spark):
    """Whatever they are called, and also maps."""
    more = {"score": "0.5", "Lang_Pred": "'zz'", "_id": "'i'", "hash": "array(1)", "missing": "map('a', doc_id)", "_Score": "date'2020-01-01'"}
    docs = documents(spark).selectExpr("*", *(f"{value} as {name}" for name, value in more.items()))
    docs = docs.unionAll(docs.limit(30))
    for frame in stages(spark, docs)[:3]:
        assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in docs.schema]
        rows = frame.collect()
        assert {(str(r.score), r.Lang_Pred, r._id, tuple(r.hash), str(r._Score)) for r in rows} == {("0.5", "zz", "i", (1,), "2020-01-01")}
        assert all(r.missing == {"a": r.doc_id} for r in rows)
    assert len(rows) == len({r.doc_id for r in rows})


def test_run_leaves_only_its_result(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(folder.iterdir())
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
    assert [path.name.split("-")[0] for path in set(folder.iterdir()) - before] == ["pipeline"]


def test_language_stage_where_nothing_is_learned(spark):
    unlabelled = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.language(spark, unlabelled, SF_DIR)
    assert kept.columns == unlabelled.columns
    assert kept.count() > 0
    assert sorted(row.doc_id for row in kept.collect()) == sorted(row.doc_id for row in unlabelled.collect() if letters(row.text) is not None)
    assert {row.lang for row in kept.collect()} == {None}
    held = odd_docs(spark).withColumn("doc_id", F.lit(None).cast("long"))  # all rows are held out
    found = corpus_pipeline.language(spark, held, SF_DIR).collect()
    assert sorted((row.text, row.lang or "") for row in found) == sorted((row[1], row[2] or "") for row in ODD if letters(row[1]) is not None)


def test_language_stage_keeps_texts_labelled_unknown(spark):
    named = documents(spark).limit(40).withColumn("lang", F.lit("und"))
    assert corpus_pipeline.language(spark, named, SF_DIR).count() == sum(letters(row.text) is not None for row in named.collect())


def test_run_of_the_pipeline(spark):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert rows.count() > 0 and rows.agg({"length": "max"}).first()[0] <= 2048


def test_rows_are_not_moved_to_drop_a_few(spark):
    plan = corpus_pipeline.near_duplicates(spark, documents(spark), SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
