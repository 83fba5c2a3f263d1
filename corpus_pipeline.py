"""A corpus made ready for training, stage by stage.

1. language: documents without text or letters go; a missing lang is filled with the predicted
   one. If no document to learn from has a lang, nothing is predicted and a missing lang stays null.
2. near_duplicates: of each group of near copies the document with the smallest doc_id stays.
3. secrets: what the scan finds is replaced by its kind in brackets, and n_chars counted anew.
4. packing: the documents' tokens in sequences of at most 2048, a row for each piece.

Nulls, empty and repeated rows, and further columns are handled as the operators say; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from veilspark.llm.common import free_names, importable
from veilspark.llm.credentials import redact_documents
from veilspark.llm.language import UNKNOWN, learn, predict, with_letters
from veilspark.llm.packing import pack_documents
from veilspark.llm.simhash import keep_one
from veilspark.sources.scratch import scratch_job, scratch_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    profiles = learn(docs)
    if not profiles.names:
        return with_letters(docs)
    found, score = free_names(docs, "lang_pred", "score")
    if UNKNOWN in profiles.names:  # a label like any other
        known = predict(with_letters(docs), profiles, (found, score))
    else:
        known = predict(docs, profiles, (found, score)).where(F.col(found) != UNKNOWN)
    filled = F.coalesce("lang", found).alias("lang")
    return known.select(*[filled if name.lower() == "lang" else F.col(f"`{name}`") for name in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return keep_one(docs, shingle=3, radius=2)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return redact_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    # Workers that earlier stages have used keep fewer words.
    packed = pack_documents(docs, capacity=2048, end_id=1, kept_words=40_000)
    return packed.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("secrets", secrets), ("packing", packing)]

#: SQL can't express profiles, fingerprints of hashes or the tokenizer; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents; each result is written and read again.

    Only the last result stays; the others, which hold secrets, are deleted with all scratch of the stages.
    """
    result = scratch_path(spark, "pipeline")
    with scratch_job(spark, "stages"):
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        for name, stage in STAGES:
            path = result if name == STAGES[-1][0] else scratch_path(spark, name)
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
