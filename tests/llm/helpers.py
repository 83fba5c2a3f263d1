"""Rows with every odd case that an operator has to handle."""

from pyspark.sql import DataFrame, SparkSession

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that clash with names the operators use within.
CLASHING = (
    "hash range borrowed hashes words fingerprint root path bits level component_id lowest node left right spans ids"
    " start held_out lang_pred score gram place part file cell far norm rep month key host segments copies list"
    " _id _hash _missing id missing stays first row"
).split()

LONG = "Lorem ipsum dolor sit amet, consetetur. " * 20_000
ODD = [
    (1, None, "en", "a", None),
    (2, "", "en", "a", 0),
    (3, "   \n\t ", "en", "a", 6),
    (4, LONG, "en", "a", len(LONG)),
    (5, "same words in the same order, twice over", "en", None, 40),
    (6, "same words in the same order, twice over", None, "b", 40),
    (6, "same words in the same order, twice over", None, "b", 40),
    (None, "a row without an id, but with some words", "en", "b", 40),
    (None, None, None, None, None),
    (7, "é 😀 漢字 \x00 ▁ <|endoftext|> 's 12", "de", "b", 25),
    (-8, "x", "de", "b", 1),
    (9, "y" * 100_000, "de", "b", 100_000),
    (10, "1234 5678 !!! ...", "de", "b", 17),
]


def odd_docs(spark: SparkSession, clashing: bool = True) -> DataFrame:
    docs = spark.createDataFrame(ODD, DOCS)
    return docs.selectExpr("*", *(f"'z' as {name}" for name in CLASHING)) if clashing else docs


def no_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCS)


def documents(spark: SparkSession) -> DataFrame:
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def texts() -> list[tuple]:
    """(doc_id, text) of the odd rows, nulls as empty texts."""
    return [(row[0], row[1] or "") for row in ODD]
