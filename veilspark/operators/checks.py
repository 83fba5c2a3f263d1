"""Verdicts on delivered files: names, columns and completeness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from veilspark.columns import DATA_META, DATASET, FAILED, OK
from veilspark.functions.names import interface_number, parse_file_name
from veilspark.operators.joins import keyed_join


def check_file_names(register: DataFrame) -> DataFrame:
    """Each part of a registered file name against the register row, and the verdict.

    Pages are compared as numbers.
    """
    parsed = register.withColumn("_parts", parse_file_name(F.col("file_nm")))
    part = F.col("_parts")
    tests = {
        "interface_ok": part["interface"] == interface_number(F.col("prvdr_cd"), "data"),
        "ask_ok": part["ask_id"] == F.col("ask_id"),
        "rshp_ok": part["rshp_id"] == F.col("rshp_id"),
        "cat_ok": part["cat_cd"] == F.col("cat_cd"),
        "page_ok": part["page"] <= part["total"],
    }
    checked = parsed.select(
        *register.columns,
        *[F.coalesce(test, F.lit(False)).alias(name) for name, test in tests.items()],
    )
    valid = F.lit(True)
    for name in tests:
        valid = valid & F.col(name)
    return checked.withColumn("valid", valid)


def check_columns(
    file_columns: DataFrame,
    catalog_columns: DataFrame,
    meta: Sequence[str] = DATA_META,
    by_position: bool = False,
) -> DataFrame:
    """Columns of each file against the variables requested for its dataset.

    `file_columns` has the dataset keys, `file_nm`, `pos` (from 1) and `var_cd`;
    `catalog_columns` the dataset keys and `var_cd`. A file passes when it has as many
    columns as meta columns and variables together and lacks none of them. With
    `by_position` the first columns of a file are taken as the meta columns whatever
    they are called. A list holds the columns of one file, so it is bounded; the
    catalog is joined once per file, not once per column.
    """
    meta_names = F.array(*[F.lit(name.upper()) for name in meta])
    listed = file_columns.groupBy(*DATASET, "file_nm").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("pos", F.upper("var_cd").alias("name")))),
            lambda item: item["name"],
        ).alias("_given")
    )
    given = F.col("_given")
    if by_position:
        rest = F.slice(given, F.lit(len(meta) + 1), F.greatest(F.size(given), F.lit(1)))
        given = F.concat(meta_names, rest)
    wanted = catalog_columns.groupBy(*DATASET).agg(F.collect_list(F.upper("var_cd")).alias("_vars"))
    joined = keyed_join(listed, wanted, DATASET, "left").select(
        *DATASET,
        "file_nm",
        F.col("_vars").isNotNull().alias("in_catalog"),
        given.alias("_given"),
        F.concat(F.coalesce("_vars", F.array().cast("array<string>")), meta_names).alias("_wanted"),
    )
    given, wanted = F.col("_given"), F.col("_wanted")
    missing = F.array_except(wanted, given)
    passed = (
        F.col("in_catalog") & (F.size(given) == F.size(wanted)) & (F.size(missing) == 0)
    )
    return joined.select(
        *DATASET,
        "file_nm",
        "in_catalog",
        F.size(given).alias("n_file"),
        F.size(wanted).alias("n_catalog"),
        F.array_join(F.array_sort(missing), ",").alias("missing"),
        F.array_join(F.array_sort(F.array_except(given, wanted)), ",").alias("extra"),
        (F.size(given) - F.size(F.array_distinct(given))).alias("n_duplicate"),
        passed.alias("passed"),
    )


def not_produced(expected: DataFrame, produced: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected rows, such as output files, that were not produced."""
    return keyed_join(expected, produced.select(*keys).distinct(), keys, "left_anti")


def completeness(
    expected: DataFrame,
    produced: DataFrame,
    keys: Sequence[str],
    by: Sequence[str],
) -> DataFrame:
    """Expected and produced counts per `by` (a subset of the keys) and the verdict."""
    found = produced.select(*keys).distinct().withColumn("_found", F.lit(1))
    return (
        expected.select(*keys)
        .distinct()
        .join(found, list(keys), "left")
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("n_expected"), F.count("_found").alias("n_produced"))
        .withColumn(
            "status", F.when(F.col("n_expected") == F.col("n_produced"), OK).otherwise(FAILED)
        )
    )
