"""Variable catalogs: lookups, rule resolution, summary variables and their metadata.

A group here is the variables of one dataset, that is the columns of one file, so
the ordered lists and ranks below work on groups of bounded size. All studies are
processed in one plan; a filter on the study keys gives the single-study form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from veilspark.columns import DATASET
from veilspark.functions.names import data_interface
from veilspark.operators.joins import keyed_join
from veilspark.operators.tables import upsert
from veilspark.sources.scratch import materialise

ORIGINAL = "1"
SUMMARY = "2"
CATALOG_KEYS = (*DATASET, "var_dscr_seq", "org_mrg_tp_cd")


def ordered_list(value: str, order: str) -> Column:
    """Comma-joined values of a column in the order of another; nulls are left out."""
    return F.expr(
        f"listagg(cast({value} as string), ',') WITHIN GROUP (ORDER BY {order}, {value})"
    )


def catalog_variables(catalog: DataFrame, standard: DataFrame) -> DataFrame:
    """Per dataset the variable codes and sequence numbers as lists in sequence order.

    The code of the standard variable wins over that of the request.
    """
    codes = standard.select("var_seq", F.col("var_cd").alias("_standard"))
    return (
        keyed_join(catalog, codes, ["var_seq"], "left")
        .withColumn("var_cd", F.coalesce("_standard", "var_cd"))
        .groupBy(*DATASET)
        .agg(
            ordered_list("var_cd", "var_dscr_seq").alias("var_cd"),
            ordered_list("var_dscr_seq", "var_dscr_seq").alias("var_dscr_seq"),
        )
    )


def dataset_columns(catalog: DataFrame, standard: DataFrame) -> DataFrame:
    """Original variables of each dataset with the code its own provider and dataset use."""
    keys = ["prvdr_cd", "cat_cd", "var_seq"]
    original = catalog.filter(F.col("org_mrg_tp_cd") == ORIGINAL).drop("var_cd")
    coded = keyed_join(original, standard.select(*keys, "var_cd"), keys, "left")
    return coded.select(*DATASET, "var_dscr_seq", "var_cd")


def rule_set(rules: DataFrame, exec_seq: Column, ruleset_seq: Column) -> DataFrame:
    """Rules of the override set where one is given, else those of the run itself."""
    return rules.filter(F.col("exec_seq") == F.coalesce(ruleset_seq, exec_seq))


def resolve_rules(rules: DataFrame, catalog: DataFrame, standard: DataFrame) -> DataFrame:
    """Rules with the code of their variable, the standard code first."""
    wanted = catalog.select(*CATALOG_KEYS, "var_seq", "var_cd")
    codes = standard.select("var_seq", F.col("var_cd").alias("_standard"))
    found = keyed_join(rules.filter(F.col("di_set_val").isNotNull()), wanted, CATALOG_KEYS)
    code = F.coalesce("_standard", "var_cd").alias("var_cd")
    coded = keyed_join(found, codes, ["var_seq"], "left")
    return coded.select(*DATASET, "exec_seq", code, "di_set_val")


def resolve_original_rules(rules: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rules with the requested code of their original variable."""
    keys = [*DATASET, "var_dscr_seq"]
    wanted = catalog.filter(F.col("org_mrg_tp_cd") == ORIGINAL).select(*keys, "var_cd")
    found = keyed_join(rules.filter(F.col("di_set_val").isNotNull()), wanted, keys)
    return found.select(*DATASET, "exec_seq", "var_cd", "di_set_val")


def resolve_summary_rules(rules: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rules of original variables under the code of the summary variable made from them."""
    original = catalog.filter(F.col("org_mrg_tp_cd") == ORIGINAL)
    summary = catalog.filter(F.col("org_mrg_tp_cd") == SUMMARY)
    pairs = original.select(*DATASET, "var_seq", "var_dscr_seq").join(
        summary.select(*DATASET, "var_seq", "var_cd"), [*DATASET, "var_seq"]
    )
    given = rules.filter(F.col("di_set_val").isNotNull())
    found = keyed_join(given, pairs, [*DATASET, "var_dscr_seq"])
    return found.select(*DATASET, "exec_seq", "var_cd", "di_set_val")


def summary_variables(
    catalog: DataFrame, standard: DataFrame, known: DataFrame, rules: DataFrame
) -> DataFrame:
    """Summary variables per dataset: those that carry a rule of any run, ranked, plus `CNT`.

    Ranks are gapped as RANK gives them, and `CNT` takes the number after the highest.
    """
    ruled = rules.filter(F.col("di_set_val").isNotNull()).select(*DATASET, "var_dscr_seq")
    original = catalog.filter(F.col("org_mrg_tp_cd") == ORIGINAL)
    original = original.join(ruled.distinct(), [*DATASET, "var_dscr_seq"], "left_semi")
    original = keyed_join(original, known.select("var_seq"), ["var_seq"], "left_semi")
    original = original.select(*DATASET, "var_seq", "var_dscr_seq", "var_dscr_nm", "req_var_tp_cd")
    coded = keyed_join(original, standard.select("var_seq", "var_cd"), ["var_seq"])
    variables = coded.distinct()
    rank = F.rank().over(Window.partitionBy(*DATASET).orderBy("var_seq")).cast("bigint")
    ranked = variables.select(
        *DATASET, "var_seq", "req_var_tp_cd", rank.alias("var_dscr_seq"), "var_cd"
    )
    return with_count_variable(ranked).select(
        *DATASET,
        F.lit(SUMMARY).alias("org_mrg_tp_cd"),
        "var_seq",
        "req_var_tp_cd",
        "var_dscr_seq",
        data_interface(F.col("prvdr_cd"), "500").alias("file_nm"),
        F.concat(F.lit("G"), F.col("var_dscr_seq").cast("string")).alias("var_dscr_nm"),
        "var_cd",
    )


def with_count_variable(ranked: DataFrame) -> DataFrame:
    """The ranked variables plus one `CNT` variable per dataset, numbered after the last."""
    counts = ranked.groupBy(*DATASET).agg((F.max("var_dscr_seq") + 1).alias("var_dscr_seq"))
    return ranked.unionByName(
        counts.select(
            *DATASET,
            F.lit(None).cast("bigint").alias("var_seq"),
            F.lit("2").alias("req_var_tp_cd"),
            "var_dscr_seq",
            F.lit("CNT").alias("var_cd"),
        )
    )


def build_summary_catalog(
    catalog: DataFrame, standard: DataFrame, known: DataFrame, rules: DataFrame
) -> DataFrame:
    """The catalog with its summary variables added or refreshed.

    Variables that tie in rank share a number; they cannot be told apart by the
    catalog keys, so the first code stands for them.
    """
    made = summary_variables(catalog, standard, known, rules)
    columns = ("req_var_tp_cd", "var_dscr_nm", "var_cd", "var_seq")
    first = F.min(F.struct("var_cd", "var_seq", "req_var_tp_cd", "var_dscr_nm"))
    single = made.groupBy(*CATALOG_KEYS).agg(first.alias("_first")).select(*CATALOG_KEYS, "_first.*")
    return upsert(catalog, materialise(single, "summary-variables"), CATALOG_KEYS, columns)


def summary_metadata(catalog: DataFrame, standard: DataFrame, rules: DataFrame) -> DataFrame:
    """Per dataset the types, codes and numbers of its summary variables, and the `CNT` number.

    `rules` are those of one run (see `rule_set`). Types and numbers follow the
    variable order, codes follow the summary order.
    """
    original = catalog.filter(F.col("org_mrg_tp_cd") == ORIGINAL)
    summary = catalog.filter(F.col("org_mrg_tp_cd") == SUMMARY)
    used = original.select(*DATASET, "var_seq", "var_dscr_seq").join(
        rules.select(*DATASET, "var_dscr_seq"), [*DATASET, "var_dscr_seq"]
    )
    described = keyed_join(
        summary.select(*DATASET, "var_seq", "var_dscr_seq"),
        standard.select("var_seq", "var_cd", "datatp"),
        ["var_seq"],
        "left",
    )
    last = described.groupBy(*DATASET).agg(F.max("var_dscr_seq").alias("cnt"))
    return (
        used.select(*DATASET, "var_seq")
        .join(described, [*DATASET, "var_seq"])
        .groupBy(*DATASET)
        .agg(
            ordered_list("datatp", "var_seq").alias("datatp"),
            ordered_list("var_cd", "var_dscr_seq").alias("var_cd"),
            ordered_list("var_dscr_seq", "var_seq").alias("var_dscr_seq"),
        )
        .join(last, list(DATASET))
    )


def split_metadata(metadata: DataFrame) -> DataFrame:
    """The comma lists of `summary_metadata` as one row per variable and list position."""
    lists = [F.split(name, ",").alias(name) for name in ("datatp", "var_cd", "var_dscr_seq")]
    return (
        metadata.select(*DATASET, "cnt", *lists)
        .select(*DATASET, "cnt", F.posexplode(F.arrays_zip("datatp", "var_cd", "var_dscr_seq")))
        .select(*DATASET, "cnt", (F.col("pos") + 1).alias("pos"), "col.*")
    )
