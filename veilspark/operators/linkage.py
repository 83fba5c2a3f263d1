"""Hashing persons, matching requested keys, attaching and swapping keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from veilspark.columns import (
    FAILED,
    HASHED_PERSON,
    KEY,
    OK,
    PERSON,
    STUDY,
    STUDY_PROVIDER,
    WARNING,
)
from veilspark.functions.hashing import person_hash
from veilspark.operators.joins import keyed_join
from veilspark.sources.by_key import join_by_key

MATCHED = "429"
NOT_MATCHED = "428"


def as_person_file(df: DataFrame) -> DataFrame:
    """The first five columns under the fixed names of a person file; fewer raise."""
    if len(df.columns) < len(PERSON):
        raise ValueError(f"a person file has at least {len(PERSON)} columns, this one {df.columns}")
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in zip(df.columns, PERSON)])


def as_provider_file(df: DataFrame) -> DataFrame:
    """Columns four to six of a provider file renamed to name, id and dataset; fewer raise."""
    fixed = (*PERSON, "cat_cd")
    if len(df.columns) < len(fixed):
        raise ValueError(f"a provider file has at least {len(fixed)} columns, this one {df.columns}")
    return df.toDF(*fixed, *df.columns[len(fixed):])


def hash_persons(persons: DataFrame, salts: DataFrame, null_text: str | None = None) -> DataFrame:
    """Distinct persons with the salt of their study and provider and their key.

    Persons of a study without a salt drop out; `unsalted` lists those studies.
    Copies collapse before the join, so neither join nor hash sees them twice.
    """
    distinct = salts.select(*STUDY_PROVIDER, "ttp_id").distinct()
    salted = keyed_join(
        persons.select(*PERSON).distinct(), distinct, STUDY_PROVIDER, sized_by=salts
    )
    key = person_hash(F.col("mrg_nm"), F.col("mrg_ssn"), F.col("ttp_id"), null_text)
    return salted.withColumn("hash_did", key).select(*HASHED_PERSON)


def unsalted(persons: DataFrame, salts: DataFrame) -> DataFrame:
    """Studies and providers that delivered persons but have no salt, with their row counts."""
    counted = persons.groupBy(*STUDY_PROVIDER).agg(F.count(F.lit(1)).alias("n_persons"))
    return keyed_join(counted, salts.select(*STUDY_PROVIDER), STUDY_PROVIDER, "left_anti")


def unhashable(hashed: DataFrame) -> DataFrame:
    """Persons per study and provider whose key is null because a part was missing."""
    return hashed.groupBy(*STUDY_PROVIDER).agg(
        F.count(F.lit(1)).alias("n_persons"),
        F.count_if(F.col("hash_did").isNull()).alias("n_unhashable"),
    )


def key_file(hashed: DataFrame) -> DataFrame:
    """The columns of a hashed-person table that leave the provider."""
    return hashed.select(*KEY)


def passthrough_keys(df: DataFrame) -> DataFrame:
    """An already hashed key file, accepted only with exactly the four key columns."""
    if sorted(name.lower() for name in df.columns) != sorted(KEY):
        raise ValueError(f"a hashed key file has the columns {KEY}, not {tuple(df.columns)}")
    return df.select(*KEY)


def request_match_counts(hashed: DataFrame, requested: DataFrame) -> DataFrame:
    """Per requested study: keys with a bad transfer code, and request-to-person matches.

    Both sides are counted per key first, so a match costs one row whatever the
    number of copies; the products of those counts add up to the joined row count.
    """
    wanted = requested.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("_wanted"),
        F.count_if(F.col("trnsmrcv_cd") != "S").alias("_bad"),
    )
    known = hashed.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_known"))
    return (
        wanted.join(known, list(KEY), "left")
        .groupBy(*STUDY)
        .agg(
            F.sum("_bad").alias("n_bad"),
            F.sum(F.col("_wanted") * F.coalesce("_known", F.lit(0))).alias("n_matched"),
        )
    )


def request_verdicts(counts: DataFrame) -> DataFrame:
    """Whether a study may go on: no bad transfer code and at least one match."""
    passed = (F.col("n_bad") == 0) & (F.col("n_matched") > 0)
    reason = (
        F.when(F.col("n_bad") > 0, "transfer code")
        .when(F.col("n_matched") == 0, "no match")
        .otherwise("matched")
    )
    return counts.select(
        "*", F.when(passed, MATCHED).otherwise(NOT_MATCHED).alias("prcsts"), reason.alias("reason")
    )


def match_requested(
    hashed: DataFrame, requested: DataFrame, verdicts: DataFrame | None = None
) -> DataFrame:
    """Known persons whose key was requested, restricted to the studies that passed.

    A key requested twice gives its persons twice, as the joining insert does.
    """
    matched = keyed_join(hashed.select(*HASHED_PERSON), requested.select(*KEY), KEY)
    if verdicts is not None:
        passed = verdicts.filter(F.col("prcsts") == MATCHED).select(*STUDY)
        matched = keyed_join(matched, passed, STUDY, "left_semi")
    return matched.select(*HASHED_PERSON)


def attach_hash(rows: DataFrame, matched: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Swap name and id of provider rows for the key: key columns first, then the data.

    Rows of persons that were not requested drop out. `carry` names leading columns,
    such as the file name, that stay in front.
    """
    keys = matched.select(*PERSON, "hash_did")
    joined = keyed_join(rows, keys, PERSON)
    used = {*PERSON, "hash_did", *(name.lower() for name in carry)}
    values = [name for name in rows.columns if name.lower() not in used]
    return joined.select(*carry, *KEY, *values)


def attach_report(rows: DataFrame, attached: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows delivered and rows kept per file; a file without any match has failed."""
    given = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))
    kept = attached.groupBy(*by).agg(F.count(F.lit(1)).alias("n_matched"))
    return (
        given.join(kept, list(by), "left")
        .fillna(0, ["n_matched"])
        .withColumn("status", F.when(F.col("n_matched") == 0, FAILED).otherwise(OK))
    )


def swap_key(
    rows: DataFrame, alternates: DataFrame, how: str = "left", keep: Sequence[str] = (), by_key: bool = False
) -> DataFrame:
    """Replace `hash_did` by `alter_id` at the same place.

    `left` keeps rows without an alternate key, `inner` drops them. A hash with two
    alternates yields a row for each. `keep` names more columns of the alternate
    table (such as a date shift) to append. With `by_key`, `alternates` is a table of these columns
    that `sources.by_key` stored by `hash_did`, and is not shuffled.
    """
    if by_key:
        joined = join_by_key(rows, alternates.select("hash_did", "alter_id", *keep), "hash_did", how)
    else:
        pairs = alternates.select("hash_did", "alter_id", *keep).distinct()
        joined = keyed_join(rows, pairs, ["hash_did"], how, sized_by=alternates)
    names = ["alter_id" if name.lower() == "hash_did" else name for name in rows.columns]
    return joined.select(*names, *keep)


def swap_report(swapped: DataFrame, by: Sequence[str]) -> DataFrame:
    """Matched and unmatched rows per file: none matched fails, some unmatched warns."""
    status = (
        F.when(F.col("n_matched") == 0, FAILED)
        .when(F.col("n_unmatched") > 0, WARNING)
        .otherwise(OK)
    )
    return (
        swapped.groupBy(*by)
        .agg(
            F.count("alter_id").alias("n_matched"),
            F.count_if(F.col("alter_id").isNull()).alias("n_unmatched"),
        )
        .withColumn("status", status)
    )
