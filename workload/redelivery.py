"""Kept summaries that follow a redelivery: a page comes late, one comes again, one is withdrawn."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from veilspark.operators.joins import keyed_join
from veilspark.plans.incremental import KEYS, Kept, follow, kept_summary
from veilspark.sources.scratch import scratch_path
from veilspark.sources.tables import append_rows
from workload.records import META, NAMES, PAGES, RULES, _M, _N, _sql_new
from workload.registry import query
from workload.tables import Tables

_LATE = "prvdr_cd = 'K0001' AND prsnt_pg_num = 4"
_AGAIN = "prvdr_cd = 'K0002' AND prsnt_pg_num = 2"
_GONE = "prvdr_cd = 'K0003' AND prsnt_pg_num = 3"
_NOW = f"keyed WHERE NOT ({_GONE})"


def _inventory(delivered: DataFrame) -> DataFrame:
    """The measures of the delivered pages."""
    return delivered.groupBy(*KEYS).agg(
        F.max("crt_ymd").alias("crt_ymd"),
        F.sum(F.length(F.concat_ws(",", *NAMES))).alias("file_sz"),
        F.count(F.lit(1)).alias("datum_cnt"),
        F.lit(len(NAMES)).alias("var_ea"),
        F.max("file_nm").alias("file_nm"),
    )


def _redelivered(t: Tables) -> Kept:
    rows = t.keyed.select(*META, *PAGES, *NAMES, "o_orderkey", "file_nm")
    first = rows.filter(f"NOT ({_LATE}) AND NOT ({_AGAIN} AND o_orderkey % 8 = 1)")
    first = first.withColumn("amt", F.when(F.expr(_AGAIN), F.concat("amt", F.lit("9"))).otherwise(F.col("amt")))
    second = rows.filter(f"NOT ({_GONE})")
    path = scratch_path(t.spark, "kept")
    for delivery, ymd in ((first, F.lit("20210226")), (second, F.when(F.expr(_AGAIN), "20210301").otherwise("20210226"))):
        store = scratch_path(t.spark, "delivery")
        append_rows(delivery.withColumn("crt_ymd", ymd), store, ["file_nm"])
        stored = t.spark.read.parquet(store)
        # The files of other pages are pruned, as rows are stored by file.
        follow(_inventory(stored), lambda pages: keyed_join(stored, pages.select("file_nm"), ["file_nm"], "left_semi"), NAMES, path)
    return kept_summary(t.spark, path)


@query(f"SELECT {_M}, {_N}, count(*) cnt FROM {_NOW} GROUP BY ALL", "keyed")
def summary_after_redelivery(t: Tables) -> DataFrame:
    return _redelivered(t).pages


@query(f"SELECT {', '.join(META)}, {_N}, count(*) cnt FROM {_NOW} GROUP BY ALL", "keyed")
def totals_after_redelivery(t: Tables) -> DataFrame:
    """Counts of the datasets: those before, less those of the changed pages, and those they have now."""
    return _redelivered(t).datasets


@query(
    f"""WITH f AS (SELECT {_M}, {_N}, count(*) cnt FROM {_NOW} GROUP BY ALL), {_sql_new('f')}
SELECT {_M}, nd order_dt, na amt, np prio, status, CAST(sum(cnt) AS BIGINT) cnt FROM n GROUP BY ALL""",
    "keyed",
)
def deidentified_after_redelivery(t: Tables) -> DataFrame:
    return _redelivered(t).deidentified(RULES)
