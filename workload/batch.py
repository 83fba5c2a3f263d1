"""Whole batches, with datasets, variables, types and rules from the catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from veilspark.operators import catalog, status
from veilspark.plans import batch
from veilspark.plans.deidentify import deidentify
from veilspark.sources.scratch import materialise, scratch_path
from workload.records import _SWAP, RULES, _sql_new
from workload.registry import query
from workload.tables import DATASET, NUMBER, TEXT, Tables

_COLUMNS = DATASET.split(", ")
_VARIABLES = [(1, "order_dt", TEXT), (2, "amt", NUMBER), (3, "prio", TEXT), (4, "status", TEXT)]
_FIRST = [(1, "date->trunc(x, 'YEAR')"), (2, "Int64->floor(x / 50000) * 50000"), (3, "string->substring(x, 1, 1)")]
_SECOND = [(2, "Int64->floor(x / 1000) * 1000"), (3, "string->substring(x, 1, 3)")]


class Batches:
    """Catalog, rules, requests and batches of the studies that orders were delivered for."""

    def __init__(self, t: Tables):
        self.t = t
        self.datasets = materialise(t.delivered.select(*_COLUMNS).distinct(), "datasets")

    def _times(self, rows: list[tuple], schema: str) -> DataFrame:
        """Each dataset with each of a few given rows."""
        names = [part.split()[0] for part in schema.split(", ")]
        made = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows])
        return self.datasets.select(*_COLUMNS, F.inline(made)).select(*_COLUMNS, *[F.expr(f"cast({p.split()[0]} as {p.split()[1]}) {p.split()[0]}") for p in schema.split(", ")])

    @property
    def catalog(self) -> DataFrame:
        found = self._times(_VARIABLES, "var_seq bigint, var_cd string, datatp string").withColumns(
            {"var_dscr_seq": F.col("var_seq"), "req_var_tp_cd": F.lit("1"), "org_mrg_tp_cd": F.lit("1")}
        )
        name = F.concat(F.lit("V"), F.col("var_seq").cast("string"))
        return found.withColumn("var_dscr_nm", name).select(
            *_COLUMNS, "var_seq", "var_dscr_seq", "var_dscr_nm", "var_cd", "req_var_tp_cd", "org_mrg_tp_cd"
        )

    @property
    def standard(self) -> DataFrame:
        return self.t.spark.createDataFrame(_VARIABLES, "var_seq long, var_cd string, datatp string")

    @property
    def rules(self) -> DataFrame:
        first = self._times(_FIRST, "var_dscr_seq bigint, di_set_val string").withColumn("exec_seq", F.lit(1))
        second = self._times(_SECOND, "var_dscr_seq bigint, di_set_val string").withColumn("exec_seq", F.lit(2))
        rows = first.unionByName(second.filter("prvdr_cd IN ('K0001', 'K0002')"))
        return rows.withColumn("org_mrg_tp_cd", F.lit("1"))

    @property
    def pending(self) -> DataFrame:
        """A batch for each study; studies of odd number name the second rule set."""
        number = F.right("ask_id", F.lit(1)).cast("int")
        studies = self.datasets.select("ask_id", "rshp_id").distinct()
        requests = studies.select(
            F.col("ask_id").alias("requestid"), F.col("rshp_id").alias("hypoid"), F.lit("K0002").alias("cnorgcode"),
            F.when(number % 2 == 1, 2).alias("rulesetseq2"),
        )
        batches = studies.select(
            number.alias("bt_seq"), "ask_id", "rshp_id", F.lit(1).alias("exec_seq"), F.lit("7F").alias("wk_dtl_tp_cd"),
            F.concat(F.lit("in/"), "ask_id").alias("src_pth_nm"), F.lit("out").alias("rslt_pth_nm"),
        )
        paths = ["src_pth_nm", "rslt_pth_nm"]
        return status.pending_batches(
            requests, batches, self.t.execution, "NoSuchJob", "7F", True, ["rulesetseq2"], paths
        )


_DS = f"ds AS (SELECT DISTINCT {DATASET} FROM delivered)"


def _rows(pairs: list[tuple]) -> str:
    return ", ".join("({}, '{}')".format(n, text.replace("'", "''")) for n, text in pairs)


_RULES = f"""
r AS (SELECT ds.*, CAST(v AS BIGINT) var_dscr_seq, t di_set_val, 1 exec_seq FROM ds, (VALUES {_rows(_FIRST)}) x(v, t)
 UNION ALL SELECT ds.*, CAST(v AS BIGINT), t, 2 FROM ds, (VALUES {_rows(_SECOND)}) x(v, t)
 WHERE prvdr_cd IN ('K0001', 'K0002'))"""


@query(
    f"""WITH {_DS}, {_RULES}
SELECT CAST(right(ask_id, 1) AS INTEGER) bt_seq, {DATASET}, var_dscr_seq, di_set_val, exec_seq, '1' org_mrg_tp_cd
FROM r WHERE exec_seq = CASE WHEN CAST(right(ask_id, 1) AS INTEGER) % 2 = 1 THEN 2 ELSE 1 END""",
    "delivered",
)
def rule_set_of_batch(t: Tables) -> DataFrame:
    given = Batches(t)
    return batch.rules_of_batch(given.pending, given.rules)


EAV_OF = {"original": "original_eav", "deidentified": "deidentified_eav"}


def run_batch(t: Tables, given: Batches, store: str) -> batch.SummaryBatch:
    """The summary job of all pending batches, with summary variables made from the catalog."""
    known = given.standard.select("var_seq")
    made = materialise(catalog.build_summary_catalog(given.catalog, given.standard, known, given.rules), "catalog")
    return batch.summary_job(
        given.pending,
        given.datasets.withColumn("exec_seq", F.lit(1)),
        made,
        given.standard,
        given.rules,
        t.delivered,
        t.stored,
        store,
        "85",
        F.lit("K0002"),
    )


_GROUP = f"{DATASET}, prsnt_pg_num, tot_pg_num, file_nm"


@query(
    rf"""WITH k AS (SELECT *, CAST(right(ask_id, 1) AS INTEGER) % 2 odd FROM keyed),
f AS (SELECT {_GROUP}, odd, CASE WHEN odd = 0 THEN order_dt END order_dt, amt, prio, count(*) cnt FROM k
 WHERE odd = 0 OR prvdr_cd IN ('K0001', 'K0002') GROUP BY ALL),
n AS (SELECT * REPLACE (CASE WHEN regexp_matches(order_dt, '^\d{{8}}$')
  THEN strftime(date_trunc('year', try_strptime(order_dt, '%Y%m%d')), '%Y%m%d') END AS order_dt,
 CASE WHEN regexp_matches(amt, '^\s*[+-]?\d+\s*$') THEN CASE odd WHEN 1 THEN CAST(TRY_CAST(amt AS BIGINT) // 1000 * 1000 AS VARCHAR)
  ELSE CAST(TRY_CAST(amt AS BIGINT) // 50000 * 50000 AS VARCHAR) END END AS amt, substr(prio, 1, 1 + 2 * odd) AS prio) FROM f),
d AS (SELECT {_GROUP}, odd, order_dt, amt, prio, CAST(sum(cnt) AS BIGINT) cnt FROM n GROUP BY ALL),
b AS (SELECT 'original' kind, * FROM f UNION ALL SELECT 'deidentified', * FROM d),
e AS (SELECT *, CAST(row_number() OVER (PARTITION BY kind, {_GROUP}
 ORDER BY order_dt NULLS FIRST, amt NULLS FIRST, prio NULLS FIRST) AS BIGINT) datum_seq FROM b)
SELECT kind, left(ask_id, 4) ask_year, {_GROUP}, 1 exec_seq, datum_seq, 1 var_dscr_seq, coalesce(order_dt, '') str_datatp_val,
 CAST(NULL AS DOUBLE) num_datatp_val FROM e WHERE odd = 0
UNION ALL SELECT kind, left(ask_id, 4), {_GROUP}, 1, datum_seq, 2, NULL, TRY_CAST(amt AS DOUBLE) FROM e
UNION ALL SELECT kind, left(ask_id, 4), {_GROUP}, 1, datum_seq, 3, coalesce(prio, ''), NULL FROM e
UNION ALL SELECT kind, left(ask_id, 4), {_GROUP}, 1, datum_seq, 4, NULL, CAST(cnt AS DOUBLE) FROM e""",
    "keyed",
)
def summary_job_eav(t: Tables) -> DataFrame:
    """The stored long tables of all pending batches, whose rule sets decide variables and rules."""
    store, found = scratch_path(t.spark, "summaries"), None
    run_batch(t, Batches(t), store)
    for kind, name in EAV_OF.items():
        rows = t.spark.read.schema(batch.EAV).parquet(f"{store}/{name}").withColumn("kind", F.lit(kind))
        found = rows if found is None else found.unionByName(rows)
    return found


@query(
    f"""
SELECT DISTINCT CAST(right(d.ask_id, 1) AS INTEGER) bt_seq, {", ".join("d." + name for name in _COLUMNS)}, d.file_nm,
 CASE WHEN k.file_nm IS NULL THEN '902' WHEN d.prvdr_cd NOT IN ('K0001', 'K0002') AND CAST(right(d.ask_id, 1) AS INTEGER) % 2 = 1 THEN '003' ELSE '002' END wk_exec_sts_cd,
 CASE WHEN k.file_nm IS NULL THEN 'no rows' WHEN d.prvdr_cd NOT IN ('K0001', 'K0002') AND CAST(right(d.ask_id, 1) AS INTEGER) % 2 = 1 THEN 'no summary variables' END message
FROM delivered d LEFT JOIN (SELECT DISTINCT file_nm FROM keyed) k USING (file_nm)""",
    "keyed",
)
def summary_job_detail(t: Tables) -> DataFrame:
    """A row for each registered file: made, without variables, or without rows."""
    return run_batch(t, Batches(t), scratch_path(t.spark, "summaries")).detail


@query(
    f"""WITH {_SWAP}, {_sql_new('g')},
k AS (SELECT file_nm, count(alter_id) m, count(*) - count(alter_id) u FROM s GROUP BY ALL),
c AS (SELECT file_nm, bool_or(na IS NULL OR nd IS NULL OR np IS NULL) bad FROM n GROUP BY ALL)
SELECT 7 bt_seq, file_nm, CASE WHEN m = 0 THEN '902' WHEN u > 0 OR bad THEN '003' ELSE '002' END wk_exec_sts_cd
FROM k LEFT JOIN c USING (file_nm)""",
    "keyed alternate",
)
def deid_detail_rows(t: Tables) -> DataFrame:
    done = deidentify(t.keyed, t.alternate, RULES)
    return batch.deid_detail(F.lit(7), done.keys, done.cells)
