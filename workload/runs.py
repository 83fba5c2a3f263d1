"""Batches, executions, requests and their status."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from veilspark.operators import checks, status, tables
from workload.registry import query
from workload.tables import Tables


@query("SELECT bt_seq, bt_exec_seq, wk_exec_sts_cd, count(*) cnt FROM detail GROUP BY ALL", "detail")
def count_by_status(t: Tables) -> DataFrame:
    return status.count_by_status(t.detail).orderBy(F.desc("wk_exec_sts_cd"), "bt_seq")


_ROLLUP = """
SELECT bt_seq, count(*) FILTER (WHERE wk_exec_sts_cd = '902') n_failed,
 count(*) FILTER (WHERE wk_exec_sts_cd = '003') n_warned,
 CASE WHEN bool_or(wk_exec_sts_cd = '902') THEN '902' WHEN bool_or(wk_exec_sts_cd = '003') THEN '003'
  ELSE '002' END status
FROM {source} GROUP BY bt_seq"""


@query(_ROLLUP.format(source="detail"), "detail")
def rollup_status(t: Tables) -> DataFrame:
    return status.rollup_status(t.detail)


@query(
    "WITH e AS (SELECT user_id bt_seq, CASE event_type WHEN 'error' THEN '902' WHEN 'signup' THEN '003'"
    " ELSE '002' END wk_exec_sts_cd FROM events)" + _ROLLUP.format(source="e")
)
def rollup_status_of_events(t: Tables) -> DataFrame:
    code = "case event_type when 'error' then '902' when 'signup' then '003' else '002' end"
    detail = t.given("events").selectExpr("user_id bt_seq", f"{code} wk_exec_sts_cd")
    return status.rollup_status(detail)


@query(
    "SELECT prnt_oid, count(*) FILTER (WHERE prcs_fail_yn = 'Y') cnt FROM register GROUP BY ALL", "register"
)
def failed_files(t: Tables) -> DataFrame:
    return status.failed_files(t.register, ["prnt_oid"])


@query("SELECT bt_seq, max(bt_exec_seq) bt_exec_seq FROM execution GROUP BY ALL", "execution")
def latest_execution(t: Tables) -> DataFrame:
    return status.latest_execution(t.execution)


@query(
    """
SELECT bt_seq, max(bt_exec_seq) + 1 bt_exec_seq FROM execution GROUP BY ALL""",
    "execution",
)
def next_sequence(t: Tables) -> DataFrame:
    return status.next_sequence(t.execution, "bt_exec_seq", ["bt_seq"])


@query(
    """
SELECT user_id, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
)
def latest_row_per_batch(t: Tables) -> DataFrame:
    latest = status.latest_row(t.given("events"), ["user_id"], ["ts", "event_id"])
    return latest.select("user_id", "event_id", "event_type")


_REGISTERED = """
SELECT c.bt_seq, c.ask_id, c.rshp_id, c.exec_seq, a.cnorgcode
FROM request a JOIN batch c ON a.requestid = c.ask_id AND a.hypoid = c.rshp_id"""


@query(
    f"""{_REGISTERED} LEFT JOIN execution d ON c.bt_seq = d.bt_seq AND d.crt_pgm_id = 'Deid'
WHERE c.wk_dtl_tp_cd = '7A' AND coalesce(d.wk_sts_cd, '902') NOT IN ('002')""",
    "request batch execution",
)
def pending_batches(t: Tables) -> DataFrame:
    return status.pending_batches(t.request, t.batch, t.execution, "Deid", "7A")


@query(
    f"""{_REGISTERED} WHERE c.wk_dtl_tp_cd = '7A' AND NOT EXISTS (SELECT 1 FROM execution d
WHERE c.bt_seq = d.bt_seq AND d.crt_pgm_id = 'Deid' AND d.wk_sts_cd = '002')""",
    "request batch execution",
)
def pending_batches_strict(t: Tables) -> DataFrame:
    return status.pending_batches(t.request, t.batch, t.execution, "Deid", "7A", strict=True)


@query(
    """
SELECT c.bt_seq, d.exec_seq, d.prvdr_cd, d.cat_cd
FROM request a JOIN batch c ON a.requestid = c.ask_id AND a.hypoid = c.rshp_id
 JOIN chosen d ON c.ask_id = d.ask_id AND c.rshp_id = d.rshp_id AND c.exec_seq = d.exec_seq
WHERE c.wk_dtl_tp_cd = '7F'""",
    "request batch chosen",
)
def batch_datasets(t: Tables) -> DataFrame:
    return status.batch_datasets(t.request, t.batch, t.chosen, "7F")


@query(
    """
SELECT DISTINCT a.ask_id, a.rshp_id, a.exec_seq, a.prvdr_cd, a.cat_cd, a.wk_exec_cnts, a.di_wk_div_cnts
FROM run_log a, batch b, detail d
WHERE a.di_wk_div_cnts = '85' AND b.wk_dtl_tp_cd = '85' AND b.bt_seq = d.bt_seq
 AND d.wk_exec_sts_cd IN ('002', '003') AND a.ask_id = b.ask_id AND a.rshp_id = b.rshp_id
 AND a.exec_seq = b.exec_seq AND a.wk_exec_cnts = d.wk_exec_cnts""",
    "run_log batch detail",
)
def logged_outputs(t: Tables) -> DataFrame:
    return status.logged_outputs(t.run_log, t.batch, t.detail, "85")


@query(
    """
WITH d AS (SELECT ask_id, rshp_id, exec_seq, prvdr_cd, string_agg(cat_cd, ',' ORDER BY cat_cd) cat_cd
 FROM chosen GROUP BY ALL)
SELECT ask_id, rshp_id, exec_seq, string_agg(prvdr_cd || ' => ' || cat_cd, ',' ORDER BY prvdr_cd) message
FROM d GROUP BY ALL""",
    "chosen",
)
def dataset_listing(t: Tables) -> DataFrame:
    return status.dataset_listing(t.chosen)


@query(
    """
SELECT originoid, requestid AS ask_id, hypoid AS rshp_id FROM request
WHERE requestid = '2019-000000007' AND hypoid = 'A0001'""",
    "request",
)
def study_filter(t: Tables) -> DataFrame:
    """One study by its keys, as query parameters."""
    text = """SELECT originoid, requestid AS ask_id, hypoid AS rshp_id FROM {requests}
              WHERE requestid = :ask_id AND hypoid = :rshp_id"""
    keys = {"ask_id": "2019-000000007", "rshp_id": "A0001"}
    return t.spark.sql(text, args=keys, requests=t.request)


_CHAINED = """
WITH a AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END st FROM orders)"""


@query(
    f"""{_CHAINED}
SELECT o_orderkey, coalesce(st, '-') st, coalesce(st, '902') NOT IN ('F') AS pending,
 st IS NOT NULL AS has_status, coalesce(st <> 'F', FALSE) AS not_f, coalesce(st IN ('F', 'P'), FALSE) AS f_or_p
FROM a"""
)
def null_aware_predicates(t: Tables) -> DataFrame:
    rows = t.given("orders").selectExpr(
        "o_orderkey", "case when o_orderkey % 3 <> 0 then o_orderstatus end st"
    )
    st = F.col("st")
    return rows.fillna("-", ["st"]).join(
        rows.select(
            "o_orderkey",
            (~F.coalesce(st, F.lit("902")).isin("F")).alias("pending"),
            st.isNotNull().alias("has_status"),
            F.coalesce(st != "F", F.lit(False)).alias("not_f"),
            F.coalesce(st.isin("F", "P"), F.lit(False)).alias("f_or_p"),
        ),
        "o_orderkey",
    )


_NOTPROD = """FROM chosen e WHERE NOT EXISTS (SELECT 1 FROM run_log p WHERE e.ask_id = p.ask_id
 AND e.exec_seq = p.exec_seq AND e.prvdr_cd = p.prvdr_cd AND e.cat_cd = p.cat_cd)"""


@query(f"SELECT ask_id, rshp_id, exec_seq, prvdr_cd, cat_cd {_NOTPROD}", "chosen run_log")
def not_produced(t: Tables) -> DataFrame:
    return checks.not_produced(t.chosen, t.run_log, ["ask_id", "exec_seq", "prvdr_cd", "cat_cd"]).select(
        "ask_id", "rshp_id", "exec_seq", "prvdr_cd", "cat_cd"
    )


@query(
    """
WITH p AS (SELECT DISTINCT ask_id, exec_seq, prvdr_cd, cat_cd, 1 found FROM run_log),
c AS (SELECT ask_id, exec_seq, count(*) n_expected, count(found) n_produced
 FROM chosen LEFT JOIN p USING (ask_id, exec_seq, prvdr_cd, cat_cd) GROUP BY ALL)
SELECT *, CASE WHEN n_expected = n_produced THEN '002' ELSE '902' END status FROM c""",
    "chosen run_log",
)
def completeness(t: Tables) -> DataFrame:
    keys = ["ask_id", "exec_seq", "prvdr_cd", "cat_cd"]
    return checks.completeness(t.chosen, t.run_log, keys, ["ask_id", "exec_seq"])


@query(
    """
SELECT requestid, hypoid, cnorgcode, CASE WHEN cnorgcode = 'K0002' THEN '440' ELSE requeststatus END requeststatus,
 originoid FROM request""",
    "request",
)
def update_where(t: Tables) -> DataFrame:
    return tables.update_where(
        t.request, F.col("cnorgcode") == "K0002", {"requeststatus": F.lit("440")}
    )


@query(
    """
SELECT bt_seq, ask_id, rshp_id, exec_seq,
 CASE WHEN EXISTS (SELECT 1 FROM execution e WHERE e.bt_seq = b.bt_seq) THEN 'run' ELSE wk_dtl_tp_cd END wk_dtl_tp_cd
FROM batch b""",
    "batch execution",
)
def update_exists(t: Tables) -> DataFrame:
    return tables.update_exists(
        t.batch, t.execution, {"bt_seq": "bt_seq"}, {"wk_dtl_tp_cd": F.lit("run")}
    )
