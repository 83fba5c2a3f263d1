"""Hashing, matching, attaching and swapping of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from veilspark.functions.hashing import person_hash
from veilspark.operators import linkage
from veilspark.plans.linkage import attach_job, hash_job, match_job
from veilspark.sources.by_key import store_by_key
from veilspark.sources.scratch import scratch_path
from veilspark.sources.tables import key_set
from workload.registry import query
from workload.tables import PERSON, Tables

_D = "d.ask_id, d.rshp_id, d.prvdr_cd"


@query(
    """
SELECT c_custkey, upper(sha256(c_name || lpad(CAST(c_custkey AS VARCHAR), 13, '0') || 'T1')) hash_did
FROM customer"""
)
def person_hash_sha256(t: Tables) -> DataFrame:
    ssn = F.lpad(F.col("c_custkey").cast("string"), 13, "0")
    return t.given("customer").select(
        "c_custkey", person_hash(F.col("c_name"), ssn, F.lit("T1")).alias("hash_did")
    )


@query("SELECT ask_id, rshp_id, prvdr_cd, mrg_nm, mrg_ssn FROM person_file", "person_file")
def positional_projection(t: Tables) -> DataFrame:
    delivered = t.person_file.toDF("a", "b", "c", "full name", "id", "extra")
    return linkage.as_person_file(delivered)


@query(f"SELECT {PERSON}, ttp_id, hash_did FROM hashed", "hashed person_file")
def hash_persons(t: Tables) -> DataFrame:
    return linkage.hash_persons(t.person_file, t.salt)


@query(
    f"""
SELECT {PERSON}, ttp_id, upper(sha256(coalesce(mrg_nm, 'nan') || mrg_ssn || ttp_id)) hash_did
FROM hashed""",
    "hashed",
)
def hash_persons_null_as_text(t: Tables) -> DataFrame:
    return linkage.hash_persons(t.person_file, t.salt, null_text="nan")


@query(
    """
SELECT ask_id, rshp_id, prvdr_cd, count(*) n_persons FROM person_file
WHERE prvdr_cd = 'K0004' GROUP BY ALL""",
    "person_file",
)
def unsalted_studies(t: Tables) -> DataFrame:
    return linkage.unsalted(t.person_file, t.salt)


@query(
    """
SELECT ask_id, rshp_id, prvdr_cd, count(*) n_persons, count(*) - count(hash_did) n_unhashable
FROM hashed GROUP BY ALL""",
    "hashed",
)
def unhashable_persons(t: Tables) -> DataFrame:
    return hash_job(t.person_file, t.salt).unhashable


@query("SELECT ask_id, rshp_id, prvdr_cd, hash_did FROM hashed", "hashed")
def hashed_key_file(t: Tables) -> DataFrame:
    return linkage.key_file(t.hashed)


@query("SELECT ask_id, rshp_id, prvdr_cd, hash_did FROM requested", "requested")
def passthrough_key_file(t: Tables) -> DataFrame:
    return linkage.passthrough_keys(t.requested.drop("trnsmrcv_cd"))


_COUNTS = """
WITH b AS (SELECT ask_id, rshp_id, count(*) FILTER (WHERE trnsmrcv_cd <> 'S') n_bad
 FROM requested GROUP BY ALL),
m AS (SELECT r.ask_id, r.rshp_id, count(*) n FROM requested r
 JOIN hashed h USING (ask_id, rshp_id, prvdr_cd, hash_did) GROUP BY ALL),
counts AS (SELECT b.ask_id, b.rshp_id, CAST(n_bad AS BIGINT) n_bad, CAST(coalesce(n, 0) AS BIGINT) n_matched
 FROM b LEFT JOIN m USING (ask_id, rshp_id))"""


@query(f"{_COUNTS} SELECT * FROM counts", "requested")
def request_match_counts(t: Tables) -> DataFrame:
    return linkage.request_match_counts(t.hashed, t.requested)


@query(
    f"""{_COUNTS} SELECT *, CASE WHEN n_bad = 0 AND n_matched > 0 THEN '429' ELSE '428' END prcsts,
CASE WHEN n_bad > 0 THEN 'transfer code' WHEN n_matched = 0 THEN 'no match' ELSE 'matched' END reason
FROM counts""",
    "requested",
)
def request_verdicts(t: Tables) -> DataFrame:
    return linkage.request_verdicts(linkage.request_match_counts(t.hashed, t.requested))


_MATCHED = f"""
SELECT {PERSON}, ttp_id, hash_did FROM hashed h JOIN requested r USING (ask_id, rshp_id, prvdr_cd, hash_did)"""


@query(_MATCHED, "requested")
def match_requested(t: Tables) -> DataFrame:
    return linkage.match_requested(t.hashed, t.requested)


@query(f"{_MATCHED} WHERE ask_id NOT IN ('2019-00004', '2019-00005')", "requested")
def match_requested_passed_studies(t: Tables) -> DataFrame:
    return match_job(t.hashed, t.requested).persons


_ATTACHED = f"""
SELECT {_D}, hash_did, cat_cd, o_orderkey, order_dt, amt, prio, status, prsnt_pg_num, tot_pg_num, file_nm
FROM delivered d JOIN hashed h USING (ask_id, rshp_id, prvdr_cd, mrg_nm, mrg_ssn)"""


@query(_ATTACHED, "delivered hashed")
def attach_hash(t: Tables) -> DataFrame:
    return linkage.attach_hash(t.delivered, t.hashed)


@query(
    f"""
WITH m AS ({_MATCHED} WHERE ask_id NOT IN ('2019-00004', '2019-00005')),
a AS (SELECT d.file_nm FROM delivered d JOIN m USING (ask_id, rshp_id, prvdr_cd, mrg_nm, mrg_ssn)),
g AS (SELECT file_nm, count(*) n_rows FROM delivered GROUP BY ALL),
k AS (SELECT file_nm, count(*) n FROM a GROUP BY ALL)
SELECT file_nm, n_rows, CAST(coalesce(n, 0) AS BIGINT) n_matched,
 CASE WHEN coalesce(n, 0) = 0 THEN '902' ELSE '002' END status
FROM g LEFT JOIN k USING (file_nm)""",
    "delivered requested",
)
def attach_report(t: Tables) -> DataFrame:
    matched = match_job(t.hashed, t.requested).persons
    return attach_job(t.delivered, matched).report


_SWAPPED = """
SELECT ask_id, rshp_id, prvdr_cd, alter_id, cat_cd, o_orderkey, order_dt, amt, prio, status,
 prsnt_pg_num, tot_pg_num, file_nm
FROM keyed {how} JOIN (SELECT DISTINCT hash_did, alter_id FROM alternate) USING (hash_did)"""


@query(_SWAPPED.format(how="LEFT"), "keyed alternate")
def swap_key_left(t: Tables) -> DataFrame:
    return linkage.swap_key(t.keyed, t.alternate)


def _by_key(t: Tables) -> DataFrame:
    return store_by_key(t.alternate.select("hash_did", "alter_id"), scratch_path(t.spark, "by-key"), ["hash_did"], 8)


@query(_SWAPPED.format(how="LEFT"), "keyed alternate")
def swap_key_bucketed(t: Tables) -> DataFrame:
    """With the alternate keys stored by key; rows without a key stay."""
    return linkage.swap_key(t.keyed, _by_key(t), by_key=True)


@query(_SWAPPED.format(how=""), "keyed alternate")
def swap_key_bucketed_inner(t: Tables) -> DataFrame:
    return linkage.swap_key(t.keyed, _by_key(t), how="inner", by_key=True)


@query(_SWAPPED.format(how=""), "keyed alternate")
def swap_key_inner(t: Tables) -> DataFrame:
    return linkage.swap_key(t.keyed, t.alternate, how="inner")


@query(
    f"""
WITH s AS ({_SWAPPED.format(how="LEFT")})
SELECT file_nm, count(alter_id) n_matched, count(*) - count(alter_id) n_unmatched,
 CASE WHEN count(alter_id) = 0 THEN '902' WHEN count(alter_id) < count(*) THEN '003' ELSE '002' END status
FROM s GROUP BY file_nm""",
    "keyed alternate",
)
def swap_report(t: Tables) -> DataFrame:
    return linkage.swap_report(linkage.swap_key(t.keyed, t.alternate), ["file_nm"])


@query("SELECT DISTINCT hash_did, alter_id FROM alternate", "alternate")
def alternate_keys_distinct(t: Tables) -> DataFrame:
    return t.alternate.select("hash_did", "alter_id").distinct()


@query(
    """
SELECT left(ask_id, 4) ask_year, ask_id, rshp_id, prvdr_cd, coalesce(hash_did, '') hash_did
FROM hashed WHERE ask_id = '2019-00001' AND rshp_id = 'A0001' AND prvdr_cd = 'K0001'""",
    "hashed",
)
def key_set_filtered(t: Tables) -> DataFrame:
    study = "ask_id = '2019-00001' AND rshp_id = 'A0001' AND prvdr_cd = 'K0001'"
    return key_set(t.hashed.filter(study))
