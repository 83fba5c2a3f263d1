"""Table maintenance, written outputs, inventories and release."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from veilspark.operators import release, tables
from veilspark.operators.inventory import expected_outputs, inventory_status, outputs_of_rows
from veilspark.plans.publish import complete_requests, inventory_job, release_job
from veilspark.sources import manifest, tables as stored
from veilspark.sources.delimited import file_inventory
from veilspark.sources.scratch import materialise, scratch_path
from veilspark.sources.sinks import deliver, write_bundles
from workload.registry import query
from workload.tables import Tables

_PART = "p_partkey, p_name, p_brand, p_size"


@query(
    """
SELECT a.ask_id, a.rshp_id, a.prvdr_cd, a.hash_did, ttp_id, mrg_nm, mrg_ssn, 'MatchJob' crt_pgm_id
FROM hashed a, requested b WHERE a.ask_id = b.ask_id AND a.rshp_id = b.rshp_id
 AND a.prvdr_cd = b.prvdr_cd AND a.hash_did = b.hash_did""",
    "requested",
)
def insert_select(t: Tables) -> DataFrame:
    keys = ["ask_id", "rshp_id", "prvdr_cd", "hash_did"]
    joined = t.hashed.join(t.requested, keys)
    return tables.insert_select(
        joined, [*keys, "ttp_id", "mrg_nm", "mrg_ssn"], {"crt_pgm_id": F.lit("MatchJob")}
    )


@query(
    f"""
WITH tgt AS (SELECT {_PART} FROM part WHERE p_partkey % 3 <> 0),
src AS (SELECT DISTINCT {_PART} FROM part WHERE p_partkey % 2 = 0)
SELECT * FROM tgt UNION ALL
SELECT * FROM src s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.p_partkey = s.p_partkey
 AND t.p_name = s.p_name AND t.p_brand = s.p_brand AND t.p_size = s.p_size)"""
)
def merge_insert_only(t: Tables) -> DataFrame:
    part = t.given("part").selectExpr(*_PART.split(", "))
    source = part.filter("p_partkey % 2 = 0")
    return tables.merge_insert_only(part.filter("p_partkey % 3 <> 0"), source.union(source))


_NULLED = "p_partkey, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_name END p_name"


@query(
    f"""
WITH tgt AS (SELECT {_NULLED} FROM part WHERE p_partkey % 3 <> 0),
src AS (SELECT {_NULLED} FROM part WHERE p_partkey % 2 = 0)
SELECT * FROM tgt UNION ALL
SELECT * FROM src s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.p_partkey = s.p_partkey
 AND t.p_name = s.p_name)"""
)
def merge_insert_only_with_nulls(t: Tables) -> DataFrame:
    part = t.given("part").selectExpr("p_partkey", "case when p_size % 5 = 0 then null else p_name end p_name")
    return tables.merge_insert_only(part.filter("p_partkey % 3 <> 0"), part.filter("p_partkey % 2 = 0"))


@query(
    f"""
WITH tgt AS (SELECT {_NULLED} FROM part WHERE p_partkey % 3 <> 0),
src AS (SELECT {_NULLED} FROM part WHERE p_partkey % 2 = 0)
SELECT * FROM tgt UNION ALL
SELECT * FROM src s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.p_partkey = s.p_partkey
 AND t.p_name IS NOT DISTINCT FROM s.p_name)"""
)
def merge_insert_only_null_safe(t: Tables) -> DataFrame:
    part = t.given("part").selectExpr("p_partkey", "case when p_size % 5 = 0 then null else p_name end p_name")
    return tables.merge_insert_only(
        part.filter("p_partkey % 3 <> 0"), part.filter("p_partkey % 2 = 0"), null_safe=True
    )


@query(
    f"""
WITH tgt AS (SELECT {_PART} FROM part WHERE p_partkey % 3 <> 0),
src AS (SELECT p_partkey, upper(p_name) p_name, p_brand, p_size + 100 p_size FROM part WHERE p_partkey % 2 = 0)
SELECT coalesce(t.p_partkey, s.p_partkey) p_partkey, coalesce(t.p_name, s.p_name) p_name,
 coalesce(t.p_brand, s.p_brand) p_brand, coalesce(s.p_size, t.p_size) p_size
FROM tgt t FULL JOIN src s ON t.p_partkey = s.p_partkey"""
)
def upsert(t: Tables) -> DataFrame:
    part = t.given("part").selectExpr(*_PART.split(", "))
    source = part.filter("p_partkey % 2 = 0").selectExpr(
        "p_partkey", "upper(p_name) p_name", "p_brand", "p_size + 100 p_size"
    )
    return tables.upsert(part.filter("p_partkey % 3 <> 0"), source, ["p_partkey"], ["p_size"])


@query(
    "SELECT l_orderkey, count(*) n_rows FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1"
)
def repeated_keys(t: Tables) -> DataFrame:
    return tables.repeated_keys(t.given("lineitem"), ["l_orderkey"])


_ORDER = "o_orderkey, o_custkey, o_orderstatus, o_orderpriority"


def _orders(t: Tables) -> DataFrame:
    return t.given("orders").selectExpr(*_ORDER.split(", "))


def _stored(t: Tables, label: str) -> str:
    path = scratch_path(t.spark, label)
    stored.append_rows(_orders(t), path, ["o_orderstatus"])
    return path


def _read(t: Tables, path: str) -> DataFrame:
    return t.spark.read.parquet(path).select(*_ORDER.split(", "))


@query(
    f"""
WITH src AS (SELECT o_orderkey, o_custkey, o_orderstatus, 'late ' || o_orderpriority o_orderpriority FROM orders WHERE o_custkey % 50 = 0
 UNION ALL SELECT -o_orderkey, o_custkey, o_orderstatus, 'new' FROM orders WHERE o_custkey % 70 = 0)
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, coalesce(s.o_orderpriority, o.o_orderpriority) o_orderpriority
FROM orders o LEFT JOIN src s USING (o_orderkey)
UNION ALL SELECT {_ORDER} FROM src WHERE o_orderkey < 0"""
)
def upsert_touched_files(t: Tables) -> DataFrame:
    """A stored table of which only the files with a changed row are written anew."""
    path, names = scratch_path(t.spark, "touched"), _ORDER.split(", ")
    _orders(t).repartitionByRange(200, "o_orderkey").write.parquet(path)
    changed = _orders(t).filter("o_custkey % 50 = 0").selectExpr(*names[:3], "concat('late ', o_orderpriority) o_orderpriority")
    new = _orders(t).filter("o_custkey % 70 = 0").selectExpr("-o_orderkey o_orderkey", *names[1:3], "'new' o_orderpriority")
    stored.upsert_files(changed.unionByName(new), path, ["o_orderkey"], ["o_orderpriority"])
    return _read(t, path)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN 'open' ELSE o_orderpriority END o_orderpriority FROM orders")
def update_touched_files(t: Tables) -> DataFrame:
    path = _stored(t, "updated")
    stored.update_files(t.spark, path, F.col("o_orderstatus") == "P", {"o_orderpriority": F.lit("open")}, ["o_orderstatus"])
    return _read(t, path)


@query(
    f"""
SELECT {_ORDER} FROM orders WHERE o_orderstatus <> 'F' UNION ALL
SELECT o_orderkey, o_custkey + 1, o_orderstatus, 'new' FROM orders WHERE o_orderstatus = 'F'"""
)
def replace_partition(t: Tables) -> DataFrame:
    path = _stored(t, "replace")
    fresh = _orders(t).filter("o_orderstatus = 'F'").selectExpr(
        "o_orderkey", "o_custkey + 1 o_custkey", "o_orderstatus", "'new' o_orderpriority"
    )
    stored.replace_partition(fresh, path, ["o_orderstatus"])
    return _read(t, path)


@query(
    f"""
SELECT {_ORDER} FROM orders WHERE o_orderstatus = 'O' UNION ALL
SELECT o_orderkey, o_custkey + 1, o_orderstatus, 'new' FROM orders WHERE o_orderstatus = 'F'"""
)
def replace_with_empty(t: Tables) -> DataFrame:
    """Two partitions are replaced, one of them by nothing."""
    path = _stored(t, "replace-empty")
    scope = _orders(t).filter("o_orderstatus IN ('F', 'P')").select("o_orderstatus").distinct()
    fresh = _orders(t).filter("o_orderstatus = 'F'").selectExpr(
        "o_orderkey", "o_custkey + 1 o_custkey", "o_orderstatus", "'new' o_orderpriority"
    )
    stored.replace_partition(fresh, path, ["o_orderstatus"], scope)
    return _read(t, path)


@query(f"SELECT {_ORDER} FROM orders WHERE o_orderstatus <> 'P'")
def truncate_partition(t: Tables) -> DataFrame:
    path = _stored(t, "truncate")
    stored.truncate_partition(t.spark, path, {"o_orderstatus": "P"})
    return _read(t, path)


@query(f"SELECT {_ORDER} FROM orders UNION ALL SELECT {_ORDER} FROM orders WHERE o_orderstatus = 'O'")
def append_rows(t: Tables) -> DataFrame:
    path = _stored(t, "append")
    stored.append_rows(_orders(t).filter("o_orderstatus = 'O'"), path, ["o_orderstatus"])
    return _read(t, path)


@query(
    f"""SELECT o_orderkey, o_custkey, o_orderstatus,
CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE o_orderpriority END o_orderpriority FROM orders"""
)
def rewrite_table_in_place(t: Tables) -> DataFrame:
    path = _stored(t, "rewrite")
    done = {"o_orderpriority": F.lit("done")}
    state = tables.update_where(_read(t, path), F.col("o_orderstatus") == "F", done)
    stored.rewrite(state, path, ["o_orderstatus"])
    return _read(t, path)


_KEYS = """
SELECT '2019' ask_year, '2019-00078' ask_id, 'A0001' rshp_id, 'K0003' prvdr_cd,
 coalesce(hash_did, '') hash_did, 'S' trnsmrcv_cd FROM hashed"""
_STUDY = {"ask_id": "2019-00078", "rshp_id": "A0001", "prvdr_cd": "K0003"}


def _loaded(t: Tables) -> str:
    path = scratch_path(t.spark, "keys")
    source = deliver(t.hashed.select("ask_id", "rshp_id", "prvdr_cd", "hash_did"), "key-file")
    stored.load_key_file(t.spark, source, path, _STUDY, {"trnsmrcv_cd": F.lit("S")})
    return path


def _texts(df: DataFrame) -> DataFrame:
    """Partition columns are read back with inferred types; all of these are text."""
    return df.select(*[F.col(name).cast("string").alias(name) for name in df.columns])


@query(_KEYS, "hashed")
def load_key_file(t: Tables) -> DataFrame:
    return _texts(t.spark.read.parquet(_loaded(t)))


@query(_KEYS.replace("'S' trnsmrcv_cd", "'CopyJob' crt_pgm_id"), "hashed")
def copy_key_set(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "key-copy")
    received = _texts(t.spark.read.parquet(_loaded(t)))
    wanted = F.col("prvdr_cd") == "K0003"
    for _ in range(2):  # a second copy replaces the first
        stored.copy_key_set(received, path, wanted, {"crt_pgm_id": F.lit("CopyJob")})
    return _texts(t.spark.read.parquet(path))


@query("SELECT 'IF_DL_50' || right(prvdr_cd, 1) ifid, cat_cd, file_nm, prio, status FROM keyed", "keyed")
def write_bundles_compressed(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "bundles")
    rows = t.keyed.withColumn("ifid", F.concat(F.lit("IF_DL_50"), F.right("prvdr_cd", F.lit(1))))
    write_bundles(rows.select("ifid", "cat_cd", "file_nm", "prio", "status"), path)
    return t.spark.read.option("header", True).csv(path).select(
        "ifid", "cat_cd", "file_nm", "prio", "status"
    )


_FILES = """
f AS (SELECT file_nm, CAST(sum(length(ask_id) + length(rshp_id) + length(prvdr_cd) + length(cat_cd)
  + length(CAST(o_orderkey AS VARCHAR)) + length(prio) + 6) AS BIGINT) body, count(*) datum_cnt
 FROM keyed GROUP BY file_nm),
i AS (SELECT file_nm, body + length('ask_id,rshp_id,prvdr_cd,cat_cd,o_orderkey,prio') + 1 file_sz,
 datum_cnt, CAST(6 AS BIGINT) var_ea FROM f)"""


def _files(t: Tables) -> str:
    columns = ["ask_id", "rshp_id", "prvdr_cd", "cat_cd", "o_orderkey", "prio", "file_nm"]
    return deliver(t.keyed.select(*columns), "inventory", "file_nm")


@query(f"WITH {_FILES} SELECT file_nm, datum_cnt, var_ea FROM i", "keyed")
def inventory_of_files(t: Tables) -> DataFrame:
    return file_inventory(t.spark, _files(t)).select("file_nm", "datum_cnt", "var_ea")


def _inventory(t: Tables, register: DataFrame, path: str | None = None):
    """Inventory of the written files; the first page of each study is known from before."""
    before = t.keyed.filter("prsnt_pg_num = 1").select(
        "ask_id", "rshp_id", "prvdr_cd", "cat_cd", F.lit("1").alias("org_mrg_tp_cd"), "prsnt_pg_num",
        "tot_pg_num", F.lit("20200101").alias("crt_ymd"), F.lit(0).cast("bigint").alias("file_sz"),
        F.lit(0).cast("bigint").alias("datum_cnt"), F.lit(0).cast("bigint").alias("var_ea"),
        F.lit("old").alias("file_nm"),
    ).distinct()
    return inventory_job(t.spark, path or _files(t), register, before, "original")


_REGISTER = ["ask_id", "rshp_id", "prvdr_cd", "cat_cd", "file_nm"]


@query(
    f"""WITH {_FILES}
SELECT DISTINCT ask_id, rshp_id, prvdr_cd, cat_cd, '1' org_mrg_tp_cd, prsnt_pg_num, tot_pg_num,
 '20210226' crt_ymd, datum_cnt, var_ea, file_nm FROM keyed JOIN i USING (file_nm)""",
    "keyed",
)
def inventory_merge(t: Tables) -> DataFrame:
    register = t.keyed.select(*_REGISTER).distinct()
    return _inventory(t, register).table.drop("file_sz")


@query(
    """
WITH k AS (SELECT ask_id, rshp_id, prvdr_cd, cat_cd, prsnt_pg_num, tot_pg_num, file_nm, '20210226' crt_ymd FROM keyed
 UNION ALL SELECT ask_id, rshp_id, prvdr_cd, cat_cd, prsnt_pg_num, tot_pg_num,
  replace(file_nm, '20210226', '20210301'), '20210301' FROM keyed WHERE prsnt_pg_num = 1 AND o_orderkey % 3 = 0),
f AS (SELECT ask_id, rshp_id, prvdr_cd, cat_cd, '1' org_mrg_tp_cd, prsnt_pg_num, tot_pg_num, crt_ymd,
 count(*) datum_cnt, CAST(6 AS BIGINT) var_ea, file_nm FROM k GROUP BY ALL)
SELECT * FROM f QUALIFY row_number() OVER (
 PARTITION BY ask_id, rshp_id, prvdr_cd, cat_cd, prsnt_pg_num, tot_pg_num ORDER BY crt_ymd DESC) = 1""",
    "keyed",
)
def inventory_redelivered(t: Tables) -> DataFrame:
    """First pages were delivered again later; the inventory shows the later delivery."""
    again = t.keyed.filter("prsnt_pg_num = 1 AND o_orderkey % 3 = 0").withColumn(
        "file_nm", F.replace("file_nm", F.lit("20210226"), F.lit("20210301"))
    )
    rows = t.keyed.unionByName(again)
    columns = ["ask_id", "rshp_id", "prvdr_cd", "cat_cd", "o_orderkey", "prio", "file_nm"]
    path = deliver(rows.select(*columns), "redelivered", "file_nm")
    return _inventory(t, rows.select(*_REGISTER).distinct(), path).table.drop("file_sz")


@query(
    """
SELECT DISTINCT d.ask_id, d.rshp_id, d.prvdr_cd, d.cat_cd, d.file_nm,
 CASE WHEN d.prvdr_cd = 'K0004' THEN '902' ELSE '002' END wk_exec_sts_cd FROM delivered d""",
    "delivered",
)
def inventory_detail(t: Tables) -> DataFrame:
    """Every delivered file is expected; those of unsalted providers were never made."""
    return _inventory(t, t.delivered.select(*_REGISTER).distinct()).detail


_NAME = "'IF_DL_802_' || replace(ask_id, '-', '') || '_A0001_' || cat_cd || '_' || CAST(prsnt_pg_num AS VARCHAR) || '_4_20210226.txt'"


@query(
    f"SELECT ask_id, prvdr_cd, file_nm, {_NAME} out_nm, prio FROM delivered", "delivered"
)
def expected_deid_outputs(t: Tables) -> DataFrame:
    expected = expected_outputs(t.delivered, "deid", F.lit("K0002"))
    return expected.select("ask_id", "prvdr_cd", "file_nm", "out_nm", "prio")


_EXPECTED = f"x AS (SELECT DISTINCT ask_id, rshp_id, {_NAME} out_nm FROM keyed)"
_PRODUCED = f"""
y AS (SELECT DISTINCT ask_id, rshp_id, {_NAME} out_nm, 1 found FROM keyed
 WHERE NOT (ask_id = '2019-00003' AND prsnt_pg_num = 2))"""
_VERDICT = """
v AS (SELECT ask_id, rshp_id, count(*) n_expected, count(found) n_produced
 FROM x LEFT JOIN y USING (ask_id, rshp_id, out_nm) GROUP BY ALL)"""


def _stored_rows(t: Tables) -> DataFrame:
    """The rows that are released, stored: what registers, names and files are made from."""
    return materialise(t.keyed.select(*_REGISTER, "prsnt_pg_num", "o_orderkey", "prio"), "keyed")


def _outputs(t: Tables) -> tuple[DataFrame, DataFrame]:
    expected = outputs_of_rows(_stored_rows(t), "deid", F.lit("K0002"))
    return expected, expected.filter("NOT (ask_id = '2019-00003' AND prsnt_pg_num = 2)")


@query(
    f"""WITH {_EXPECTED}, {_PRODUCED}, {_VERDICT}
SELECT *, CASE WHEN n_expected = n_produced THEN '002' ELSE '902' END status FROM v""",
    "keyed",
)
def release_verdicts(t: Tables) -> DataFrame:
    return release.release_verdicts(*_outputs(t))


@query(
    f"WITH {_EXPECTED}, {_PRODUCED} SELECT * FROM x EXCEPT SELECT ask_id, rshp_id, out_nm FROM y", "keyed"
)
def missing_outputs(t: Tables) -> DataFrame:
    return release.missing_outputs(*_outputs(t)).distinct()



@query(
    f"""
SELECT CAST(o_orderkey AS VARCHAR) o_orderkey, prio, {_NAME} file_nm FROM keyed
WHERE ask_id <> '2019-00003'""",
    "keyed",
)
def release_complete_studies(t: Tables) -> DataFrame:
    """A study without its second page is held back as a whole."""
    return _released(t, 1)


def _released(t: Tables, runs: int, registered: str = "true") -> DataFrame:
    stored_rows = _stored_rows(t)
    rows = outputs_of_rows(stored_rows, "deid", F.lit("K0002"))
    register = stored_rows.filter(registered).select(*_REGISTER).distinct()
    made = rows.filter("NOT (ask_id = '2019-00003' AND prsnt_pg_num = 2)")
    path = scratch_path(t.spark, "release")
    columns = ["ask_id", "rshp_id", "out_nm", "o_orderkey", "prio"]
    for _ in range(runs):
        release_job(register, made.select(*columns), path, F.lit("K0002"))
    return t.spark.read.option("header", True).csv(path).select("o_orderkey", "prio", "file_nm")


@query(
    f"""
SELECT CAST(o_orderkey AS VARCHAR) o_orderkey, prio, {_NAME} file_nm FROM keyed
WHERE ask_id <> '2019-00003'""",
    "keyed",
)
def release_twice(t: Tables) -> DataFrame:
    """A second run leaves what the first one published."""
    return _released(t, 2)


def _released_by_manifest(t: Tables) -> str:
    """Two releases, of which the second replaces files of some studies."""
    stored_rows = _stored_rows(t)
    rows = outputs_of_rows(stored_rows, "deid", F.lit("K0002"))
    made = rows.filter("NOT (ask_id = '2019-00003' AND prsnt_pg_num = 2)")
    path = scratch_path(t.spark, "release")
    columns = ["ask_id", "rshp_id", "out_nm", "o_orderkey", "prio"]
    register = stored_rows.select(*_REGISTER).distinct()
    release_job(register, made.select(*columns), path, F.lit("K0002"), with_manifest=True)
    again = made.filter("ask_id >= '2019-00004'").selectExpr(*columns[:-1], "upper(prio) prio")
    release_job(register.filter("ask_id >= '2019-00004'"), again, path, F.lit("K0002"), with_manifest=True)
    return path


@query(
    f"""SELECT {_NAME} file_nm, count(*) n_rows, TRUE intact FROM keyed WHERE ask_id <> '2019-00003' GROUP BY ALL""",
    "keyed",
)
def release_manifest(t: Tables) -> DataFrame:
    """Released files and their rows as the manifest says, held against the files."""
    return manifest.verify(t.spark, _released_by_manifest(t))


@query(
    f"""
SELECT CAST(o_orderkey AS VARCHAR) o_orderkey, CASE WHEN ask_id >= '2019-00004' THEN upper(prio) ELSE prio END prio,
 {_NAME} file_nm FROM keyed WHERE ask_id <> '2019-00003'""",
    "keyed",
)
def release_read_by_manifest(t: Tables) -> DataFrame:
    rows = manifest.read_release(t.spark, _released_by_manifest(t))
    return rows.select(F.col("O_ORDERKEY").alias("o_orderkey"), F.col("PRIO").alias("prio"), "file_nm")


@query(
    f"""
SELECT CAST(o_orderkey AS VARCHAR) o_orderkey, prio, {_NAME} file_nm FROM keyed
WHERE ask_id <> '2019-00003' AND prsnt_pg_num <> 4""",
    "keyed",
)
def release_registered_only(t: Tables) -> DataFrame:
    """Fourth pages were made but are not registered."""
    return _released(t, 1, "prsnt_pg_num <> 4")


@query(
    """
WITH v AS (SELECT ask_id, rshp_id, bool_and(o_orderstatus <> 'F') done
 FROM register JOIN orders USING (o_orderkey) GROUP BY ALL)
SELECT requestid, hypoid, cnorgcode, CASE WHEN EXISTS (SELECT 1 FROM v WHERE done
  AND v.ask_id = replace(requestid, '-0000', '-') AND v.rshp_id = hypoid) THEN '440' ELSE requeststatus END requeststatus,
 originoid FROM request""",
    "register request",
)
def complete_requests_by_inventory(t: Tables) -> DataFrame:
    done = F.when(F.bool_and(F.col("prcs_fail_yn") == "N"), "002").otherwise("902")
    verdicts = t.register.groupBy("ask_id", "rshp_id").agg(done.alias("status"))
    verdicts = verdicts.withColumn("ask_id", F.replace("ask_id", F.lit("-"), F.lit("-0000")))
    return complete_requests(t.request, verdicts)


@query(
    f"""SELECT DISTINCT d.ask_id, d.rshp_id, d.prvdr_cd, d.cat_cd, d.file_nm,
CASE WHEN k.file_nm IS NULL THEN '902' ELSE '002' END wk_exec_sts_cd
FROM delivered d LEFT JOIN (SELECT DISTINCT file_nm FROM keyed) k USING (file_nm)""",
    "keyed",
)
def inventory_status_rows(t: Tables) -> DataFrame:
    expected = expected_outputs(t.delivered.select(*_REGISTER).distinct(), "original")
    return inventory_status(expected, t.keyed.select("file_nm"))
