"""Study tables derived from the given tables, once in Spark and once as SQL.

Sizes follow the given tables: persons from customer, data rows from orders, variable
catalogs from part (forty variables per dataset), batches from orders, executions and
their detail rows from lineitem.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from veilspark.operators.joins import keyed_join
from veilspark.sources.scratch import materialise

TEXT = "문자"
NUMBER = "숫자"
PERSON = "ask_id, rshp_id, prvdr_cd, mrg_nm, mrg_ssn"
DATASET = "ask_id, rshp_id, prvdr_cd, cat_cd"
WORK = "CASE o_orderpriority WHEN '1-URGENT' THEN '7A' WHEN '2-HIGH' THEN '7F' ELSE '85' END"
STATUS = "CASE l_returnflag WHEN 'A' THEN '902' WHEN 'R' THEN '003' ELSE '002' END"


class Tables:
    """The given tables by name, and the study tables made from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self._dir = sf_dir
        self._given: dict[str, DataFrame] = {}

    def given(self, name: str) -> DataFrame:
        if name not in self._given:
            self._given[name] = self.spark.read.parquet(f"{self._dir}/{name}.parquet")
        return self._given[name]

    # Persons, salts, keys

    @cached_property
    def person(self) -> DataFrame:
        return self.given("customer").selectExpr(
            "concat('2019-0000', cast(c_custkey % 5 + 1 as string)) ask_id",
            "'A0001' rshp_id",
            "concat('K000', cast(c_nationkey % 4 + 1 as string)) prvdr_cd",
            "case when c_custkey % 211 <> 0 then c_name end mrg_nm",
            "lpad(cast(c_custkey as string), 13, '0') mrg_ssn",
            "c_custkey",
        )

    @cached_property
    def person_file(self) -> DataFrame:
        """Persons as delivered, a tenth of them twice, with a column too many."""
        copies = self.person.filter("c_custkey % 10 = 0")
        return self.person.union(copies)

    @cached_property
    def salt(self) -> DataFrame:
        return self.person.filter("prvdr_cd <> 'K0004'").selectExpr(
            "ask_id", "rshp_id", "prvdr_cd",
            "concat('T', right(ask_id, 1), right(prvdr_cd, 1)) ttp_id",
        ).distinct()

    @cached_property
    def hashed(self) -> DataFrame:
        """Hashed persons as stored, with the key the other fixtures are picked by."""
        salted = keyed_join(self.person, self.salt, ["ask_id", "rshp_id", "prvdr_cd"], sized_by=self.salt)
        return salted.selectExpr(
            "ask_id", "rshp_id", "prvdr_cd", "mrg_nm", "mrg_ssn", "ttp_id",
            "upper(sha2(concat(mrg_nm, mrg_ssn, ttp_id), 256)) hash_did", "c_custkey",
        )

    @cached_property
    def requested(self) -> DataFrame:
        return self.hashed.filter("c_custkey % 3 = 0 and hash_did is not null").selectExpr(
            "ask_id", "rshp_id", "prvdr_cd",
            "case when ask_id = '2019-00004' then reverse(hash_did) else hash_did end hash_did",
            "case when ask_id = '2019-00005' and c_custkey % 9 = 0 then 'N' else 'S' end trnsmrcv_cd",
        )

    @cached_property
    def alternate(self) -> DataFrame:
        known = self.hashed.filter(
            "c_custkey % 5 <> 0 and c_custkey % 7 <> 0 and hash_did is not null"
        )
        number = "lpad(cast(c_custkey as string), 8, '0')"
        first = known.selectExpr(
            "hash_did", f"concat('ALT', {number}) alter_id", "concat(c_custkey % 15, '.5') rnd"
        )
        second = known.filter("c_custkey % 97 = 1").selectExpr(
            "hash_did", f"concat('ALU', {number}) alter_id", "concat(c_custkey % 15, '.5') rnd"
        )
        return first.union(second)

    # Data rows

    @cached_property
    def delivered(self) -> DataFrame:
        """Provider data with identity, four pages per study and provider, some cells dirty."""
        orders = self.given("orders").withColumnRenamed("o_custkey", "c_custkey")
        rows = orders.join(self.person, "c_custkey")
        return rows.selectExpr(
            "ask_id", "rshp_id", "prvdr_cd", "mrg_nm", "mrg_ssn", "concat('ORD', right(prvdr_cd, 1)) cat_cd", "o_orderkey",
            """case when o_orderkey % 83 = 0 then '20210230' when o_orderkey % 79 = 0 then ''
               else date_format(o_orderdate, 'yyyyMMdd') end order_dt""",
            """case when o_orderkey % 97 = 0 then 'x' when o_orderkey % 89 = 0 then null
               else cast(cast(floor(o_totalprice) as bigint) as string) end amt""",
            "o_orderpriority prio", "o_orderstatus status",
            "cast(o_orderkey % 4 + 1 as int) prsnt_pg_num", "4 tot_pg_num",
            """concat('IF_DL_50', right(prvdr_cd, 1), '_', replace(ask_id, '-', ''), '_A0001_ORD',
               right(prvdr_cd, 1), '_', o_orderkey % 4 + 1, '_4_20210226.txt') file_nm""",
        )

    @cached_property
    def keyed(self) -> DataFrame:
        """The same rows as they arrive at the centre: key instead of identity."""
        keys = self.hashed.select("ask_id", "rshp_id", "prvdr_cd", "mrg_nm", "mrg_ssn", "hash_did")
        rows = self.delivered.join(keys, ["ask_id", "rshp_id", "prvdr_cd", "mrg_nm", "mrg_ssn"])
        return rows.select(
            "ask_id", "rshp_id", "prvdr_cd", "hash_did", "cat_cd", "o_orderkey", "order_dt", "amt",
            "prio", "status", "prsnt_pg_num", "tot_pg_num", "file_nm",
        )

    @cached_property
    def stored(self) -> DataFrame:
        """Those rows as the centre has stored them, for jobs that read them more than once."""
        return materialise(self.keyed, "keyed")

    @cached_property
    def register(self) -> DataFrame:
        """One registered file per order, some of them misnamed."""
        return self.given("orders").selectExpr(
            "concat('2019-', lpad(cast(o_custkey % 100000 as string), 5, '0')) ask_id",
            "'A0001' rshp_id",
            "concat('K000', cast(o_orderkey % 4 + 1 as string)) prvdr_cd",
            "case when o_orderkey % 3 = 0 then 'HN17_ALL' else 'TWJHC200' end cat_cd",
            """case when o_orderkey % 29 = 0 then concat('bad_', o_orderkey, '.txt') else
               concat('IF_DL_50', case when o_orderkey % 17 = 0 then 9 else o_orderkey % 4 + 1 end,
                '_2019', lpad(cast(o_custkey % 100000 as string), 5, '0'), '_A0001_',
                case when o_orderkey % 3 = 0 then 'HN17_ALL' else 'TWJHC200' end,
                '_', o_orderkey % 150 + 1, '_144_20210226',
                case when o_orderkey % 2 = 0 then '120000000' else '' end, '.txt') end file_nm""",
            "case when o_orderstatus = 'F' then 'Y' else 'N' end prcs_fail_yn",
            "o_orderkey",
            "o_custkey prnt_oid",
        )

    # Variable catalogs

    _DATASET = (
        "concat('2019-', lpad(cast(p_partkey div 40 as string), 9, '0')) ask_id",
        "'A0001' rshp_id",
        "concat('K000', cast(p_partkey div 40 % 5 + 1 as string)) prvdr_cd",
        "concat('C', cast(p_partkey div 40 % 3 as string)) cat_cd",
    )

    @cached_property
    def catalog(self) -> DataFrame:
        return self.given("part").selectExpr(
            *self._DATASET, "p_partkey var_seq", "p_partkey % 40 + 1 var_dscr_seq",
            "concat('V', p_partkey % 40 + 1) var_dscr_nm",
            "case when p_partkey % 7 <> 0 then concat('VC', p_partkey) end var_cd",
            "'1' req_var_tp_cd", "'1' org_mrg_tp_cd",
        )

    @cached_property
    def standard(self) -> DataFrame:
        return self.given("part").filter("p_partkey % 5 <> 0").selectExpr(
            "p_partkey var_seq", "concat('SV', p_partkey) var_cd",
            f"case when p_size % 2 = 0 then '{TEXT}' else '{NUMBER}' end datatp",
            *self._DATASET[2:],
        )

    @cached_property
    def known(self) -> DataFrame:
        return self.given("part").filter("p_partkey % 11 <> 0").selectExpr("p_partkey var_seq")

    @cached_property
    def rule(self) -> DataFrame:
        text = """case when p_partkey % 13 = 0 then null when p_size % 2 = 0 then 'string->left(x, 1)'
                  else 'Int64->floor(x / 10) * 10' end di_set_val"""
        columns = [*self._DATASET, "p_partkey % 40 + 1 var_dscr_seq", "'1' org_mrg_tp_cd"]
        part = self.given("part")
        first = part.filter("p_partkey % 3 <> 0").selectExpr(*columns, "1 exec_seq", text)
        second = part.filter("p_partkey % 4 = 0").selectExpr(*columns, "2 exec_seq", text)
        return first.union(second)

    @cached_property
    def catalog_before(self) -> DataFrame:
        """The catalog with summary variables of an earlier run."""
        stale = self.given("part").filter("p_partkey % 40 < 3").selectExpr(
            *self._DATASET, "cast(null as bigint) var_seq", "p_partkey % 40 + 1 var_dscr_seq",
            "'OLD' var_dscr_nm", "'OLD' var_cd", "'9' req_var_tp_cd", "'2' org_mrg_tp_cd",
        )
        return self.catalog.union(stale)

    @cached_property
    def file_column(self) -> DataFrame:
        """Columns of one file per dataset: meta, then variables, some wrong."""
        part = self.given("part")
        name = "concat('F', p_partkey div 40, '.txt') file_nm"
        meta = (
            "inline(array(struct(1 as pos, 'ASK_ID' as var_cd), struct(2 as pos, 'RSHP_ID' as var_cd),"
            " struct(3 as pos, 'PRVDR_CD' as var_cd), struct(4 as pos, 'HASH_DID' as var_cd),"
            " struct(5 as pos, 'CAT_CD' as var_cd)))"
        )
        position = "cast(p_partkey % 40 + 6 as int) pos"
        given = part.filter("p_partkey % 97 <> 0").selectExpr(
            *self._DATASET, name, position, "concat('vc', p_partkey) var_cd"
        )
        first = part.filter("p_partkey % 40 = 0")
        extra = first.filter("p_partkey div 40 % 5 = 0").selectExpr(
            *self._DATASET, name, "46 pos", "'extra' var_cd"
        )
        twice = first.filter("p_partkey div 40 % 7 = 0").selectExpr(
            *self._DATASET, name, "47 pos", "concat('VC', p_partkey + 1) var_cd"
        )
        heads = first.selectExpr(*self._DATASET, name, meta)
        return heads.union(given).union(extra).union(twice)

    @cached_property
    def catalog_column(self) -> DataFrame:
        return self.given("part").filter("p_partkey div 40 % 11 <> 3").selectExpr(
            *self._DATASET, "concat('VC', p_partkey) var_cd"
        )

    # Requests, batches, executions

    @cached_property
    def request(self) -> DataFrame:
        return self.given("customer").selectExpr(
            "concat('2019-', lpad(cast(c_custkey as string), 9, '0')) requestid",
            "'A0001' hypoid",
            "concat('K000', cast(c_nationkey % 4 + 1 as string)) cnorgcode",
            "'400' requeststatus",
            "c_custkey originoid",
        )

    _ASK = "concat('2019-', lpad(cast(o_custkey as string), 9, '0')) ask_id"

    @cached_property
    def batch(self) -> DataFrame:
        return self.given("orders").selectExpr(
            "o_orderkey bt_seq", self._ASK, "'A0001' rshp_id", "o_orderkey % 3 + 1 exec_seq",
            f"{WORK} wk_dtl_tp_cd",
        )

    @cached_property
    def execution(self) -> DataFrame:
        return self.given("lineitem").selectExpr(
            "l_orderkey bt_seq", "l_linenumber + 10 * l_suppkey bt_exec_seq", f"{STATUS} wk_sts_cd",
            "case when l_linestatus = 'F' then 'Deid' else 'Summary' end crt_pgm_id",
        )

    @cached_property
    def detail(self) -> DataFrame:
        return self.given("lineitem").selectExpr(
            "l_orderkey bt_seq", "cast(l_linenumber as bigint) bt_exec_seq",
            f"{STATUS} wk_exec_sts_cd", "concat('out_', l_partkey % 5) wk_exec_cnts",
        )

    @cached_property
    def run_log(self) -> DataFrame:
        return self.given("orders").selectExpr(
            self._ASK, "'A0001' rshp_id", "o_orderkey % 3 + 1 exec_seq",
            "concat('K000', o_orderkey % 4 + 1) prvdr_cd", "concat('C', o_orderkey % 5) cat_cd",
            f"{WORK} di_wk_div_cnts", "concat('out_', o_orderkey % 5) wk_exec_cnts",
        )

    @cached_property
    def chosen(self) -> DataFrame:
        return self.given("orders").selectExpr(
            self._ASK, "'A0001' rshp_id", "o_orderkey % 3 + 1 exec_seq",
            "concat('K000', o_orderkey % 4 + 1) prvdr_cd", "concat('C', o_orderkey % 6) cat_cd",
        ).distinct()


_SQL_DATASET = """'2019-' || lpad(CAST(p_partkey // 40 AS VARCHAR), 9, '0') ask_id, 'A0001' rshp_id,
 'K000' || CAST(p_partkey // 40 % 5 + 1 AS VARCHAR) prvdr_cd,
 'C' || CAST(p_partkey // 40 % 3 AS VARCHAR) cat_cd"""
_SQL_ASK = "'2019-' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') ask_id"
_SQL_RULE = """CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_size % 2 = 0 THEN 'string->left(x, 1)'
 ELSE 'Int64->floor(x / 10) * 10' END di_set_val"""

# The same tables in SQL.
CTES = {
    "person": """
SELECT '2019-0000' || CAST(c_custkey % 5 + 1 AS VARCHAR) ask_id, 'A0001' rshp_id,
 'K000' || CAST(c_nationkey % 4 + 1 AS VARCHAR) prvdr_cd,
 CASE WHEN c_custkey % 211 <> 0 THEN c_name END mrg_nm,
 lpad(CAST(c_custkey AS VARCHAR), 13, '0') mrg_ssn, c_custkey
FROM customer""",
    "person_file": """
SELECT * FROM person UNION ALL SELECT * FROM person WHERE c_custkey % 10 = 0""",
    "salt": """
SELECT DISTINCT ask_id, rshp_id, prvdr_cd, 'T' || right(ask_id, 1) || right(prvdr_cd, 1) ttp_id
FROM person WHERE prvdr_cd <> 'K0004'""",
    "hashed": """
SELECT ask_id, rshp_id, prvdr_cd, mrg_nm, mrg_ssn, ttp_id,
 upper(sha256(mrg_nm || mrg_ssn || ttp_id)) hash_did, c_custkey
FROM person JOIN salt USING (ask_id, rshp_id, prvdr_cd)""",
    "requested": """
SELECT ask_id, rshp_id, prvdr_cd,
 CASE WHEN ask_id = '2019-00004' THEN reverse(hash_did) ELSE hash_did END hash_did,
 CASE WHEN ask_id = '2019-00005' AND c_custkey % 9 = 0 THEN 'N' ELSE 'S' END trnsmrcv_cd
FROM hashed WHERE c_custkey % 3 = 0 AND hash_did IS NOT NULL""",
    "alternate": """
SELECT hash_did, 'ALT' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') alter_id,
 CAST(c_custkey % 15 AS VARCHAR) || '.5' rnd, c_custkey
FROM hashed WHERE c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 AND hash_did IS NOT NULL
UNION ALL
SELECT hash_did, 'ALU' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') alter_id,
 CAST(c_custkey % 15 AS VARCHAR) || '.5' rnd, c_custkey
FROM hashed
WHERE c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 AND hash_did IS NOT NULL AND c_custkey % 97 = 1""",
    "delivered": """
SELECT ask_id, rshp_id, prvdr_cd, mrg_nm, mrg_ssn, 'ORD' || right(prvdr_cd, 1) cat_cd, o_orderkey,
 CASE WHEN o_orderkey % 83 = 0 THEN '20210230' WHEN o_orderkey % 79 = 0 THEN ''
  ELSE strftime(o_orderdate, '%Y%m%d') END order_dt,
 CASE WHEN o_orderkey % 97 = 0 THEN 'x' WHEN o_orderkey % 89 = 0 THEN NULL
  ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END amt,
 o_orderpriority prio, o_orderstatus status,
 CAST(o_orderkey % 4 + 1 AS INTEGER) prsnt_pg_num, CAST(4 AS INTEGER) tot_pg_num,
 'IF_DL_50' || right(prvdr_cd, 1) || '_' || replace(ask_id, '-', '') || '_A0001_ORD'
  || right(prvdr_cd, 1) || '_' || CAST(o_orderkey % 4 + 1 AS VARCHAR) || '_4_20210226.txt' file_nm
FROM orders JOIN person ON o_custkey = c_custkey""",
    "keyed": """
SELECT d.ask_id, d.rshp_id, d.prvdr_cd, hash_did, cat_cd, o_orderkey, order_dt, amt, prio, status,
 prsnt_pg_num, tot_pg_num, file_nm
FROM delivered d JOIN hashed h USING (ask_id, rshp_id, prvdr_cd, mrg_nm, mrg_ssn)""",
    "register": """
SELECT '2019-' || lpad(CAST(o_custkey % 100000 AS VARCHAR), 5, '0') ask_id, 'A0001' rshp_id,
 'K000' || CAST(o_orderkey % 4 + 1 AS VARCHAR) prvdr_cd,
 CASE WHEN o_orderkey % 3 = 0 THEN 'HN17_ALL' ELSE 'TWJHC200' END cat_cd,
 CASE WHEN o_orderkey % 29 = 0 THEN 'bad_' || CAST(o_orderkey AS VARCHAR) || '.txt' ELSE
  'IF_DL_50' || CAST(CASE WHEN o_orderkey % 17 = 0 THEN 9 ELSE o_orderkey % 4 + 1 END AS VARCHAR)
  || '_2019' || lpad(CAST(o_custkey % 100000 AS VARCHAR), 5, '0') || '_A0001_'
  || CASE WHEN o_orderkey % 3 = 0 THEN 'HN17_ALL' ELSE 'TWJHC200' END
  || '_' || CAST(o_orderkey % 150 + 1 AS VARCHAR) || '_144_20210226'
  || CASE WHEN o_orderkey % 2 = 0 THEN '120000000' ELSE '' END || '.txt' END file_nm,
 CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END prcs_fail_yn, o_orderkey, o_custkey prnt_oid
FROM orders""",
    "catalog": f"""
SELECT {_SQL_DATASET}, p_partkey var_seq, p_partkey % 40 + 1 var_dscr_seq,
 'V' || CAST(p_partkey % 40 + 1 AS VARCHAR) var_dscr_nm,
 CASE WHEN p_partkey % 7 <> 0 THEN 'VC' || CAST(p_partkey AS VARCHAR) END var_cd,
 '1' req_var_tp_cd, '1' org_mrg_tp_cd
FROM part""",
    "standard": f"""
SELECT p_partkey var_seq, 'SV' || CAST(p_partkey AS VARCHAR) var_cd,
 CASE WHEN p_size % 2 = 0 THEN '{TEXT}' ELSE '{NUMBER}' END datatp,
 'K000' || CAST(p_partkey // 40 % 5 + 1 AS VARCHAR) prvdr_cd,
 'C' || CAST(p_partkey // 40 % 3 AS VARCHAR) cat_cd
FROM part WHERE p_partkey % 5 <> 0""",
    "known": "SELECT p_partkey var_seq FROM part WHERE p_partkey % 11 <> 0",
    "rule": f"""
SELECT {_SQL_DATASET}, p_partkey % 40 + 1 var_dscr_seq, '1' org_mrg_tp_cd, 1 exec_seq, {_SQL_RULE}
FROM part WHERE p_partkey % 3 <> 0
UNION ALL
SELECT {_SQL_DATASET}, p_partkey % 40 + 1 var_dscr_seq, '1' org_mrg_tp_cd, 2 exec_seq, {_SQL_RULE}
FROM part WHERE p_partkey % 4 = 0""",
    "catalog_before": f"""
SELECT * FROM catalog UNION ALL
SELECT {_SQL_DATASET}, CAST(NULL AS BIGINT), p_partkey % 40 + 1, 'OLD', 'OLD', '9', '2'
FROM part WHERE p_partkey % 40 < 3""",
    "summary_variable": f"""
WITH v AS (
 SELECT DISTINCT {", ".join("c." + c for c in DATASET.split(", "))}, c.var_seq, c.req_var_tp_cd,
  c.var_dscr_seq, s.var_cd
 FROM catalog c JOIN standard s USING (var_seq) JOIN known USING (var_seq)
  JOIN rule r ON c.ask_id = r.ask_id AND c.rshp_id = r.rshp_id AND c.prvdr_cd = r.prvdr_cd
   AND c.cat_cd = r.cat_cd AND c.var_dscr_seq = r.var_dscr_seq
 WHERE c.org_mrg_tp_cd = '1' AND di_set_val IS NOT NULL),
k AS (
 SELECT {DATASET}, var_seq, req_var_tp_cd, var_cd,
  CAST(rank() OVER (PARTITION BY {DATASET} ORDER BY var_seq) AS BIGINT) var_dscr_seq FROM v),
a AS (
 SELECT {DATASET}, var_seq, req_var_tp_cd, var_cd, var_dscr_seq FROM k
 UNION ALL
 SELECT {DATASET}, NULL, '2', 'CNT', CAST(max(var_dscr_seq) + 1 AS BIGINT) FROM k GROUP BY {DATASET})
SELECT {DATASET}, '2' org_mrg_tp_cd, var_seq, req_var_tp_cd, var_dscr_seq,
 CASE prvdr_cd WHEN 'K0001' THEN 'IF_DL_501' WHEN 'K0002' THEN 'IF_DL_502'
  WHEN 'K0003' THEN 'IF_DL_503' WHEN 'K0004' THEN 'IF_DL_504' ELSE 'IF_DL_500' END file_nm,
 'G' || CAST(var_dscr_seq AS VARCHAR) var_dscr_nm, var_cd
FROM a""",
    "summary_catalog": f"""
SELECT {DATASET}, var_seq, var_dscr_seq, var_dscr_nm, var_cd, req_var_tp_cd, org_mrg_tp_cd
FROM catalog_before b WHERE NOT EXISTS (
 SELECT 1 FROM summary_variable s WHERE s.ask_id = b.ask_id AND s.rshp_id = b.rshp_id
  AND s.prvdr_cd = b.prvdr_cd AND s.cat_cd = b.cat_cd AND s.var_dscr_seq = b.var_dscr_seq
  AND s.org_mrg_tp_cd = b.org_mrg_tp_cd)
UNION ALL
SELECT {DATASET}, var_seq, var_dscr_seq, var_dscr_nm, var_cd, req_var_tp_cd, org_mrg_tp_cd
FROM summary_variable""",
    "file_column": f"""
SELECT {_SQL_DATASET}, 'F' || CAST(p_partkey // 40 AS VARCHAR) || '.txt' file_nm, pos, m.var_cd
FROM part, (VALUES (1, 'ASK_ID'), (2, 'RSHP_ID'), (3, 'PRVDR_CD'), (4, 'HASH_DID'), (5, 'CAT_CD'))
 m(pos, var_cd) WHERE p_partkey % 40 = 0
UNION ALL
SELECT {_SQL_DATASET}, 'F' || CAST(p_partkey // 40 AS VARCHAR) || '.txt', p_partkey % 40 + 6,
 'VC' || CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey % 97 <> 0
UNION ALL
SELECT {_SQL_DATASET}, 'F' || CAST(p_partkey // 40 AS VARCHAR) || '.txt', 46, 'EXTRA'
FROM part WHERE p_partkey % 40 = 0 AND p_partkey // 40 % 5 = 0
UNION ALL
SELECT {_SQL_DATASET}, 'F' || CAST(p_partkey // 40 AS VARCHAR) || '.txt', 47,
 'VC' || CAST(p_partkey + 1 AS VARCHAR) FROM part WHERE p_partkey % 40 = 0 AND p_partkey // 40 % 7 = 0""",
    "catalog_column": f"""
SELECT {_SQL_DATASET}, 'VC' || CAST(p_partkey AS VARCHAR) var_cd
FROM part WHERE p_partkey // 40 % 11 <> 3""",
    "request": """
SELECT '2019-' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') requestid, 'A0001' hypoid,
 'K000' || CAST(c_nationkey % 4 + 1 AS VARCHAR) cnorgcode, '400' requeststatus, c_custkey originoid
FROM customer""",
    "batch": f"""
SELECT o_orderkey bt_seq, {_SQL_ASK}, 'A0001' rshp_id, o_orderkey % 3 + 1 exec_seq,
 {WORK} wk_dtl_tp_cd FROM orders""",
    "execution": f"""
SELECT l_orderkey bt_seq, l_linenumber + 10 * l_suppkey bt_exec_seq, {STATUS} wk_sts_cd,
 CASE WHEN l_linestatus = 'F' THEN 'Deid' ELSE 'Summary' END crt_pgm_id FROM lineitem""",
    "detail": f"""
SELECT l_orderkey bt_seq, CAST(l_linenumber AS BIGINT) bt_exec_seq, {STATUS} wk_exec_sts_cd,
 'out_' || CAST(l_partkey % 5 AS VARCHAR) wk_exec_cnts FROM lineitem""",
    "run_log": f"""
SELECT {_SQL_ASK}, 'A0001' rshp_id, o_orderkey % 3 + 1 exec_seq,
 'K000' || CAST(o_orderkey % 4 + 1 AS VARCHAR) prvdr_cd,
 'C' || CAST(o_orderkey % 5 AS VARCHAR) cat_cd, {WORK} di_wk_div_cnts,
 'out_' || CAST(o_orderkey % 5 AS VARCHAR) wk_exec_cnts FROM orders""",
    "chosen": f"""
SELECT DISTINCT {_SQL_ASK}, 'A0001' rshp_id, o_orderkey % 3 + 1 exec_seq,
 'K000' || CAST(o_orderkey % 4 + 1 AS VARCHAR) prvdr_cd,
 'C' || CAST(o_orderkey % 6 AS VARCHAR) cat_cd FROM orders""",
}

NEEDS = {
    "person_file": ("person",),
    "salt": ("person",),
    "hashed": ("person", "salt"),
    "requested": ("hashed",),
    "alternate": ("hashed",),
    "delivered": ("person",),
    "keyed": ("delivered", "hashed"),
    "catalog_before": ("catalog",),
    "summary_variable": ("catalog", "standard", "known", "rule"),
    "summary_catalog": ("catalog_before", "summary_variable"),
}
