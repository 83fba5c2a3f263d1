"""Cells and rows: parsing, rules, reports, frequency tables, long form."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from veilspark.functions import parsing
from veilspark.operators.linkage import attach_hash, hash_persons, swap_key
from veilspark.operators.rules import (
    Rule,
    apply_rules,
    bin_numbers,
    deid_report,
    map_codes,
    mask_text,
    shift_dates,
    truncate_dates,
)
from veilspark.operators.summary import (
    Variable,
    deidentified_table,
    frequency_table,
    ordinal,
    roll_up,
    to_eav,
)
from veilspark.plans.deidentify import deidentify
from veilspark.plans.summarise import summarise
from workload.registry import query
from workload.tables import Tables

RULES = [
    Rule.parse("amt", "Int64->floor(x / 50000) * 50000"),
    Rule.parse("order_dt", "date->trunc(x, 'YEAR')"),
    Rule.parse("prio", "string->substring(x, 1, 1)"),
]
META = ["ask_id", "rshp_id", "prvdr_cd", "cat_cd"]
PAGES = ["prsnt_pg_num", "tot_pg_num"]
NAMES = ["order_dt", "amt", "prio", "status"]
VARIABLES = [
    Variable(1, "order_dt", False),
    Variable(2, "amt", True),
    Variable(3, "prio", False),
    Variable(4, "status", False),
]
_M = ", ".join(META + PAGES)
_N = ", ".join(NAMES)

# Parsed and changed cells: na, nd, np.
_NEW = r"""
SELECT *, CASE WHEN regexp_matches(amt, '^\s*[+-]?\d+\s*$')
  THEN CAST(TRY_CAST(amt AS BIGINT) // 50000 * 50000 AS VARCHAR) END na,
 CASE WHEN regexp_matches(order_dt, '^\d{8}$')
  THEN strftime(date_trunc('year', try_strptime(order_dt, '%Y%m%d')), '%Y%m%d') END nd,
 substr(prio, 1, 1) np"""


def _sql_new(source: str) -> str:
    return f"n AS ({_NEW} FROM {source})"


# Texts of every kind a number or date may take, made from the rows themselves.
_EDGE = """CASE l_linenumber WHEN 1 THEN {q} WHEN 2 THEN concat('  ', {q}, ' ')
 WHEN 3 THEN concat('+', {q}, '.0') WHEN 4 THEN concat({q}, 'd') WHEN 5 THEN concat('-', {q}, '.5')
 WHEN 6 THEN concat({q}, 'e2') ELSE concat({q}, ',000') END"""
_NUM = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


@query(
    rf"""
WITH c AS (SELECT l_orderkey, l_linenumber,
 {_EDGE.format(q="CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)")} cell FROM lineitem)
SELECT l_orderkey, l_linenumber, cell,
 CASE WHEN regexp_matches(cell, '^\s*[+-]?\d+\s*$') THEN TRY_CAST(trim(cell) AS BIGINT)
  WHEN regexp_matches(cell, '{_NUM}') AND TRY_CAST(trim(cell) AS DOUBLE) = floor(TRY_CAST(trim(cell) AS DOUBLE))
  THEN CAST(TRY_CAST(trim(cell) AS DOUBLE) AS BIGINT) END as_int,
 CASE WHEN regexp_matches(cell, '{_NUM}') THEN TRY_CAST(trim(cell) AS DOUBLE) END as_float
FROM c"""
)
def parse_numbers(t: Tables) -> DataFrame:
    cell = F.expr(_EDGE.format(q="cast(cast(l_quantity as bigint) as string)"))
    return t.given("lineitem").select("l_orderkey", "l_linenumber", cell.alias("cell")).select(
        "*",
        F.expr(parsing.int_sql("cell")).alias("as_int"),
        F.expr(parsing.float_sql("cell")).alias("as_float"),
    )


@query(
    r"""
SELECT o_orderkey, order_dt, CASE WHEN regexp_matches(order_dt, '^\d{8}$')
 THEN strftime(try_strptime(order_dt, '%Y%m%d'), '%Y-%m-%d') END iso_day
FROM delivered""",
    "delivered",
)
def parse_dates(t: Tables) -> DataFrame:
    day = F.expr(parsing.date_sql("order_dt"))
    return t.delivered.select("o_orderkey", "order_dt", F.date_format(day, "yyyy-MM-dd").alias("iso_day"))


@query(
    r"""
SELECT o_orderkey, CASE WHEN regexp_matches(order_dt, '^\d{8}$')
  AND try_strptime(order_dt, '%Y%m%d') IS NOT NULL
 THEN strftime(CAST(try_strptime(order_dt, '%Y%m%d') AS DATE) + CAST(floor(o_orderkey % 31 - 15.5) AS INTEGER), '%Y%m%d')
 WHEN order_dt = '0' THEN '00000000' ELSE '' END moved
FROM delivered""",
    "delivered",
)
def shift_date_cells(t: Tables) -> DataFrame:
    moved = parsing.shift_sql("order_dt", "o_orderkey % 31 - 15.5")
    return t.delivered.select("o_orderkey", F.expr(moved).alias("moved"))


_CELLS = ["o_orderkey", "order_dt", "amt", "prio", "status"]


@query(
    f"WITH {_sql_new('delivered')} SELECT o_orderkey, nd order_dt, na amt, np prio, status FROM n",
    "delivered",
)
def apply_rules_suppress(t: Tables) -> DataFrame:
    return apply_rules(t.delivered.select(*_CELLS), RULES)


@query(
    f"""WITH {_sql_new('delivered')}
SELECT o_orderkey, coalesce(nd, order_dt) order_dt, coalesce(na, amt) amt, np prio, status FROM n""",
    "delivered",
)
def apply_rules_keep(t: Tables) -> DataFrame:
    return apply_rules(t.delivered.select(*_CELLS), RULES, on_invalid="keep")


@query(
    f"""
SELECT o_orderkey, strftime(date_trunc('quarter', o_orderdate), '%Y%m%d') quarter_dt,
 left(o_orderpriority, 3) || repeat('*', greatest(length(o_orderpriority) - 3, 0)) masked,
 CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'P' THEN 'open' ELSE 'other' END state,
 CAST(CAST(floor(o_totalprice / 1000) * 1000 AS BIGINT) AS VARCHAR) price
FROM orders"""
)
def rule_helpers(t: Tables) -> DataFrame:
    rows = t.given("orders").selectExpr(
        "o_orderkey", "date_format(o_orderdate, 'yyyyMMdd') quarter_dt", "o_orderpriority masked",
        "o_orderstatus state", "cast(o_totalprice as string) price",
    )
    rules = [
        truncate_dates("quarter_dt", "QUARTER"),
        mask_text("masked", 3),
        map_codes("state", {"F": "closed", "P": "open"}, otherwise="other"),
        bin_numbers("price", 1000, kind="float"),
    ]
    return apply_rules(rows, rules)


@query(
    """
SELECT o_orderkey, CAST(o_orderkey + 10000000 AS VARCHAR) || '.75' price,
 '0.0000' || CAST(o_orderkey % 9 + 1 AS VARCHAR) ratio FROM orders"""
)
def rule_decimals(t: Tables) -> DataFrame:
    """Large prices with cents and small ratios stay plain decimals."""
    rows = t.given("orders").selectExpr(
        "o_orderkey", "concat(o_orderkey + 10000000, '.25') price", "concat('0.0000', o_orderkey % 9 + 1) ratio"
    )
    return apply_rules(rows, [Rule.parse("price", "float->x + 0.5"), Rule.parse("ratio", "float->x")])


@query(
    f"""WITH {_sql_new('delivered')},
c AS (SELECT file_nm, 'amt' var_cd, amt raw, na new FROM n UNION ALL
 SELECT file_nm, 'order_dt', order_dt, nd FROM n UNION ALL SELECT file_nm, 'prio', prio, np FROM n),
r AS (SELECT file_nm, var_cd, count(*) - count(raw) n_null, count(raw) - count(new) n_failed,
 count(new) n_done FROM c GROUP BY ALL)
SELECT *, CASE WHEN n_null + n_failed = 0 THEN '002' ELSE '003' END status FROM r""",
    "delivered",
)
def deid_report_by_file(t: Tables) -> DataFrame:
    return deid_report(t.delivered, RULES, by=["file_nm"])


_SWAP = """
s AS (SELECT ask_id, rshp_id, prvdr_cd, alter_id, cat_cd, o_orderkey, order_dt, amt, prio, status,
  prsnt_pg_num, tot_pg_num, file_nm, rnd
 FROM keyed LEFT JOIN (SELECT DISTINCT hash_did, alter_id, rnd FROM alternate) USING (hash_did)),
g AS (SELECT s.* FROM s WHERE file_nm IN (SELECT file_nm FROM s GROUP BY file_nm HAVING count(alter_id) > 0))"""


@query(
    f"""WITH {_SWAP}, {_sql_new('g')}
SELECT ask_id, rshp_id, prvdr_cd, alter_id, cat_cd, o_orderkey, nd order_dt, na amt, np prio, status,
 prsnt_pg_num, tot_pg_num, file_nm FROM n""",
    "keyed alternate",
)
def deidentify_dataset(t: Tables) -> DataFrame:
    return deidentify(t.keyed, t.alternate, RULES).rows


@query(
    rf"""WITH {_SWAP}
SELECT ask_id, rshp_id, prvdr_cd, alter_id, cat_cd, o_orderkey,
 CASE WHEN regexp_matches(order_dt, '^\d{{8}}$') THEN strftime(CAST(try_strptime(order_dt, '%Y%m%d') AS DATE)
  + CAST(floor(CAST(rnd AS DOUBLE)) AS INTEGER), '%Y%m%d') END order_dt,
 amt, prio, status, prsnt_pg_num, tot_pg_num, file_nm FROM g""",
    "keyed alternate",
)
def deidentify_shifted_dates(t: Tables) -> DataFrame:
    rules = [shift_dates("order_dt", "rnd")]
    return deidentify(t.keyed, t.alternate, rules, shift="rnd").rows


# Frequency tables


_FREQ = f"f AS (SELECT {_M}, {_N}, count(*) cnt FROM keyed GROUP BY ALL)"
_DEID = f"""{_FREQ}, {_sql_new('f')},
df AS (SELECT {_M}, nd order_dt, na amt, np prio, status, CAST(sum(cnt) AS BIGINT) cnt FROM n GROUP BY ALL)"""


@query(f"WITH {_FREQ} SELECT * FROM f", "keyed")
def frequency_by_page(t: Tables) -> DataFrame:
    return frequency_table(t.keyed, [*META, *PAGES, *NAMES])


@query(f"SELECT {', '.join(META)}, {_N}, count(*) cnt FROM keyed GROUP BY ALL", "keyed")
def frequency_rolled_up(t: Tables) -> DataFrame:
    return roll_up(frequency_table(t.keyed, [*META, *PAGES, *NAMES]), [*META, *NAMES])


@query(f"WITH {_DEID} SELECT * FROM df", "keyed")
def frequency_deidentified(t: Tables) -> DataFrame:
    return deidentified_table(frequency_table(t.keyed, [*META, *PAGES, *NAMES]), RULES)


@query(
    """
WITH d AS (SELECT DISTINCT o_custkey, o_orderdate, o_orderkey FROM orders)
SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y%m%d') order_dt,
 CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS BIGINT) datum_seq
FROM d"""
)
def ordinal_within_group(t: Tables) -> DataFrame:
    rows = t.given("orders").select("o_custkey", "o_orderdate", "o_orderkey").distinct()
    numbered = ordinal(rows, ["o_orderdate", "o_orderkey"], within=["o_custkey"])
    order_dt = F.date_format("o_orderdate", "yyyyMMdd").alias("order_dt")
    return numbered.select("o_custkey", "o_orderkey", order_dt, "datum_seq")


@query(
    """
SELECT l_orderkey, l_partkey, cnt,
 CAST(row_number() OVER (ORDER BY l_orderkey, l_partkey) AS BIGINT) datum_seq
FROM (SELECT l_orderkey, l_partkey, count(*) cnt FROM lineitem GROUP BY ALL)"""
)
def ordinal_whole_table(t: Tables) -> DataFrame:
    groups = frequency_table(t.given("lineitem"), ["l_orderkey", "l_partkey"])
    return ordinal(groups, ["l_orderkey", "l_partkey"])


_EAV = """
e AS (SELECT {m}, CAST(row_number() OVER (PARTITION BY {m}
 ORDER BY order_dt NULLS FIRST, amt NULLS FIRST, prio NULLS FIRST, status NULLS FIRST) AS BIGINT) datum_seq,
 {n}, cnt FROM {source})
SELECT {m}, datum_seq, CAST(1 AS INTEGER) var_dscr_seq, coalesce(order_dt, '') str_datatp_val,
 CAST(NULL AS DOUBLE) num_datatp_val FROM e
UNION ALL SELECT {m}, datum_seq, 2, NULL, TRY_CAST(amt AS DOUBLE) FROM e
UNION ALL SELECT {m}, datum_seq, 3, coalesce(prio, ''), NULL FROM e
UNION ALL SELECT {m}, datum_seq, 4, coalesce(status, ''), NULL FROM e
UNION ALL SELECT {m}, datum_seq, 5, NULL, CAST(cnt AS DOUBLE) FROM e"""


@query(f"WITH {_FREQ}, {_EAV.format(m=_M, n=_N, source='f')}", "keyed")
def summary_eav_original(t: Tables) -> DataFrame:
    return summarise(t.keyed, RULES, VARIABLES, 5).original_eav()


@query(f"WITH {_DEID}, {_EAV.format(m=_M, n=_N, source='df')}", "keyed")
def summary_eav_deidentified(t: Tables) -> DataFrame:
    return summarise(t.keyed, RULES, VARIABLES, 5).deidentified_eav()


@query(
    """
WITH f AS (SELECT p_brand, p_type, p_size, count(*) cnt FROM part GROUP BY ALL)
SELECT p_brand, 1 var_dscr_seq, p_type str_datatp_val, CAST(NULL AS DOUBLE) num_datatp_val FROM f
UNION ALL SELECT p_brand, 2, NULL, CAST(p_size AS DOUBLE) FROM f
UNION ALL SELECT p_brand, 3, NULL, CAST(cnt AS DOUBLE) FROM f"""
)
def unpivot_to_eav(t: Tables) -> DataFrame:
    table = frequency_table(t.given("part"), ["p_brand", "p_type", "p_size"])
    variables = [Variable(1, "p_type", False), Variable(2, "p_size", True)]
    return to_eav(table, variables, ["p_brand"], cnt_seq=3)


@query(
    f"""WITH {_SWAP}, {_sql_new('g')}
SELECT {', '.join(META)}, nd order_dt, na amt, np prio, count(*) cnt FROM n GROUP BY ALL""",
    "keyed alternate",
)
def study_summary(t: Tables) -> DataFrame:
    """The whole chain: hash, attach, swap, de-identify, count."""
    hashed = hash_persons(t.person_file, t.salt)
    keyed = attach_hash(t.delivered, hashed)
    published = deidentify(keyed, t.alternate, RULES).rows
    return frequency_table(published, [*META, "order_dt", "amt", "prio"])


@query(
    """
SELECT o_orderkey, alter_id FROM keyed
JOIN (SELECT DISTINCT hash_did, alter_id, rnd FROM alternate) USING (hash_did) WHERE rnd <> '0.5'""",
    "keyed alternate",
)
def swap_key_with_shift(t: Tables) -> DataFrame:
    swapped = swap_key(t.keyed, t.alternate, how="inner", keep=["rnd"])
    return swapped.filter(F.col("rnd") != "0.5").select("o_orderkey", "alter_id")
