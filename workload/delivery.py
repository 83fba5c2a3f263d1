"""Files as they are delivered: names, layouts, encodings, repairs.

Rows of the given tables are written as text in the layout in question and read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from veilspark.functions import names
from veilspark.operators import checks
from veilspark.sources import delimited, repair
from veilspark.sources.scratch import scratch_path
from veilspark.sources.sinks import deliver, write_delimited
from workload.registry import query
from workload.tables import Tables

_FIELDS = ["ask_id", "rshp_id", "prvdr_cd", "hash_did", "cat_cd", "o_orderkey", "order_dt", "amt", "prio"]
_ROW = """ask_id, rshp_id, prvdr_cd, hash_did, cat_cd, CAST(o_orderkey AS VARCHAR) o_orderkey,
 nullif(order_dt, '') order_dt, amt, prio, file_nm"""


def _lower(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def _data(t: Tables) -> DataFrame:
    return t.keyed.filter("hash_did IS NOT NULL").select(*_FIELDS, "file_nm")


def _line() -> F.Column:
    cells = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in _FIELDS]
    return F.concat_ws(",", *cells)


def _write_lines(lines: DataFrame, t: Tables, label: str) -> str:
    """Write `value` lines into one folder per `file_nm`.

    With `chunk` and `pos`, each chunk becomes a part of its own with lines in order, so
    no task writes more than the rows of a chunk.
    """
    path = scratch_path(t.spark, label)
    folders = ["file_nm"]
    if "pos" in lines.columns:
        folders.append("chunk")
        lines = lines.repartition(*folders).sortWithinPartitions(*folders, "pos").drop("pos")
    lines.write.partitionBy(*folders).text(path)
    return path


def _chunked(data: DataFrame) -> DataFrame:
    """Data lines with the part they go to and their place in it, behind any head."""
    return data.select(
        (F.col("o_orderkey") + 8).alias("pos"), _line().alias("value"), "file_nm", F.expr(_CHUNK)
    )


def _heads(data: DataFrame, lines: list[str]) -> DataFrame:
    """The same head lines for every part."""
    head = F.array(*[F.lit(text) for text in lines])
    parts = data.selectExpr("file_nm", _CHUNK).distinct()
    placed = parts.select(F.posexplode(head).alias("pos", "value"), "file_nm", "chunk")
    return placed.withColumn("pos", F.col("pos").cast("bigint"))


_CHUNK = "o_orderkey div 100000 AS chunk"
_KEPT = "FROM keyed WHERE hash_did IS NOT NULL"


@query(f"SELECT {_ROW} {_KEPT}", "keyed")
def read_headered(t: Tables) -> DataFrame:
    path = deliver(_data(t), "headered", "file_nm")
    return _lower(delimited.read_delimited(t.spark, path))


@query(f"SELECT {_ROW} {_KEPT}", "keyed")
def read_headerless(t: Tables) -> DataFrame:
    path = _write_lines(_data(t).select(_line().alias("value"), "file_nm"), t, "headerless")
    return _lower(delimited.read_delimited(t.spark, path, "headerless", columns=_FIELDS))


def _with_preamble(t: Tables) -> DataFrame:
    """Lines of files with the header on row 4 and data from row 9."""
    data = _data(t)
    head = ["title", "study,data", "", ",".join(_FIELDS), "text,text", "1,2", "a", "end"]
    return _heads(data, head).unionByName(_chunked(data))


@query(f"SELECT {_ROW} {_KEPT}", "keyed")
def read_preamble(t: Tables) -> DataFrame:
    path = _write_lines(_with_preamble(t), t, "preamble")
    return _lower(delimited.read_delimited(t.spark, path, "preamble"))


@query(f"SELECT {_ROW} {_KEPT}", "keyed")
def read_preamble_mixed_headers(t: Tables) -> DataFrame:
    """The second provider delivers its columns in another order."""
    data, names = _data(t), [*reversed(_FIELDS)]
    head = ["title", "study,data", "", ",".join(names), "text,text", "1,2", "a", "end"]
    other = data.filter("prvdr_cd = 'K0002'")
    cells = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in names]
    place = (F.col("o_orderkey") + 8).alias("pos")
    lines = other.select(place, F.concat_ws(",", *cells).alias("value"), "file_nm", F.expr(_CHUNK))
    first = _with_preamble(t).filter("file_nm NOT LIKE 'IF_DL_502%'")
    path = _write_lines(first.unionByName(_heads(other, head)).unionByName(lines), t, "headers")
    return _lower(delimited.read_delimited(t.spark, path, "preamble")).select(*_FIELDS, "file_nm")


@query(
    f"""
SELECT file_nm, count(*) n_rows,
 count(*) FILTER (WHERE o_orderkey % 10 = 0 AND prvdr_cd = 'K0003') n_wide,
 count(*) FILTER (WHERE o_orderkey % 10 = 1 AND prvdr_cd = 'K0002') n_narrow,
 CAST(0 AS BIGINT) n_open, CAST(NULL AS VARCHAR) header_fault,
 CASE WHEN count(*) FILTER (WHERE (o_orderkey % 10 = 0 AND prvdr_cd = 'K0003')
  OR (o_orderkey % 10 = 1 AND prvdr_cd = 'K0002')) > 0 THEN '902' ELSE '002' END status
{_KEPT} GROUP BY file_nm""",
    "keyed",
)
def read_wrong_width_report(t: Tables) -> DataFrame:
    """Some lines of two providers have a field more or less than the others."""
    more = F.when((F.col("o_orderkey") % 10 == 0) & (F.col("prvdr_cd") == "K0003"), F.concat(_line(), F.lit(",x")))
    less = (F.col("o_orderkey") % 10 == 1) & (F.col("prvdr_cd") == "K0002")
    line = F.when(less, F.regexp_replace(_line(), ",[^,]*$", "")).otherwise(F.coalesce(more, _line()))
    path = _write_lines(_data(t).select(line.alias("value"), "file_nm"), t, "widths")
    return delimited.file_faults(t.spark, path, "headerless", columns=_FIELDS)


@query(
    f"""
SELECT CAST(o_orderkey AS VARCHAR) o_orderkey, prio, '자료 ' || prvdr_cd || ' +1%.txt' file_nm {_KEPT}""",
    "keyed",
)
def read_spaced_file_names(t: Tables) -> DataFrame:
    name = F.concat(F.lit("자료 "), "prvdr_cd", F.lit(" +1%.txt")).alias("file_nm")
    path = deliver(_data(t).select("o_orderkey", "prio", name), "names", "file_nm")
    return _lower(delimited.read_delimited(t.spark, path))


@query(f"SELECT {_ROW} {_KEPT}", "keyed")
def read_any_layout(t: Tables) -> DataFrame:
    """Each provider delivers in another layout."""
    data = _data(t)
    titled = _heads(data.filter("prvdr_cd = 'K0001'"), [",".join(_FIELDS)])
    rows = _chunked(data.filter("prvdr_cd <> 'K0003'"))
    third = _with_preamble(t).filter("file_nm LIKE 'IF_DL_503%'")
    path = _write_lines(titled.unionByName(rows).unionByName(third), t, "layouts")
    return _lower(delimited.read_delimited(t.spark, path, "auto", columns=_FIELDS))


@query(
    f"""SELECT DISTINCT file_nm, CASE prvdr_cd WHEN 'K0001' THEN 'headered' WHEN 'K0002' THEN 'headerless'
ELSE 'preamble' END layout {_KEPT}""",
    "keyed",
)
def detect_layouts(t: Tables) -> DataFrame:
    data = _data(t)
    titled = _heads(data.filter("prvdr_cd = 'K0001'"), [",".join(_FIELDS)])
    headed = _heads(data.filter("prvdr_cd = 'K0003'"), ["title"])
    lines = titled.unionByName(headed).unionByName(_chunked(data))
    path = _write_lines(lines, t, "layout")
    return delimited.detect_layouts(t.spark, path)


def _encoded(t: Tables) -> DataFrame:
    """Lines with Korean text, encoded in EUC-KR for the second provider."""
    line = F.concat_ws(",", F.concat(F.lit("주문"), F.col("o_orderkey").cast("string")), "prio")
    setting = delimited.LEGACY_CHARSETS
    before = t.spark.conf.get(setting)
    t.spark.conf.set(setting, "true")
    try:
        foreign = F.encode(line, "EUC-KR").cast("string")
        value = F.when(F.col("prvdr_cd") == "K0002", foreign).otherwise(line)
        return _data(t).select(value.alias("value"), "file_nm")
    finally:
        t.spark.conf.set(setting, before)


@query(f"SELECT '주문' || CAST(o_orderkey AS VARCHAR) name, prio, file_nm {_KEPT}", "keyed")
def read_mixed_encodings(t: Tables) -> DataFrame:
    path = _write_lines(_encoded(t), t, "encoded")
    read = delimited.read_delimited(t.spark, path, "headerless", ["name", "prio"], encoding="auto")
    return _lower(read)


@query(
    f"SELECT DISTINCT file_nm, CASE prvdr_cd WHEN 'K0002' THEN 'EUC-KR' ELSE 'UTF-8' END encoding {_KEPT}",
    "keyed",
)
def detect_encoding(t: Tables) -> DataFrame:
    return delimited.detect_encoding(t.spark, _write_lines(_encoded(t), t, "encoding"))


@query(f"SELECT {_ROW} {_KEPT} AND prvdr_cd = 'K0002'", "keyed")
def read_by_name_prefix(t: Tables) -> DataFrame:
    path = deliver(_data(t), "prefix", "file_nm")
    return _lower(delimited.read_delimited(t.spark, f"{path}/file_nm=IF_DL_502_*"))


_NOTE = """CASE o_orderkey % 4 WHEN 0 THEN 'no "' || o_custkey || '", by clerk ' || o_orderstatus WHEN 1 THEN '"' || o_custkey || '"'
 WHEN 2 THEN NULL ELSE 'order of ' || o_custkey END"""
_NOTES = f"SELECT CAST(o_orderkey AS VARCHAR) o_orderkey, {_NOTE} note, o_orderstatus status, 'N' || o_custkey % 7 || '.txt' file_nm FROM orders"


def _notes(t: Tables) -> DataFrame:
    return t.given("orders").selectExpr("o_orderkey", f"{_NOTE} note", "o_orderstatus status", "concat('N', o_custkey % 7, '.txt') file_nm")


def _standard(*names: str) -> F.Column:
    """A line as other programs write it: quotes around every text that has them, doubled within."""
    cells = []
    for name in names:
        cell = F.coalesce(F.col(name).cast("string"), F.lit(""))
        needs = cell.rlike('[",\\n]')
        cells.append(F.when(needs, F.concat(F.lit('"'), F.replace(cell, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(cell))
    return F.concat_ws(",", *cells)


@query(_NOTES)
def read_doubled_quotes(t: Tables) -> DataFrame:
    """Fields with quotes and separators, in files without a header."""
    lines = _notes(t).select(_standard("o_orderkey", "note", "status").alias("value"), "file_nm")
    return _lower(delimited.read_delimited(t.spark, _write_lines(lines, t, "quotes"), "headerless", ["o_orderkey", "note", "status"]))


@query(_NOTES)
def write_quotes_round_trip(t: Tables) -> DataFrame:
    """Written as delivered files, read by the header."""
    return _lower(delimited.read_delimited(t.spark, deliver(_notes(t), "written", "file_nm")))


_BREAKS = f"SELECT o_orderkey, replace(note, ' ', chr(10)) note, status, file_nm FROM ({_NOTES})"


@query(_BREAKS)
def read_line_breaks_parallel(t: Tables) -> DataFrame:
    """Fields with line breaks, in files that several tasks read."""
    broken = _notes(t).withColumn("note", F.replace("note", F.lit(" "), F.lit("\n")))
    path = scratch_path(t.spark, "breaks")
    write_delimited(broken, path, "file_nm", line_breaks="quote")
    return _lower(delimited.read_delimited(t.spark, path, line_breaks="read"))


@query(
    """
WITH h(pos, var_cd) AS (VALUES (1, 'O_ORDERKEY'), (2, 'NOTE|TEXT'), (3, 'STATUS'))
SELECT f.file_nm, CAST(pos AS INTEGER) pos, var_cd
FROM (SELECT DISTINCT 'N' || o_custkey % 7 || '.txt' file_nm FROM orders) f, h"""
)
def file_headers_pipe(t: Tables) -> DataFrame:
    """Names in quotes, one with the separator in it."""
    files = _notes(t).select("file_nm").distinct()
    heads = files.select(F.posexplode(F.array(F.lit('"o_orderkey"|"Note|text"|status'), F.lit("1|a|O"))).alias("pos", "value"), "file_nm", F.lit(0).alias("chunk"))
    return delimited.file_headers(t.spark, _write_lines(heads, t, "pipes"), sep="|")


@query(
    """
SELECT CAST(o_orderkey AS VARCHAR) o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END status
FROM orders"""
)
def read_null_tokens(t: Tables) -> DataFrame:
    rows = t.given("orders").selectExpr(
        "o_orderkey", "case when o_orderstatus = 'P' then 'NA' else o_orderstatus end status"
    )
    read = delimited.read_delimited(t.spark, deliver(rows, "tokens"), missing="tokens")
    return _lower(read).drop("file_nm")


@query(
    f"SELECT CAST(o_orderkey AS VARCHAR) o_orderkey, coalesce(order_dt, '') order_dt, coalesce(amt, '') amt {_KEPT}",
    "keyed",
)
def read_empty_as_text(t: Tables) -> DataFrame:
    rows = _data(t).select("o_orderkey", "order_dt", "amt")
    read = delimited.read_delimited(t.spark, deliver(rows, "empty"), missing="keep")
    return _lower(read).drop("file_nm")


_PACKED = """
SELECT ask_id, rshp_id, prvdr_cd, hash_did, 'TWJHC200' cat_cd, prio, status FROM keyed WHERE hash_did IS NOT NULL"""


def _packed(t: Tables, dashed: bool) -> DataFrame:
    """Packed key, values, and a comma at the end of the line."""
    study = F.col("ask_id") if dashed else F.replace("ask_id", F.lit("-"), F.lit(""))
    packed = F.concat(study, "rshp_id", "prvdr_cd", "hash_did")
    rows = t.keyed.filter("hash_did IS NOT NULL")
    return rows.select(F.concat_ws(",", packed, "prio", "status", F.lit("")).alias("value"), "file_nm")


def _unpacked(t: Tables, dashed: bool) -> DataFrame:
    path = _write_lines(_packed(t, dashed), t, "packed")
    columns = ["all_id", "prio", "status", "dummy"]
    read = delimited.read_delimited(t.spark, path, "headerless", columns).drop("file_nm")
    return _lower(repair.unpack_keys(repair.drop_dummy_last(read), dashed, "TWJHC200"))


@query(_PACKED, "keyed")
def unpack_keys(t: Tables) -> DataFrame:
    return _unpacked(t, dashed=False)


@query(_PACKED, "keyed")
def unpack_dashed_keys(t: Tables) -> DataFrame:
    return _unpacked(t, dashed=True)


@query("SELECT ask_id, rshp_id, prvdr_cd, hash_did, 'HN17' cat_cd, amt FROM keyed", "keyed")
def repair_key_columns(t: Tables) -> DataFrame:
    plain = t.keyed.select(
        F.replace("ask_id", F.lit("-"), F.lit("")).alias("ask_id"), "rshp_id", "prvdr_cd",
        "hash_did", "amt", F.lit(None).cast("string").alias("dummy"),
    )
    return repair.add_dataset_column(repair.drop_dummy_last(repair.dash_ask_id(plain)), "HN17")


_PATTERN = r"'^IF_DL_(\d{3})_(\d{4})([0-9A-Za-z]{5})_([A-Z]\d{4})_(.+)_(\d+)_(\d+)_(\d{8})\d*\.txt$'"
_PARSED = f"""
p AS (SELECT *, regexp_matches(file_nm, {_PATTERN}) ok,
 regexp_extract(file_nm, {_PATTERN}, 1) i, regexp_extract(file_nm, {_PATTERN}, 2) || '-'
  || regexp_extract(file_nm, {_PATTERN}, 3) a, regexp_extract(file_nm, {_PATTERN}, 4) h,
 regexp_extract(file_nm, {_PATTERN}, 5) c, TRY_CAST(regexp_extract(file_nm, {_PATTERN}, 6) AS INTEGER) p,
 TRY_CAST(regexp_extract(file_nm, {_PATTERN}, 7) AS INTEGER) t, regexp_extract(file_nm, {_PATTERN}, 8) y
 FROM register)"""


@query(
    f"""WITH {_PARSED}
SELECT o_orderkey, CASE WHEN ok THEN i END interface, CASE WHEN ok THEN a END parsed_ask_id,
 CASE WHEN ok THEN h END parsed_rshp_id, CASE WHEN ok THEN c END parsed_cat_cd,
 CASE WHEN ok THEN p END page, CASE WHEN ok THEN t END total, CASE WHEN ok THEN y END ymd
FROM p""",
    "register",
)
def parse_file_names(t: Tables) -> DataFrame:
    parts = t.register.select("o_orderkey", names.parse_file_name(F.col("file_nm")).alias("p"))
    return parts.select("o_orderkey", "p.*").withColumnsRenamed(
        {name: f"parsed_{name}" for name in ("ask_id", "rshp_id", "cat_cd")}
    )


@query(
    f"""WITH {_PARSED},
v AS (SELECT o_orderkey, file_nm, ok AND i = '50' || right(prvdr_cd, 1) interface_ok, ok AND a = ask_id ask_ok,
 ok AND h = rshp_id rshp_ok, ok AND c = cat_cd cat_ok, ok AND p <= t page_ok FROM p),
w AS (SELECT o_orderkey, file_nm, coalesce(interface_ok, FALSE) interface_ok, coalesce(ask_ok, FALSE) ask_ok,
 coalesce(rshp_ok, FALSE) rshp_ok, coalesce(cat_ok, FALSE) cat_ok, coalesce(page_ok, FALSE) page_ok FROM v)
SELECT *, interface_ok AND ask_ok AND rshp_ok AND cat_ok AND page_ok valid FROM w""",
    "register",
)
def check_file_names(t: Tables) -> DataFrame:
    checked = checks.check_file_names(t.register)
    return checked.drop("ask_id", "rshp_id", "prvdr_cd", "cat_cd", "prcs_fail_yn", "prnt_oid")


_HEAD = "replace(a, '-', '') || '_' || h || '_' || 'C1'"
_TAIL = "CAST(p AS VARCHAR) || '_' || CAST(t AS VARCHAR) || '_' || y || '.txt'"


@query(
    f"""WITH {_PARSED}
SELECT o_orderkey,
 'IF_DL_30' || right(prvdr_cd, 1) || '_' || file_nm key_nm,
 CASE WHEN ok THEN 'IF_DL_' || i || '_' || {_HEAD} || '_' || {_TAIL} END provider_nm,
 file_nm original_nm,
 CASE WHEN ok THEN 'IF_DL_' || CASE prvdr_cd WHEN 'K0001' THEN '801' ELSE '802' END || '_' || {_HEAD}
  || '_' || {_TAIL} END deid_nm,
 CASE WHEN ok THEN 'IF_DL_50' || right(prvdr_cd, 1) || '_' || {_HEAD} || '_S_' || {_TAIL} END summary_nm,
 CASE WHEN ok THEN 'IF_DL_' || CASE prvdr_cd WHEN 'K0001' THEN '801' ELSE '802' END || '_' || {_HEAD}
  || '_S_' || CAST(o_orderkey % 9 AS VARCHAR) || '_' || {_TAIL} END deid_summary_nm
FROM p""",
    "register",
)
def output_names(t: Tables) -> DataFrame:
    run = F.col("o_orderkey") % 9
    file, provider, dataset = F.col("file_nm"), F.col("prvdr_cd"), F.lit("C1")
    stages = ("key", "provider", "original", "deid", "summary", "deid_summary")
    return t.register.select(
        "o_orderkey",
        *[names.output_name(file, s, provider, dataset, run).alias(f"{s}_nm") for s in stages],
    )


@query(
    """
SELECT c_custkey, 'IF_DL_30' || CAST(n AS VARCHAR) key_id, 'IF_DL_50' || CAST(n AS VARCHAR) data_id,
 CASE n WHEN 1 THEN 'IF_DL_801' ELSE 'IF_DL_802' END deid_id
FROM (SELECT c_custkey, c_nationkey % 4 + 1 n FROM customer)"""
)
def interface_ids(t: Tables) -> DataFrame:
    provider = F.concat(F.lit("K000"), (F.col("c_nationkey") % 4 + 1).cast("string"))
    return t.given("customer").select(
        "c_custkey",
        *[names.interface_id(provider, stage).alias(f"{stage}_id") for stage in ("key", "data", "deid")],
    )


@query(
    f"""
WITH h(var_cd, pos) AS (VALUES {", ".join(f"('{name.upper()}', {i})" for i, name in enumerate(_FIELDS, 1))})
SELECT f.file_nm, CAST(pos AS INTEGER) pos, var_cd FROM (SELECT DISTINCT file_nm {_KEPT}) f, h""",
    "keyed",
)
def file_headers(t: Tables) -> DataFrame:
    path = deliver(_data(t), "headers", "file_nm")
    return delimited.file_headers(t.spark, path)
