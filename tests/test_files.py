"""Readers on flat files, including files that Spark cuts into several splits."""

import bz2
import gzip
import io
import zlib
from random import Random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from veilspark.sources import delimited, heads, repair
from veilspark.sources.sinks import write_delimited

META = "ASK_ID,RSHP_ID,PRVDR_CD,HASH_DID,CAT_CD"


def row(i, text="v"):
    return f"2019-00001,A0001,K0001,H{i},ORD,{text}{i}"


@pytest.fixture
def small_splits(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "400", "spark.sql.files.openCostInBytes": "0"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def put(folder, name, lines, encoding="utf-8"):
    (folder / name).write_bytes(("\n".join(lines) + "\n").encode(encoding))


def values(df, name="V"):
    return sorted(tuple(r) for r in df.select("file_nm", name).collect())


def test_headered(spark, tmp_path):
    put(tmp_path, "a.txt", ["ask_id,v", "1,x", "2,"])
    put(tmp_path, "b.txt", ["ask_id,v", "3,NA"])
    df = delimited.read_delimited(spark, str(tmp_path))
    assert df.columns == ["ASK_ID", "V", "file_nm"]
    assert {r.V for r in df.collect()} == {"x", None, "NA"}
    tokens = delimited.read_delimited(spark, str(tmp_path), missing="tokens")
    assert {r.V for r in tokens.collect()} == {"x", None}
    kept = delimited.read_delimited(spark, str(tmp_path), missing="keep")
    assert {r.V for r in kept.collect()} == {"x", "", "NA"}


def test_headers_have_to_agree(spark, tmp_path):
    put(tmp_path, "a.txt", ["a,b", "1,2"])
    put(tmp_path, "b.txt", ["b,a", "3,4"])
    with pytest.raises(Exception, match="(?i)header"):
        delimited.read_delimited(spark, str(tmp_path)).collect()
    named = delimited.read_delimited(spark, str(tmp_path), headers="by_name")
    assert sorted(map(tuple, named.collect())) == [("1", "2", "a.txt"), ("4", "3", "b.txt")]


@pytest.mark.parametrize("layout", ["headered", "preamble"])
@pytest.mark.parametrize("encoding", ["utf-8", "euc-kr"])
def test_columns_go_by_each_header(spark, tmp_path, layout, encoding):
    """Two orders of columns; a third file lacks one and has another instead."""
    before, after = (["t", "", ""], ["", "", "", "x"]) if layout == "preamble" else ([], [])
    put(tmp_path, "a.txt", [*before, "ASK,AMT,나이", *after, "1,60,2"], encoding)
    put(tmp_path, "b.txt", [*before, "ASK,나이,AMT", *after, "2,60,2"], encoding)
    read = lambda **more: delimited.read_delimited(
        spark, str(tmp_path), layout, encoding=encoding, headers="by_name", **more
    )
    assert sorted(tuple(r) for r in read().collect()) == [("1", "60", "2", "a.txt"), ("2", "2", "60", "b.txt")]
    put(tmp_path, "c.txt", [*before, "ASK,AMT,X", *after, "3,1,1"], encoding)
    with pytest.raises(ValueError, match="c.txt has no column 나이; has more columns: X"):
        read()
    left = read(on_width="fail_file")
    assert {r.file_nm for r in left.collect()} == {"a.txt", "b.txt"}
    faults = delimited.file_faults(spark, str(tmp_path), layout, encoding=encoding)
    assert {r.file_nm: r.status for r in faults.collect()} == {"a.txt": "002", "b.txt": "002", "c.txt": "902"}


@pytest.mark.parametrize("layout", ["headered", "headerless", "preamble"])
@pytest.mark.parametrize("line, kind", [("1,2,3", "n_wide"), ("1", "n_narrow"), ('1,"2', "n_open")])
def test_no_field_is_cut(spark, tmp_path, layout, line, kind):
    head = {"headered": ["a,b"], "headerless": [], "preamble": ["t", "", "", "a,b", "", "", "", ""]}[layout]
    put(tmp_path, "good.txt", [*head, "1,2", '"3,4",5', '"6""7",8', "9,"])
    put(tmp_path, "bad.txt", [*head, "1,2", line])
    columns = ["a", "b"]
    for headers in ("same", "by_name"):
        with pytest.raises(Exception, match="(?i)malformed|fields|line break"):
            delimited.read_delimited(spark, str(tmp_path), layout, columns, headers=headers).collect()
    rows = delimited.read_delimited(spark, str(tmp_path), layout, columns, on_width="fail_file").collect()
    assert {r.file_nm for r in rows} == {"good.txt"} and len(rows) == 4
    found = {r.file_nm: r for r in delimited.file_faults(spark, str(tmp_path), layout, columns).collect()}
    assert found["good.txt"].status == "002" and found["good.txt"].n_rows == 4
    assert found["bad.txt"].status == "902" and found["bad.txt"][kind] == 1


QUOTED = {
    '"dou""ble, x",1': ('dou"ble, x', "1"),
    '"dou""ble",1': ('dou"ble', "1"),
    '5" pipe,1': ('5" pipe', "1"),
    '"""all""",""': ('"all"', None),
    '1,"3"" nail"': ("1", '3" nail'),
    "back\\slash,\"a\\\"": ("back\\slash", "a\\"),
    'C:\\,"x, y"': ("C:\\", "x, y"),
    '1,"trailing "': ("1", "trailing "),
}
HEADS = {"headered": ["a,b"], "headerless": [], "preamble": ["t", "", "", "a,b", "", "", "", ""]}


@pytest.mark.parametrize("layout", HEADS)
@pytest.mark.parametrize("how", [{}, {"headers": "by_name"}, {"on_width": "fail_file"}, {"encoding": "auto"}, {"line_breaks": "read"}])
def test_quotes_are_read_as_csv_has_them(spark, tmp_path, layout, how):
    lines = [line for line in QUOTED if line.count('"') % 2 == 0 or "line_breaks" not in how]
    put(tmp_path, "a.txt", [*HEADS[layout], *lines])
    rows = delimited.read_delimited(spark, str(tmp_path), layout, ["a", "b"], **how).collect()
    assert sorted(tuple(r)[:2] for r in rows if r.B) + [tuple(r)[:2] for r in rows if not r.B] == sorted(
        QUOTED[line] for line in lines if QUOTED[line][1]
    ) + [QUOTED[line] for line in lines if not QUOTED[line][1]]
    faults = delimited.file_faults(spark, str(tmp_path), layout, ["a", "b"]).first()
    assert faults.status == "002" and faults.n_rows == len(lines)


@pytest.mark.parametrize("layout", HEADS)
@pytest.mark.parametrize("line", ['he said "hi, there" ok,1', '"a""b,c,d', '1,"open', '"x"y,z,1', ',,', '"a,b"'])
def test_wrong_lines_raise_whatever_is_selected(spark, tmp_path, layout, line):
    put(tmp_path, "a.txt", [*HEADS[layout], "1,2", line])
    for headers in ("same", "by_name") if layout == "headered" else ("same",):
        with pytest.raises(Exception, match="fields|line break"):
            delimited.read_delimited(spark, str(tmp_path), layout, ["a", "b"], headers=headers).select("B").collect()
    assert delimited.file_faults(spark, str(tmp_path), layout, ["a", "b"]).first().status == "902"


def test_cells_with_many_quotes(spark, tmp_path):
    """A regular expression over a cell would run out of stack."""
    long = '"' + '""' * 20_000 + ', "",' * 999 + '"'
    put(tmp_path, "a.txt", ["a,b", f"{long},1"])
    row = delimited.read_delimited(spark, str(tmp_path)).first()
    assert row.B == "1" and len(row.A) == 20_000 + 5 * 999 - 999


BROKEN = [("1", "one\ntwo"), ("2", 'say "x"\n\n, then, "y"'), ("3", None), ("4", "x" * 900 + "\n" * 400 + "z"), ("5", "a"), ("6", '\n"\n')]


def broken_lines(times: int) -> str:
    cell = lambda text: "" if text is None else '"' + text.replace('"', '""') + '"'
    return "".join(f"{key}-{n},{cell(text)}\n" for n in range(times) for key, text in BROKEN)


@pytest.mark.parametrize("layout", HEADS)
@pytest.mark.parametrize("encoding", ["utf-8", "auto"])
def test_line_breaks_over_many_splits(spark, tmp_path, small_splits, layout, encoding):
    """Splits of 400 bytes begin, end and lie within cells."""
    head = "".join(line + "\n" for line in HEADS[layout])
    for name, times in (("a.txt", 30), ("b.txt", 1)):
        (tmp_path / name).write_text(head + broken_lines(times))
    read = delimited.read_delimited(spark, str(tmp_path), layout, ["a", "b"], encoding, line_breaks="read")
    got = sorted((r.file_nm, r.A, r.B or "") for r in read.collect())
    assert got == sorted((name, f"{key}-{n}", text or "") for name, times in (("a.txt", 30), ("b.txt", 1)) for n in range(times) for key, text in BROKEN)
    if encoding == "utf-8":
        assert read.rdd.getNumPartitions() > 3
        faults = delimited.file_faults(spark, str(tmp_path), layout, ["a", "b"], line_breaks="read").collect()
        assert {(r.file_nm, r.status, r.n_rows) for r in faults} == {("a.txt", "002", 180), ("b.txt", "002", 6)}


def _joined_lines(splits, sizes):
    """What the joiner of lines makes of splits in batches of the given sizes, and in how many batches."""
    rows, inside = [], False
    for split, lines in enumerate(splits):
        rows += [(line.encode(), "f", split, split, i, inside) for i, line in enumerate(lines)]
        inside ^= sum(line.count('"') for line in lines) % 2 == 1
    names = ["value", "_path", "_split", "_id", "_line", "_inside"]
    table = pa.table({name: [row[i] for row in rows] for i, name in enumerate(names)})
    batches, at = [], 0
    for size in sizes:
        batches += table.slice(at, size).combine_chunks().to_batches()
        at += size
    assert at >= len(rows)
    made = list(delimited._line_joiner()(iter(batches)))
    return [(r["value"].decode(), r["_id"], r["_line"], r["_piece"]) for part in made for r in part.to_pylist()], len(made)


def test_lines_are_joined_by_batch_and_not_one_by_one():
    found, batches = _joined_lines([[line for i in range(500) for line in (f'{i},"a', f'b",{i}')]], [400, 400, 200])
    assert found == [(f'{i},"a\nb",{i}', 0, 2 * i, 0) for i in range(500)]
    assert batches == 3


def test_pieces_of_records_over_splits_and_batches():
    random = Random(3)
    for _ in range(300):
        splits = [[random.choice(["a", "", 'q"', '"p""', '""', '"']) for _ in range(random.randint(1, 6))] for _ in range(random.randint(1, 4))]
        want, inside = [], False
        for split, lines in enumerate(splits):
            held, piece = [], int(inside)
            for i, line in enumerate(lines):
                held.append((line, i))
                inside ^= line.count('"') % 2 == 1
                if not inside:
                    want.append(("\n".join(text for text, _ in held), split, held[0][1], piece))
                    held, piece = [], 0
            if held:
                want.append(("\n".join(text for text, _ in held), split, held[0][1], piece or 2))
        sizes = [random.randint(1, 5) for _ in range(sum(map(len, splits)))]
        assert _joined_lines(splits, sizes)[0] == want


def test_records_that_are_wrong_raise(spark, tmp_path, small_splits):
    for text in ('1,5" pipe\n2,3" nail\n3,x\n', '1,"never closed\n2,x\n', '1,"a\nb",c\n'):
        (tmp_path / "a.txt").write_text("a,b\n" + "0,plain\n" * 200 + text)
        with pytest.raises(Exception, match="fields|line break|quotes"):
            delimited.read_delimited(spark, str(tmp_path), line_breaks="read").collect()


def test_lone_quotes_join_no_lines_of_one_column(spark, tmp_path):
    """Two of them are an even number, and any lines are as wide as one."""
    put(tmp_path, "a.txt", ["a", "x", '5" pipe', "y", '3" nail', "z"])
    with pytest.raises(Exception, match="quotes are open"):
        delimited.read_delimited(spark, str(tmp_path), line_breaks="read").collect()
    assert delimited.file_faults(spark, str(tmp_path), line_breaks="read").first().status == "902"
    assert delimited.read_delimited(spark, str(tmp_path)).count() == 5


def test_inventory_of_records(spark, tmp_path, small_splits):
    (tmp_path / "a.txt").write_text("a,b\n" + broken_lines(20))
    row = delimited.file_inventory(spark, str(tmp_path), line_breaks="read").first()
    assert (row.datum_cnt, row.var_ea) == (120, 2)


def test_written_quotes_are_read_by_others(spark, tmp_path):
    import duckdb
    import pandas as pd

    cells = ['5" pipe', '"all"', 'a "b", c', "back\\slash", '\\"', " spaces ", "x,y", '""', "tab\t"]
    rows = spark.createDataFrame([("F.txt", str(i), cell) for i, cell in enumerate(cells)], "file_nm string, a string, b string")
    path = str(tmp_path / "out")
    write_delimited(rows.coalesce(1), path, "file_nm")
    want = sorted((str(i), cell) for i, cell in enumerate(cells))
    for headers in ("same", "by_name"):
        read = delimited.read_delimited(spark, path, headers=headers)
        assert sorted(tuple(r)[:2] for r in read.collect()) == want
    files = [str(f) for f in (tmp_path / "out").rglob("part-*.csv")]
    assert sorted(map(tuple, pd.concat(pd.read_csv(f, dtype=str) for f in files).values.tolist())) == want
    found = duckdb.sql(f"SELECT a, b FROM read_csv({files}, header = true, all_varchar = true, hive_partitioning = false, escape = '\"')").fetchall()
    assert sorted(found) == want
    assert delimited.file_faults(spark, path).first().status == "002"


@pytest.mark.parametrize("sep", ["|", ",", "||", "\t", "."])
def test_headers_are_read_by_one_rule(spark, tmp_path, sep):
    head = sep.join(['"ASK"', " amt ", f'"a{sep}b"', '"dou""ble"', ""])
    (tmp_path / "a.txt").write_bytes(("\ufeff" + head + "\n" + sep.join("12345") + "\n").encode())
    names = ["ASK", "AMT", f"A{sep}B".upper(), 'DOU"BLE', ""]
    rows = delimited.file_headers(spark, str(tmp_path), sep=sep).orderBy("pos").collect()
    assert [r.var_cd for r in rows] == names
    assert delimited.file_inventory(spark, str(tmp_path), sep=sep).first().var_ea == 5
    for how in ({}, {"headers": "by_name"}):
        assert delimited.read_delimited(spark, str(tmp_path), sep=sep, **how).columns[:4] == names[:4]


def test_more_headers_than_expected(spark, tmp_path):
    for i in range(4):
        names = ["a", "b", "c", "d"]
        put(tmp_path, f"{i}.txt", [",".join(names[i:] + names[:i]), "1,2,3,4"])
    with pytest.raises(ValueError, match="most_headers"):
        delimited.read_delimited(spark, str(tmp_path), headers="by_name", most_headers=3)
    assert delimited.read_delimited(spark, str(tmp_path), headers="by_name", most_headers=4).count() == 4


def test_auto_encoding_reads_the_source_once(spark, tmp_path):
    put(tmp_path, "a.txt", ["a,길", "1,2"], "euc-kr")
    df = delimited.read_delimited(spark, str(tmp_path), "headerless", ["a", "b"], encoding="auto")
    assert not any(name.endswith("a.txt") for name in df.inputFiles())  # but from the staged copy
    assert df.count() == 2


def test_line_breaks_in_cells(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.createDataFrame([("F.txt", "one\ntwo", 'say "x"'), ("F.txt", "a", "b")], "file_nm string, a string, b string")
    with pytest.raises(Exception, match="line break"):
        write_delimited(rows, path, "file_nm", mode="overwrite")
    write_delimited(rows, path, "file_nm", mode="overwrite", line_breaks="quote")
    with pytest.raises(Exception, match="line breaks within them take"):
        delimited.read_delimited(spark, path).collect()
    back = delimited.read_delimited(spark, path, line_breaks="read")
    assert {r.A for r in back.collect()} == {"one\ntwo", "a"}


@pytest.mark.parametrize("name", ["자료 1.txt", "a+b%20c.txt", "x#y[1].txt"])
@pytest.mark.parametrize("layout", ["headered", "auto", "preamble"])
def test_names_are_those_delivered(spark, tmp_path, name, layout):
    head = ["t", "", "", META + ",V", "", "", "", ""] if layout == "preamble" else [META + ",V"]
    put(tmp_path, name, [*head, row(1)])
    assert values(delimited.read_delimited(spark, str(tmp_path), layout)) == [(name, "v1")]
    assert delimited.file_inventory(spark, str(tmp_path)).first().file_nm == name


@pytest.mark.parametrize("name", ["자료 1.txt", "a+b%20c:d=e.txt"])
def test_names_of_files_of_parts(spark, tmp_path, name):
    path = str(tmp_path / "out")
    write_delimited(spark.createDataFrame([(name, "1")], "file_nm string, v string"), path, "file_nm")
    assert values(delimited.read_delimited(spark, path)) == [(name, "1")]


def test_files_are_replaced(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.createDataFrame([("a.txt", "1"), ("b.txt", "2")], "file_nm string, v string")
    for part in (rows, rows.filter("v = 1"), rows.filter("v = 1")):
        write_delimited(part, path, "file_nm", mode="replace")
    assert values(delimited.read_delimited(spark, path)) == [("a.txt", "1"), ("b.txt", "2")]


def test_auto_reads_the_lines_twice(spark, tmp_path):
    """Heads are found in one pass, which is stored; the rows come from one more."""
    put(tmp_path, "a.txt", [META + ",V", row(1)])
    df = delimited.read_delimited(spark, str(tmp_path), "auto")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [value") == 1


def test_preamble_over_many_splits(spark, tmp_path, small_splits):
    head = ["t", "t,t", "", META + ",V", "x", "x,x", "", "x"]
    want = []
    for name, size in (("a.txt", 300), ("b.txt", 40), ("c.txt", 1)):
        put(tmp_path, name, head + [row(i) for i in range(size)])
        want += [(name, f"v{i}") for i in range(size)]
    df = delimited.read_delimited(spark, str(tmp_path), "preamble")
    assert df.rdd.getNumPartitions() > 3
    assert df.columns == [*META.split(","), "V", "file_nm"]
    assert values(df) == sorted(want)


def test_data_like_the_preamble_is_kept(spark, tmp_path):
    head = ["t", "t,t", "", "A,B", "x", "x,x", "", "1,2"]
    put(tmp_path, "a.txt", [*head, "x,x", "A,B", "1,2"])
    df = delimited.read_delimited(spark, str(tmp_path), "preamble")
    assert sorted(tuple(r)[:2] for r in df.collect()) == [("1", "2"), ("A", "B"), ("x", "x")]


def test_layouts_are_told_apart(spark, tmp_path, small_splits):
    put(tmp_path, "a.txt", [META + ",v", *[row(i) for i in range(50)]])
    put(tmp_path, "b.txt", [row(i) for i in range(50)])
    put(tmp_path, "c.txt", ["t", "", "", META + ",V", "", "", "", "", *[row(i) for i in range(50)]])
    found = {r.file_nm: r.layout for r in delimited.detect_layouts(spark, str(tmp_path)).collect()}
    assert found == {"a.txt": "headered", "b.txt": "headerless", "c.txt": "preamble"}
    df = delimited.read_delimited(spark, str(tmp_path), "auto", columns=[*META.split(","), "V"])
    assert values(df) == sorted((n, f"v{i}") for n in ("a.txt", "b.txt", "c.txt") for i in range(50))


def test_short_data_needs_its_layout_named(spark, tmp_path):
    put(tmp_path, "a.txt", ["1,2"])
    assert delimited.detect_layouts(spark, str(tmp_path)).first().layout == "preamble"
    df = delimited.read_delimited(spark, str(tmp_path), "headerless", columns=["a", "b"])
    assert df.first()[:2] == ("1", "2")


@pytest.mark.parametrize("layout", ["headered", "headerless", "preamble"])
def test_encodings(spark, tmp_path, layout, small_splits):
    """The only line that is not UTF-8 is far behind; the whole file counts."""
    head = {"headered": ["id,이름"], "headerless": [], "preamble": ["t", "", "", "id,이름", "", "", "", ""]}
    lines = head[layout] + [f"{i},a" for i in range(200)] + ["200,홍길동"]
    put(tmp_path, "a.txt", lines, "euc-kr")
    before = spark.conf.get(delimited.LEGACY_CHARSETS)
    columns = ["id", "이름"]
    auto = delimited.read_delimited(spark, str(tmp_path), layout, columns, encoding="auto")
    named = delimited.read_delimited(spark, str(tmp_path), layout, columns, encoding="EUC-KR")
    assert spark.conf.get(delimited.LEGACY_CHARSETS) == before
    for df in (auto, named):
        assert df.columns == ["ID", "이름", "file_nm"]
        assert df.count() == 201
        assert df.filter("ID = '200'").first()["이름"] == "홍길동"
    assert delimited.detect_encoding(spark, str(tmp_path)).first().encoding == "EUC-KR"


def test_glob_picks_files(spark, tmp_path):
    put(tmp_path, "IF_DL_502_a.txt", ["a", "1"])
    put(tmp_path, "IF_DL_503_a.txt", ["a", "2"])
    df = delimited.read_delimited(spark, str(tmp_path), glob="IF_DL_502*")
    assert [r.A for r in df.collect()] == ["1"]


def test_inventory(spark, tmp_path, small_splits):
    put(tmp_path, "a.txt", ["a,b,c", *["1,2,3"] * 500])
    put(tmp_path, "b.txt", ["a"])
    got = {r.file_nm: tuple(r)[1:] for r in delimited.file_inventory(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": (6 + 6 * 500, 500, 3), "b.txt": (2, 0, 1)}


def test_inventory_needs_no_sort(spark, tmp_path):
    put(tmp_path, "a.txt", ["a,b", "1,2"])
    plan = delimited.file_inventory(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan


def test_delivered_file_may_have_many_parts(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(1000).selectExpr("concat('F', id % 3, '.txt') file_nm", "cast(id as string) v", "'' e")
    write_delimited(df, path, "file_nm", order=["v"])
    back = delimited.read_delimited(spark, path, missing="keep")
    assert values(back) == sorted((r.file_nm, r.v) for r in df.collect())
    rows = {r.file_nm: r.datum_cnt for r in delimited.file_inventory(spark, path).collect()}
    assert rows == {"F0.txt": 334, "F1.txt": 333, "F2.txt": 333}


def test_packed_keys(spark):
    key = "201800004A0001K0002" + "3E" * 32
    df = spark.createDataFrame([(key, "1", None)], "k string, v string, dummy string")
    out = repair.unpack_keys(repair.drop_dummy_last(df), dashed=False, dataset="D")
    assert out.columns == ["ask_id", "rshp_id", "prvdr_cd", "hash_did", "cat_cd", "v"]
    assert out.first() == ("2018-00004", "A0001", "K0002", "3E" * 32, "D", "1")
    dashed = spark.createDataFrame([("2018-00004A0001K0002" + "3E" * 32, "1")], "k string, v string")
    assert repair.unpack_keys(dashed, dashed=True).first()[:3] == ("2018-00004", "A0001", "K0002")


def test_parts_of_a_file_count_as_one(spark, tmp_path):
    """Encoding and layout are those of the delivered file, whichever part shows them."""
    folder = tmp_path / "file_nm=F.txt"
    folder.mkdir()
    put(folder, "part-0.txt", [META + ",v", row(1)])
    put(folder, "part-1.txt", [META + ",v", row(2, "길")], "euc-kr")
    path = str(tmp_path)
    assert [tuple(r) for r in delimited.detect_encoding(spark, path).collect()] == [("F.txt", "EUC-KR")]
    assert [tuple(r) for r in delimited.detect_layouts(spark, path).collect()] == [("F.txt", "headered")]
    assert delimited.file_headers(spark, path).count() == 6
    df = delimited.read_delimited(spark, path, encoding="auto")
    assert values(df) == [("F.txt", "v1"), ("F.txt", "길2")]
    assert delimited.file_inventory(spark, path).first().datum_cnt == 2


STARTS = {
    "a.txt": b"\xef\xbb\xbfone\r\ntwo\rthree\n\nfive\nsix",
    "b.txt": b"x" * 300_000 + b"\n" + "길".encode("euc-kr") + b"\r\n",
    "c d%+.txt": b"one\n",
    "e.txt": b"",
    "f.txt": b"\n",
    "g.txt.gz": gzip.compress(b"in\nside\n" + b"z\n" * 100_000),
    "h.txt.bz2": bz2.compress(b"in\nside"),
}


@pytest.mark.parametrize("other", [False, True])
def test_heads_are_those_of_the_lines(spark, tmp_path, other):
    for name, data in STARTS.items():
        (tmp_path / name).write_bytes(data)
    if other:
        (tmp_path / "i.txt.deflate").write_bytes(zlib.compress(b"in\nside\n"))
    found = heads.head_lines_by_range(spark, str(tmp_path), None, 4, {"file_nm": delimited.logical_file()})
    assert (found is None) == other
    if not other:
        lines = spark.read.text(str(tmp_path)).select(F.col("_metadata.file_path").alias("_path"), F.hex("value").alias("value"), F.monotonically_increasing_id().alias("n"))
        wanted = {}
        for line in lines.orderBy("n").collect():
            wanted.setdefault(line["_path"], []).append(line["value"])
        got = found.select("_path", F.transform("_lines", F.hex).alias("lines")).collect()
        assert {r["_path"]: r.lines for r in got} == {path: some[:4] for path, some in wanted.items()}
        assert {r.file_nm for r in found.collect()} == STARTS.keys() - {"e.txt"}
    layouts = {r.file_nm for r in delimited.detect_layouts(spark, str(tmp_path)).collect()}
    assert layouts == STARTS.keys() - {"e.txt"} | ({"i.txt.deflate"} if other else set())


def test_heads_read_little_of_a_file():
    file = io.BytesIO(b"name,value\n" * 1_000_000)
    assert heads._lines(file.read, 4) == [b"name,value"] * 4 and file.tell() <= heads.FIRST_READ
    assert heads.first_lines("nosuchstore://a/b.txt", 4) is None


@pytest.mark.parametrize("layout", ["preamble", "auto"])
def test_preambles_by_lines_and_by_range(spark, tmp_path, layout, small_splits):
    rows = ["t", "", "", META + ",V", "", "", "", "", *[row(i) for i in range(50)]]
    put(tmp_path, "a.txt", rows)
    put(tmp_path, "b.txt", rows)
    ranged = values(delimited.read_delimited(spark, str(tmp_path), layout, columns=[*META.split(","), "V"]))
    (tmp_path / "c.txt.deflate").write_bytes(zlib.compress("\n".join(rows).encode()))
    scanned = values(delimited.read_delimited(spark, str(tmp_path), layout, columns=[*META.split(","), "V"]))
    assert ranged == [(n, v) for n, v in scanned if n != "c.txt.deflate"] and len(ranged) == 100 and len(scanned) == 150
