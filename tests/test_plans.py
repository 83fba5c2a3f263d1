"""The jobs on small literal studies."""

import hashlib

import pytest
from pyspark.sql import Window, functions as F

from veilspark.operators import catalog, linkage, status, summary
from veilspark.operators.inventory import expected_outputs, merge_inventory, outputs_of_rows
from veilspark.operators.rules import Rule, RuleError
from veilspark.operators.summary import Variable
from veilspark.plans import batch
from veilspark.plans.deidentify import deidentify
from veilspark.plans.linkage import attach_job, hash_job, match_job, store_hashed
from veilspark.plans.publish import inventory_job, release_job
from veilspark.plans.summarise import summarise
from veilspark.sources import manifest
from veilspark.sources.delimited import read_delimited
from veilspark.sources.scratch import materialise
from veilspark.sources.sinks import write_delimited

STUDY = ("2019-00001", "A0001")
PERSON = "ask_id string, rshp_id string, prvdr_cd string, mrg_nm string, mrg_ssn string"


@pytest.fixture
def persons(spark):
    people = [("kim", "1"), ("kim", "1"), ("lee", "2"), (None, "3"), ("park", "4")]
    rows = [(*STUDY, "K0001", *p) for p in people] + [(*STUDY, "K0009", "choi", "5")]
    return spark.createDataFrame(rows, PERSON)


@pytest.fixture
def salts(spark):
    return spark.createDataFrame(
        [(*STUDY, "K0001", "T")], "ask_id string, rshp_id string, prvdr_cd string, ttp_id string"
    )


def key(text):
    return hashlib.sha256(text.encode()).hexdigest().upper()


def test_hash_job(persons, salts):
    job = hash_job(persons, salts)
    hashed = {row.mrg_ssn: row.hash_did for row in job.persons.collect()}
    assert hashed == {"1": key("kim1T"), "2": key("lee2T"), "3": None, "4": key("park4T")}
    assert job.persons.count() == 4
    assert [row.prvdr_cd for row in job.unsalted.collect()] == ["K0009"]
    assert job.unhashable.first().n_unhashable == 1
    assert job.key_file.columns == ["ask_id", "rshp_id", "prvdr_cd", "hash_did"]
    as_text = linkage.hash_persons(persons, salts, null_text="nan")
    assert as_text.filter("mrg_ssn = '3'").first().hash_did == key("nan3T")


def test_stored_persons_are_replaced_per_study(spark, persons, salts, tmp_path):
    path = str(tmp_path / "persons")
    other = persons.withColumn("ask_id", F.lit("2019-00002"))
    other_salts = salts.withColumn("ask_id", F.lit("2019-00002"))
    store_hashed(hash_job(other, other_salts).persons, path)
    for _ in range(2):
        store_hashed(hash_job(persons, salts).persons, path)
    counts = spark.read.parquet(path).groupBy("ask_id").count().collect()
    assert {row.ask_id: row["count"] for row in counts} == {"2019-00001": 4, "2019-00002": 4}


def requested(spark, codes):
    rows = [(*STUDY, "K0001", key(text), code) for text, code in codes]
    return spark.createDataFrame(
        rows, "ask_id string, rshp_id string, prvdr_cd string, hash_did string, trnsmrcv_cd string"
    )


@pytest.mark.parametrize(
    "codes, prcsts, reason, found",
    [
        ([("kim1T", "S"), ("lee2T", "S")], "429", "matched", 2),
        ([("kim1T", "S"), ("lee2T", "N")], "428", "transfer code", 0),
        ([("nobody", "S")], "428", "no match", 0),
        ([("kim1T", "S"), ("kim1T", "S")], "429", "matched", 2),
    ],
)
def test_match_job(spark, persons, salts, codes, prcsts, reason, found):
    job = match_job(hash_job(persons, salts).persons, requested(spark, codes))
    assert [(r.prcsts, r.reason) for r in job.verdicts.collect()] == [(prcsts, reason)]
    assert job.persons.count() == found


def test_attach_job(spark, persons, salts):
    matched = hash_job(persons, salts).persons
    rows = spark.createDataFrame(
        [("f1", *STUDY, "K0001", "kim", "1", "D", "v1"), ("f1", *STUDY, "K0001", "x", "9", "D", "v2"),
         ("f2", *STUDY, "K0001", "x", "9", "D", "v3")],
        "file_nm string, " + PERSON + ", cat_cd string, v string",
    )
    job = attach_job(rows, matched)
    assert job.rows.columns == ["file_nm", "ask_id", "rshp_id", "prvdr_cd", "hash_did", "cat_cd", "v"]
    assert [row.v for row in job.rows.collect()] == ["v1"]
    report = {row.file_nm: (row.n_rows, row.n_matched, row.status) for row in job.report.collect()}
    assert report == {"f1": (2, 1, "002"), "f2": (1, 0, "902")}


def test_hashed_files_pass_only_with_their_columns(spark):
    good = spark.createDataFrame([(*STUDY, "K0001", "H")], "ASK_ID string, RSHP_ID string, PRVDR_CD string, HASH_DID string")
    assert linkage.passthrough_keys(good).count() == 1
    with pytest.raises(ValueError):
        linkage.passthrough_keys(good.withColumn("X", F.lit(1)))


@pytest.fixture
def keyed(spark):
    rows = [("f1", *STUDY, "K0001", "H1", "D", "15", "a"), ("f1", *STUDY, "K0001", "H2", "D", "x", "b"),
            ("f1", *STUDY, "K0001", "H9", "D", "27", "c"), ("f2", *STUDY, "K0001", "H9", "D", "1", "d")]
    meta = "ask_id string, rshp_id string, prvdr_cd string, hash_did string, cat_cd string"
    return spark.createDataFrame(rows, f"file_nm string, {meta}, amt string, t string")


@pytest.fixture
def alternates(spark):
    return spark.createDataFrame([("H1", "A1"), ("H1", "A1"), ("H2", "A2"), ("H2", "B2")], "hash_did string, alter_id string")


RULES = [Rule.parse("amt", "Int64->floor(x / 10) * 10")]


def test_deidentify(keyed, alternates):
    out = deidentify(keyed, alternates, RULES)
    assert out.rows.columns == ["file_nm", "ask_id", "rshp_id", "prvdr_cd", "alter_id", "cat_cd", "amt", "t"]
    rows = sorted((str(r.alter_id), str(r.amt), r.t) for r in out.rows.collect())
    assert rows == [("A1", "10", "a"), ("A2", "None", "b"), ("B2", "None", "b"), ("None", "20", "c")]
    keys = {r.file_nm: (r.n_matched, r.n_unmatched, r.status) for r in out.keys.collect()}
    assert keys == {"f1": (3, 1, "003"), "f2": (0, 1, "902")}
    cells = [tuple(r) for r in out.cells.collect()]
    assert cells == [("f1", "amt", 0, 2, 2, "003")]
    inner = deidentify(keyed, alternates, RULES, how="inner").rows
    assert inner.count() == 3


def test_no_rules_is_an_error(keyed, alternates):
    with pytest.raises(RuleError):
        deidentify(keyed, alternates, [])


def test_summary_counts_add_up(spark):
    rows = spark.range(500).selectExpr(
        "'s' ask_id", "'h' rshp_id", "'p' prvdr_cd", "'c' cat_cd", "1 prsnt_pg_num", "1 tot_pg_num",
        "cast(id % 37 as string) amt", "cast(id % 5 as string) code",
    )
    variables = [Variable(1, "amt", True), Variable(2, "code", False)]
    out = summarise(rows, RULES, variables, cnt_seq=3)
    assert out.original.agg(F.sum("cnt")).first()[0] == 500
    assert out.deidentified.agg(F.sum("cnt")).first()[0] == 500
    direct = deidentified_directly(rows)
    columns = ["amt", "code", "cnt"]
    assert sorted(map(tuple, out.deidentified.select(columns).collect())) == direct
    eav = out.deidentified_eav()
    assert eav.count() == 3 * out.deidentified.count()
    assert eav.filter("var_dscr_seq = 3").agg(F.sum("num_datatp_val")).first()[0] == 500
    wide = eav.groupBy("datum_seq").pivot("var_dscr_seq", [1, 2, 3]).agg(
        F.first(F.coalesce("str_datatp_val", F.col("num_datatp_val").cast("bigint").cast("string")))
    )
    back = sorted((r["1"], r["2"], int(r["3"])) for r in wide.collect())
    assert back == direct


def deidentified_directly(rows):
    pdf = rows.select("amt", "code").toPandas()
    pdf["amt"] = (pdf["amt"].astype(int) // 10 * 10).astype(str)
    counts = pdf.groupby(["amt", "code"]).size().reset_index()
    return sorted((a, c, int(n)) for a, c, n in counts.itertuples(index=False))


@pytest.mark.parametrize("within", [[], ["g"]])
def test_ordinal_equals_row_number(spark, within):
    """One group holds most of the rows, so it spans several range partitions."""
    df = spark.range(5000).selectExpr("case when id % 10 = 0 then id % 7 end g", "id * 7919 % 5000 v", "id")
    got = summary.ordinal(df, ["v", "id"], within=within)
    window = Window.partitionBy(*within).orderBy("v", "id")
    want = df.select(F.row_number().over(window).cast("bigint").alias("datum_seq"), "*")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    numbers = got.filter("g IS NULL").select("datum_seq") if within else got.select("datum_seq")
    assert sorted(r[0] for r in numbers.collect()) == list(range(1, numbers.count() + 1))


def test_text_values_of_eav_may_be_missing(spark):
    df = spark.createDataFrame([(1, None, None, 2)], "id int, t string, n string, cnt bigint")
    out = summary.to_eav(df, [Variable(1, "t", False), Variable(2, "n", True)], ["id"], 3)
    assert sorted(map(tuple, out.collect()), key=lambda r: r[1]) == [
        (1, 1, "", None), (1, 2, None, None), (1, 3, None, 2.0),
    ]


def test_release_is_all_or_nothing(spark, tmp_path):
    names = [f"IF_DL_501_2019{study}_A0001_D_{page}_2_20210226.txt" for study in ("00001", "00002") for page in (1, 2)]
    register = spark.createDataFrame(
        [(f"2019-{n[14:19]}", "A0001", "K0001", "D", n) for n in names],
        "ask_id string, rshp_id string, prvdr_cd string, cat_cd string, file_nm string",
    )
    made = [n.replace("501", "801") for n in names][:3]
    rows = spark.createDataFrame(
        [(f"2019-{n[14:19]}", "A0001", n, "v") for n in made], "ask_id string, rshp_id string, out_nm string, v string"
    )
    path = str(tmp_path / "out")
    job = release_job(register, rows, path, F.lit("K0001"))
    assert {r.ask_id: r.status for r in job.verdicts.collect()} == {"2019-00001": "002", "2019-00002": "902"}
    assert [r.out_nm for r in job.missing.collect()] == [names[3].replace("501", "801")]
    assert {r.file_nm for r in read_delimited(spark, path).collect()} == set(made[:2])


@pytest.mark.parametrize("with_manifest", [False, True])
def test_release_evaluates_rows_and_register_once(spark, tmp_path, with_manifest):
    names = [f"IF_DL_501_201900001_A0001_D_{page}_2_20210226.txt" for page in (1, 2)]
    seen = {"rows": spark.sparkContext.accumulator(0), "register": spark.sparkContext.accumulator(0)}

    def counted(df, name):
        counter = seen[name]

        def each(batches):
            for batch in batches:
                counter.add(batch.num_rows)
                yield batch

        return df.mapInArrow(each, df.schema)

    register = spark.createDataFrame(
        [(*STUDY, "K0001", "D", n) for n in names], "ask_id string, rshp_id string, prvdr_cd string, cat_cd string, file_nm string"
    )
    rows = spark.createDataFrame(
        [(*STUDY, n.replace("501", "801"), v) for n in names for v in "xyz"], "ask_id string, rshp_id string, out_nm string, v string"
    )
    path = str(tmp_path / "out")
    job = release_job(counted(register, "register"), counted(rows, "rows"), path, F.lit("K0001"), with_manifest)
    assert (job.verdicts.count(), job.missing.count()) == (1, 0)
    assert {name: counter.value for name, counter in seen.items()} == {"rows": 6, "register": 2}
    read = manifest.read_release(spark, path) if with_manifest else read_delimited(spark, path)
    assert sorted(r.V for r in read.collect()) == sorted("xyz" * 2)


@pytest.mark.parametrize("stage", ["deid", "deid_summary"])
def test_rows_get_the_names_of_their_files(spark, stage):
    names = ["IF_DL_501_201900001_A0001_D_1_2_20210226.txt", "IF_DL_501_201900001_A0001_D_2_2_202102261200.txt", "bad.txt", None]
    given = [(n, p, c, v) for n in names for p in ("K0001", "K0004", None) for c in ("D", "E", None) for v in (1, 1, 2)]
    rows = spark.createDataFrame(given, "file_nm string, prvdr_cd string, cat_cd string, v int")
    for centre, seq in ((None, F.lit("3")), (F.lit("K0002"), F.col("v"))):
        named = outputs_of_rows(rows, stage, centre, seq)
        wanted = expected_outputs(rows, stage, centre, seq)
        assert named.columns == wanted.columns
        assert sorted(map(str, named.collect())) == sorted(map(str, wanted.collect()))
        assert "regexp" not in named._jdf.queryExecution().executedPlan().toString()


def test_inventory_job_refreshes_and_reports(spark, tmp_path):
    names = [f"IF_DL_501_201900001_A0001_D_{page}_2_20210226.txt" for page in (1, 2)]
    meta = "ask_id string, rshp_id string, prvdr_cd string, cat_cd string"
    register = spark.createDataFrame([(*STUDY, "K0001", "D", n) for n in names], f"{meta}, file_nm string")
    rows = spark.createDataFrame([(names[0], "1", "2")] * 3, "file_nm string, a string, b string")
    write_delimited(rows, str(tmp_path / "in"), "file_nm")
    known = spark.createDataFrame(
        [(*STUDY, "K0001", "D", "1", 1, 2, "2020", 0, 0, 0, "old")],
        f"{meta}, org_mrg_tp_cd string, prsnt_pg_num int, tot_pg_num int, crt_ymd string,"
        " file_sz long, datum_cnt long, var_ea long, file_nm string",
    )
    job = inventory_job(spark, str(tmp_path / "in"), register, known, "original")
    (row,) = job.table.collect()
    assert (row.crt_ymd, row.datum_cnt, row.var_ea, row.file_nm) == ("20210226", 3, 2, names[0])
    assert {r.file_nm: r.wk_exec_sts_cd for r in job.detail.collect()} == {names[0]: "002", names[1]: "902"}


def test_deid_inventory_is_kept_per_run(spark, tmp_path):
    name = "IF_DL_501_201900001_A0001_D_1_1_20210226.txt"
    meta = "ask_id string, rshp_id string, prvdr_cd string, cat_cd string"
    register = spark.createDataFrame([(*STUDY, "K0001", "D", name)], f"{meta}, file_nm string")
    out = name.replace("501", "801")
    write_delimited(spark.createDataFrame([(out, "1")], "file_nm string, a string"), str(tmp_path / "in"), "file_nm")
    known = spark.createDataFrame(
        [(*STUDY, "K0001", "D", "2", 1, 1, "2020", 0, 0, 0, "old", 1)],
        f"{meta}, org_mrg_tp_cd string, prsnt_pg_num int, tot_pg_num int, crt_ymd string,"
        " file_sz long, datum_cnt long, var_ea long, file_nm string, exec_seq int",
    )
    path = str(tmp_path / "in")
    job = inventory_job(spark, path, register, known, "deid", F.lit("K0001"), F.lit(2))
    assert sorted((r.exec_seq, r.datum_cnt, r.file_nm) for r in job.table.collect()) == [(1, 0, "old"), (2, 1, out)]
    with pytest.raises(ValueError):
        inventory_job(spark, path, register, known, "deid", F.lit("K0001"))


def test_dates_only_refresh_keeps_old_measures(spark):
    columns = (
        "ask_id string, rshp_id string, prvdr_cd string, cat_cd string, org_mrg_tp_cd string,"
        " prsnt_pg_num int, tot_pg_num int, crt_ymd string, file_sz long"
    )
    old = spark.createDataFrame([(*STUDY, "K0001", "D", "1", 1, 1, "2020", 5)], columns)
    new = spark.createDataFrame([(*STUDY, "K0001", "D", "1", 1, 1, "2021", 9)], columns)
    (row,) = merge_inventory(old, new, update_cols=("crt_ymd",)).collect()
    assert (row.crt_ymd, row.file_sz) == ("2021", 5)


def test_provider_columns_are_renamed_by_position(spark):
    df = spark.createDataFrame([("a",) * 7], "x1 string, x2 string, x3 string, x4 string, x5 string, x6 string, v string")
    assert linkage.as_provider_file(df).columns == [
        "ask_id", "rshp_id", "prvdr_cd", "mrg_nm", "mrg_ssn", "cat_cd", "v",
    ]


def test_rank_leaves_gaps(spark):
    rows = [(*STUDY, "K0001", "D", seq, "1", name) for seq, name in ((10, "a"), (10, "b"), (20, "c"))]
    columns = (
        "ask_id string, rshp_id string, prvdr_cd string, cat_cd string, var_seq long,"
        " req_var_tp_cd string, var_cd string"
    )
    ranked = spark.createDataFrame(rows, columns).withColumn(
        "var_dscr_seq", F.rank().over(Window.partitionBy("ask_id").orderBy("var_seq")).cast("bigint")
    )
    out = catalog.with_count_variable(ranked).collect()
    assert sorted((r.var_dscr_seq, r.var_cd) for r in out) == [(1, "a"), (1, "b"), (3, "c"), (4, "CNT")]


def test_pending_batches_default_and_strict(spark):
    requests = spark.createDataFrame([("s", "h", "K0001")], "requestid string, hypoid string, cnorgcode string")
    batches = spark.createDataFrame(
        [(i, "s", "h", 1, "7A") for i in (1, 2, 3)],
        "bt_seq int, ask_id string, rshp_id string, exec_seq int, wk_dtl_tp_cd string",
    )
    runs = spark.createDataFrame(
        [(1, "902", "p"), (1, "002", "p"), (2, "002", "p"), (2, "902", "other")],
        "bt_seq int, wk_sts_cd string, crt_pgm_id string",
    )
    loose = status.pending_batches(requests, batches, runs, "p", "7A")
    strict = status.pending_batches(requests, batches, runs, "p", "7A", strict=True)
    assert sorted(r.bt_seq for r in loose.collect()) == [1, 3]
    assert sorted(r.bt_seq for r in strict.collect()) == [3]




def test_files_with_too_few_columns_raise(spark):
    short = spark.createDataFrame([("a", "b", "c")], "x string, y string, z string")
    for reads in (linkage.as_person_file, linkage.as_provider_file):
        with pytest.raises(ValueError, match="at least"):
            reads(short)


def test_long_form_compiles(spark, capfd):
    """Both kinds of variables in one projection must not fall back to interpreted rows."""
    df = spark.range(50).selectExpr("id", "concat('t', id) t", "cast(id as string) n", "id cnt")
    out = summary.to_eav(df, [Variable(1, "t", False), Variable(2, "n", True)], ["id"], 3)
    assert out.count() == 150 and len(out.collect()) == 150
    assert "Failed to compile" not in "".join(capfd.readouterr())


def test_summary_job_replaces_its_run(spark, tmp_path):
    """A second run of a batch leaves what the first stored, and no scratch remains."""
    import os

    from workload.batch import EAV_OF, Batches, run_batch
    from workload.tables import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    store, root = str(tmp_path / "store"), spark.conf.get("spark.checkpoint.dir")
    counts = []
    for _ in range(2):
        done = run_batch(t, Batches(t), store)
        assert {r.status for r in done.status.collect()} <= {"002", "003", "902"}
        counts.append([spark.read.schema(batch.EAV).parquet(f"{store}/{name}").count() for name in EAV_OF.values()])
    assert counts[0] == counts[1] and counts[0][0] > 0
    assert not [name for name in os.listdir(root) if name.startswith("summary-job")]
    assert done.detail.select("bt_seq").distinct().count() == 5
    wide = [name for _, _, files in os.walk(f"{store}/deid_summary") for name in files if name.endswith(".csv")]
    assert wide


def test_summary_job_has_as_many_jobs_for_any_datasets(spark, tmp_path):
    """Sixty datasets of two kinds, and a study with two batches, which run in turn."""
    key = "ask_id string, rshp_id string, prvdr_cd string, cat_cd string"
    names = [f"2019-{n:05d}" for n in range(1, 21)]
    datasets = [(study, "A", "K0001", f"C{i}") for study in names for i in range(3)]
    frame = lambda rows, more: spark.createDataFrame(rows, f"{key}, {more}")
    rows = frame([(*d, 1, 1, f"IF_DL_501_{d[0].replace('-', '')}_A_{d[3]}_1_1_20200101.txt", str(n % 3), "x") for d in datasets for n in range(7)],
                 "prsnt_pg_num int, tot_pg_num int, file_nm string, amt string, prio string")
    variables = [(*d, v, v, f"V{v}", name, "1", "3") for d in datasets for v, name in ((1, "amt"), (2, "prio"))[: 1 + (d[3] != "C0")]]
    catalog_rows = frame([*variables, *((*d, 9, 9, "CNT", "cnt", "1", "3") for d in datasets)],
                         "var_seq long, var_dscr_seq long, var_dscr_nm string, var_cd string, req_var_tp_cd string, org_mrg_tp_cd string")
    standard = spark.createDataFrame([(1, "amt", batch.NUMBER_TYPE), (2, "prio", "t"), (9, "cnt", batch.NUMBER_TYPE)], "var_seq long, var_cd string, datatp string")
    made = materialise(catalog.build_summary_catalog(catalog_rows, standard, standard.select("var_seq"), frame([(*d, 1, "Int64->x", 1, "1") for d in datasets], "var_dscr_seq long, di_set_val string, exec_seq int, org_mrg_tp_cd string")), "catalog")
    rules = frame([(*d, 1, "Int64->floor(x / 2) * 2", 1, "1") for d in datasets], "var_dscr_seq long, di_set_val string, exec_seq int, org_mrg_tp_cd string")
    counts = {}
    for some in (2, 20):
        pending = spark.createDataFrame([(n, study, "A", 1, None) for n, study in enumerate(names[:some])], "bt_seq int, ask_id string, rshp_id string, exec_seq int, rulesetseq2 int")
        spark.sparkContext.setJobGroup(f"jobs-{some}", "")
        done = batch.summary_job(pending, frame([(*d, 1) for d in datasets], "exec_seq int"), made, standard, rules, rows, rows, str(tmp_path / str(some)), "85")
        counts[some] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"jobs-{some}"))
        spark.sparkContext.setJobGroup("rest", "")
        assert done.detail.count() == 3 * some
    assert counts[2] == counts[20] < 40, counts


def test_summary_status_rows_do_not_read_the_data_again(spark, tmp_path):
    key = "ask_id string, rshp_id string, prvdr_cd string, cat_cd string"
    dataset = (*STUDY, "K0001", "D")
    seen = spark.sparkContext.accumulator(0)

    def each(batches):
        for part in batches:
            seen.add(part.num_rows)
            yield part

    data = spark.createDataFrame([(*dataset, "a.txt", v) for v in "xyz"], f"{key}, file_nm string, v string")
    register = spark.createDataFrame([(*dataset, name) for name in ("a.txt", "b.txt")], f"{key}, file_nm string")
    pending = spark.createDataFrame([(1, *STUDY, 1, None)], "bt_seq int, ask_id string, rshp_id string, exec_seq int, rulesetseq2 int")
    chosen = spark.createDataFrame([(*dataset, 1)], f"{key}, exec_seq int")
    none = spark.createDataFrame([], f"{key}, var_seq long, var_dscr_seq long, var_dscr_nm string, var_cd string, req_var_tp_cd string, org_mrg_tp_cd string")
    standard = spark.createDataFrame([], "var_seq long, var_cd string, datatp string")
    rules = spark.createDataFrame([], f"{key}, var_dscr_seq long, di_set_val string, exec_seq int, org_mrg_tp_cd string")
    done = batch.summary_job(pending, chosen, none, standard, rules, register, data.mapInArrow(each, data.schema), str(tmp_path), "85")
    assert {r.file_nm: r.wk_exec_sts_cd for r in done.detail.collect()} == {"a.txt": "003", "b.txt": "902"}
    assert (done.status.count(), done.log.count()) == (1, 0)
    assert seen.value == 3
