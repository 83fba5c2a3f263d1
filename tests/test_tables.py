import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from veilspark.operators import tables
from veilspark.plans.linkage import hash_and_store
from veilspark.sources import manifest, tables as stored
from veilspark.sources.scratch import materialise, scratch_job, scratch_path


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_insert_only_merge_follows_sql_on_nulls(spark):
    target = spark.createDataFrame([("a", 1), ("b", None)], "k string, v int")
    source = spark.createDataFrame([("a", 1), ("b", None), ("c", 2), ("c", 2)], "k string, v int")
    assert rows(tables.merge_insert_only(target, source)) == [
        ("a", 1), ("b", None), ("b", None), ("c", 2),
    ]
    safe = tables.merge_insert_only(target, source, null_safe=True)
    assert rows(safe) == [("a", 1), ("b", None), ("c", 2)]
    assert rows(tables.merge_insert_only(safe, source, null_safe=True)) == rows(safe)


def test_upsert_changes_only_the_named_columns(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, n string, v int")
    source = spark.createDataFrame([(2, "B", None), (3, "C", 30)], "k int, n string, v int")
    once = tables.upsert(target, source, ["k"], ["v"])
    assert rows(once) == [(1, "a", 10), (2, "b", None), (3, "C", 30)]
    assert rows(tables.upsert(once, source, ["k"], ["v"])) == rows(once)


def test_upsert_with_a_large_source(spark, monkeypatch):
    """The same result when neither side may be broadcast."""
    from veilspark.operators import joins

    target = spark.range(0, 500).selectExpr("id k", "id v")
    source = spark.range(250, 900).selectExpr("id k", "-id v")
    want = rows(tables.upsert(target, source, ["k"], ["v"]))
    monkeypatch.setattr(tables, "is_small", lambda df: False)
    monkeypatch.setattr(joins, "is_small", lambda df, small: False)
    assert rows(tables.upsert(target, source, ["k"], ["v"])) == want
    assert len(want) == 900


def test_updates(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert rows(tables.update_where(df, F.col("k") == 1, {"V": F.lit("z")})) == [(1, "z"), (2, "b")]
    other = spark.createDataFrame([(2,), (2,)], "o int")
    hit = tables.update_exists(df, other, {"k": "o"}, {"v": F.lit("z")})
    assert rows(hit) == [(1, "a"), (2, "z")]
    none = tables.update_exists(df, other, {"k": "o"}, {"v": F.lit("z")}, F.col("v") == "q")
    assert rows(none) == rows(df)
    with pytest.raises(ValueError):
        tables.update_where(df, F.lit(True), {"gone": F.lit(1)})


def test_projections(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    assert tables.drop_and_order(df, ["B"]).columns == ["a", "c", "d"]
    assert tables.move_last(df, 1).columns == ["a", "d", "b", "c"]


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("p", 1), ("q", 2), ("r", 3)], "part string, v int")
    stored.append_rows(first, path, ["part"])
    stored.replace_partition(spark.createDataFrame([("q", 9)], "part string, v int"), path, ["part"])
    stored.truncate_partition(spark, path, {"part": "r"})

    def now():
        return rows(spark.read.parquet(path).select("part", "v"))

    assert now() == [("p", 1), ("q", 9)]
    stored.append_rows(spark.createDataFrame([("r", 4)], "part string, v int"), path, ["part"])
    assert now() == [("p", 1), ("q", 9), ("r", 4)]
    state = spark.read.parquet(path).select((F.col("v") + 1).alias("v"), "part")
    stored.rewrite(state, path, ["part"])
    assert now() == [("p", 2), ("q", 10), ("r", 5)]


def partitioned(spark, path, rows):
    stored.append_rows(spark.createDataFrame(rows, "p string, q string, v long"), path, ["p", "q"])


def held(spark, path):
    return sorted(tuple(r) for r in spark.read.schema("v long, p string, q string").parquet(path).select("p", "q", "v").collect())


def test_replaced_partitions_without_rows_are_emptied(spark, tmp_path):
    path = str(tmp_path / "t")
    partitioned(spark, path, [("a:b", "1", 1), ("a:b", "2", 2), ("c", "1", 3), (None, "1", 4)])
    scope = spark.createDataFrame([("a:b", "1"), ("c", "1"), (None, "1"), ("never", "1")], "p string, q string")
    fresh = spark.createDataFrame([("c", "1", 9)], "p string, q string, v long")
    stored.replace_partition(fresh, path, ["p", "q"], scope)
    assert held(spark, path) == [("a:b", "2", 2), ("c", "1", 9)]
    stored.replace_partition(fresh.limit(0), path, ["p", "q"], scope)
    assert held(spark, path) == [("a:b", "2", 2)]


def test_truncated_partition_has_to_exist(spark, tmp_path):
    path = str(tmp_path / "t")
    partitioned(spark, path, [("a:b", "01", 1), ("a:b", "2", 2)])
    stored.truncate_partition(spark, path, {"p": "a:b", "q": "01"})
    assert held(spark, path) == [("a:b", "2", 2)]
    with pytest.raises(ValueError, match="no partition"):
        stored.truncate_partition(spark, path, {"p": "a:c", "q": "2"})
    assert held(spark, path) == [("a:b", "2", 2)]


def test_rewrite_that_fails_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    broken = spark.read.parquet(path).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("no"))).alias("id"))
    with pytest.raises(Exception, match="no"):
        stored.rewrite(broken, path)
    assert spark.read.parquet(path).count() == 5
    stored.rewrite(spark.read.parquet(path).filter("id < 2"), path)
    assert spark.read.parquet(path).count() == 2


def test_upsert_refuses_repeated_keys(spark):
    target = spark.createDataFrame([(1, "a")], "k long, v string")
    source = spark.createDataFrame([(1, "x"), (1, "y"), (2, "p"), (2, "q")], "k long, v string")
    with pytest.raises(ValueError, match="repeats the key"):
        tables.upsert(target, source, ["k"], ["v"])
    with pytest.raises(ValueError, match="latest"):
        tables.upsert(target, source, ["k"], ["v"], "latest")
    got = tables.upsert(target, source, ["k"], ["v"], "latest", ["v"])
    assert sorted(map(tuple, got.collect())) == [(1, "y"), (2, "q")]


def test_nothing_of_a_finished_job_remains(spark, tmp_path):
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root))
    persons = spark.createDataFrame([("2019-1", "A1", "K1", "name", "900101", "x")], "ask_id string, rshp_id string, prvdr_cd string, mrg_nm string, mrg_ssn string, dummy string")
    salts = spark.createDataFrame([("2019-1", "A1", "K1", "T1"), ("2019-2", "A1", "K1", "T2")], "ask_id string, rshp_id string, prvdr_cd string, ttp_id string")
    path = str(tmp_path / "hashed")
    hash_and_store(persons, salts, path)
    assert spark.read.parquet(path).count() == 1
    hash_and_store(persons.limit(0), salts, path)
    assert spark.read.schema("hash_did string").parquet(path).count() == 0
    with pytest.raises(ZeroDivisionError), scratch_job(spark, "fails"):
        materialise(spark.range(1), "part")
        1 / 0
    assert set(os.listdir(root)) == before


def test_cluster_needs_shared_scratch():
    class Conf:
        get = staticmethod(lambda name, default=None: {"spark.master": "yarn"}.get(name, default))

    class Session:
        conf = Conf

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(Session, "x")


def stored_in_files(spark, path, files=20):
    spark.range(1000).selectExpr("id", "id % 3 as part", "'old' as v", "'kept' as w").repartitionByRange(files, "id").write.partitionBy("part").parquet(path)


def files_of(path):
    return {file: file.stat().st_mtime_ns for file in Path(path).rglob("*.parquet")}


def state(spark, path):
    return sorted((r.id, r.part, r.v, r.w) for r in spark.read.parquet(path).collect())


UPDATES = [(5, 2, "new"), (6, 0, None), (5000, 1, "added"), (5001, 7, "added")]


def updated():
    new = {key: (key, part, v) for key, part, v in UPDATES}
    rows = [(i, i % 3, new[i][2] if i in new else "old", "kept") for i in range(1000)]
    return sorted([*rows, (5000, 1, "added", None), (5001, 7, "added", None)])


@pytest.mark.parametrize("name", ["table", "a b%20+c"])
def test_upsert_rewrites_touched_files_only(spark, tmp_path, name):
    path = str(tmp_path / name)
    stored_in_files(spark, path)
    before = files_of(path)
    source = spark.createDataFrame(UPDATES, "id long, part long, v string")
    assert stored.upsert_files(source, path, ["id"], ["v"], ["part"]) == 2
    after = files_of(path)
    assert len(before.keys() - after.keys()) == 2 and all(after[file] == before[file] for file in before.keys() & after.keys())
    assert state(spark, path) == updated()
    assert not [child for child in Path(path).iterdir() if child.name.startswith("_") and child.is_dir()]
    assert stored.upsert_files(source, path, ["id"], ["v"], ["part"]) == 4  # now also those of the added rows
    assert state(spark, path) == updated()
    with pytest.raises(ValueError, match="repeats the key"):
        stored.upsert_files(source.unionAll(source), path, ["id"], ["v"], ["part"])
    assert state(spark, path) == updated()


def test_update_rewrites_touched_files_only(spark, tmp_path):
    path = str(tmp_path / "table")
    stored_in_files(spark, path)
    assert stored.update_files(spark, path, F.col("id") < 3, {"v": F.lit("u")}, ["part"]) == 3
    assert [row[2] for row in state(spark, path)] == ["u"] * 3 + ["old"] * 997
    assert stored.update_files(spark, path, F.col("id") > 1_000_000, {"v": F.lit("u")}, ["part"]) == 0
    assert len(state(spark, path)) == 1000


@pytest.mark.parametrize("at", range(8))
def test_rewrite_that_stops_anywhere_is_finished_or_undone(spark, tmp_path, monkeypatch, at):
    """Each step on the store fails once; the same call again gives the same table."""
    path = str(tmp_path / "table")
    stored_in_files(spark, path)
    source = spark.createDataFrame(UPDATES, "id long, part long, v string")
    real = stored.file_system
    left = [at]

    class Failing:
        def __init__(self, store):
            self.store = store

        def __getattr__(self, name):
            if name in ("rename", "delete", "create", "mkdirs"):
                if left[0] == 0:
                    left[0] = -1
                    raise OSError("lost")
                left[0] -= 1
            return getattr(self.store, name)

    monkeypatch.setattr(stored, "file_system", lambda *args: (Failing(real(*args)[0]), real(*args)[1]))
    with pytest.raises(OSError, match="lost"):
        stored.upsert_files(source, path, ["id"], ["v"], ["part"])
    stored.upsert_files(source, path, ["id"], ["v"], ["part"])
    assert state(spark, path) == updated()
    assert not [child for child in Path(path).iterdir() if child.name.startswith(("_staged", "_journal", "_part"))]


def released(spark, path):
    return sorted((r.file_nm, r.V) for r in manifest.read_release(spark, path).collect())


def files(spark, rows):
    return spark.createDataFrame(rows, "file_nm string, v string")


def test_release_is_seen_as_a_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    with pytest.raises(ValueError, match="nothing is released"):
        manifest.read_release(spark, path)
    first = [("a.txt", "1"), ("a.txt", "2"), ("b 1.txt", "3")]
    assert manifest.publish(files(spark, first), path) == "v000000001"
    assert released(spark, path) == first
    second = files(spark, [("a.txt", "x"), ("c.txt", "y")])
    real = manifest._measured
    monkeypatch.setattr(manifest, "_measured", lambda *_: 1 / 0)  # behind the files, before the manifest
    with pytest.raises(ZeroDivisionError):
        manifest.publish(second, path)
    monkeypatch.setattr(manifest, "_measured", real)
    assert released(spark, path) == first
    for version in ("v000000002", "v000000003"):  # run again, also when done
        assert manifest.publish(second, path) == version
        assert released(spark, path) == [("a.txt", "x"), ("b 1.txt", "3"), ("c.txt", "y")]
    assert manifest.prune(spark, path) == 2
    assert released(spark, path) == [("a.txt", "x"), ("b 1.txt", "3"), ("c.txt", "y")]


def test_manifest_sums_all_lines(spark, tmp_path):
    path = str(tmp_path / "out")
    manifest.publish(files(spark, [("a.txt", str(i)) for i in range(50)]), path)
    lines = spark.createDataFrame([("v",), *[(str(i),) for i in range(50)]], "value string")
    hashes = [r.h for r in lines.selectExpr("xxhash64(value) h").collect()]
    assert min(hashes) < 0 < max(hashes)
    parts = len(list(Path(path).rglob("part-*.csv")))
    (listed,) = manifest.manifest(spark, path).collect()
    assert (listed.n_rows, int(listed.checksum)) == (50, sum(hashes) + (parts - 1) * hashes[0])


def test_released_names_are_not_worked_out_for_each_line(spark, tmp_path):
    path = str(tmp_path / "out 1")
    manifest.publish(files(spark, [("a.txt", "1"), ("b 1%.txt", "2"), ("가.txt", "3"), ("가.txt", "4")]), path)
    manifest.publish(files(spark, [("a.txt", "x"), ("c+.txt", "y")]), path)
    wanted = [("a.txt", "x"), ("b 1%.txt", "2"), ("c+.txt", "y"), ("가.txt", "3"), ("가.txt", "4")]
    read = manifest.read_release(spark, path)
    assert sorted((r.file_nm, r.V) for r in read.collect()) == wanted
    assert "regexp_extract" not in read._jdf.queryExecution().executedPlan().toString()
    by_name = manifest.read_release(spark, path, headers="by_name")
    assert sorted((r.file_nm, r.V) for r in by_name.collect()) == wanted


@pytest.mark.parametrize("harm", ["change", "delete", "add"])
def test_files_that_are_not_as_released_are_found(spark, tmp_path, harm):
    path = tmp_path / "out"
    manifest.publish(files(spark, [("a.txt", "1"), ("a.txt", "2"), ("b.txt", "3")]), str(path))
    file = next(path.rglob("file_nm=a.txt/part-*.csv"))
    text = file.read_text()
    if harm == "change":
        file.write_text(text.replace("2", "9"))
    elif harm == "add":
        file.write_text(text + "2\n")
    else:
        file.unlink()
    (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    assert {r.file_nm: r.intact for r in manifest.verify(spark, str(path)).collect()} == {"a.txt": False, "b.txt": True}
    with pytest.raises(ValueError, match="a.txt"):
        manifest.read_release(spark, str(path))


def test_key_table_is_not_exchanged(spark, tmp_path):
    from veilspark.operators.linkage import swap_key
    from veilspark.sources.by_key import open_by_key, store_by_key

    path = str(tmp_path / "it's keys")
    pairs = spark.range(300).selectExpr("concat('h', id % 200) hash_did", "concat('a', id % 200) alter_id", "id % 7 rnd")
    stored_ = store_by_key(pairs.distinct(), path, ["hash_did"], 4)
    data = spark.range(1000).selectExpr("case when id % 3 > 0 then concat('h', id % 250) end hash_did", "id v")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for table in (stored_, open_by_key(spark, path)):
            for how in ("left", "inner"):
                swapped = swap_key(data, table, how, keep=["rnd"], by_key=True)
                plan = swapped._jdf.queryExecution().executedPlan().toString()
                assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan
                assert rows(swapped) == rows(swap_key(data, pairs, how, keep=["rnd"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
