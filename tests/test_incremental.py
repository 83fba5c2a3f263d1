"""Kept summaries against summaries of all rows."""

import pytest
from pyspark.sql import functions as F

from veilspark.operators.summary import frequency_table, with_counts
from veilspark.plans import incremental
from veilspark.plans.incremental import KEYS, follow, kept_summary, prune
from veilspark.sources.scratch import scratch_path

NAMES = ["amt", "code"]


def page(spark, number, rows, cat="c"):
    made = spark.createDataFrame([(str(a), c) for a, c in rows] or [], "amt string, code string")
    given = dict(ask_id="s", rshp_id="h", prvdr_cd="p", cat_cd=cat, prsnt_pg_num=number, tot_pg_num=9)
    return made.withColumns({name: F.lit(value) for name, value in given.items()})


class Store:
    """Delivered pages, and which of them were read."""

    def __init__(self, spark):
        self.spark, self.pages, self.asked = spark, {}, []

    def put(self, number, ymd, rows, cat="c"):
        self.pages[cat, number] = ymd, len(rows), page(self.spark, number, rows, cat)

    def rows(self, pages):
        frames = [self.pages[key][2] for key in sorted(pages)]
        none = page(self.spark, 0, [])
        for frame in frames:
            none = none.unionByName(frame)
        return none

    def inventory(self):
        listed = [("s", "h", "p", cat, n, 9, ymd, size) for (cat, n), (ymd, size, _) in self.pages.items()]
        kinds = "ask_id string, rshp_id string, prvdr_cd string, cat_cd string, prsnt_pg_num int, tot_pg_num int, crt_ymd string, datum_cnt int"
        return self.spark.createDataFrame(listed, kinds)

    def read(self, pages):
        keys = sorted((row.cat_cd, row.prsnt_pg_num) for row in pages.collect())
        self.asked.append(keys)
        return self.rows(keys)

    def follow(self, path):
        changed = follow(self.inventory(), self.read, NAMES, path, ["crt_ymd", "datum_cnt"])
        return sorted((row.cat_cd, row.prsnt_pg_num, row.change) for row in changed.collect())

    def check(self, path):
        kept, rows = kept_summary(self.spark, path), self.rows(self.pages)
        dataset = [*KEYS[:4], *NAMES]
        for held, columns in ((kept.pages, [*KEYS, *NAMES]), (kept.datasets, dataset)):
            wanted = frequency_table(rows, columns)
            assert sorted(map(repr, held.select(*wanted.columns).collect())) == sorted(map(repr, wanted.collect()))
        return {(row.cat_cd, row.prsnt_pg_num): row.page_run for row in kept.state.collect()}


def test_only_changed_pages_are_read(spark):
    store, path = Store(spark), scratch_path(spark, "kept")
    store.put(1, "1", [(1, "a"), (1, "a"), (2, None)])
    store.put(2, "1", [(1, "a"), (3, "b")])
    store.put(3, "1", [(3, "b")])
    store.put(1, "1", [(7, "z")], "d")
    store.put(2, "1", [], "d")
    assert kept_summary(spark, path) is None
    assert store.follow(path) == [("c", 1, "added"), ("c", 2, "added"), ("c", 3, "added"), ("d", 1, "added"), ("d", 2, "added")]
    first = store.check(path)

    store.put(2, "2", [(3, "b"), (3, "b"), (4, "c")])
    store.put(4, "2", [(2, None)])
    del store.pages["c", 3]
    assert store.follow(path) == [("c", 2, "changed"), ("c", 3, "gone"), ("c", 4, "added")]
    assert store.asked[1:] == [[("c", 2), ("c", 4)]]
    second = store.check(path)
    assert sorted(key for key in first if second.get(key) == first[key]) == [("c", 1), ("d", 1), ("d", 2)]

    assert store.follow(path) == [] and len(store.asked) == 2
    store.pages = {key: value for key, value in store.pages.items() if key[0] == "d"}
    assert [change for *_, change in store.follow(path)] == ["gone"] * 3
    store.check(path)
    # Of pages the first run's is used, of datasets as well; those of two later runs are not.
    assert prune(spark, path) == 4
    store.check(path)


def test_a_run_that_fails_is_not_seen(spark, monkeypatch):
    store, path = Store(spark), scratch_path(spark, "kept")
    store.put(1, "1", [(1, "a")])
    store.follow(path)
    before = store.check(path)
    real = incremental.add_version
    monkeypatch.setattr(incremental, "add_version", lambda *_: 1 / 0)  # behind the tables, before the state
    store.put(1, "2", [(5, "b"), (6, None)])
    with pytest.raises(ZeroDivisionError):
        store.follow(path)
    assert {(row.cat_cd, row.prsnt_pg_num): row.page_run for row in kept_summary(spark, path).state.collect()} == before
    monkeypatch.setattr(incremental, "add_version", real)
    assert store.follow(path) == [("c", 1, "changed")]
    store.check(path)


def test_rows_of_other_pages_are_left_out(spark):
    store, path = Store(spark), scratch_path(spark, "kept")
    store.put(1, "1", [(1, "a")])
    follow(store.inventory(), lambda pages: page(spark, 1, [(1, "a")]).unionByName(page(spark, 2, [(1, "a")])), NAMES, path, ["crt_ymd"])
    store.check(path)


def test_pages_listed_wrong_raise(spark):
    store = Store(spark)
    store.put(1, "1", [])
    twice = store.inventory().unionByName(store.inventory())
    null = store.inventory().withColumn("cat_cd", F.lit(None).cast("string"))
    for wrong in (twice, null):
        with pytest.raises(ValueError, match="page is listed"):
            follow(wrong, store.read, NAMES, scratch_path(spark, "kept"), ["crt_ymd"])


def test_counts_below_none_raise(spark):
    table = spark.createDataFrame([("a", 1)], "code string, cnt long")
    assert with_counts(table, spark.createDataFrame([("a", -1)], table.schema), ["code"]).collect() == []
    with pytest.raises(Exception, match="more rows are subtracted"):
        with_counts(table, spark.createDataFrame([("a", -2)], table.schema), ["code"]).collect()
