"""Near duplicates, nearest vectors and URL lists."""

import re
from datetime import datetime

import duckdb
import numpy as np
import pytest
import xxhash

import veilspark.llm.simhash as simhash
import veilspark.llm.url_lists as url_lists
from tests.llm.helpers import CLASHING, ODD, documents, no_docs, odd_docs, texts
from veilspark.llm.knn import group_bounds, scores, top_k
from veilspark.llm.simhash import close_pairs, forest, keep_one, links, near_duplicates, roots
from veilspark.llm.url_lists import evaluate, intervals

UPPER = {c: c + 32 for c in range(65, 91)}


def fingerprint(text: str) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(UPPER))
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(run.encode(), seed=42) for run in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(values: np.ndarray, radius: int) -> np.ndarray:
    label = np.arange(len(values))
    for i, value in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values ^ value) <= radius):
            a, b = label[i], label[j]
            label[label == max(a, b)] = min(a, b)
    return label


def clustered(rng, n: int) -> np.ndarray:
    """Distinct values with many within a few bits of each other."""
    centres = rng.integers(0, 1 << 63, 20, dtype=np.uint64)
    values = centres[rng.integers(0, 20, n)]
    for _ in range(4):
        values ^= np.where(rng.random(n) < 0.7, np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64), np.uint64(0))
    return np.unique(values)


# ---- near duplicates


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
@pytest.mark.parametrize("pairs", [7, 1 << 17])
def test_bit_slices_find_all_pairs_of_each_bucket(monkeypatch, radius, pairs):
    monkeypatch.setattr(simhash, "PAIRS", pairs)
    rng = np.random.default_rng(radius)
    sizes = np.array([2, 64, 65, 3, 130, 1, 200])
    values = clustered(rng, 3000)[: sizes.sum()]
    rng.shuffle(values)
    bucket = np.repeat(np.arange(len(sizes)), sizes)
    found = [set(zip(left.tolist(), right.tolist())) for left, right in close_pairs(values, sizes, radius)]
    wanted = {
        (i, j)
        for i in range(len(values))
        for j in np.flatnonzero((np.bitwise_count(values ^ values[i]) <= radius) & (bucket == bucket[i])).tolist()
        if i < j
    }
    assert set().union(*found) == wanted and sum(map(len, found)) == len(wanted)


def test_forest():
    label = forest(6, np.array([4, 1, 5]), np.array([1, 0, 3]))
    assert label.tolist() == [0, 0, 2, 3, 0, 3]


@pytest.mark.parametrize("bucket, radius", [(4096, 2), (8, 2), (1, 2), (8, 1), (8, 3)])
def test_links_connect_what_is_near(spark, monkeypatch, bucket, radius):
    """Small buckets are cut again at each level, which must lose no link."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    values = clustered(np.random.default_rng(7), 400)
    signed = values.view(np.int64).tolist()
    prints = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    tree = {row.node: row.root for row in roots(links(prints, radius)).collect()}
    label = plain_roots(values, radius)
    groups = {}
    for value, root in zip(signed, label):
        groups.setdefault(root, set()).add(value)
    found = {}
    for value in signed:
        found.setdefault(tree.get(value, value), set()).add(value)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, groups.values()))
    assert all(root == min(members) for root, members in found.items())


def test_roots_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 99)], "left long, right long")
    assert {row.node: row.root for row in roots(chain).collect()} == {i: 0 for i in range(1, 61)} | {100: 99}


def test_near_duplicates_against_all_pairs(spark):
    rows = [(row.doc_id, row.text or "") for row in documents(spark).collect()]
    values = np.array([fingerprint(text) for _, text in rows], np.uint64)
    label = plain_roots(values, 2)
    lowest = {}
    for (key, _), root in zip(rows, label):
        lowest[root] = min(lowest.get(root, key), key)
    wanted = {key: (f"{value:016x}", lowest[root]) for (key, _), value, root in zip(rows, values.tolist(), label)}
    found = {row.doc_id: (row.fingerprint, row.component_id) for row in near_duplicates(documents(spark)).collect()}
    assert found == wanted
    kept = sorted(row.doc_id for row in keep_one(documents(spark)).collect())
    assert kept == sorted(set(lowest.values()))


def test_near_duplicates_of_odd_rows(spark):
    found = near_duplicates(odd_docs(spark)).collect()
    assert sorted((row.doc_id or 0, row.fingerprint) for row in found) == sorted((k or 0, f"{fingerprint(t):016x}") for k, t in texts())
    by_id = {row.doc_id: row.component_id for row in found if row.doc_id is not None}
    assert by_id[1] == by_id[2] == by_id[3] == 1 and by_id[5] == by_id[6] == 5
    assert near_duplicates(no_docs(spark)).count() == 0


def test_keep_one_of_odd_rows(spark):
    kept = keep_one(odd_docs(spark))
    assert set(kept.columns) == {"doc_id", "text", "lang", "source", "n_chars", *CLASHING}
    rows = kept.collect()
    assert sorted(row.doc_id for row in rows if row.doc_id is not None) == [-8, 1, 4, 5, 7, 9, 10]
    assert [row.text for row in rows if row.doc_id is None] == [ODD[7][1]]
    assert keep_one(no_docs(spark)).count() == 0


def test_keep_one_of_rows_without_ids(spark):
    rows = [(None, text, "en", "a", 1) for text in ("one two three four", "something else than that", "one two three four")]
    docs = spark.createDataFrame(rows, documents(spark).schema)
    assert sorted(row.text for row in keep_one(docs).collect()) == ["one two three four", "something else than that"]


# ---- nearest vectors


def plain_top_k(rows: list[tuple], every: int, k: int) -> list[tuple]:
    whole = {}
    for key, vector in rows:
        if key is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        value = [int(np.floor(64 * x)) for x in vector]
        whole[key] = min(whole.get(key, value), value)
    out = []
    for query, own in whole.items():
        if query % every == 0:
            found = sorted((-sum(a * b for a, b in zip(own, other)), key) for key, other in whole.items() if key != query)[:k]
            out += [(query, place, key, -score) for place, (score, key) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [5, 64, 8192])
@pytest.mark.parametrize("kind", ["random", "clusters", "copies"])
def test_top_k_against_all_pairs(spark, block, kind):
    rng = np.random.default_rng(1)
    points = rng.normal(size=(300, 6))
    if kind == "clusters":
        points = rng.normal(size=(5, 6))[rng.integers(0, 5, 300)] * 3 + 0.05 * points
    if kind == "copies":
        points[rng.random(300) < 0.5] = points[0]
    rows = [(int(key), row.tolist()) for key, row in zip(rng.permutation(600)[:300], points)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = top_k(vectors, every=7, k=4, block=block).collect()
    assert sorted(map(tuple, found)) == plain_top_k(rows, 7, 4)


def test_bounds_send_less_than_all_and_lose_nothing():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 8)) * 40
    points = np.round(np.concatenate([centre + rng.normal(size=(60, 8)) for centre in centres])).astype(np.int64)
    pivots = points[::60]
    cell = np.argmin(((points[:, None] - pivots[None]) ** 2).sum(axis=2), axis=1)
    far = np.sqrt(((points - pivots[cell]) ** 2).sum(axis=1))
    norm = np.sqrt((points**2).sum(axis=1))
    data = {
        int(c): {"radius": far[cell == c].max(), "norm": norm[cell == c].max(), "near": np.sort(far[cell == c])[:4].tolist()}
        for c in np.unique(cell)
    }
    reach = {int(c): far[cell == c].max() for c in np.unique(cell)}
    sent = group_bounds(pivots, reach, data, 3)
    assert len(sent) < len(reach) * len(data) / 2
    least = {(i, j): value for i, j, value in sent}
    table = scores(points, points)
    for row, line in enumerate(table):
        for other in np.argsort(-line, kind="stable")[:4]:
            assert far[other] >= least[int(cell[row]), int(cell[other])]


def test_top_k_of_odd_rows(spark):
    rows = [
        (0, [0.5, 0.5]),
        (0, [0.5, 0.5]),
        (0, [0.25, 0.5]),
        (20, None),
        (40, [None, 1.0]),
        (60, [float("nan"), 1.0]),
        (80, [float("inf"), 1.0]),
        (None, [1.0, 1.0]),
        (100, []),
        (120, [0.5]),
        (5, [0.1, 0.2, 0.3]),
        (6, [-1e6, 1e6]),
        (7, [-0.001, 0.0]),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", *(f"'z' as {c}" for c in CLASHING))
    whole = [(key, None if vector is None else vector) for key, vector in rows]
    padded = [(key, None if vector is None else [*vector, *[0.0] * (3 - len(vector))]) for key, vector in whole]
    assert sorted(map(tuple, top_k(vectors).collect())) == plain_top_k(padded, 20, 20)
    assert top_k(vectors.where("false")).count() == 0
    assert top_k(vectors.where("vec_id = 5")).count() == 0
    assert top_k(vectors.where("vec_id = 100")).count() == 0


@pytest.mark.parametrize("block", [5, 8192])
def test_query_keeps_rows_that_share_an_id(spark, tmp_path, block):
    from tests.compare import difference
    from veilspark.llm import queries

    rng = np.random.default_rng(4)
    points = rng.normal(size=(400, 4)) + rng.integers(0, 3, (400, 1))
    ids = rng.integers(0, 130, 400)  # several rows for most ids
    ids[:9] = 20
    rows = [(int(key), point.tolist()) for key, point in zip(ids, points)]
    rows += rows[:30]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors.write.parquet(f"{tmp_path}/embeddings.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    assert difference(queries.QUERIES["op2_knn"](spark, str(tmp_path)), connection, queries.SQL["op2_knn"]) is None
    assert difference(top_k(vectors, block=block, all_rows=True), connection, queries.SQL["op2_knn"]) is None


def test_query_beside_an_id_with_many_rows(spark, tmp_path):
    """The rows of one id, and a query's own ones, crowd out no others."""
    from veilspark.llm import queries

    rng = np.random.default_rng(11)
    near = 1 + rng.integers(0, 40, (100_000, 3)) / 64
    rows = [(21 if i > 200 else 20, row) for i, row in enumerate(near.tolist())] + [(int(key), row.tolist()) for key, row in zip(rng.integers(0, 90, 500), rng.normal(size=(500, 3)))]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = {}
    for row in queries.QUERIES["op2_knn"](spark, str(tmp_path)).collect():
        found.setdefault(row.query_id, []).append((row["rank"], row.vec_id, row.score))
    ids = np.array([row[0] for row in rows])
    whole = np.floor(64 * np.array([row[1] for row in rows])).astype(np.int64)
    for query in set(ids[ids % 20 == 0].tolist()):
        best = []
        others = whole[ids != query]
        for own in np.unique(whole[ids == query], axis=0):
            copies = int((whole[ids == query] == own).all(axis=1).sum())
            line = others @ own
            some = np.lexsort((ids[ids != query], -line))[:20]
            best += [(-int(line[p]), int(ids[ids != query][p])) for p in some for _ in range(min(copies, 20))]
        wanted = [(rank, key, -score) for rank, (score, key) in enumerate(sorted(best)[:20], 1)]
        assert sorted(found[query]) == wanted


# ---- URL lists

ENTRY = "list string, scope string, pattern string, verdict string, action string, effective timestamp"


def day(n: int) -> datetime:
    return datetime(2024, 1 + (n - 1) // 28, 1 + (n - 1) % 28)


def test_intervals(spark):
    rows = [
        ("l", "host", "a.b", "block", "add", day(1)),
        ("l", "host", "a.b", "block", "add", day(1)),
        ("l", "host", "a.b", "block", "remove", day(5)),
        ("l", "host", "a.b", "block", "add", day(9)),
        ("l", "host", "a.b", "block", "add", day(12)),
        ("l", "host", "c.d", "block", "add", day(3)),
        ("l", "host", "c.d", "block", "remove", day(3)),
        ("l", None, "e.f", "block", "add", day(3)),
    ]
    found = intervals(spark.createDataFrame(rows, ENTRY)).orderBy("since").collect()
    assert [(row.pattern, row.since, row.until.year) for row in found] == [("a.b", day(1), 2024), ("a.b", day(9), 2024), ("a.b", day(12), 9999)]
    assert found[0].until == day(5) and found[1].until == day(12)


def test_evaluate(spark):
    entries = [
        ("b", "domain", "example.com", "block", "add", day(10)),
        ("a", "host", "www.example.com", "block", "add", day(20)),
        ("c", "prefix", "www.example.com/en/x", "allow", "add", day(30)),
        ("c", "prefix", "www.example.com/en/x", "allow", "remove", day(40)),
        ("d", "host", "www.example.com", "allow", "add", day(60)),
        ("e", "host", "www.example.com", "block", "add", day(60)),
    ]
    url = "HTTPS://user:pw@WWW.Example.com.:8080//en/x/y?q=/z#f"
    captures = [
        (1, url, day(9)), (2, url, day(10)), (3, url, day(20)), (4, url, day(30)), (4, url, day(30)), (5, url, day(40)), (6, url, day(60)),
        (7, "https://notexample.com/", day(60)), (8, "https://deep.www.example.com", day(60)), (9, None, day(60)), (10, url, None),
        (None, "not a url", day(60)), (11, "https:///path", day(60)), (12, "http://" + "a." * 3000 + "example.com/" + "p/" * 3000, day(60)),
    ]
    frame = spark.createDataFrame(captures, "capture_id long, url string, fetched timestamp").selectExpr("*", *(f"'z' as {c}" for c in CLASHING))
    found = evaluate(frame, spark.createDataFrame(entries, ENTRY)).collect()
    got = sorted((row.capture_id or 0, row.active, row.verdict, row.list) for row in found)
    assert got == [
        (0, 0, None, None), (1, 0, None, None), (2, 1, "block", "b"), (3, 2, "block", "a"), (4, 3, "allow", "c"), (4, 3, "allow", "c"),
        (5, 2, "block", "a"), (6, 4, "allow", "d"), (7, 0, None, None), (8, 1, "block", "b"), (9, 0, None, None), (10, 0, None, None),
        (11, 0, None, None), (12, 1, "block", "b"),
    ]
    assert evaluate(frame, spark.createDataFrame([], ENTRY)).where("verdict is not null or active > 0").count() == 0
    assert evaluate(frame.where("false"), spark.createDataFrame(entries, ENTRY)).count() == 0


def test_patterns_that_share_a_mark(spark, monkeypatch):
    entries = spark.createDataFrame([("b", "domain", "com", "block", "add", day(1)), ("b", "domain", "b.org", "block", "add", day(1))], ENTRY)
    captures = [(n, f"http://{'ab'[n % 2]}.{('com', 'org', 'net')[n % 3]}/", day(2)) for n in range(60)]
    frame = spark.createDataFrame(captures, "capture_id long, url string, fetched timestamp")
    wanted = sorted((n, int(n % 3 == 0 or n % 6 == 1)) for n in range(60))
    for marks in (1 << 20, 1):
        monkeypatch.setattr(url_lists, "MARKS", marks)
        assert sorted((row.capture_id, row.active) for row in evaluate(frame, entries).collect()) == wanted
