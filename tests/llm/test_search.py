"""Graph search, hard negatives and the Merkle manifest."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest

import veilspark.llm.graph_search as graph_search
import veilspark.llm.hard_negatives as hard_negatives
from tests.compare import difference
from tests.llm.helpers import CLASHING, documents, no_docs, odd_docs
from veilspark.llm import merkle, queries
from veilspark.llm.graph_search import Graph, beam_search, build, prune, same_length, search
from veilspark.llm.hard_negatives import Bucket, mine, window

ODD_VECTORS = [
    (0, [0.5, 0.5], 1),
    (0, [0.5, 0.5], 1),
    (0, [0.25, 0.5], 1),
    (20, None, 1),
    (40, [None, 1.0], 1),
    (60, [float("nan"), 1.0], 1),
    (80, [float("inf"), 1.0], 1),
    (None, [1.0, 1.0], 1),
    (100, [], 2),
    (120, [0.5], 2),
    (140, [0.0, -0.0], 2),
    (5, [0.1, 0.2, 0.3], None),
    (6, [-1e6, 1e6], 2),
    (7, [-0.001, 0.0], 1),
    (200, [0.5, 0.5], 2),
    (300, [0.5, 0.5], 1),
    (301, [0.4, 0.5], 1),
    (302, [0.2, 0.2], 2),
]
VECTORS = "vec_id long, embedding array<double>, label int"


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, VECTORS).selectExpr("*", *(f"'z' as {c}" for c in CLASHING if c not in ("rank", "label")))


# ---- graph search


def nearest(rows: list[tuple], every: int, k: int) -> dict[int, list[tuple]]:
    """The exact answer: (rank, vec_id, score) of each query."""
    width = max((len(v) for _, v in rows if v), default=0)
    known = {}
    for key, v in rows:
        if key is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            known[key, tuple([*v, *[0.0] * (width - len(v))])] = True
    out = {}
    for query in {key for key, _ in known if key % every == 0}:
        pairs = [(-sum(a * b for a, b in zip(own, other)), key) for q, own in known if q == query for key, other in known if key != query]
        out[query] = [(rank, key, -score) for rank, (score, key) in enumerate(sorted(pairs)[:k], 1)]
    return out


def found_by(frame) -> dict[int, list[tuple]]:
    out = {}
    for row in frame.orderBy("query_id", "rank").collect():
        out.setdefault(row.query_id, []).append((row["rank"], row.vec_id, row.score))
    return out


def points(kind: str, n: int, width: int) -> np.ndarray:
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, width))
    if kind == "clusters":
        x = rng.normal(size=(n // 50, width))[rng.integers(0, n // 50, n)] * rng.uniform(0.5, 2, (n, 1)) + 0.1 * x
    if kind == "near copies":
        x = x[rng.integers(0, 3, n)] + 1e-5 * x
    return x


@pytest.mark.parametrize("kind", ["random", "clusters", "near copies"])
def test_beam_search_finds_what_is_near(kind):
    x = points(kind, 3000, 24)
    graph = build(same_length(x))
    queries_ = points(kind, 3000, 24)[::60]
    found, _ = beam_search(graph, np.hstack([queries_, np.zeros((50, 1))]), 128)
    exact = queries_ @ x.T
    last = np.sort(exact, axis=1)[:, -20]
    hits = [(exact[row][line[line >= 0]] >= last[row] - 1e-9).sum() for row, line in enumerate(found)]
    assert np.mean(np.minimum(hits, 20)) / 20 >= 0.95


@pytest.mark.parametrize("kind", ["random", "near copies"])
def test_every_point_is_reached(kind):
    graph = build(same_length(points(kind, 700, 3)), degree=6, beam=8)
    found, _ = beam_search(graph, graph.points[:3], 700)
    assert all(len(set(line)) == 700 for line in found.tolist())


def test_prune_keeps_directions():
    """On a line the nearest point on each side is kept, and none behind it."""
    at = np.array([0, 1, 2, 3, -1, -4], np.float32)[:, None]
    graph = Graph(at, np.full((6, 4), -1, np.int64), 0)
    kept = prune(graph, np.array([0]), np.array([[5, 3, 1, 2, 4, 0, -1, 1]]), 1.0)
    assert kept[0].tolist() == [1, 4, -1, -1]
    relaxed = prune(graph, np.array([0]), np.array([[5, 3, 1, 2, 4, 0, -1, 1]]), 2.5)
    assert relaxed[0].tolist() == [1, 4, 2, 5]


def test_search_of_few_rows_is_exact(spark):
    """A beam as wide as the shard finds everything, over several shards and with ties."""
    rng = np.random.default_rng(6)
    rows = [(int(key), rng.integers(-2, 3, 4).astype(float).tolist()) for key in rng.integers(0, 300, 400)]
    frame = spark.createDataFrame([(*row, 1) for row in rows], VECTORS)
    found = found_by(search(frame, every=7, k=9, shard=100))
    assert found == nearest(rows, 7, 9)


def test_search_beyond_own_rows(spark):
    """A query id with more rows than the beam still meets the others."""
    rows = [(20, [1.0, 0.001 * i]) for i in range(300)] + [(21, [0.5, 0.1]), (22, [-1.0, 0.0])]
    found = found_by(search(spark.createDataFrame([(*row, 1) for row in rows], VECTORS), k=2, beam=16))
    wanted = nearest(rows, 20, 2)
    assert [row[:2] for row in found[20]] == [row[:2] for row in wanted[20]]


def test_search_of_odd_rows(spark):
    frame = vectors_of(spark, ODD_VECTORS)
    assert found_by(search(frame)) == nearest([row[:2] for row in ODD_VECTORS], 20, 20)
    assert search(frame.where("false")).count() == 0
    assert search(frame.where("vec_id = 5")).count() == 0
    assert search(frame.where("vec_id in (100, 140)")).count() == 0


def test_search_of_the_given_vectors(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(row.vec_id, row.embedding) for row in frame.collect()]
    x, ids = np.array([row[1] for row in rows]), np.array([row[0] for row in rows])
    found = found_by(search(frame, shard=700, beam=64))
    hits = 0
    for query in ids[ids % 20 == 0]:
        line = x @ x[ids == query][0]
        line[ids == query] = -np.inf
        hits += len({key for _, key, _ in found[query]} & set(ids[np.argsort(-line)[:20]]))
        assert [score for *_, score in found[query]] == pytest.approx([line[ids == key][0] for _, key, _ in found[query]], abs=1e-12)
    assert len(found) == 100 and hits >= 0.9 * 2000


# ---- hard negatives


def test_window():
    for score in range(-30, 200):
        inside = [n for n in range(-300, 300) if 30 * score <= 100 * n <= 90 * score]
        low, high = window(score)
        assert inside == list(range(low, high + 1))


@pytest.mark.parametrize("spread", [0.0, 0.3])
def test_candidates_lose_no_row(spread):
    """Ranges of the focus coordinates leave rows out, and never one that reaches the score."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(20, 6)) * 100
    rows = np.round(centres[rng.integers(0, 20, 2000)] * rng.uniform(0.8, 1.2, (2000, 1)) + spread * rng.normal(size=(2000, 6))).astype(np.int64)
    rows[:5] = 0
    import pyarrow as pa

    norm = np.sqrt((rows * rows).sum(axis=1).astype(float))
    bucket = Bucket(pa.table({"vec_id": np.arange(2000), "label": np.zeros(2000, int), "v": rows.tolist(), "norm": norm}))
    looked = 0
    for anchor in rows[10:400:7]:
        length = float(np.sqrt((anchor * anchor).sum()))
        line = rows @ anchor
        for least in (-5.0, 0.0, 1.0, 0.5 * length * bucket.longest, 0.97 * line.max(), float(line.max()), 1.01 * length * bucket.longest):
            places = bucket.candidates(anchor, length, least)
            wanted = set(np.flatnonzero(line >= least).tolist())
            assert places is None or wanted <= set(places.tolist())
            looked += places is not None and len(places) < 1000
    assert looked > 100


def oracle(tmp_path, frame):
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    return con


@pytest.mark.parametrize("kind", ["random", "clusters", "copies"])
def test_hard_negatives_against_sql(spark, tmp_path, monkeypatch, kind):
    monkeypatch.setattr(hard_negatives, "BUCKET", 70)
    monkeypatch.setattr(hard_negatives, "SLOT", 3)
    monkeypatch.setattr(hard_negatives, "SAMPLE", 40)
    x = points("random" if kind == "copies" else kind, 900, 5)
    if kind == "copies":
        x[::2] = x[0]
    ids = np.random.default_rng(9).integers(0, 1200, 900)
    rows = [(int(key), np.round(row, 2).tolist(), int(key * 7919 % 5)) for key, row in zip(ids, x)]
    frame = spark.createDataFrame(rows + rows[:40], VECTORS)
    con = oracle(tmp_path, frame)
    assert difference(queries.QUERIES["op12_hard_negatives"](spark, str(tmp_path)), con, queries.SQL["op12_hard_negatives"]) is None


def test_hard_negatives_of_odd_rows(spark, tmp_path):
    width = max(len(row[1] or ()) for row in ODD_VECTORS)
    full = [(key, v if v is None else [*v, *[0.0] * (width - len(v))], label) for key, v, label in ODD_VECTORS]
    con = oracle(tmp_path, spark.createDataFrame(full, VECTORS))
    frame = vectors_of(spark, ODD_VECTORS).selectExpr("* except (label)", "case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label")
    assert difference(mine(frame), con, queries.SQL["op12_hard_negatives"]) is None
    assert mine(frame.where("false")).count() == 0
    assert mine(frame.where("vec_id = 100")).count() == 0
    assert mine(frame.where("vec_id = 6")).count() == 0


# ---- Merkle manifest


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more: int = 0) -> str:
    n = None if row.n_chars is None else row.n_chars + more
    texts = [None if x is None else str(x) for x in (row.doc_id, row.source, row.lang, n, row.text)]
    return h(*("-" if x is None else f"{len(x.encode())}:{x}" for x in texts))


def tree(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root, and of each node the siblings left and right on its way up."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(place):
            odd = at % 2
            right = nodes[at + 1] if not odd and at + 1 < len(nodes) else ""
            paths[i].append((nodes[at - 1] if odd else "", right))
            place[i] = at // 2
        nodes = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def plain_manifest(rows: list) -> list[tuple]:
    """What the query returns, by lists."""
    claimed = lambda r: leaf(r, r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0)
    langs = sorted({r.lang for r in rows}, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((r for r in rows if r.lang == lang), key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r)))
        trees[lang] = own, *tree([leaf(r) for r in own])
    root, tops = tree([trees[lang][1] for lang in langs]) if langs else (None, [])
    out = []
    for lang, top in zip(langs, tops):
        own, subroot, paths = trees[lang]
        for row, path in zip(own, paths):
            node = claimed(row)
            for left, right in path + top:
                node = h(left, node, right)
            out.append((row.doc_id, leaf(row), subroot, root, h(*(left + right for left, right in path + top)), node, node == root))
    return sorted(out, key=str)


def write_docs(tmp_path, docs) -> str:
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def run_query(spark, sf_dir) -> list[tuple]:
    return sorted(map(tuple, queries.QUERIES["op13_manifest"](spark, sf_dir).collect()), key=str)


@pytest.mark.parametrize("step", [1, 2, 3, 8])
def test_manifest_against_lists(spark, monkeypatch, step):
    docs = documents(spark).limit(77 if step < 3 else 10_000)
    build_ = merkle.build
    monkeypatch.setattr(merkle, "build", lambda docs, claimed: build_(docs, claimed, step))
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    assert run_query(spark, "") == plain_manifest(docs.collect())


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 9])
def test_manifest_of_one_language(spark, n):
    rows = [(i, f"text {i}", "en", "a", 6) for i in range(n)]
    found = merkle.proofs(merkle.build(spark.createDataFrame(rows, no_docs(spark).schema), step=2)).orderBy("doc_id").collect()
    root, paths = tree([leaf(r) for r in spark.createDataFrame(rows, no_docs(spark).schema).collect()])
    assert [[tuple(at) for at in row.path] for row in found] == paths
    assert {row.root for row in found} == {row.subroot for row in found} == {root}


def test_manifest_of_odd_rows(spark, tmp_path):
    docs = odd_docs(spark).unionByName(odd_docs(spark).where("doc_id = 5").selectExpr("* except (n_chars)", "9223372036854775807 as n_chars"))
    assert run_query(spark, write_docs(tmp_path, docs)) == plain_manifest(docs.collect())


def test_manifest_without_rows(spark):
    empty = merkle.build(no_docs(spark))
    assert merkle.proofs(empty).count() == 0 and empty.root() is None


def test_manifest_of_many_equal_rows_and_languages(spark):
    rows = [(1, "same", "en", "a", 4)] * 700 + [(i, "x", f"l{i}", "a", 1) for i in range(300)]
    docs = spark.createDataFrame(rows, no_docs(spark).schema)
    manifest = merkle.build(docs, step=3)
    found = merkle.proofs(manifest)
    assert found.count() == 1000 and found.where(merkle.folded("leaf", "path") != merkle.F.col("root")).count() == 0
    assert {row.root for row in found.select("root").distinct().collect()} == {manifest.root()} == {plain_manifest(docs.collect())[0][3]}


@pytest.mark.parametrize("name", ["op12_hard_negatives", "op13_manifest"])
def test_queries_against_sql(spark, name):
    from tests.compare import connect

    sf_dir = "/root/testdata/sf0.001"
    assert difference(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.SQL[name]) is None
