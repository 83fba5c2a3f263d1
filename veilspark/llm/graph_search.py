"""Approximate nearest neighbours by inner product on robust-pruned directed graphs.

Distinct vectors are dealt by hash to shards of bounded size, and each shard becomes one graph.
Points enter it in batches: a greedy search from the start proposes neighbours, and relaxed
distance pruning keeps the near ones that no kept one stands clearly nearer to, so the edges
point in different directions. Edges lead back as well, and a point with too many is pruned
anew. A beam search of every shard answers each query; the best of all shards are merged, and
their scores are inner products of the original vectors in double precision.

Within a shard a vector gets one more component that gives all the same length, so the
largest inner product is the nearest point. That form only guides the
search.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window, functions as F

from veilspark.sources.scratch import materialise

SHARD = 16384  # vectors of a shard, about, and
NUMBERS = 1 << 22  # components of its vectors at most
DEGREE = 48  # edges that leave a point
BUILD_BEAM = 64
SEARCH_BEAM = 128
RELAXED = 1.1
AT_ONCE = 4  # points of a beam that are expanded in one step
QUERIES = 2048  # that meet a shard in one group
BATCH = 256


class Graph:
    """Points and the edges that leave each; `edges` is filled up with -1."""

    def __init__(self, points: np.ndarray, edges: np.ndarray, start: int):
        self.points, self.edges, self.start = points, edges, start
        self.squares = np.einsum("nd,nd->n", points, points)


def beam_search(graph: Graph, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(queries x beam) nearest points found, nearest first, and all that were expanded; filled up with -1."""
    count, size = len(queries), len(graph.points)
    degree = graph.edges.shape[1]
    seen = np.zeros((count, size), np.int16)
    seen[:, graph.start] = 1
    ids = np.full((count, beam), -1, np.int64)
    far = np.full((count, beam), np.inf)
    fresh = np.zeros((count, beam), bool)
    ids[:, 0], fresh[:, 0] = graph.start, True
    far[:, 0] = graph.squares[graph.start] - 2 * (queries @ graph.points[graph.start])
    expanded = []
    active = np.arange(count)
    while len(active):
        # The first unexpanded points of each beam.
        order = np.argsort(~fresh[active], axis=1, kind="stable")[:, :AT_ONCE]
        chosen = np.where(np.take_along_axis(fresh[active], order, 1), np.take_along_axis(ids[active], order, 1), -1)
        fresh[active[:, None], order] = False
        step = np.full((count, AT_ONCE), -1, np.int64)
        step[active] = chosen
        expanded.append(step)
        near = np.where(chosen[:, :, None] >= 0, graph.edges[chosen], -1).reshape(len(active), -1)
        row, place = np.nonzero((near >= 0) & (seen[active[:, None], near] == 0))
        point, whose = near[row, place], active[row]
        seen[whose, point] = place + 1  # of a point met twice the last counts
        once = seen[whose, point] == place + 1
        row, place, point, whose = row[once], place[once], point[once], whose[once]
        new = np.full((len(active), AT_ONCE * degree), np.inf)
        new[row, place] = graph.squares[point] - 2 * np.einsum("md,md->m", graph.points[point], queries[whose])
        all_far = np.concatenate([far[active], new], axis=1)
        best = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
        best = np.take_along_axis(best, np.argsort(np.take_along_axis(all_far, best, 1), axis=1, kind="stable"), 1)
        found = np.take_along_axis(all_far, best, 1)
        known = np.isfinite(found)
        ids[active] = np.where(known, np.take_along_axis(np.concatenate([ids[active], near], axis=1), best, 1), -1)
        far[active] = found
        is_new = np.concatenate([fresh[active], np.isfinite(new)], axis=1)
        fresh[active] = np.take_along_axis(is_new, best, 1) & known
        active = active[fresh[active].any(axis=1)]
    return ids, np.concatenate(expanded, axis=1) if expanded else np.full((count, 1), -1)


def prune(graph: Graph, points: np.ndarray, proposed: np.ndarray, relaxed: float) -> np.ndarray:
    """For each of `points` the edges kept of those proposed to it, nearest first; filled up with -1.

    The nearest is kept, all go that it is nearer to, by the factor `relaxed`, than the point is, and so on.
    """
    degree = graph.edges.shape[1]
    proposed = np.where(proposed == points[:, None], -1, proposed)
    own, others = graph.points[points], graph.points[proposed]
    squares = graph.squares[proposed]
    far = graph.squares[points][:, None] + squares - 2 * np.matmul(others, own[:, :, None])[:, :, 0]
    between = squares[:, :, None] + squares[:, None, :] - 2 * np.matmul(others, others.transpose(0, 2, 1))
    rows = np.arange(len(points))
    left = np.where(proposed >= 0, np.maximum(far, 0), np.inf)
    limit = left / (relaxed * relaxed)  # squares of distances
    kept = np.full((len(points), degree), -1, np.int64)
    for place in range(degree):
        nearest = np.argmin(left, axis=1)
        some = np.isfinite(left[rows, nearest])
        if not some.any():
            break
        kept[some, place] = proposed[rows, nearest][some]
        left[between[rows, nearest] <= limit] = np.inf
        left[rows, nearest] = np.inf
        left[proposed == proposed[rows, nearest][:, None]] = np.inf
    return kept


def build(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, relaxed: float = RELAXED, seed: int = 0) -> Graph:
    """The graph of distinct points of the same length."""
    size = len(points)
    middle = points.mean(axis=0)
    start = int(np.argmin(((points - middle) ** 2).sum(axis=1)))
    graph = Graph(points, np.full((size, degree), -1, np.int64), start)
    order = np.random.default_rng(seed).permutation(size)
    order = order[order != start]
    at, batch = 0, 1
    while at < len(order):
        some = order[at : at + batch]
        _, proposed = beam_search(graph, points[some], beam)
        graph.edges[some] = prune(graph, some, proposed, relaxed)
        _lead_back(graph, some, relaxed)
        at += len(some)
        batch = min(BATCH, max(1, at))
    _reach_all(graph, beam)
    return graph


def _reach_all(graph: Graph, beam: int) -> None:
    """An edge to each point that none leads to from the start: from the nearest found, or from another point with the same nearest.

    Where there is no place for it, the edges get a column more.
    """
    while True:
        seen = np.zeros(len(graph.points), bool)
        new = np.array([graph.start])
        while len(new):
            seen[new] = True
            ends = np.unique(graph.edges[new])
            new = ends[(ends >= 0) & ~seen[ends]]
        lost = np.flatnonzero(~seen)[:BATCH]
        if not len(lost):
            return
        found, _ = beam_search(graph, graph.points[lost], beam)
        order = np.argsort(found[:, 0], kind="stable")
        source, lost = found[order, 0], lost[order]
        alike = np.flatnonzero(source[1:] == source[:-1])
        source[alike + 1] = lost[alike]
        if (graph.edges[source] >= 0).all(axis=1).any():
            graph.edges = np.concatenate([graph.edges, np.full((len(seen), 1), -1, np.int64)], axis=1)
        graph.edges[source, np.argmax(graph.edges[source] < 0, axis=1)] = lost


def _lead_back(graph: Graph, points: np.ndarray, relaxed: float) -> None:
    """Edges back to `points`; where there is no place for them, the edges are pruned anew."""
    degree = graph.edges.shape[1]
    source, place = np.nonzero(graph.edges[points] >= 0)
    target, source = graph.edges[points][source, place], points[source]
    order = np.argsort(target, kind="stable")
    target, source = target[order], source[order]
    ends, first, more = np.unique(target, return_index=True, return_counts=True)
    for low in range(0, len(ends), BATCH):
        own, begin, count = (x[low : low + BATCH] for x in (ends, first, more))
        new = np.full((len(own), int(count.max())), -1, np.int64)
        row = np.repeat(np.arange(len(own)), count)
        column = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        new[row, column] = source[begin[0] : begin[0] + len(row)]
        both = np.concatenate([graph.edges[own], new], axis=1)
        wide = (both >= 0).sum(axis=1) > degree
        packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)
        graph.edges[own[~wide]] = packed[~wide, :degree]
        if wide.any():
            graph.edges[own[wide]] = prune(graph, own[wide], both[wide], relaxed)


def same_length(vectors: np.ndarray) -> np.ndarray:
    """Vectors scaled, with one more component that makes them equally long."""
    scaled = vectors / np.abs(vectors).max()
    squares = (scaled * scaled).sum(axis=1)
    return np.hstack([scaled, np.sqrt(squares.max() - squares)[:, None]])


def products(queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Inner product of each query and its vectors `ids`, component after component, so equal vectors have equal ones."""
    some = vectors[ids]
    out = np.zeros(ids.shape)
    for d in range(queries.shape[1]):
        out += some[:, :, d] * queries[:, d, None]
    return out


class Shard:
    """A graph with its original vectors and the rows that have each of them."""

    def __init__(self, graph: Graph, vectors: np.ndarray, ids: np.ndarray, counts: np.ndarray):
        self.graph, self.vectors, self.ids, self.counts = graph, vectors, ids, counts
        self.heads = np.concatenate(([0], np.cumsum(counts)))

    def best(self, query_ids: np.ndarray, queries: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, ...]:
        """query number, vec_id and score of the `k` best rows found of another vec_id, all of them if fewer."""
        out: tuple[list, ...] = ([], [], [])
        todo = np.arange(len(queries))
        while len(todo):
            again = []
            for low in range(0, len(todo), BATCH):
                again.append(self._best(todo[low : low + BATCH], query_ids, queries, k, beam, out))
            todo = np.concatenate(again)
            beam *= 2
        return tuple(np.concatenate(column) if column else np.zeros(0, np.int64) for column in out)

    def _best(self, some: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, beam: int, out: tuple[list, ...]) -> np.ndarray:
        """Adds to `out` what is found, and returns the queries that a wider beam may find more for."""
        beam = min(beam, len(self.vectors))
        own = queries[some]
        guide = np.hstack([own / np.maximum(np.abs(own).max(axis=1, keepdims=True), 5e-324), np.zeros((len(own), 1))])
        nodes, _ = beam_search(self.graph, guide, beam)
        exact = products(own, self.vectors, np.maximum(nodes, 0))
        short = []
        for number, line, score in zip(some, nodes, exact):
            known = line >= 0
            line, score = line[known], score[known]
            sizes = self.counts[line]
            places = np.repeat(self.heads[line] + sizes - np.cumsum(sizes), sizes) + np.arange(sizes.sum())
            ids, score = self.ids[places], np.repeat(score, sizes)
            other = ids != query_ids[number]
            ids, score = ids[other], score[other]
            if len(ids) < k and beam < len(self.vectors):
                short.append(number)
                continue
            best = np.lexsort((ids, -score))[:k]
            for column, part in zip(out, (np.full(len(best), number), ids[best], score[best])):
                column.append(part)
        return np.array(short, np.int64)


def clean_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id and v, distinct, without null ids and without vectors that are null, zero or have a null or non-finite component."""
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.coalesce(finite, F.lit(False)))
    return rows.where(F.exists("v", lambda c: c != 0)).distinct()


def _vectors(table: pa.Table, width: int) -> np.ndarray:
    column = table.column("v").combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(-1, width)


def build_index(rows: DataFrame, width: int, shards: int, k: int) -> DataFrame:
    """A row for each shard of the distinct vectors in `rows`, stored: vectors, edges, and of each vector the k + 1 smallest ids.

    A query's own id is at most one of these, so no other row can be among its `k` best.
    """
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.withColumn("place", place).where(F.col("place") <= k + 1)
    alike = few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    dealt = alike.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)))

    def index(key: tuple, group: pa.Table) -> pa.Table:
        own = _vectors(group, width)
        graph = build(same_length(own), seed=key[0].as_py())
        ids = group.column("ids").combine_chunks()
        row = {
            "shard": [key[0].as_py()],
            "start": [graph.start],
            "vectors": [own.tobytes()],
            "edges": [graph.edges.astype("<i4").tobytes()],
            "counts": [np.asarray(pa.compute.list_value_length(ids), "<i4").tobytes()],
            "ids": [np.asarray(ids.flatten(), "<i8").tobytes()],
        }
        return pa.table(row, schema=kinds)

    kinds = pa.schema({"shard": pa.int64(), "start": pa.int64()} | dict.fromkeys(("vectors", "edges", "counts", "ids"), pa.binary()))
    built = dealt.groupBy("shard").applyInArrow(index, "shard long, start long, vectors binary, edges binary, counts binary, ids binary")
    return materialise(built, "graphs")


def load(row: dict, width: int) -> Shard:
    """The shard of an index row."""
    vectors = np.frombuffer(row["vectors"]).reshape(-1, width)
    edges = np.frombuffer(row["edges"], "<i4").reshape(len(vectors), -1).astype(np.int64)
    graph = Graph(same_length(vectors), edges, row["start"])
    return Shard(graph, vectors, np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["counts"], "<i4"))


def _numbers(count: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))


def search(vectors: DataFrame, every: int = 20, k: int = 20, shard: int = SHARD, beam: int = SEARCH_BEAM) -> DataFrame:
    """query_id, rank, vec_id, score: the `k` nearest found of each vector whose vec_id is divisible by `every`.

    `vectors` has vec_id and embedding; other columns are ignored. Nearest is the largest inner
    product. Candidates are all rows but those of the query's own id; fewer than `k` are all
    returned. Ties go to the smaller vec_id. Rows that are null, zero or have a null or non-finite
    component take no part, and equal rows count once. Of a vec_id with several vectors each is a candidate, and the
    best of the id as a query are those of all its vectors. Shorter vectors count as filled up
    with zeros. No rows give no rows.
    """
    spark = vectors.sparkSession
    clean = materialise(clean_vectors(vectors), "vectors")
    size = clean.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    if not size["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = size["width"]
    filled = F.concat("v", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("v")))
    clean = clean.withColumn("v", filled) if clean.where(F.size("v") < width).take(1) else clean
    shards = -(-size["n"] // max(64, min(shard, NUMBERS // width)))
    graphs = build_index(clean, width, shards, k)
    asked = clean.where(F.col("vec_id") % every == 0)
    slots = max(1, -(-asked.count() // QUERIES))
    slot = F.pmod(F.xxhash64("vec_id", "v", F.lit(1)), F.lit(slots)).alias("slot")
    asked = asked.select("vec_id", "v", slot, F.explode(_numbers(shards)).alias("shard"))
    graphs = graphs.withColumn("slot", F.explode(_numbers(slots)))

    def solve(graph: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(graph) or not len(queries):
            return pa.table({name: [] for name in kinds.names}, schema=kinds)
        at = load(graph.to_pylist()[0], width)
        ids = np.asarray(queries.column("vec_id"), np.int64)
        number, vec_id, score = at.best(ids, _vectors(queries, width), k, beam)
        return pa.table([pa.array(ids[number.astype(np.int64)]), pa.array(vec_id, pa.int64()), pa.array(score, pa.float64())], schema=kinds)

    kinds = pa.schema({"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()})
    met = graphs.groupBy("shard", "slot").cogroup(asked.groupBy("shard", "slot"))
    found = met.applyInArrow(solve, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
