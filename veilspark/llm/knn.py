"""Exact top-k search by inner product as a Voronoi join.

Vectors become whole numbers. Data and queries are grouped by their nearest pivot. From
summaries of the groups (sizes, radii, the distances nearest to each pivot) follow, for each
group of queries, a score that the k best of any of its queries reach at least, and for each
group of data a score that none of its vectors can exceed. Only data that may reach the
former is sent to a group of queries, where the best are found by a matrix product. All
bounds are those of inner products: q.x lies within |q| |x - p| of q.p for a pivot p.

Equal vectors are one vector with its 2k smallest ids, of one id k at most: others can't be among the best. A
group is cut in blocks of bounded size, so no task holds a whole one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from veilspark.llm.common import partitions, with_columns
from veilspark.sources.scratch import materialise

DATA_BLOCK = 8192
QUERY_BLOCK = 1024
MOST_PIVOTS = 2048


def whole_vectors(vectors: DataFrame, factor: int = 64, all_rows: bool = False) -> DataFrame:
    """vec_id and v, the floors of `factor` times each component of `embedding`.

    Without rows whose vec_id or embedding is null, or that have a null or non-finite component.
    Of rows that share a vec_id the one whose vector sorts first counts, or with `all_rows` each.
    """
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    doubles = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    rows = doubles.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & F.coalesce(finite, F.lit(False)))
    floors = F.transform("x", lambda c: F.floor(F.lit(factor) * c).cast("long"))
    whole = rows.select("vec_id", floors.alias("v"))
    return whole if all_rows else whole.groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of a list array, padded with zeros to `width`."""
    ends = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.to_numpy()
    lengths = np.diff(ends)
    if len(lengths) and (lengths == width).all():
        return values[ends[0] : ends[-1]].reshape(-1, width)
    out = np.zeros((len(lengths), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(row)) - np.repeat(ends[:-1] - ends[0], lengths)] = values[ends[0] : ends[-1]]
    return out


def nearest(rows: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each row and its distance."""
    x, p = rows.astype(np.float64), pivots.astype(np.float64)
    cells, far = np.zeros(len(x), np.int64), np.zeros(len(x))
    for at in range(0, len(x), 4096):
        part = x[at : at + 4096]
        cell = np.argmin((p * p).sum(axis=1) - 2 * part @ p.T, axis=1)
        cells[at : at + 4096] = cell
        far[at : at + 4096] = np.sqrt(((part - p[cell]) ** 2).sum(axis=1))
    return cells, far


class Bounds:
    """For cells of queries the cells of data that may matter.

    `data`: each data cell's radius, largest norm and ascending distances near its pivot. The vectors at those
    distances have different ids, over all cells, so k + 1 of them are k of other ids than any query's.
    """

    def __init__(self, pivots: np.ndarray, data: dict[int, dict], k: int):
        p = pivots.astype(np.float64)
        self.norm, self.dots, self.k = np.sqrt((p * p).sum(axis=1)), p @ p.T, k
        self.cells = np.array(sorted(data))
        rows = [data[cell] for cell in self.cells.tolist()]
        self.radius, self.longest = (np.array([row[name] for row in rows]) for name in ("radius", "norm"))
        self.near = np.full((len(rows), k + 1), np.inf)
        for line, row in zip(self.near, rows):
            line[: len(row["near"])] = row["near"][: k + 1]

    def of(self, cell: int, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """Data cells, and the least distance to its pivot that a vector of each needs, for queries within `reach`.

        A little slack covers rounding.
        """
        longest, dots, norm = self.norm[cell] + reach, self.dots[cell, self.cells], self.norm[self.cells]
        slack = 1e-9 * (1 + longest * (self.longest + norm).max())
        sure = (dots - reach * norm)[:, None] - (longest * self.near if longest else np.where(np.isfinite(self.near), 0, np.inf))
        sure = sure[np.isfinite(self.near)]
        floor = -np.inf if len(sure) <= self.k else np.partition(sure, len(sure) - self.k - 1)[len(sure) - self.k - 1]
        centre = dots + reach * norm
        most = np.minimum(centre + longest * self.radius, longest * self.longest)
        least = (floor - slack - centre) / longest if longest and floor > -np.inf else np.full(len(dots), -1.0)
        some = most + slack >= floor
        return self.cells[some], np.maximum(-1.0, least - 1e-9 * (1 + np.abs(least)))[some]


def group_bounds(pivots: np.ndarray, radius: dict[int, float], data: dict[int, dict], k: int) -> list[tuple[int, int, float]]:
    """(query cell, data cell, least distance) for query cells with their `radius`."""
    bounds = Bounds(pivots, data, k)
    return [(i, int(j), float(least)) for i, r in radius.items() for j, least in zip(*bounds.of(i, r))]


def scores(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact below 2 ** 63."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(data).max(initial=0)) * queries.shape[1]
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
    return queries.astype(kind) @ data.astype(kind).T


def best(line: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller `first`."""
    some = np.arange(len(line))
    if len(line) > 4 * k:
        some = np.flatnonzero(line >= np.partition(line, len(line) - k)[len(line) - k])
    return some[np.lexsort((first[some], -line[some].astype(np.int64)))[:k]]


def first_rows(line: np.ndarray, first: np.ndarray, ids: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """vec_id and score of the 2k first rows of vectors with these scores, of each vec_id k at most.

    `ids` has the rows of each vector and `first` the smallest. Each of m vectors has a row before all of the
    other vectors, so of their rows the first m are those of all.
    """
    m = 4 * k
    while True:
        places = best(line, first, m)
        some = [ids[p] for p in places]
        value, found = np.repeat(line[places].astype(np.int64), [len(x) for x in some]), np.concatenate(some)
        order = np.lexsort((found, -value))
        order = order[:m] if m < len(line) else order
        found, value = found[order], value[order]
        by_id = np.argsort(found, kind="stable")
        begins = np.flatnonzero(np.diff(found[by_id], prepend=found[by_id[:1]] - 1))
        turn = np.empty(len(found), np.int64)
        turn[by_id] = np.arange(len(found)) - np.repeat(begins, np.diff(np.append(begins, len(found))))
        kept = np.flatnonzero(turn < k)[: 2 * k]
        if len(kept) == 2 * k or m >= len(line):
            return found[kept], value[kept]
        m *= 4


def top_k(vectors: DataFrame, every: int = 20, k: int = 20, factor: int = 64, block: int = DATA_BLOCK, all_rows: bool = False) -> DataFrame:
    """query_id, rank, vec_id, score: the `k` best of each vector whose vec_id is divisible by `every`.

    `vectors` has vec_id and embedding; other columns are ignored. Candidates are all vectors
    but the query's own id; fewer than `k` give fewer rows. Ties go to the smaller vec_id.
    Vectors that `whole_vectors` leaves out take no part. Of vectors of several lengths the
    shorter count as filled up with zeros. No rows give no rows.

    With `all_rows` all rows of a vec_id are candidates, and the best of a query's id are the best
    of all pairs of one of its rows and a row of another id, as the SQL says.
    """
    spark = vectors.sparkSession
    clean = materialise(whole_vectors(vectors, factor, all_rows), "vectors")
    size = clean.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not size["n"]:
        return empty
    width = max(1, size["width"])
    # Of one id k rows at most can be among the best; so of k of an id and k more, k are another's.
    few = clean
    if all_rows:
        again = F.row_number().over(Window.partitionBy("v", "vec_id").orderBy("vec_id"))
        few = few.withColumn("place", again).where(F.col("place") <= k)
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = few.withColumn("place", place).where(F.col("place") <= 2 * k)
    alike = few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    # A number for each distinct vector; with `all_rows` several may have the same smallest id.
    alike = alike.withColumn("rep", F.monotonically_increasing_id() if all_rows else F.col("ids")[0])
    asked = clean.where(F.col("vec_id") % every == 0)
    asking = asked.select("v").distinct().withColumn("asks", F.lit(True))
    alike = materialise(alike.join(asking, "v", "left").withColumn("asks", F.coalesce("asks", F.lit(False))), "alike")
    # As many pivots as blocks of data, drawn by hash from the distinct vectors.
    most = max(1, min(MOST_PIVOTS, -(-alike.count() // block)))
    drawn = alike.select("v", "rep").orderBy(F.xxhash64("v"), "rep").limit(most).collect()
    pivots = np.array([list(row["v"]) + [0] * (width - len(row["v"])) for row in drawn], np.int64)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column("v"), width)
            cell, far = nearest(rows, pivots)
            norm = np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1))
            columns = [*batch.columns, pa.array(cell), pa.array(far), pa.array(norm)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "cell", "far", "norm"])

    schema = with_columns(alike, cell="long", far="double", norm="double")
    grouped = materialise(alike.mapInArrow(assign, schema), "grouped")

    near = F.row_number().over(Window.partitionBy("cell").orderBy("far", "id"))
    of_id = grouped.groupBy(F.col("ids")[0].alias("id")).agg(F.min(F.struct("far", "cell")).alias("at"))
    nearest_of = of_id.select("id", "at.far", "at.cell").withColumn("place", near).where(F.col("place") <= k + 1)
    nearest_of = nearest_of.groupBy("cell").agg(F.sort_array(F.collect_list("far")).alias("near"))
    summary = grouped.groupBy("cell").agg(
        F.count("*").alias("n"),
        F.max("far").alias("radius"),
        F.max("norm").alias("norm"),
        F.count_if("asks").alias("asking"),
        F.max(F.when(F.col("asks"), F.col("far"))).alias("reach"),
    )
    data = {row["cell"]: row.asDict() | {"near": row["near"] or []} for row in summary.join(nearest_of, "cell", "left").collect()}
    reach = {cell: row["reach"] for cell, row in data.items() if row["asking"]}
    if not reach:
        return empty
    sizes = spark.createDataFrame(
        [(c, -(-row["n"] // block), max(1, -(-row["asking"] // QUERY_BLOCK))) for c, row in data.items()],
        "cell long, data_blocks long, query_blocks long",
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = Bounds(pivots, data, k)
        for batch in batches:
            for cell, far in zip(batch.column("query_cell").to_pylist(), batch.column("reach").to_pylist()):
                cells, least = bounds.of(cell, far)
                yield pa.RecordBatch.from_arrays([pa.array([cell] * len(cells), pa.int64()), pa.array(cells), pa.array(least)], ["query_cell", "data_cell", "least"])

    asking_cells = spark.createDataFrame(list(reach.items()), "query_cell long, reach double").repartition(partitions(alike), "query_cell")
    pairs = asking_cells.mapInArrow(meet, "query_cell long, data_cell long, least double")

    def pack(names: tuple[str, ...]):
        def run(key: tuple, group: pa.Table) -> pa.Table:
            group = group.combine_chunks()
            rows = _matrix(group.column("v").combine_chunks() if group.num_rows else group.column("v"), width)
            kind = np.result_type(np.min_scalar_type(int(rows.min())), np.min_scalar_type(int(rows.max())), np.int16)
            ids = group.column("ids").to_pylist()
            columns = {
                "cell": [key[0].as_py()],
                "block": [key[1].as_py()],
                "kind": [kind.str],
                "rows": [rows.astype(kind).tobytes()],
                "ids": [np.concatenate([np.array(x, "<i8") for x in ids]).tobytes()],
                "counts": [np.array([len(x) for x in ids], "<i4").tobytes()],
                "far": [group.column("far").to_numpy().astype("<f8").tobytes()],
            }
            return pa.table({name: pa.array(columns[name], kinds[name]) for name in names})

        kinds = {"cell": pa.int64(), "block": pa.int64(), "kind": pa.string()} | dict.fromkeys(
            ("rows", "ids", "counts", "far"), pa.binary()
        )
        return run

    packed = "cell long, block long, kind string, rows binary, ids binary, counts binary, far binary"
    names = tuple(part.split()[0] for part in packed.split(", "))
    sized = grouped.join(F.broadcast(sizes), "cell")  # a row for each pivot, 2048 at most
    blocked = lambda column: F.pmod(F.xxhash64("rep"), F.col(column)).alias("block")
    blocks = sized.select("cell", blocked("data_blocks"), "v", "ids", "far").groupBy("cell", "block").applyInArrow(pack(names), packed)
    asks = sized.where("asks").select("cell", blocked("query_blocks"), "v", F.array("rep").alias("ids"), "far")
    asks = asks.groupBy("cell", "block").applyInArrow(pack(names), packed)
    asks = asks.selectExpr("cell as query_cell", "block as query_block", "kind as query_kind", "rows as queries", "ids as query_ids", "counts as query_counts")
    meetings = asks.join(pairs, "query_cell").join(blocks.withColumnRenamed("cell", "data_cell"), "data_cell")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                at = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                rows = np.frombuffer(at["rows"], at["kind"]).reshape(-1, width)
                ends = np.cumsum(np.frombuffer(at["counts"], "<i4"))
                ids = np.split(np.frombuffer(at["ids"], "<i8"), ends[:-1])
                near_ = np.flatnonzero(np.frombuffer(at["far"], "<f8") >= at["least"])
                if not len(near_):
                    continue
                queries = np.frombuffer(at["queries"], at["query_kind"]).reshape(-1, width)
                heads = np.concatenate(([0], np.cumsum(np.frombuffer(at["query_counts"], "<i4"))[:-1]))
                reps = np.frombuffer(at["query_ids"], "<i8")[heads]
                first = np.array([x[0] for x in ids])[near_]
                table = scores(queries, rows[near_])
                out = [[], [], []]
                for rep, line in zip(reps, table):
                    found_ids, value = first_rows(line, first, [ids[p] for p in near_] if len(near_) < len(ids) else ids, k)
                    for column, part in zip(out, (np.full(len(value), rep), found_ids, value)):
                        column.append(part)
                columns = [pa.array(np.concatenate(column)) for column in out]
                yield pa.RecordBatch.from_arrays(columns, ["rep", "vec_id", "score"])

    found = meetings.select(
        "query_kind", "queries", "query_ids", "query_counts", "kind", "rows", "ids", "counts", "far", "least"
    ).mapInArrow(solve, "rep long, vec_id long, score long")
    order = [F.desc("score"), F.asc("vec_id")]
    if all_rows:
        of_id = F.row_number().over(Window.partitionBy("rep", "vec_id").orderBy(F.desc("score")))
        found = found.withColumn("place", of_id).where(F.col("place") <= k)
    ranked = found.withColumn("place", F.row_number().over(Window.partitionBy("rep").orderBy(*order))).where(F.col("place") <= 2 * k)
    lists = ranked.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("list"))
    queries = asked.select(F.col("vec_id").alias("query_id"), "v").join(alike.select("v", "rep"), "v").select("query_id", "rep")
    own = F.slice(F.filter("list", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    rows = queries.join(lists, "rep").select("query_id", F.posexplode(own).alias("place", "hit"))
    if all_rows:
        best_of_id = Window.partitionBy("query_id").orderBy(F.desc("hit.score"), "hit.vec_id")
        rows = rows.withColumn("place", F.row_number().over(best_of_id) - 1).where(F.col("place") < k)
    return rows.select("query_id", (F.col("place") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
