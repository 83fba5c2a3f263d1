"""Hard negatives by inner product with length buckets and pruned coordinates.

Vectors become whole numbers, are ordered by length and cut into buckets. A bucket keeps, for each
coordinate, its unit vectors' values in ascending order. A search asks for the rows whose
product with an anchor reaches some least score: that and the bucket's largest length give an
angle, and from the angle follow, for the anchor's largest coordinates (its focus), the
values a row can have. The rows within all these ranges are the candidates, and only their
products are computed. Buckets that are too short for the least score are never sent.

Least scores come from a bounded sample of the rows: what its k-th best reaches, the k-th best
of all rows reaches as well. The sample decides how much is pruned, not what is found.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from veilspark.llm.common import partitions, running_start, with_columns
from veilspark.llm.knn import best, scores
from veilspark.sources.scratch import materialise

BUCKET = 4096  # rows of a bucket at most
SLOT = 1024  # anchors that are sent together
SAMPLE = 4096  # rows of the sample at most, and
NUMBERS = 1 << 19  # components of its vectors at most
FOCUS = 5  # coordinates of an anchor that are looked at
SLACK = 1e-5  # for values in single precision


def clean_rows(vectors: DataFrame, factor: int = 256) -> DataFrame:
    """Distinct vec_id, label and v, the floors of `factor` times the components, and `norm`, the length of v."""
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select("vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("x"))
    known = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()
    floors = F.transform("x", lambda c: F.floor(F.lit(factor) * c).cast("long"))
    rows = rows.where(known & F.coalesce(finite, F.lit(False))).select("vec_id", "label", floors.alias("v")).distinct()
    squares = F.aggregate("v", F.lit(0.0), lambda sum_, c: sum_ + c.cast("double") * c)
    return rows.withColumn("norm", F.sqrt(squares))


def _vectors(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    column = table.column("v")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.int64).reshape(len(table), -1)


def _whole(table: pa.Table | pa.RecordBatch, name: str) -> np.ndarray:
    return np.asarray(table.column(name))


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as stream:
        stream.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def _unpacked(content: bytes) -> pa.Table:
    return pa.ipc.open_stream(content).read_all()


def _blocks(rows: DataFrame, order: str, size: int, label: str) -> DataFrame:
    """Stored rows `number`, `most`, `least` and `content`: at most `size` rows each, in descending `order`, numbered from 0.

    `most` and `least` are of `order` within the block. Rows are dealt in ranges, equal ones as well.
    """
    salted = rows.withColumn("salt", F.xxhash64("vec_id", "v"))
    keys = [F.desc(order), F.col("salt")]
    ranges = salted.repartitionByRange(partitions(rows), *keys).sortWithinPartitions(*keys).drop("salt")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, place = [], 0
        for batch in batches:
            held.append(batch)
            while sum(map(len, held)) >= size:
                table = pa.Table.from_batches(held)
                yield block(table[:size], place)
                held, place = table[size:].to_batches(), place + 1
        if sum(map(len, held)):
            yield block(pa.Table.from_batches(held), place)

    def block(table: pa.Table, place: int) -> pa.RecordBatch:
        values = _whole(table, order)
        slice_ = table.column("slice")[0].as_py()
        row = ([slice_], [place], [values.max()], [values.min()], [_packed(table.drop_columns(["slice"]))])
        return pa.RecordBatch.from_arrays(list(map(pa.array, row)), ["slice", "place", "most", "least", "content"])

    cut_up = ranges.withColumn("slice", F.spark_partition_id().cast("long"))
    stored = materialise(cut_up.mapInArrow(cut, "slice long, place long, most double, least double, content binary"), label)
    starts = running_start(stored.groupBy("slice").agg(F.count("*").alias("blocks")), "slice", "blocks", "start")
    starts = F.broadcast(materialise(starts.select("slice", "start"), label))  # a row for each partition at most
    return stored.join(starts, "slice").select((F.col("start") + F.col("place")).alias("number"), "most", "least", "content")


class Bucket:
    """Rows of similar length and, of each coordinate, the ascending values of their unit vectors."""

    def __init__(self, table: pa.Table):
        self.ids, self.labels, self.rows = _whole(table, "vec_id"), _whole(table, "label"), _vectors(table)
        norm = _whole(table, "norm")
        self.longest = float(norm.max())
        unit = (self.rows / np.where(norm > 0, norm, 1)[:, None]).astype(np.float32)
        self.places = np.argsort(unit.T, axis=1, kind="stable")
        self.values = np.take_along_axis(unit.T, self.places, 1)

    def candidates(self, anchor: np.ndarray, norm: float, least: float) -> np.ndarray | None:
        """Places of all rows whose product with the anchor may reach `least`; None: all rows."""
        if least <= 0:
            return None
        cosine = least / (norm * self.longest) - SLACK if norm and self.longest else 2.0
        if cosine > 1:
            return np.zeros(0, np.int64)
        if cosine <= 0:
            return None
        unit, angle = anchor / norm, np.arccos(cosine)
        hits, looked = np.zeros(len(self.ids), np.uint8), 0
        for focus in np.argsort(-np.abs(unit), kind="stable")[:FOCUS]:
            own = np.arccos(np.clip(unit[focus], -1, 1))
            low, high = np.cos(min(np.pi, own + angle)) - SLACK, np.cos(max(0.0, own - angle)) + SLACK
            begin, end = np.searchsorted(self.values[focus], low, "left"), np.searchsorted(self.values[focus], high, "right")
            if begin > 0 or end < len(hits):
                hits[self.places[focus, begin:end]] += 1
                looked += 1
        return np.flatnonzero(hits == looked) if looked else None

    def products(self, anchors: np.ndarray, norms: np.ndarray, least: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each anchor its number, the places of rows that reach its least score, and their exact scores."""
        some = [self.candidates(anchor, norm, bound) for anchor, norm, bound in zip(anchors, norms, least)]
        whole = [number for number, places in enumerate(some) if places is None]
        every = np.arange(len(self.ids))
        if whole:
            for number, line in zip(whole, scores(anchors[whole], self.rows)):
                reached = line >= least[number]
                yield number, every[reached], line[reached].astype(np.int64)
        for number, places in enumerate(some):
            if places is not None and len(places):
                line = scores(anchors[number : number + 1], self.rows[places])[0]
                reached = line >= least[number]
                yield number, places[reached], line[reached].astype(np.int64)


def _first(line: np.ndarray, ids: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Places of the `k` highest scores that are allowed, ties to smaller ids."""
    some = np.flatnonzero(allowed)
    return some[best(line[some], ids[some], k)]


def _retrieve(asked: DataFrame, buckets: DataFrame, count: int, solve: Callable, schema: str) -> DataFrame:
    """What `solve` finds for all anchors, each with its norm and `least` score, in the buckets that are long enough.

    `solve` takes a Bucket and a table of anchors and returns a table.
    """
    need = F.when(F.col("least") <= 0, float("-inf")).when(F.col("norm") > 0, F.col("least") / F.col("norm")).otherwise(float("inf"))
    slots = _blocks(asked.withColumn("need", need), "need", SLOT, "slots")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
    pairs = slots.select(F.col("number").alias("slot"), "least", every.alias("bucket"))
    lengths = buckets.select(F.col("number").alias("bucket"), F.col("most").alias("longest"))
    pairs = pairs.join(lengths, "bucket").where(F.col("longest") * (1 + SLACK) >= F.col("least")).select("slot", "bucket")
    met = pairs.join(slots.select(F.col("number").alias("slot"), F.col("content").alias("anchors")), "slot")
    met = met.join(buckets.select(F.col("number").alias("bucket"), "content"), "bucket").select("anchors", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bucket = None, None
        for batch in batches:
            for anchors, content in zip(batch.column("anchors"), batch.column("content")):
                content = content.as_py()
                if content != held:
                    held, bucket = content, Bucket(_unpacked(content))
                yield from solve(bucket, _unpacked(anchors.as_py())).to_batches()

    return met.mapInArrow(run, schema)


def _columns(out: list[list[np.ndarray]], names: list[str]) -> pa.Table:
    parts = [np.concatenate(column) if column else np.zeros(0, np.int64) for column in out]
    return pa.table([pa.array(part.astype(np.int64)) for part in parts], names)


def window(score: int) -> tuple[int, int]:
    """The least and the largest n with 30 * score <= 100 * n <= 90 * score."""
    return -(-3 * score // 10), 9 * score // 10


def mine(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, factor: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are rows whose vec_id is divisible by `every`. Their positives are the first rows of
    another vec_id with the same label, and each positive's negatives the first rows of another label
    with scores from 0.3 to 0.9 of its score; higher scores come first, ties by smaller vec_id.
    Where there are fewer than asked for, all are returned.

    `vectors` has vec_id, label and embedding; other columns are ignored. Rows without vec_id or label,
    without a vector, or with a null or non-finite component take no part. Equal rows count once;
    rows that share a vec_id but not label and vector are rows of their own, also as anchors. Shorter vectors
    count as filled up with zeros. Scores are exact while they fit in 64 bits. No rows give no rows.
    """
    spark = vectors.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = materialise(clean_rows(vectors, factor), "vectors")
    width = rows.agg(F.max(F.size("v"))).first()[0]
    if not width:
        if width is None:
            return spark.createDataFrame([], schema)
        width = 1
    filled = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("v")))
    rows = rows.withColumn("v", filled) if rows.where(F.size("v") < width).take(1) else rows
    drawn = rows.orderBy(F.xxhash64("v", "vec_id"), "vec_id", "label").limit(max(1, min(SAMPLE, NUMBERS // width))).collect()
    sample = np.array([row["v"] for row in drawn], np.int64)
    sample_ids = np.array([row["vec_id"] for row in drawn], np.int64)
    sample_labels = np.array([row["label"] for row in drawn], np.int64)
    buckets = _blocks(rows, "norm", BUCKET, "buckets")
    count = buckets.count()
    anchors = materialise(rows.where(F.col("vec_id") % every == 0).withColumn("key", F.monotonically_increasing_id()), "anchors")

    def bound_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = []
            for vec_id, label, line in zip(_whole(batch, "vec_id"), _whole(batch, "label"), scores(_vectors(batch), sample)):
                same = line[(sample_labels == label) & (sample_ids != vec_id)]
                least.append(float(np.sort(same)[-positives]) if len(same) >= positives else -np.inf)
            yield batch.append_column("least", pa.array(least, pa.float64()))

    def solve_positives(bucket: Bucket, asked: pa.Table) -> pa.Table:
        key, ids, labels = (_whole(asked, name) for name in ("key", "vec_id", "label"))
        out = [[], [], []]
        for number, places, line in bucket.products(_vectors(asked), _whole(asked, "norm"), _whole(asked, "least")):
            own = bucket.ids[places]
            chosen = _first(line, own, (bucket.labels[places] == labels[number]) & (own != ids[number]), positives)
            for column, part in zip(out, (np.full(len(chosen), key[number]), own[chosen], line[chosen])):
                column.append(part)
        return _columns(out, ["key", "positive_id", "positive_score"])

    asked = anchors.mapInArrow(bound_positives, with_columns(anchors, least="double"))
    found = _retrieve(asked, buckets, count, solve_positives, "key long, positive_id long, positive_score long")
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("positive_score"), "positive_id"))
    found = found.withColumn("place", rank).where(F.col("place") <= positives)
    firsts = found.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("firsts"))
    firsts = firsts.select("key", F.col("firsts.positive_id").alias("positive_ids"), F.col("firsts.positive_score").alias("positive_scores"))
    paired = materialise(anchors.join(firsts, "key").select(*anchors.columns, "positive_ids", "positive_scores"), "paired")

    def bound_negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = []
            every_bound = []
            found = batch.column("positive_scores").to_pylist()
            for label, of, line in zip(_whole(batch, "label"), found, scores(_vectors(batch), sample)):
                other = np.sort(line[sample_labels != label])
                bounds = []
                for low, high in map(window, of):
                    end = int(np.searchsorted(other, high, "right"))
                    bounds.append(max(low, int(other[end - negatives])) if end >= negatives else low)
                every_bound.append(bounds)
                least.append(float(min(bounds)))
            bounds = pa.array(every_bound, pa.list_(pa.int64()))
            yield batch.append_column("bounds", bounds).append_column("least", pa.array(least, pa.float64()))

    def solve_negatives(bucket: Bucket, asked: pa.Table) -> pa.Table:
        key, ids, labels = (_whole(asked, name) for name in ("key", "vec_id", "label"))
        firsts = [asked.column(name).to_pylist() for name in ("positive_ids", "positive_scores", "bounds")]
        out = [[] for _ in range(7)]
        for number, places, line in bucket.products(_vectors(asked), _whole(asked, "norm"), _whole(asked, "least")):
            own, other = bucket.ids[places], bucket.labels[places] != labels[number]
            for place, (positive_id, score, bound) in enumerate(zip(*(column[number] for column in firsts))):
                chosen = _first(line, own, other & (line >= bound) & (line <= window(score)[1]), negatives)
                for column, value in zip(out, (key[number], place, ids[number], positive_id, score)):
                    column.append(np.full(len(chosen), value))
                out[5].append(own[chosen])
                out[6].append(line[chosen])
        return _columns(out, names)

    names = ["key", "place", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
    asked = paired.mapInArrow(bound_negatives, with_columns(paired, bounds=T.ArrayType(T.LongType()), least="double"))
    found = _retrieve(asked, buckets, count, solve_negatives, ", ".join(f"{name} long" for name in names))
    rank = F.row_number().over(Window.partitionBy("key", "place").orderBy(F.desc("negative_score"), "negative_id"))
    found = found.withColumn("rank", rank).where(F.col("rank") <= negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
