"""Near duplicates by SimHash, compared in bit slices.

A document's fingerprint has a bit set if over half of its shingles' hashes have it.
Fingerprints that differ in at most `radius` bits are linked; documents linked over any
number of steps form a component.

Distinct fingerprints are cut into radius + 2 bands of bits. Two that are linked agree in
two bands at least, so each pair of bands gives buckets that hold every link. A bucket with
more than `BUCKET` fingerprints is cut again by bands of its open bits, until at most 16 bits
are open; so no task ever holds more than 65,536 of one bucket, whatever the data.

Within a bucket, fingerprints lie in blocks of 64, with one word for each bit of all 64. One
fingerprint is compared with a block by adding the differing bits of all 64 into carry-save
counters; a block is dropped once all its counters have run over the radius. Of the links
found only a spanning forest leaves the task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from veilspark.llm.common import free_names, partitions, with_columns
from veilspark.operators.joins import keyed_join
from veilspark.sources.scratch import materialise

BITS = 64
BUCKET = 4096
REMOVED = 250_000  # keys of rows that go, to send to all tasks
OPEN_BITS = 16
#: Pairs of a fingerprint and a block compared at a time, and shingle hashes counted at a time.
PAIRS = HASHES = 1 << 17
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shingle_hashes(text: Column, shingle: int) -> Column:
    """XXH64 (seed 42) of each run of `shingle` words; of all words, if fewer; none of no words.

    Words are what white space (space, tab to carriage return) divides, with A-Z lower-cased.
    """
    words = F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    count = F.greatest(F.size("words") - shingle + 1, F.lit(1))
    run = lambda i: F.xxhash64(F.concat_ws(" ", F.slice("words", i, shingle)))
    hashes = F.when(F.size("words") == 0, F.array().cast("array<long>")).otherwise(
        F.transform(F.sequence(F.lit(1), count), run)
    )
    return words.alias("words"), hashes.alias("hashes")


def majority(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Fingerprints of lists of hashes that lie one behind the other."""
    out = np.zeros(len(lengths), np.uint64)
    some = np.flatnonzero(lengths)
    if len(some):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts = np.add.reduceat(bits, (np.cumsum(lengths) - lengths)[some], axis=0, dtype=np.int32)
        over = counts * 2 > lengths[some, None]
        out[some] = np.packbits(over, axis=1, bitorder="little").view("<u8").reshape(-1)
    return out


def _sums(hashes: np.ndarray, length: int) -> np.ndarray:
    """The fingerprint of one long list, counted in pieces."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, length, HASHES):
        part = hashes[at : at + HASHES].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > length, bitorder="little").view("<u8")


def fingerprints(docs: DataFrame, shingle: int = 3, carried: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `carried` and fingerprint (long) of each row of `docs`, whose text is read whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("hashes")
            ends = column.offsets.to_numpy()
            hashes = column.values.to_numpy().view(np.uint64)
            lengths = np.diff(ends)
            prints, begin = np.zeros(len(batch), np.uint64), 0
            while begin < len(batch):
                end = max(begin + 1, int(np.searchsorted(ends, ends[begin] + HASHES, "right")) - 1)
                part = hashes[ends[begin] : ends[end]]
                if end == begin + 1 and len(part):
                    prints[begin:end] = _sums(part, len(part))
                else:
                    prints[begin:end] = majority(part, lengths[begin:end])
                begin = end
            columns = [*(batch.column(name) for name in carried), pa.array(prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [*carried, "fingerprint"])

    words, hashes = shingle_hashes(F.col("text"), shingle)
    hashed = docs.select(*carried, words).select(*carried, hashes)
    return hashed.mapInArrow(run, with_columns(docs.select(*carried), fingerprint="long"))


def planes(prints: np.ndarray, bit: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each of the 64 bits, a word for each block: bit j is that bit of its fingerprint j."""
    one = np.uint64(1)
    return np.stack([np.bitwise_or.reduceat((prints >> np.uint64(b) & one) << bit, starts) for b in range(BITS)])


def close_pairs(prints: np.ndarray, sizes: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j), i < j, of fingerprints of one bucket that differ in `radius` bits at most.

    Buckets of `sizes` lie one behind the other.
    """
    first = np.cumsum(sizes) - sizes
    blocks = -(-sizes // BITS)
    base = np.cumsum(blocks) - blocks
    bucket = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(prints)) - first[bucket]
    own, bit = base[bucket] + place // BITS, (place % BITS).astype(np.uint64)
    starts = np.flatnonzero(np.diff(own, prepend=-1))
    held = np.diff(np.append(starts, len(prints)))
    slices = planes(prints, bit, starts)
    every = np.uint64(0xFFFFFFFFFFFFFFFF)
    full = every >> (BITS - held).astype(np.uint64)
    width = (radius + 1).bit_length()
    ahead = (1 << width) - radius - 1  # a counter runs over at radius + 1
    tests = base[bucket] + blocks[bucket] - own
    upto = np.cumsum(tests)
    begin = 0
    while begin < len(prints):
        end = max(begin + 1, int(np.searchsorted(upto, upto[begin] - tests[begin] + PAIRS, "right")))
        count = tests[begin:end]
        row = np.repeat(np.arange(begin, end), count)
        block = own[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        later = every << bit[row] << np.uint64(1)
        alive = np.where(block == own[row], full[block] & later, full[block])
        keep = alive != 0
        row, block, alive = row[keep], block[keep], alive[keep]
        counters = [np.full(len(row), every if ahead >> k & 1 else np.uint64(0)) for k in range(width)]
        for b in range(BITS):
            if not b % 4 and b:
                keep = alive != 0
                if keep.sum() < 0.75 * len(keep):
                    row, block, alive, counters = row[keep], block[keep], alive[keep], [c[keep] for c in counters]
            if not len(row):
                break
            carry = slices[b][block] ^ (np.uint64(0) - (prints[row] >> np.uint64(b) & np.uint64(1)))
            for k, counter in enumerate(counters):
                counters[k], carry = counter ^ carry, counter & carry
            alive = alive & ~carry
        if len(row):
            at, j = np.nonzero(np.unpackbits(alive.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            yield row[at], starts[block[at]] + j
        begin = end


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest place that each of n places is linked to over any number of steps."""
    label = np.arange(n)
    while len(left):
        a, b = label[left], label[right]
        open_ = a != b
        if not open_.any():
            break
        left, right, a, b = left[open_], right[open_], a[open_], b[open_]
        low = np.minimum(a, b)
        np.minimum.at(label, np.maximum(a, b), low)
        while (label != (label := label[label])).any():
            pass
    return label


def _masks(radius: int, taken: int = 0) -> list[int]:
    """Masks with two more bands of the bits that `taken` leaves open."""
    free = [b for b in range(BITS) if not taken >> b & 1]
    bands = [sum(1 << int(b) for b in part) for part in np.array_split(free, radius + 2)]
    return [taken | a | b for a, b in combinations(bands, 2)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _buckets(prints: DataFrame, radius: int) -> DataFrame:
    """(path, bits, fingerprint): a fingerprint in each of its buckets."""
    done, rows, masks = [], prints.select("fingerprint", F.lit(0).alias("path")), [0]
    while True:
        after = [_masks(radius, mask) for mask in masks]
        options = F.lit(None).cast("array<struct<path:int,mask:long>>")
        for number, some in enumerate(after):
            kinds = [F.struct(F.lit(number * len(some) + i).alias("path"), F.lit(_signed(m)).cast("long").alias("mask")) for i, m in enumerate(some)]
            options = F.when(F.col("path") == number, F.array(*kinds)).otherwise(options)
        rows = rows.select("fingerprint", F.explode(options).alias("_to"))
        rows = rows.select(F.col("_to.path").alias("path"), F.col("fingerprint").bitwiseAND(F.col("_to.mask")).alias("bits"), "fingerprint")
        masks = [mask for some in after for mask in some]
        if BITS - min(mask.bit_count() for mask in masks) <= OPEN_BITS:
            done.append(rows)
            break
        heavy = rows.groupBy("path", "bits").count().where(F.col("count") > BUCKET).select("path", "bits")
        done.append(rows.join(heavy, ["path", "bits"], "left_anti"))
        rows = rows.join(heavy, ["path", "bits"], "left_semi")
    out = done[0].withColumn("level", F.lit(0))
    for level, part in enumerate(done[1:], 1):
        out = out.unionByName(part.withColumn("level", F.lit(level)))
    return out


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """left, right: fingerprints of `prints` (distinct) so that all within `radius` are connected."""

    def solve(bits: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        sizes = np.diff(np.append(np.flatnonzero(bits), len(values)))
        many = np.repeat(sizes > 1, sizes)
        values, sizes = values[many].view(np.uint64), sizes[sizes > 1]
        if not len(values):
            return
        for left, right in close_pairs(values, sizes, radius):
            label = forest(len(values), left, right)
            child = np.flatnonzero(label != np.arange(len(values)))
            ends = [pa.array(values[x].view(np.int64)) for x in (child, label[child])]
            yield pa.RecordBatch.from_arrays(ends, ["left", "right"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in the order of their buckets; the last bucket waits for its other rows."""
        held: list[list[np.ndarray]] = []
        for batch in batches:
            held.append([batch.column(name).to_numpy() for name in ("level", "path", "bits", "fingerprint")])
            if sum(len(part[0]) for part in held) < 2 * BUCKET:
                continue
            level, path, bits, values = (np.concatenate(parts) for parts in zip(*held))
            begins = _changes(level, path, bits)
            last = int(np.flatnonzero(begins)[-1])
            yield from solve(begins[:last], values[:last])
            held = [[level[last:], path[last:], bits[last:], values[last:]]]
        if held:
            level, path, bits, values = (np.concatenate(parts) for parts in zip(*held))
            yield from solve(_changes(level, path, bits), values)

    keys = ["level", "path", "bits"]
    dealt = _buckets(prints, radius).repartition(partitions(prints), *keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, "left long, right long").distinct()


def _changes(*columns: np.ndarray) -> np.ndarray:
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for column in columns:
        out[1:] |= column[1:] != column[:-1]
    return out


def roots(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node that each node of `edges` (left, right) is connected to.

    Large-star and small-star steps in turn, each pair written to the shared folder, until
    the edges are stars. A node of many edges costs a partial aggregate and a join that
    adaptive execution may split.
    """
    edges, before = materialise(edges, "links"), None
    while True:
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("left", "right").cast("decimal(38,0)"))).first()
        if found == before or not found[0]:
            return edges.select(F.col("left").alias("node"), F.col("right").alias("root"))
        before = found
        both = edges.unionByName(edges.select(F.col("right").alias("left"), F.col("left").alias("right")))
        lowest = both.groupBy("left").agg(F.least(F.col("left"), F.min("right")).alias("low"))
        large = both.where("right > left").join(lowest, "left").select(F.col("right").alias("left"), F.col("low").alias("right"))
        down = large.where("left <> right").distinct()
        least = down.groupBy("left").agg(F.min("right").alias("low"))
        small = down.join(least, "left").where("right <> low").select(F.col("right").alias("left"), F.col("low").alias("right"))
        stars = least.select("left", F.col("low").alias("right")).unionByName(small).distinct()
        edges = materialise(stars, "links")


def components(docs: DataFrame, shingle: int, radius: int, carried: tuple[str, ...]) -> DataFrame:
    """`carried`, fingerprint (long), root (a fingerprint for each component) and component_id."""
    prints = materialise(fingerprints(docs, shingle, carried), "fingerprints")
    distinct = materialise(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("lowest")), "distinct")
    tree = roots(links(distinct.select("fingerprint"), radius))
    placed = distinct.join(tree, distinct.fingerprint == tree.node, "left")
    placed = placed.select("fingerprint", "lowest", F.coalesce("root", "fingerprint").alias("root"))
    ids = placed.groupBy("root").agg(F.min("lowest").alias("component_id"))
    return prints.join(placed.join(ids, "root").drop("lowest"), "fingerprint")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, a row for each row of `docs`.

    component_id is the smallest doc_id of all documents connected by links. Null and empty
    texts, and texts of white space, have fingerprint zero and are linked like any other. A
    null doc_id keeps its row and never is a component_id unless its component has no other.
    Repeated rows are linked with each other. No rows give no rows. Other columns are ignored.
    """
    text = F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint")
    return components(docs, shingle, radius, ("doc_id",)).select("doc_id", text, "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """The rows of `docs` without all but one of each component: that of the smallest doc_id.

    A null doc_id counts as larger than any. Of rows of one doc_id the text with the smallest hash
    stays, of rows equal in both the first as JSON. Columns stay as they are.

    The keys of rows that go are joined to the rows, so the rows are moved only where there are too
    many such keys to send them to all tasks (`REMOVED` keys, 16 MB).
    """
    keys = missing, id_, hash_ = free_names(docs, "missing", "id", "hash")
    marked = docs.withColumns(
        {
            missing: F.col("doc_id").isNull(),
            id_: F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
            hash_: F.xxhash64("text", F.col("text").isNull()),
        }
    )
    narrow = marked.select("text", F.col("doc_id").cast("long").alias("doc_id"), F.struct(*keys).alias("key"))
    groups = materialise(components(narrow, shingle, radius, ("doc_id", "key")).groupBy("root", "key").count(), "groups")
    # Stored, so that the join meets no aggregate and adaptive execution may split a large component.
    first = materialise(groups.groupBy("root").agg(F.min("key").alias("first")), "first")
    told = groups.join(first, "root").select("key.*", (F.col("key") == F.col("first")).alias("stays"), "count")
    told = materialise(told.where("not stays or count > 1"), "told")
    left = keyed_join(marked, told.select(*keys), keys, "left_anti", small=REMOVED)
    again = keyed_join(marked, told.where("stays").select(*keys), keys, "left_semi", small=REMOVED)
    single = again.groupBy(*keys).agg(F.min_by(F.struct(*docs.columns), F.to_json(F.struct(*docs.columns))).alias("row"))
    return left.select(*docs.columns).unionByName(single.select("row.*"))
