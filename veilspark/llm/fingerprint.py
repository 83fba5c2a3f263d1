"""Document fingerprints by content-defined chunking.

A gear hash over the last 32 bytes decides where a text is cut: seldom before the normal
length of a chunk, often after it, never below the least or beyond the greatest length. A
shift moves the cuts with the text, so the same passage gives the same chunks anywhere. The
fingerprint is the set of the chunks' digests, each with its length; how much of one text's
length lies in chunks that the other has as well measures containment.

Each document is also compared with the next by doc_id. Documents are dealt out in ranges
of doc_id of which the bounds are known, and the first of each range also goes to the range before.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from veilspark.llm.common import in_chunks, partitions

LEAST, NORMAL, GREATEST = 32, 96, 512
STRICT, LOOSE = np.uint32(32 - 9), np.uint32(32 - 5)
WINDOW = 32
SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def _gears() -> np.ndarray:
    """A number for each byte, by a multiply and shift rule."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(32)).astype(np.uint32)


GEARS = _gears()


def cut_places(texts: list[bytes]) -> tuple[list[int], list[int], list[int]]:
    """Where texts begin when they lie one behind the other, and where they may be cut: seldom, often.

    The hash of a place is the sum of the gears of the 32 bytes up to it, each shifted by its
    distance; doubling the reach five times gives it for all places at once.
    """
    sizes = np.array([len(text) for text in texts])
    begins = np.cumsum(sizes + WINDOW) - sizes  # with a gap before each, so none sees another
    sums = np.zeros(int(begins[-1] + sizes[-1]), np.uint32)
    sums[np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())] = GEARS[
        np.frombuffer(b"".join(texts), np.uint8)
    ]
    reach = 1
    while reach < WINDOW:
        sums[reach:] += sums[:-reach] << np.uint32(reach)
        reach *= 2
    often = np.flatnonzero(sums >> LOOSE == 0) + 1
    seldom = often[sums[often - 1] >> STRICT == 0]
    return begins.tolist(), seldom.tolist(), often.tolist()


def chunks(texts: list[bytes]) -> Iterator[list[tuple[int, int]]]:
    """(start, end) of the chunks of each text."""
    if not texts:
        return
    begins, seldom, often = cut_places(texts)
    for text, begin in zip(texts, begins):
        found, start, end = [], begin, begin + len(text)
        while end - start > LEAST:
            normal, greatest = min(start + NORMAL, end), min(start + GREATEST, end)
            place = bisect_left(seldom, start + LEAST)
            cut = seldom[place] if place < len(seldom) else greatest
            if cut > normal:
                place = bisect_right(often, normal)
                cut = min(often[place], greatest) if place < len(often) else greatest
            found.append((start - begin, cut - begin))
            start = cut
        if start < end:
            found.append((start - begin, end - begin))
        yield found


def digests(texts: list[bytes]) -> list[dict[int, int]]:
    """The length of each distinct chunk, by its digest."""
    digest = xxhash.xxh3_64_intdigest
    return [{digest(text[a:b]): b - a for a, b in cuts} for text, cuts in zip(texts, chunks(texts))]


def render(prints: dict[int, int]) -> str:
    """Digests in ascending order, as `digest.length`, with spaces between."""
    return " ".join(["%016x.%d" % item for item in sorted(prints.items())])


def containment(one: dict[int, int], other: dict[int, int]) -> float:
    """The share of `one`'s length in chunks that `other` has; 1 for two empty texts."""
    total = sum(one.values())
    if not total:
        return 0.0 if other else 1.0
    return sum(one[key] for key in one.keys() & other.keys()) / total


def edited(text: str, after: str) -> str:
    """`text` with its second half replaced by the beginning of `after`."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def _pairs(chunk: Iterable[tuple]) -> pa.RecordBatch:
    """Rows of (doc_id, text, digests, next text, next digests)."""
    rows = list(chunk)
    changed = [edited(text, after) for _, text, _, after, _ in rows]
    encoded = [text.encode() for text in changed]
    prints = digests(encoded)
    columns = {
        "doc_id": pa.array([row[0] for row in rows], pa.int64()),
        "n_chars": pa.array([len(row[1]) for row in rows], pa.int64()),
        "edited_sha256": pa.array([sha256(text).hexdigest() for text in encoded], pa.string()),
        "fingerprint": pa.array([render(row[2]) for row in rows], pa.string()),
        "edited_fingerprint": pa.array([render(own) for own in prints], pa.string()),
        "near_edited": pa.array([containment(row[2], own) for row, own in zip(rows, prints)], pa.float64()),
        "near_next": pa.array([containment(row[2], row[4]) for row in rows], pa.float64()),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by range and order, the next range's first behind each range."""
    waiting = None  # the last row, whose next is still to come
    for chunk in in_chunks(batches, "text"):
        texts = [text or "" for text in chunk.column("text").to_pylist()]
        prints = digests([text.encode() for text in texts])
        out = []
        for part, borrowed, key, text, own in zip(
            chunk.column("range").to_pylist(), chunk.column("borrowed").to_pylist(), chunk.column("doc_id").to_pylist(), texts, prints
        ):
            if waiting:
                if waiting[0] != part:
                    raise ValueError(f"range {waiting[0]} has no document behind it")
                out.append((*waiting[1:], text, own))
            waiting = None if borrowed else (part, key, text, own)
        if out:
            yield _pairs(out)
    if waiting:
        raise ValueError(f"range {waiting[0]} has no document behind it")


def fingerprint_documents(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """A row for each row of `docs` (doc_id, text): its fingerprint, its edited text's, and how near they are.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many of the
    next document, or all of them. Next is by ascending doc_id, null first, rows of one doc_id by
    their text's hash; after the last comes the first, which may be the same. Null texts are empty.
    near_edited and near_next are the share of the document's length found in the other, 1 if
    both are empty. No rows give no rows; other columns are ignored.
    """
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"))
    count = 4 * (ranges or partitions(docs))
    keys = hashed.select("doc_id", "hash").repartitionByRange(count, "doc_id", "hash")
    firsts = keys.groupBy(F.spark_partition_id().alias("range")).agg(F.min(F.struct("doc_id", "hash")).alias("key"))
    low = -(1 << 63) - 1
    bounds = sorted((low if row["key"]["doc_id"] is None else row["key"]["doc_id"], row["key"]["hash"]) for row in firsts.collect())

    @F.pandas_udf("array<struct<range:int,borrowed:boolean>>")
    def places(doc_id: pd.Series, hash_: pd.Series) -> pd.Series:
        found = []
        for key in zip([low if d is None else d for d in doc_id], hash_):
            place = bisect_right(bounds, key) - 1
            own = [{"range": place, "borrowed": False}]
            if key == bounds[place]:
                own.append({"range": (place or len(bounds)) - 1, "borrowed": True})
            found.append(own)
        return pd.Series(found)

    doc_id = F.col("doc_id").cast("decimal(20,0)")  # nulls and large numbers stay what they are
    dealt = hashed.select("doc_id", "text", "hash", F.explode(places(doc_id, "hash")).alias("to"))
    dealt = dealt.select("doc_id", "text", "hash", "to.range", "to.borrowed").repartition(count // 4, "range")
    return dealt.sortWithinPartitions("range", "borrowed", "doc_id", "hash").drop("hash").mapInArrow(_compare, SCHEMA)
