"""Packing of documents into windows of tokens by minimum bin slack.

A document's whole windows stand alone. What remains of each document goes into a pool
of lengths with counts. For each further window the longest remainder is set, and a
subset-sum table of bits finds the multiset of other remainders that comes closest to
the capacity; walking back through the table gives how many of each length to take. A
pattern is used as often as the counts allow. If it leaves slack, every remainder still
in the pool is longer than the slack, so one of them is cut to fill it.

Each task packs its own rows in groups of bounded size, so nothing is shuffled and no
task holds more than a group. What can't fill a window goes on to the next group; a
task's last tokens fill windows of powers of two, which need no padding.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from veilspark.llm.common import in_chunks
from veilspark.llm.tokens import KEPT_WORDS, default_tokenizer, encoder

GROUP_TOKENS = 1 << 20
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def fill_window(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each length to take for a sum as close to `capacity` as can be, not above.

    The longest length that fits is always taken, once at least. Bit s of a table is set if the
    sum s can be made; lengths come in descending order, in lots of 1, 2, 4, ... copies.
    """
    lengths = sorted((length for length, n in counts.items() if n and length <= capacity), reverse=True)
    if not lengths:
        return {}
    longest, taken = lengths[0], defaultdict(int)
    taken[longest] = 1
    room = capacity - longest
    reach, steps, within = 1, [], (1 << (room + 1)) - 1
    for length in lengths:
        left = min(counts[length] - (length == longest), room // length)
        lot = 1
        while left > 0 and not reach >> room & 1:
            lot = min(lot, left)
            steps.append((reach, length, lot))
            reach |= (reach << length * lot) & within
            left -= lot
            lot *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    for before, length, lot in reversed(steps):
        if not before >> total & 1:
            taken[length] += lot
            total -= length * lot
    return dict(taken)


class Pool:
    """Remainders by length: (document, start, ids) each, taken in the order they came."""

    def __init__(self):
        self.pieces: dict[int, list[tuple]] = defaultdict(list)
        self.counts: dict[int, int] = {}
        self.tokens = 0

    def add(self, doc: tuple, start: int, ids: np.ndarray) -> None:
        length = len(ids)
        if length:
            self.pieces[length].append((doc, start, ids))
            self.counts[length] = self.counts.get(length, 0) + 1
            self.tokens += length

    def take(self, length: int) -> tuple:
        piece = self.pieces[length].pop()
        self.tokens -= length
        self.counts[length] -= 1
        if not self.counts[length]:
            del self.counts[length], self.pieces[length]
        return piece

    def fill(self, slack: int) -> list[tuple]:
        """Pieces of `slack` tokens in all, the last of them cut where needed."""
        out = []
        while slack:
            length = min((x for x in self.counts if x >= slack), default=None) or max(self.counts)
            doc, start, ids = self.take(length)
            out.append((doc, start, ids[:slack]))
            self.add(doc, start + slack, ids[slack:])
            slack -= len(out[-1][2])
        return out

    def windows(self, capacity: int) -> Iterator[list[tuple]]:
        """Full windows, as long as there are tokens for one."""
        while self.tokens >= capacity:
            pattern = fill_window(self.counts, capacity)
            slack = capacity - sum(length * n for length, n in pattern.items())
            for _ in range(min(self.counts[length] // n for length, n in pattern.items()) if not slack else 1):
                window = [self.take(length) for length, n in pattern.items() for _ in range(n)]
                yield window + self.fill(slack)

    def rest(self) -> Iterator[list[tuple]]:
        """Windows of powers of two, the largest first, with all that is left."""
        while self.tokens:
            yield self.fill(1 << self.tokens.bit_length() - 1)


def pack(documents: Iterable[tuple], capacity: int, group_tokens: int = GROUP_TOKENS) -> Iterator[list[tuple]]:
    """Windows of ((key, tokens), start, ids) pieces from (key, ids) documents."""
    pool, held = Pool(), 0
    for key, ids in documents:
        doc, whole = (key, len(ids)), len(ids) // capacity * capacity
        for start in range(0, whole, capacity):
            yield [(doc, start, ids[start : start + capacity])]
        pool.add(doc, whole, ids[whole:].copy())
        held += len(ids) - whole
        if held >= group_tokens:
            yield from pool.windows(capacity)
            held = pool.tokens
    yield from pool.windows(capacity)
    yield from pool.rest()


def pack_documents(
    docs: DataFrame,
    capacity: int = 2048,
    end_id: int = 1,
    tokenizer: str | None = None,
    group_tokens: int = GROUP_TOKENS,
    kept_words: int = KEPT_WORDS,
) -> DataFrame:
    """Pieces of `docs` (doc_id, text; other columns are ignored) with their place in a sequence.

    Null and empty texts are the end id alone, as is fitting. A null doc_id stays null; repeated
    ids and rows are packed as documents of their own. No rows give no rows. `sequence_id` is
    unique, not dense: the task's number, then its sequences in order. `ids` are little-endian
    unsigned 32-bit. Sequences have `capacity` tokens, but for a few powers of two for each task.
    `kept_words` bounds the memory of each worker, not the result.
    """
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, sequence = TaskContext.get().partitionId(), 0
        encode = encoder(path, kept_words).encode
        end = np.array([end_id], "<u4").tobytes()

        def documents():
            for chunk in in_chunks(batches, "text"):
                for key, text in zip(chunk.column("doc_id").to_pylist(), chunk.column("text").to_pylist()):
                    yield key, np.frombuffer(encode(text or "") + end, "<u4")

        rows, size = [], 0
        for window in pack(documents(), capacity, group_tokens):
            offset = 0
            for (key, tokens), start, ids in window:
                rows.append((key, start, len(ids), ids.tobytes(), tokens, task << 40 | sequence, offset))
                offset += len(ids)
            sequence, size = sequence + 1, size + offset
            if size >= GROUP_TOKENS:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names)
