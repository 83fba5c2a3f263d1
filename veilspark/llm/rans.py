"""Static range asymmetric numeral system over blocks of interleaved lanes.

All blocks of a file share one table of frequencies, scaled to a power of two. Id j of a
block belongs to lane j mod LANES. A lane's state stays in [2^31, 2^63); a step that would
leave that range moves 32 bits to the block's words first. Decoding reads the words in the
order of step and lane, so all lanes of all blocks advance together as one array.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

LANES, STEPS = 128, 512
BLOCK = LANES * STEPS
LOW = np.uint64(1 << 31)
HALF, ALL = np.uint64(32), np.uint64(0xFFFFFFFF)
MAGIC = b"VRNS\x01"


class Table:
    """Frequencies of `symbols` (ascending) that add up to 2 ** bits, each at least one."""

    def __init__(self, symbols: np.ndarray, freqs: np.ndarray, bits: int):
        self.symbols, self.freqs, self.bits = symbols.astype("<u4"), freqs.astype("<u4"), bits
        self.starts = np.concatenate(([0], np.cumsum(freqs)[:-1])).astype(np.uint64)

    @classmethod
    def of(cls, ids: np.ndarray) -> Table:
        if int(ids.max()) < 1 << 20:
            counts = np.bincount(ids)
            symbols = np.flatnonzero(counts)
            counts = counts[symbols]
        else:
            symbols, counts = np.unique(ids, return_counts=True)
        bits = max(12, int(len(symbols) - 1).bit_length() + 2)
        freqs = np.maximum(1, counts.astype(np.float64) * ((1 << bits) / counts.sum())).astype(np.int64)
        over = int(freqs.sum()) - (1 << bits)
        order = np.argsort(-freqs, kind="stable")
        if over <= 0:
            freqs[order[0]] -= over
        for at in order:  # the largest can always give up what the ones took
            if over <= 0:
                break
            cut = min(over, int(freqs[at]) // 2)
            freqs[at] -= cut
            over -= cut
        return cls(symbols, freqs, bits)

    def number(self, ids: np.ndarray) -> np.ndarray:
        """The place of each id among the symbols."""
        top = int(self.symbols[-1])
        if top >= 1 << 20:
            return np.searchsorted(self.symbols, ids)
        places = np.zeros(top + 1, np.int32)
        places[self.symbols] = np.arange(len(self.symbols))
        return places[ids]

    def pack(self) -> bytes:
        gaps = np.diff(self.symbols, prepend=np.uint32(0)).astype("<u4")
        return struct.pack("<IB", len(self.symbols), self.bits) + gaps.tobytes() + self.freqs.tobytes()

    @classmethod
    def unpack(cls, data: bytes) -> Table:
        n, bits = struct.unpack_from("<IB", data)
        gaps = np.frombuffer(data, "<u4", n, 5)
        return cls(np.cumsum(gaps, dtype=np.uint32), np.frombuffer(data, "<u4", n, 5 + 4 * n), bits)


def _encode(index: np.ndarray, table: Table) -> tuple[np.ndarray, list[np.ndarray]]:
    """States (blocks, lanes) and each block's words, of symbol numbers (blocks, steps, lanes)."""
    index = np.ascontiguousarray(index.transpose(1, 0, 2))
    steps, blocks, lanes = index.shape
    freqs, bits = table.freqs.astype(np.uint64), np.uint64(table.bits)
    limit = np.uint64(31 + 32 - table.bits)
    state = np.full((blocks, lanes), LOW)
    words, moved = np.empty(index.shape, "<u4"), np.empty(index.shape, bool)
    for step in range(steps - 1, -1, -1):
        symbol = index[step]
        freq = freqs[symbol]
        full = state >= freq << limit
        moved[step] = full
        words[step] = state  # the low half
        state = np.where(full, state >> HALF, state)
        quotient = state // freq
        state = (quotient << bits) + (state - quotient * freq) + table.starts[symbol]
    return state, [words[:, block][moved[:, block]] for block in range(blocks)]


def _decode(state: np.ndarray, words: np.ndarray, at: np.ndarray, steps: int, table: Table, lookup: np.ndarray) -> np.ndarray:
    """Symbol numbers (blocks, steps, lanes); `at` is each block's first word."""
    blocks, lanes = state.shape
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    both = table.starts << HALF | table.freqs  # one look for both
    out = np.empty((steps, blocks, lanes), np.uint32)
    for step in range(steps):
        slot = state & mask
        symbol = lookup[slot]
        out[step] = symbol
        found = both[symbol]
        state = (found & ALL) * (state >> bits) + slot - (found >> HALF)
        low = state < LOW
        order = np.cumsum(low, axis=1, dtype=np.int32)
        here = np.flatnonzero(low.reshape(-1))
        place = (at[:, None] + order).reshape(-1)[here] - 1
        place = np.minimum(place, len(words) - 1)  # damaged blocks may ask for more; their checksum tells
        state.reshape(-1)[here] = state.reshape(-1)[here] << HALF | words[place]
        at = at + order[:, -1]
    return out.transpose(1, 0, 2)


def compress(ids: np.ndarray) -> bytes:
    """A file's bytes: header, table, checkpoints (place, states, checksum) of all blocks, words."""
    n = len(ids)
    if not n:
        return MAGIC + struct.pack("<QII", 0, 0, 0)
    table = Table.of(ids)
    index = table.number(ids)
    whole = n // BLOCK
    states, words = [], []
    if whole:
        s, w = _encode(index[: whole * BLOCK].reshape(whole, STEPS, LANES), table)
        states, words = [s], w
    if n % BLOCK:
        steps = -(-(n % BLOCK) // LANES)
        last = np.full(steps * LANES, int(np.argmax(table.freqs)))
        last[: n % BLOCK] = index[whole * BLOCK :]
        s, w = _encode(last.reshape(1, steps, LANES), table)
        states, words = [*states, s], words + w
    blocks = len(words)
    places = np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype("<u8")
    sums = np.array([zlib.crc32(ids[b * BLOCK : (b + 1) * BLOCK].astype("<u4").tobytes()) for b in range(blocks)], "<u4")
    shared = zlib.compress(table.pack(), 6)
    head = MAGIC + struct.pack("<QII", n, blocks, len(shared)) + shared
    return b"".join([head, places.tobytes(), np.concatenate(states).astype("<u8").tobytes(), sums.tobytes(), *(w.tobytes() for w in words)])


def decompress(data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of blocks `first` to `last` (exclusive; all by default). Damaged blocks raise."""
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a file of this format")
    n, blocks, shared = struct.unpack_from("<QII", data, len(MAGIC))
    last = blocks if last is None else min(last, blocks)
    if first >= last:
        return np.zeros(0, "<u4")
    at = len(MAGIC) + 16
    table = Table.unpack(zlib.decompress(data[at : at + shared]))
    at += shared
    places = np.frombuffer(data, "<u8", blocks + 1, at).astype(np.int64)
    at += 8 * (blocks + 1)
    states = np.frombuffer(data, "<u8", blocks * LANES, at).reshape(blocks, LANES).astype(np.uint64)
    at += 8 * blocks * LANES
    sums = np.frombuffer(data, "<u4", blocks, at)
    at += 4 * blocks
    words = np.frombuffer(data, "<u4", int(places[-1]), at)
    words = words if len(words) else np.zeros(1, "<u4")
    lookup = np.repeat(np.arange(len(table.freqs), dtype=np.uint32), table.freqs)
    parts, whole = [], min(last, n // BLOCK)
    if first < whole:
        parts.append(_decode(states[first:whole], words, places[first:whole], STEPS, table, lookup).reshape(-1))
    if last > n // BLOCK:
        left = n % BLOCK
        steps = -(-left // LANES)
        parts.append(_decode(states[-1:], words, places[blocks - 1 : blocks], steps, table, lookup).reshape(-1)[:left])
    ids = table.symbols[np.concatenate(parts)]
    for block in range(first, last):
        begin = (block - first) * BLOCK
        if zlib.crc32(ids[begin : begin + BLOCK].tobytes()) != sums[block]:
            raise ValueError(f"block {block} is damaged")
    return ids
