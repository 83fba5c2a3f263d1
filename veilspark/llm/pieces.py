"""SentencePiece encoding by suffix arrays, and decoding.

The words of a batch of texts, each with the mark of the space before, lie one behind the other
as one text. Its suffixes are sorted, and binary search gives each piece of the model the
range of suffixes that begin with it: all its occurrences. The occurrences are edges from
where a piece begins to where it ends. Sorted by position they are relaxed: an edge holds if
merging would leave its piece behind the last piece that holds at its beginning. For
each place just one edge does, and following them back gives the text's pieces.

Two pieces are left side by side by merging if, taking their merges back in the order
of the model, none of the pairs that come to touch would have been merged before. So the
result is that of merging the whole text pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from veilspark.llm.common import in_chunks, with_columns

SPACE = "▁"
KEPT_WORDS = 500_000
#: Words in one index, each of `LONG` characters at most, which bounds the memory of its suffixes and edges.
INDEXED_WORDS = 16_384
LONG = 256
WINDOW = 1 << 16  # characters of a longer word that are indexed at a time
KEPT_LENGTH = 48
NONE, BEGIN = -1, -2


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Model:
    """Pieces of a merging model in the order of their merges, characters first.

    Symbol 0 is any character that is no piece. `left` and `right` are the two pieces that a piece is
    merged from, itself for characters. Pieces that merging can't reach have no edges.
    """

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        rules, trained = proto.normalizer_spec, proto.trainer_spec
        normal = [(piece.piece, piece.score, number) for number, piece in enumerate(proto.pieces) if piece.type == 1]
        plain = rules.name == "identity" and rules.add_dummy_prefix and not rules.remove_extra_whitespaces
        if not plain or trained.model_type != 2 or not trained.byte_fallback or any(piece.type == 4 for piece in proto.pieces):
            raise ValueError("not a merging model with byte fallback and without normalisation")
        if any(SPACE in text.lstrip(SPACE) or (text[:2] == 2 * SPACE and text.strip(SPACE)) for text, _, _ in normal):
            raise ValueError("pieces that reach over words are not supported")
        #: What each id stands for; bytes of characters that are no piece stand for themselves.
        self.bytes = [piece.piece.replace(SPACE, " ").encode() if piece.type == 1 else b"" for piece in proto.pieces]
        self.fallback = {}
        for number, piece in enumerate(proto.pieces):
            if piece.type == 6:
                value = int(piece.piece[1:-1], 16)
                self.bytes[number], self.fallback[value] = bytes([value]), number
        self.runs = {len(text): number for text, _, number in normal if not text.strip(SPACE)}
        single = [(text, number) for text, _, number in normal if len(text) == 1]
        merged = sorted((-score, text, number) for text, score, number in normal if len(text) > 1 and text.strip(SPACE))
        self.texts = ["", *(text for text, _ in single), *(text for _, text, _ in merged)]
        self.ids = np.array([0, *(number for _, number in single), *(number for _, _, number in merged)], np.int64)
        self.chars = len(single) + 1
        self.longest = max(map(len, self.texts))
        place = {text: symbol for symbol, text in enumerate(self.texts) if text}
        self.code = np.ones(0x110000, np.uint16)  # 0 is no character, 1 any that is no piece
        for text, _ in single:
            self.code[ord(text)] = place[text] + 1
        self.left = list(range(self.chars)) + [NONE] * len(merged)
        self.right = list(self.left)
        self.pairs: dict[tuple[int, int], int] = {}
        for symbol in range(self.chars, len(self.texts)):
            text = self.texts[symbol]
            for cut in range(1, len(text)):
                a, b = place.get(text[:cut], NONE), place.get(text[cut:], NONE)
                if 0 <= a < symbol and 0 <= b < symbol and self.left[a] != NONE and self.left[b] != NONE and self.stays(a, b):
                    self.pairs[a, b] = symbol
                    self.left[symbol], self.right[symbol] = a, b
                    break
        self._arrays()

    def stays(self, a: int, b: int) -> bool:
        """Whether merging leaves two pieces side by side, by the merges known so far."""
        limit, left, right = len(self.texts), self.left, self.right
        while True:
            if self.pairs.get((a, b), limit) < limit:
                return False
            if a > b or left[b] == b:
                if right[a] == a:
                    if left[b] == b:
                        return True
                    limit, b = b + 1, left[b]
                else:
                    limit, a = a, right[a]
            else:
                limit, b = b + 1, left[b]

    def _arrays(self) -> None:
        self.length = np.array([1] + [len(text) for text in self.texts[1:]], np.int64)
        keys = sorted((a * len(self.texts) + b, symbol) for (a, b), symbol in self.pairs.items())
        self.pair_keys = np.array([key for key, _ in keys], np.int64)
        self.pair_symbols = np.array([symbol for _, symbol in keys], np.int64)
        self.lefts, self.rights = np.array(self.left, np.int64), np.array(self.right, np.int64)
        reached = [symbol for symbol in range(1, len(self.texts)) if self.left[symbol] != NONE]
        self.searched = np.array(reached, np.int64)
        points = np.zeros((len(reached), -(-self.longest // 4) * 4), np.uint16)
        for row, symbol in enumerate(reached):
            points[row, : len(self.texts[symbol])] = self.code[[ord(c) for c in self.texts[symbol]]]
        inside = np.arange(points.shape[1]) < self.length[self.searched][:, None]
        self.lowest, self.highest = _keys(points), _keys(np.where(inside, points, np.uint16(0xFFFF)))

    def stay(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of pieces whether merging leaves them side by side."""
        out = np.zeros(len(a), bool)
        row, n = np.arange(len(a)), len(self.texts)
        limit = np.full(len(a), n)
        while len(row):
            key = a * n + b
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            merged = (self.pair_keys[at] == key) & (self.pair_symbols[at] < limit)
            last_a, last_b = self.rights[a] == a, self.lefts[b] == b
            ends = ~merged & last_a & last_b
            out[row[ends]] = True
            by_a = ((a > b) | last_b) & ~last_a
            limit, a, b = np.where(by_a, a, b + 1), np.where(by_a, self.rights[a], a), np.where(by_a, b, self.lefts[b])
            go = ~merged & ~ends
            row, limit, a, b = row[go], limit[go], a[go], b[go]
        return out


def _keys(points: np.ndarray) -> list[np.ndarray]:
    """Rows of 16-bit numbers as columns of four in one, which sort alike."""
    wide = points.astype(np.uint64)
    shifts = np.array([48, 32, 16, 0], np.uint64)
    return [(wide[:, at : at + 4] << shifts).sum(axis=1, dtype=np.uint64) for at in range(0, points.shape[1], 4)]


def suffix_array(codes: np.ndarray, reach: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order of their first `reach` characters, and the sorted keys of four characters each."""
    padded = np.concatenate((codes, np.zeros(reach + 4, np.uint16))).astype(np.uint64)
    n = len(codes)
    four = sum((padded[i : n + reach + i] << np.uint64(48 - 16 * i)) for i in range(4))
    columns = [four[at : at + n] for at in range(0, reach, 4)]
    order = np.lexsort(columns[::-1])
    return order, [column[order] for column in columns]


def _search(keys: np.ndarray, low: np.ndarray, high: np.ndarray, value: np.ndarray, right: bool) -> np.ndarray:
    """Binary search for each value in its own range [low, high) of `keys`."""
    low, high = low.copy(), high.copy()
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        less = keys[middle] <= value[open_] if right else keys[middle] < value[open_]
        low[open_] = np.where(less, middle + 1, low[open_])
        high[open_] = np.where(less, high[open_], middle)
    return low


def occurrences(model: Model, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbol, position) of all occurrences of all pieces, and of characters that are no piece."""
    order, keys = suffix_array(codes, 4 * len(model.lowest))
    low = np.searchsorted(keys[0], model.lowest[0], "left")
    high = np.searchsorted(keys[0], model.highest[0], "right")
    for depth in range(1, len(keys)):
        longer = np.flatnonzero((model.length[model.searched] > 4 * depth) & (low < high))
        begin, end = low[longer], high[longer]
        low[longer] = _search(keys[depth], begin, end, model.lowest[depth][longer], False)
        high[longer] = _search(keys[depth], begin, end, model.highest[depth][longer], True)
    counts = high - low
    symbol = np.repeat(model.searched, counts)
    position = order[np.arange(len(symbol)) + np.repeat(low - (np.cumsum(counts) - counts), counts)]
    other = np.flatnonzero(codes == 1)
    return np.concatenate((symbol, np.zeros(len(other), np.int64))), np.concatenate((position, other))


def encode_words(model: Model, words: list[str]) -> list[list[int]]:
    """The symbols of each word, its mark of a space included."""
    text = "".join([f"\0{SPACE}{word}" for word in words])
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    sizes = np.array([len(word) + 2 for word in words])
    codes, ends = model.code[points], np.cumsum(sizes)
    begins = ends - sizes + 1
    codes[begins - 1] = 0
    symbol, position = occurrences(model, codes)
    after = position + model.length[symbol]
    step = after - np.repeat(begins, sizes)[position]
    order = np.argsort(step.astype(np.uint16) if step.max(initial=0) < 1 << 16 else step, kind="stable")
    symbol, position, after, step = symbol[order], position[order], after[order], step[order]
    last = np.full(len(codes) + 1, NONE)
    last[begins] = BEGIN
    n = len(model.texts)
    bounds = np.flatnonzero(np.diff(step, prepend=-1, append=-1))
    for low, high in zip(bounds[:-1], bounds[1:]):
        before, own = last[position[low:high]], symbol[low:high]
        holds = before == BEGIN
        asked = np.flatnonzero(before >= 0)
        keys, place = np.unique(before[asked] * n + own[asked], return_inverse=True)
        holds[asked] = model.stay(keys // n, keys % n)[place]
        last[after[low:high][holds]] = own[holds]
    # Back from the ends, all words at once.
    places, tokens, owner = ends.copy(), [], []
    open_ = np.arange(len(words))
    while len(open_):
        own = last[places[open_]]
        tokens.append(own)
        owner.append(open_)
        places[open_] -= model.length[own]
        open_ = open_[places[open_] > begins[open_]]
    owner, tokens = np.concatenate(owner[::-1]), np.concatenate(tokens[::-1])
    order = np.argsort(owner, kind="stable")
    cuts = np.cumsum(np.bincount(owner, minlength=len(words)))[:-1]
    return [part.tolist() for part in np.split(tokens[order], cuts)]


def encode_long(model: Model, word: str) -> list[int]:
    """The symbols of a long word, its mark of a space included.

    As in `encode_words`, the piece that ends at a place follows from those that end where it may begin, so the
    word is indexed in windows that overlap by the longest piece, and gone through once from the left.
    """
    points = np.frombuffer((SPACE + word).encode("utf-32-le"), "<u4")
    n, size, known = len(model.texts), len(points), {}
    length = model.length.tolist()
    last = [NONE] * (size + 1)
    last[0] = BEGIN
    for low in range(0, size, WINDOW):
        codes = model.code[points[low : low + WINDOW + model.longest]]
        symbol, position = occurrences(model, codes)
        own = position < WINDOW
        symbol, position = symbol[own], position[own] + low
        order = np.argsort(position, kind="stable")
        for piece, place in zip(symbol[order].tolist(), position[order].tolist()):
            before = last[place]
            if before == BEGIN:
                last[place + length[piece]] = piece
            elif before >= 0:
                pair = before * n + piece
                holds = known.get(pair)
                if holds is None:
                    holds = known[pair] = model.stays(before, piece)
                if holds:
                    last[place + length[piece]] = piece
    out, place = [], size
    while place:
        out.append(last[place])
        place -= length[last[place]]
    return out[::-1]


class Pieces:
    """Encodes and decodes texts; words are kept until there are too many."""

    def __init__(self, path: str):
        self.model = Model(path)
        self.known: dict[str, bytes] = {}
        self.mark = self.model.runs[1].to_bytes(4, "little")

    def _learn(self, words: list[str], encoded: list[list[int]]) -> None:
        model = self.model
        ids = model.ids.tolist()
        for word, symbols in zip(words, encoded):
            if 0 in symbols:
                marked, at, out = SPACE + word, 0, []
                for symbol in symbols:
                    out += [ids[symbol]] if symbol else [model.fallback[byte] for byte in marked[at].encode()]
                    at += int(model.length[symbol])
            else:
                out = [ids[symbol] for symbol in symbols]
            self.known[word] = np.array(out, "<u4").tobytes()

    def _spaces(self, n: int) -> bytes:
        """A run of spaces: the longest pieces from the left."""
        out, runs = [], self.model.runs
        while n:
            size = max(length for length in runs if length <= n)
            out.append(runs[size])
            n -= size
        return np.array(out, "<u4").tobytes()

    def _with_runs(self, words: list[str]) -> bytes:
        out, run = [], 0
        for word in words:
            if not word:
                run += 1
                continue
            ids = self.known[word]
            if run and ids[:4] == self.mark:
                run, ids = run + 1, ids[4:]
            out += [self._spaces(run), ids]
            run = 0
        return b"".join([*out, self._spaces(run)])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        split = [text.replace(SPACE, " ").split(" ") if text else [] for text in texts]
        new = set()
        for words in split:
            new.update(words)
        new = new.difference(self.known)
        new.discard("")
        words = sorted(word for word in new if len(word) <= LONG)
        for at in range(0, len(words), INDEXED_WORDS):
            some = words[at : at + INDEXED_WORDS]
            self._learn(some, encode_words(self.model, some))
        for word in new:
            if len(word) > LONG:
                self._learn([word], [encode_long(self.model, word)])
        get = self.known.__getitem__
        out = [self._with_runs(words) if "" in words else b"".join(map(get, words)) for words in split]
        for word in new:
            if len(word) > KEPT_LENGTH:
                del self.known[word]
        return out

    def decode(self, ids: bytes) -> str:
        """The text of ids, without the space that encoding sets first. Broken bytes become U+FFFD."""
        data = b"".join(map(self.model.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return data.decode("utf-8", "replace").removeprefix(" ")


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """One encoder for each Python worker."""
    return Pieces(path)


def encode_documents(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit) of each row of `docs` (doc_id, text).

    Null and empty texts have no ids. Other columns are ignored, repeated rows are encoded each.
    """
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = pieces(path).encode
        for chunk in in_chunks(batches, "text"):
            found = encode([text or "" for text in chunk.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """`encoded` with `text`, decoded from `ids`; null ids give a null text."""
    path = model or default_model()
    kept = encoded.drop("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = pieces(path).decode
        for chunk in in_chunks(batches, "ids"):
            texts = [None if ids is None else decode(ids) for ids in chunk.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*chunk.columns, pa.array(texts, pa.string())], [*chunk.schema.names, "text"])

    return kept.mapInArrow(run, with_columns(kept, text="string"))
