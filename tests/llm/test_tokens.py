"""Token ids, packing, the coder and token files."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import documents, no_docs, odd_docs, texts
from veilspark.llm.packing import fill_window, pack, pack_documents
from veilspark.llm.rans import BLOCK, compress, decompress
from veilspark.llm.token_files import read_token_files, write_token_files
from veilspark.llm.tokens import Encoder, default_tokenizer, encoder


def plain(text: str, end: int) -> np.ndarray:
    tokenizer = Tokenizer.from_file(default_tokenizer())
    return np.array([*tokenizer.encode(text, add_special_tokens=False).ids, end], "<u4")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab é漢😀 \n\t.,'s12\x1c 　<|endoftext|>"), max_size=60))
def test_words_alone_have_the_ids_of_the_text(text):
    tokenizer = Tokenizer.from_file(default_tokenizer())
    found = np.frombuffer(encoder(default_tokenizer()).encode(text), "<u4").tolist()
    assert found == tokenizer.encode(text, add_special_tokens=False).ids


def test_memory_of_words_is_renewed():
    encode = Encoder(default_tokenizer(), kept_words=5)
    for _ in range(3):
        for text in ("one two three four five six seven", "eight nine one two", "three ten eleven, twelve."):
            assert np.frombuffer(encode.encode(text), "<u4").tolist() == plain(text, 0)[:-1].tolist()
    assert len(encode.words) <= 12 and len(encode.words.old) <= 12


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=12), st.integers(1, 60))
def test_window_is_as_full_as_any_multiset_with_the_longest(lengths, capacity):
    counts = defaultdict(int)
    for length in lengths:
        counts[length] += 1
    taken = fill_window(dict(counts), capacity)
    fits = [length for length in lengths if length <= capacity]
    if not fits:
        assert not taken
        return
    rest = sorted(fits)[:-1]
    sums = {0}
    for length in rest:
        sums |= {s + length for s in sums}
    best = max(s for s in sums if s + max(fits) <= capacity) + max(fits)
    assert sum(length * n for length, n in taken.items()) == best
    assert all(n <= counts[length] for length, n in taken.items())


@pytest.mark.parametrize(
    "lengths", [[], [7], [2048] * 3, [1] * 5000, [1500] * 300, [1025] * 99, [random.Random(1).randint(1, 9000) for _ in range(500)]]
)
@pytest.mark.parametrize("group", [1, 4096, 1 << 20])
def test_packing_is_whole_and_gapless(lengths, group):
    windows = list(pack(((i, np.arange(n, dtype="<u4")) for i, n in enumerate(lengths)), 2048, group))
    sizes = [sum(len(ids) for _, _, ids in window) for window in windows]
    assert all(size == 2048 or size.bit_count() == 1 for size in sizes) and max(sizes, default=0) <= 2048
    pieces = defaultdict(list)
    for window in windows:
        for (key, n), start, ids in window:
            assert n == lengths[key] and len(ids) and ids[0] == start and ids[-1] == start + len(ids) - 1
            pieces[key].append((start, len(ids)))
    for key, n in enumerate(lengths):
        at = 0
        for start, length in sorted(pieces[key]):
            assert start == at
            at += length
        assert at == n


def test_pack_documents_handles_odd_rows(spark):
    rows = pack_documents(odd_docs(spark)).collect()
    wanted, found = defaultdict(int), defaultdict(int)
    for key, text in texts():
        wanted[key, len(plain(text, 1))] += len(plain(text, 1))
    sequences = defaultdict(list)
    for row in rows:
        found[row.doc_id, row.doc_tokens] += row.length
        sequences[row.sequence_id].append((row.offset, row.length))
    assert found == wanted
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert pack_documents(no_docs(spark)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, BLOCK - 1, BLOCK, BLOCK + 1, 3 * BLOCK + 5])
@pytest.mark.parametrize("kinds", [1, 2, 300, 50_257, 1 << 32])
def test_coder_round_trip(n, kinds):
    ids = np.random.default_rng(n).integers(0, kinds, n).astype("<u4")
    assert np.array_equal(decompress(compress(ids)), ids)


def test_blocks_decode_alone_and_damage_is_seen():
    ids = np.random.default_rng(0).geometric(0.01, 3 * BLOCK + 9).astype("<u4")
    data = compress(ids)
    assert np.array_equal(decompress(data, 1, 2), ids[BLOCK : 2 * BLOCK])
    assert np.array_equal(decompress(data, 3), ids[3 * BLOCK :])
    assert len(data) < 1.5 * len(ids)
    broken = bytearray(data)
    broken[-BLOCK // 2] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        decompress(bytes(broken))
    with pytest.raises(ValueError, match="format"):
        decompress(b"something else")


@pytest.mark.parametrize("file_tokens", [1, 1000, 1 << 22])
def test_token_files_round_trip(spark, tmp_path, file_tokens):
    path = str(tmp_path / "files")
    write_token_files(odd_docs(spark), path, file_tokens=file_tokens)
    rows = read_token_files(spark, path).collect()
    at, wanted = 0, []
    for row in sorted(rows, key=lambda row: row.start):
        assert row.start == at
        at += len(row.ids) // 4
    wanted = sorted(((key is not None, key or 0), plain(text, 2).tobytes()) for key, text in texts())
    assert sorted(((row.doc_id is not None, row.doc_id or 0), bytes(row.ids)) for row in rows) == wanted
    order = [(row.doc_id is not None, row.doc_id or 0) for row in sorted(rows, key=lambda row: row.start)]
    assert order == sorted(order)


def test_token_files_of_documents(spark, tmp_path):
    path = str(tmp_path / "files")
    write_token_files(documents(spark), path, file_tokens=5000)
    at = 0
    found = {row.doc_id: row for row in read_token_files(spark, path, with_ids=False).collect()}
    for row in documents(spark).orderBy("doc_id").collect():
        ids = plain(row.text or "", 2)
        got = found[row.doc_id]
        assert (got.start, got.n_tokens, got.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_no_documents_give_no_token_files(spark, tmp_path):
    path = str(tmp_path / "files")
    write_token_files(no_docs(spark), path)
    assert read_token_files(spark, path).count() == 0
