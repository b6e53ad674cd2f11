import zlib
from collections import Counter, defaultdict
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from harborline.llm import huffman, packing
from harborline.llm.tokens import PieceEncoder
from tests.llm.helpers import awkward, frame


@lru_cache
def library(vocabulary):
    return Tokenizer.from_file(public_tokenizers.path(vocabulary))


def library_ids(vocabulary, text, end):
    return library(vocabulary).encode(text or "", add_special_tokens=False).ids + [end]


@pytest.mark.parametrize("vocabulary,keep", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_pieces_encode_like_whole_texts(vocabulary, keep):
    rng = np.random.default_rng(5)
    letters = list("  \n\t\r\x00\u2003 ab'sé1!́ \x01\x1cΣ")
    texts = [r[1] or "" for r in awkward()] + ["".join(rng.choice(letters, 25)) for _ in range(1500)]
    tokenizer = library(vocabulary)
    encoder = PieceEncoder(vocabulary, keep, 7)
    for _ in range(2):
        for text, ids in zip(texts, encoder.encode(pa.array(texts)).to_pylist()):
            assert np.frombuffer(ids, "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [7], text


def unlimited_cost(counts):
    heap = [c for c in counts if c]
    heapify(heap)
    cost = 0
    while len(heap) > 1:
        both = heappop(heap) + heappop(heap)
        cost += both
        heappush(heap, both)
    return cost


def test_code_lengths_are_limited_and_optimal():
    rng = np.random.default_rng(1)
    counts = (rng.pareto(0.6, 500) * 10).astype(np.int64)
    wide = huffman.code_lengths(counts, 30)
    assert int((wide * counts).sum()) == unlimited_cost(counts.tolist())
    narrow = huffman.code_lengths(counts, 10)
    assert narrow.max() <= 10 and (2.0 ** -narrow[narrow > 0].astype(float)).sum() <= 1
    assert ((narrow > 0) == (counts > 0)).all()
    assert huffman.code_lengths(np.array([0, 5, 0]), 4).tolist() == [0, 1, 0]
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(5), 2)


@pytest.mark.parametrize("n", [1, 511, 512, 513, 5000])
def test_chunk_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n), 999).astype(np.uint32)
    lengths = huffman.code_lengths(np.bincount(ids, minlength=1000), 14)
    codes, _ = huffman.canonical(lengths)
    data = huffman.encode_chunk(b"keys", np.array([n]), ids, codes, lengths, zlib.crc32(lengths.tobytes()))
    keys, counts, back = huffman.Decoder(lengths).chunk(data)
    assert keys == b"keys" and counts.tolist() == [n] and (back == ids).all()
    with pytest.raises(ValueError):
        huffman.Decoder(np.roll(lengths, 1)).chunk(data)


def test_token_file_reads_back(spark, monkeypatch):
    rows = awkward()
    got = huffman.store_documents(frame(spark, rows)).collect()
    expected = Counter((r[0], tuple(library_ids("byte_bpe_50k.json", r[1], 0))) for r in rows)
    assert Counter((r["key"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in got) == expected
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) // 4
        at += r["n_tokens"]
    keys = [r["key"] for r in sorted(got, key=lambda r: r["start"])]
    assert keys == sorted(keys, key=lambda k: (k is not None, k))
    assert huffman.store_documents(frame(spark, [])).collect() == []


@pytest.mark.parametrize("window", [2048, 64])
def test_pieces_pack_every_id_once(spark, window):
    rows = awkward(many=200)
    docs = frame(spark, rows)
    got = packing.pack(docs, window=window).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        assert len(r["ids"]) == 4 * r["length"] > 0
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        if r["key"] is not None:
            by_doc[r["key"]].append((r["start"], r["ids"], r["doc_tokens"]))
    expected = Counter()
    for r in rows:
        if r[0] is not None:
            expected[r[0]] += len(library_ids("word_bpe_49k.json", r[1], 1))
    once = Counter(r[0] for r in rows)
    for r in rows:
        if r[0] is None or once[r[0]] > 1:
            continue
        ids = library_ids("word_bpe_49k.json", r[1], 1)
        pieces = sorted(by_doc[r[0]])
        assert b"".join(p[1] for p in pieces) == np.array(ids, dtype="<u4").tobytes()
        at = 0
        for start, piece, n in pieces:
            assert start == at and n == len(ids)
            at += len(piece) // 4
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == window or at < window and at & (at - 1) == 0
    assert packing.pack(frame(spark, [])).collect() == []


def test_combinations_cover_most_rests():
    rng = np.random.default_rng(2)
    rests = np.minimum(rng.lognormal(6, 0.7, 200_000).astype(int) + 1, 2047)
    histogram = np.bincount(rests, minlength=2048)
    intervals, sequences = packing.plan(histogram, 2048)
    used = np.bincount(intervals["length"], weights=intervals["n"], minlength=2048)
    assert (used <= histogram).all() and int((intervals["length"] * intervals["n"]).sum()) == 2048 * sequences
    assert used.sum() > 0.7 * histogram.sum()
