"""Token ids, their shards and their packing against the tokenizer itself."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings as budget, strategies as st
from tokenizers import Tokenizer

from lakeloom.llm import re_pair, sum_squares, tokens
from lakeloom.llm.queries import QUERIES
from lakeloom.llm.shared import read_whole, scratch_path
from tests.conftest import SF, rows

PATH = tokens.default_tokenizer()
TOKENIZER = Tokenizer.from_file(PATH)
ODD = [
    None, "", " \n\t ", "it's l'été foo's x'll  a\tb\r\n c\x1cd ", "ÀÉÎ! ǅ ﬁ ½ ² 3rd a1b2 é ́x",
    "<|endoftext|> a<|endoftext|>b", "日本語 한국어 ΟΔΥΣΣΕΥΣ, İstanbul　full width", "'s 'S don't!!", "x" * 5000, "ß ẞ. ×÷", "na na " * 3000,
]


def ids_of(text, end):
    return np.array(TOKENIZER.encode(text or "", add_special_tokens=False).ids + [end], dtype="<u4")


def frame(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame(list(zip(ids, texts, ids)), "doc_id long, text string, start long")


def documents(spark):
    return sorted(tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())


def assert_encoded(texts):
    ids, bounds = tokens.with_end(*tokens.WordIds(PATH).of(pa.array(texts, pa.string())), 7)
    for i, text in enumerate(texts):
        assert np.array_equal(ids[bounds[i] : bounds[i + 1]], ids_of(text, 7)), repr(text)


def test_odd_texts():
    assert_encoded(ODD)
    assert_encoded([])


@budget(max_examples=80, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_any_text(texts):
    assert_encoded(texts)


def test_memory_is_given_back(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    known = tokens.WordIds(PATH)
    for text in ("one two three four", "five six", "one seven eight nine ten", "two"):
        assert known.of(pa.array([text]))[0].tolist() == ids_of(text, 0)[:-1].tolist()


@budget(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=90), min_size=1, max_size=6), st.integers(1, 8))
def test_shards_come_back(docs, frequent):
    was, re_pair.FREQUENT = re_pair.FREQUENT, frequent
    try:
        docs = [d + [2] for d in docs]
        bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
        shard = re_pair.Shard.compress(list(range(len(docs))), np.array(sum(docs, []), dtype=np.uint32), bounds)
    finally:
        re_pair.FREQUENT = was
    again = re_pair.Shard.from_bytes(shard.to_bytes())
    ids, ends = again.all_ids()
    assert ids.tolist() == sum(docs, []) and ends.tolist() == bounds.tolist()
    for i, d in enumerate(docs):
        for a, b in ((0, None), (1, 3), (len(d) // 2, len(d)), (len(d), len(d) + 5)):
            assert again.ids(i, a, b).tolist() == d[a:b]


def test_grammar_compresses():
    ids = np.tile(np.arange(100, 108, dtype=np.uint32), 4000)
    shard = re_pair.Shard.compress([0], np.append(ids, 2).astype(np.uint32), np.array([0, len(ids) + 1]))
    assert len(shard.symbols) < len(ids) / 30 and shard.lengths.max() == 2**re_pair.ROUNDS


def test_every_frequent_pair_gets_a_symbol(monkeypatch):
    monkeypatch.setattr(re_pair, "ROUNDS", 1)
    rng, n = np.random.default_rng(1), 9000
    docs = [np.append(np.stack([100 + order, 50_000 + order], 1).ravel(), 2) for order in map(rng.permutation, [n] * re_pair.FREQUENT)]
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    ids = np.concatenate(docs).astype(np.uint32)
    shard = re_pair.Shard.compress(list(range(len(docs))), ids, bounds)
    assert sorted(zip(shard.left.tolist(), shard.right.tolist())) == [(100 + i, 50_000 + i) for i in range(n)]
    assert len(shard.symbols) == len(docs) * (n + 1)
    assert np.array_equal(shard.all_ids()[0], ids)


def test_words_by_their_parts():
    letters = "".join(c for c in map(chr, range(192, 256)) if c.isalpha())
    assert_encoded(["The the THE, the. the', (the) ÿß ñandú! Élan élan; " + " ".join(letters) + " " + letters, "the the", "don't, l'x's ''"])


def expected_ids(pairs):
    start = 0
    for doc, text in pairs:
        ids = ids_of(text, 2)
        yield doc, start, len(ids), zlib.crc32(ids.tobytes())
        start += len(ids)


def test_ids_of_the_query(spark):
    assert rows(QUERIES["op3_re_pair_ids"](spark, SF)) == sorted(expected_ids(documents(spark)), key=repr)


def test_small_shards_and_odd_rows(spark):
    df = frame(spark, ODD).repartition(3)
    folder = scratch_path(spark, "ids-test")
    manifest = re_pair.write_ids(df, folder, PATH, shard_ids=500)
    assert manifest.count() >= 2
    assert rows(re_pair.read_ids(manifest, folder)) == sorted(expected_ids(list(enumerate(ODD))), key=repr)
    first = re_pair.Shard.from_bytes(read_whole(folder, manifest.orderBy("start").first().file))
    assert first.doc_ids[0] == 0
    nameless = re_pair.round_trip(frame(spark, ["a b", "c", "c"], [4, None, 4]), PATH).orderBy("start").collect()
    assert [r.doc_id for r in nameless] == [None, 4, 4] and nameless[1].start == 2
    assert re_pair.round_trip(df.limit(0), PATH).count() == 0


def check_packing(found, pairs, width=2048):
    docs = {}
    for doc, text in pairs:
        docs.setdefault(doc, []).append(ids_of(text, 1))
    pieces, sequences = {}, {}
    for r in found:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert pieces.keys() == docs.keys()
    for doc, own in pieces.items():
        (ids,) = docs[doc]
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= width
        padding += 0 if at & (at - 1) == 0 else width - at
    return padding


def test_packing_of_the_query(spark):
    found = QUERIES["op9_sum_of_squares_packing"](spark, SF).collect()
    assert check_packing(found, documents(spark)) == 0


def test_packing_of_odd_rows(spark):
    df = frame(spark, ODD).repartition(3)
    assert check_packing(sum_squares.pack(df, PATH, width=64).collect(), list(enumerate(ODD)), 64) == 0
    repeated = sum_squares.pack(frame(spark, ["a", "a", None], [1, 1, None]), PATH).collect()
    assert sorted((r.doc_id is None, r.length) for r in repeated) == [(False, 2), (False, 2), (True, 1)]
    assert sum_squares.pack(df.limit(0), PATH).count() == 0


def test_level_leaves_the_smallest_sum_of_squares():
    rng = np.random.default_rng(3)
    packer = sum_squares.Packer(16)
    packer.counts[:] = rng.integers(0, 4, 16)
    packer.counts[0] = 0
    for size in range(1, 16):
        costs = {}
        for level in [0, *np.flatnonzero(packer.counts).tolist()]:
            if level + size <= 16:
                after = packer.counts.copy()
                if level:
                    after[level] -= 1
                if level + size < 16:
                    after[level + size] += 1
                costs[level] = int((after**2).sum())
        assert costs[packer.level_for(size)] == min(costs.values())


@pytest.mark.parametrize("limit", [1, 50, 1 << 20])
def test_blocks_cover_the_batch(limit):
    batch = pa.RecordBatch.from_arrays([pa.array(["ab" * 40, None, "", "x"] * 3)], names=["text"])
    found = [b.column(0).to_pylist() for b in tokens.blocks(batch, "text", limit)]
    assert sum(found, []) == batch.column(0).to_pylist()
