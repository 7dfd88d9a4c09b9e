"""Closed syncmers and SimHash against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings as budget, strategies as st
from pyspark.sql import functions as F

from lakeloom.llm import components, multi_index, syncmers
from lakeloom.llm.queries import QUERIES
from tests.conftest import SF, rows

ODD = [None, "", " \n ", "a", "é" * 30, "the same words here " * 4000, "A b\tC", "a B c", "\x00x y z", "日本語 " * 40]


def frame(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame(list(zip(ids, texts, texts)), "doc_id long, text string, bits string")


def plain_anchors(data: bytes) -> set[int]:
    """Positions whose smallest inner value is at an edge, one k-mer at a time."""

    def value(at: int) -> int:
        n = int.from_bytes(data[at : at + 8], "little")
        n ^= n >> 29
        return (n * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 32

    found = set()
    for at in range(len(data) - syncmers.K + 1):
        values = [value(at + i) for i in range(syncmers.WINDOW)]
        if min(values) in (values[0], values[-1]):
            found.add(at)
    return found


@budget(max_examples=40, deadline=None)
@given(st.binary(max_size=300))
def test_anchors_are_closed_syncmers(data):
    assert set(syncmers.anchors(data)[0].tolist()) == plain_anchors(data)


@budget(max_examples=60, deadline=None)
@given(st.text(max_size=200), st.text(max_size=200))
def test_edited_fingerprint_is_that_of_the_edited_text(a, b):
    a, b = a * 3, b * 2
    data, seen = syncmers.edited(syncmers.Marked(a), syncmers.Marked(b))
    text = a[: len(a) - len(a) // 2] + b[: len(a) // 2]
    assert data == text.encode() and np.array_equal(seen, syncmers.Marked(text).print)


def test_likeness():
    one, other = (syncmers.Marked(t).print for t in ("word " * 9 + "x", "quite another text that is long enough"))
    empty = syncmers.Marked("").print
    assert syncmers.likeness(one, one) == 1.0 and syncmers.likeness(one, other) < 0.2
    assert syncmers.likeness(empty, empty) == 1.0 and syncmers.likeness(one, empty) == 0.0


def expected_edits(pairs):
    pairs = sorted(pairs, key=lambda p: -p[0])
    for k, (i, t) in enumerate(pairs):
        t, following = t or "", pairs[(k + 1) % len(pairs)][1] or ""
        text = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        near = syncmers.likeness(syncmers.Marked(t).print, syncmers.Marked(text).print)
        beside = syncmers.likeness(syncmers.Marked(t).print, syncmers.Marked(following).print)
        yield i, len(t), hashlib.sha256(text.encode()).hexdigest(), round(near, 9), round(beside, 9)


def shown_edits(df):
    return sorted(
        (r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in df.collect()
    )


def test_edits_of_odd_texts(spark):
    df = frame(spark, ODD).repartition(3)
    assert shown_edits(syncmers.fingerprint_edits(df)) == sorted(expected_edits(list(enumerate(ODD))))


def test_edits_of_the_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert shown_edits(QUERIES["op1_closed_syncmers"](spark, SF)) == sorted(expected_edits(docs))


def test_likenesses_are_of_the_fingerprints_shown(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = sorted(syncmers.fingerprint_edits(docs).collect(), key=lambda r: -r.doc_id)
    shown = [{r.fingerprint[i : i + 8] for i in range(0, len(r.fingerprint), 8)} for r in found]
    changed = [{r.edited_fingerprint[i : i + 8] for i in range(0, len(r.edited_fingerprint), 8)} for r in found]

    def jaccard(a, b):
        return len(a & b) / len(a | b) if a or b else 1.0

    assert max(map(len, shown)) > 500
    for k, r in enumerate(found):
        assert r.near_edited == pytest.approx(jaccard(shown[k], changed[k]), abs=1e-12)
        assert r.near_next == pytest.approx(jaccard(shown[k], shown[(k + 1) % len(found)]), abs=1e-12)
        assert (r.passage_bytes > 0) <= (r.near_next > 0)


def test_edits_of_repeats_nulls_and_nothing(spark):
    df = frame(spark, ["one text"] * 3 + ["x", "y"], [1, 1, 1, None, None])
    found = syncmers.fingerprint_edits(df)
    assert found.count() == 5 and found.filter("doc_id is null").count() == 2
    assert found.filter("doc_id = 1").select("fingerprint").distinct().count() == 1
    assert syncmers.fingerprint_edits(df.limit(0)).count() == 0
    alone = syncmers.fingerprint_edits(frame(spark, ["a lonely text"])).first()
    assert alone.near_next == 1.0


def test_long_texts_show_a_short_passage_they_share(spark):
    rng = random.Random(8)
    one, other, shared = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(n)) for n in (10_000, 10_000, 60))
    a, b = f"{one} {shared} {other[:900]}", f"{other[900:]} {shared} {one[::-1]}"
    first = syncmers.fingerprint_edits(frame(spark, [b, a], [1, 2])).filter("doc_id = 2").first()
    x, y = set(syncmers.anchors(a.encode())[1].tolist()), set(syncmers.anchors(b.encode())[1].tolist())
    assert first.near_next == len(x & y) / len(x | y) > 0
    assert list(zip(first.anchor_at, first.anchor_hash)) == list(zip(*(v.tolist() for v in syncmers.anchors(a.encode()))))
    start, there, size = first.passage_at, first.passage_next_at, first.passage_bytes
    assert a[start : start + size] == b[there : there + size] and size > 0.8 * len(shared)


def plain_simhash(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance=2):
    """Smallest key reached from each key, all pairs compared."""
    keys = sorted(prints)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}


@pytest.mark.parametrize("text", ODD)
def test_simhash(text):
    assert multi_index.simhash(text) == plain_simhash(text)


def test_spark_hashes_shingles_alike(spark):
    text = "three plain words"
    bits = spark.range(1).select(F.xxhash64(F.lit(text))).first()[0]
    assert bits % (1 << 64) == multi_index.simhash(text)


def test_components_of_the_query(spark):
    docs = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    prints = {i: plain_simhash(t) for i, t in docs.items()}
    roots = plain_components(prints)
    found = rows(QUERIES["op8_multi_index_simhash"](spark, SF))
    assert found == sorted(((i, f"{p:016x}", roots[i]) for i, p in prints.items()), key=repr)


@pytest.mark.parametrize("crowded", [0, 3, 10_000])
def test_links_close_to_the_same_components(spark, crowded):
    """Chains, dense balls and halves that many share, whichever way entries are served."""
    rng = random.Random(5)
    base = rng.getrandbits(64)
    prints = {rng.getrandbits(64) for _ in range(150)}
    prints |= {base ^ 1 << b for b in range(64)} | {base ^ 3 << b for b in range(0, 63, 5)}
    at = rng.getrandbits(64)
    for step in range(25):  # a chain whose ends are far apart
        prints.add(at)
        at ^= 1 << (2 * step) | 1 << (2 * step + 1)
    half = rng.getrandbits(32) << 32
    prints |= {half | rng.getrandbits(32) for _ in range(120)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "bits long")
    links = multi_index.links(df, crowded=crowded)
    assert links.filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) > 2).count() == 0
    roots = {r.node: r.root for r in components.components(links).collect()}
    expected = plain_components({p: p % (1 << 64) for p in signed})
    assert {k: roots.get(k, k) for k in signed} == expected


def test_components_of_a_long_path_and_of_nothing(spark):
    order = list(range(200))
    random.Random(1).shuffle(order)
    df = spark.createDataFrame(list(zip(order, order[1:])) + [(500, 500), (600, 601)], "u long, v long")
    found = {r.node: r.root for r in components.components(df).collect()}
    assert found == {**{k: 0 for k in range(200)}, 600: 600, 601: 600}
    assert components.components(df.limit(0)).count() == 0


def test_near_copies_of_odd_rows(spark):
    texts = ["", None, "same text here now", "Same Text Here Now", "other words are here", "other words are here"]
    df = frame(spark, texts, [9, 3, 5, 5, None, 8])
    found = rows(multi_index.near_copies(df).select("doc_id", "component_id"))
    assert found == sorted([(9, 3), (3, 3), (5, 5), (5, 5), (None, 8), (8, 8)], key=repr)
    alone = multi_index.near_copies(frame(spark, ["some text"], [None])).first()
    assert alone.component_id is None
    assert multi_index.near_copies(df.limit(0)).count() == 0
    kept = multi_index.one_of_each(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [3, 5, 8]
    assert multi_index.one_of_each(frame(spark, ["a b", "a b"], [None, None])).count() == 1
    assert multi_index.one_of_each(frame(spark, ["a b"] * 4, [2] * 4)).count() == 1
    assert multi_index.one_of_each(df.limit(0)).count() == 0
