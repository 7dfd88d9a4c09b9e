"""Cross-tokenizer alignment against whole texts encoded by the libraries, and plain counting."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeloom.llm import spill_count
from tests.conftest import SF, rows

NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    (900001, None), (900002, ""), (900003, " "), (900004, "a  b"), (900005, " lead"), (900006, "trail "),
    (900007, "x\n y 　z  w"), (900008, "a▁b c"), (900009, "<|endoftext|> <s> </s> <0x41>"),
    (900010, "日本語のテキスト ありがとう 🎉 ①"), (None, "the cat"), (900004, "a  b"), (900011, "a\x1cb \x1c c\x85 d"),
    (900012, "it's we'll 'em 12 3.4"), (900013, "x" * 3000 + " " + "é" * 500),
]


def plain(given):
    """Every text encoded whole, every overlapping pair looked at."""
    byte_path, piece_path = spill_count.default_tokenizers()
    first = Tokenizer.from_file(byte_path)
    first.encode_special_tokens = True
    aligner = spill_count.Aligner(byte_path, piece_path)
    counts, found = collections.Counter(), []
    for name, text in given:
        whole = (" " + (text or "")).encode()
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = aligner.b.encode(text) if text else []
        bytes_a, bytes_b = [aligner.a_bytes[i] for i in a], [aligner.b_bytes[i] for i in b]
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            found.append((name, 0, 0, 0, [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
        groups, at_a, at_b = [], 0, 0
        for end in np.intersect1d(ends_a, ends_b):
            to_a, to_b = int(np.searchsorted(ends_a, end)) + 1, int(np.searchsorted(ends_b, end)) + 1
            groups.append(f"{','.join(map(str, a[at_a:to_a]))}|{','.join(map(str, b[at_b:to_b]))}")
            at_a, at_b = to_a, to_b
        links = []
        for i, end in enumerate(ends_a):
            j = int(np.searchsorted(ends_b, end - len(bytes_a[i]), side="right"))
            while j < len(b) and ends_b[j] - len(bytes_b[j]) < end:
                links.append((a[i], b[j]))
                j += 1
        counts.update(links)
        found.append((name, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = collections.defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return sorted(
        (
            (name, n_a, n_b, n_groups, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest)
            for name, n_a, n_b, n_groups, links, digest in found
        ),
        key=repr,
    )


@pytest.mark.parametrize("run_bytes, fan_in, radixes", [(40_000, 2, 3), (8 << 20, 64, 16)])
def test_alignment_equals_plain_counting(spark, run_bytes, fan_in, radixes):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame(ODD, "doc_id long, text string"))
    given = [tuple(r) for r in docs.collect()]
    found = spill_count.align(
        docs.withColumn("run", F.lit("x")).withColumn("radix", F.lit(1)), run_bytes=run_bytes, fan_in=fan_in, radixes=radixes
    )
    assert found.columns == NAMES
    assert rows(found) == plain(given)


def test_links_gathered_in_parts(spark, monkeypatch):
    """One text of more links than are gathered at a time, by itself and with others."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["the", "cat", "unbelievable", "naïve", "x1y2", "words,"]) for _ in range(n)) for n in (3000, 5, 800)]
    aligner = spill_count.Aligner(*spill_count.default_tokenizers())
    import pyarrow as pa

    block = pa.record_batch({"doc_id": pa.array([1, 2, 3]), "text": pa.array(texts)})
    whole = spill_count._run(aligner, block, "r", 4, 0)
    monkeypatch.setattr(spill_count, "GATHERED", 500)
    parts = spill_count._run(aligner, block, "r", 4, 0)
    assert whole == parts


def test_merge_of_runs_equals_counting():
    rng = random.Random(2)
    total, runs = collections.Counter(), []
    for _ in range(20):
        some = collections.Counter(rng.randrange(50_000) for _ in range(rng.choice([1, 10, 30_000])))
        keys = np.array(sorted(some))
        runs.append(spill_count._blocks_of(keys, np.array([some[k] for k in keys.tolist()])))
        total.update(some)
    merged = [np.concatenate(x) for x in zip(*spill_count.merge_runs(runs))]
    assert merged[0].tolist() == sorted(total) and merged[1].tolist() == [total[k] for k in sorted(total)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spill_count.align(none).collect() == []
    only_null = spark.createDataFrame([(None, None)], "doc_id long, text string")
    assert rows(spill_count.align(only_null)) == [(None, 0, 0, 0, 0, 0, 0, "")]
