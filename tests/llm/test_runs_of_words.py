"""Periodic runs against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import lyndon_runs
from tests.conftest import SF, rows


def plain_lyndon(words):
    """Longest stretch from each position that is smaller than all of its own proper ends."""
    n = len(words)
    return [
        max(k for k in range(1, n - i + 1) if all(words[i : i + k] < words[i + j : i + k] for j in range(1, k)))
        for i in range(n)
    ]


def plain_runs(words):
    n, found = len(words), set()
    for period in range(1, n // 4 + 1):
        i = 0
        while i + period < n:
            j = i
            while j + period < n and words[j] == words[j + period]:
                j += 1
            size = j - i + period
            smaller = any(all(words[x] == words[x + p] for x in range(i, i + size - p)) for p in range(1, period))
            if size >= max(6, 4 * period) and not smaller:
                found.add((i, size, period))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def random_words(rng):
    n, letters = rng.randint(0, 40), rng.randint(1, 3)
    words = [rng.randrange(letters) for _ in range(n)]
    if rng.random() < 0.6 and n > 4:
        a = rng.randrange(n)
        p = rng.randint(1, max(1, (n - a) // 3))
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words + words[: rng.randrange(n + 1)] if rng.random() < 0.2 else words


def test_grouping_gives_the_lyndon_array():
    rng = random.Random(1)
    for _ in range(400):
        words = random_words(rng)
        assert lyndon_runs.lyndon_array(words) == plain_lyndon(words)
        mirrored = [-w for w in words]
        assert lyndon_runs.lyndon_array(mirrored) == plain_lyndon(mirrored)


@pytest.mark.parametrize("find", [lyndon_runs.runs_of, lyndon_runs.runs_in])
def test_runs_equal_brute_force(find):
    rng = random.Random(2)
    for _ in range(1500):
        words = random_words(rng)
        assert find(np.array(words, dtype=np.int64)) == plain_runs(words)


def plain_row(name, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(name).encode()) if name is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    found = plain_runs([numbers[w] for w in words])
    gone = {i for s, size, p in found for i in range(s + p, s + size)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    listed = "".join(f"{s},{size},{p}\n" for s, size, p in found)
    return (
        name, len(found), *best, 1000 * best[1] // best[2] if found else None, hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(),
    )


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.expr("substring(text, 1, 2500)").alias("text"))
    odd = [(None, "a b a b a b a b"), (1, None), (2, ""), (3, " \n\t"), (3, "x x x x x x"), (4, "a\xa0b a\xa0b"), (5, "y " * 5), (6, "é " * 700)]
    docs = docs.union(spark.createDataFrame(odd, "doc_id long, text string")).withColumn("start", F.lit(1))
    found = lyndon_runs.detect(docs, planted=True)
    assert rows(found) == sorted((plain_row(*r) for r in docs.select("doc_id", "text").collect()), key=repr)
    assert found.filter("n_runs > 0").count() > 0


def test_long_text_and_empty_table(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(1000)]
    long_text = " ".join(base * 60 + ["end"])
    df = spark.createDataFrame([(7, long_text)], "doc_id long, text string")
    row = lyndon_runs.detect(df).first()
    assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (1, 0, 60_000, 1000, 60_000)
    assert row.collapsed_sha256 == hashlib.sha256(" ".join([*base, "end"]).encode()).hexdigest()
    assert lyndon_runs.detect(df.limit(0)).collect() == []
