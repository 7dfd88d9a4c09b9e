"""Periodic runs of words, by Lyndon arrays from the grouping phase of Baier's suffix sorter.

Suffixes start in groups by their first word. Groups are taken from the largest down; each member
finds the nearest position to its left that lies in a lower group, and that position's group is
split so that its context grows by the context of the group at hand. When a group is taken, its
context is the longest Lyndon word that begins at its members, so the lengths of the contexts are
the Lyndon array. The array is made under an order of the words and under the reversed order: the
Lyndon root of every run stands in one of them. Each root is extended both ways by the longest
common extension of its two copies, and what cannot be extended is a run.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakeloom.llm.shared import col

#: a run has so many periods at least, and so many words
PERIODS = 4
SHORTEST = 6

Run = tuple[int, int, int]


def lyndon_array(words: list[int]) -> list[int]:
    """Length of the longest Lyndon word at each position; a suffix that ends is the smaller one."""
    n = len(words)
    values = sorted(set(words))
    ranks = {v: g for g, v in enumerate(values)}
    group = [ranks[w] for w in words]
    members: list[list[int]] = [[] for _ in values]
    for i, g in enumerate(group):
        members[g].append(i)
    context = [1] * len(values)
    # groups are a chain from the largest down; a new one stands directly above its parent
    below = list(range(-1, len(values) - 1))
    above = list(range(1, len(values) + 1))
    length = [0] * n
    left = list(range(n))  # itself until it is taken, then on the way to the nearest one that is not
    at = len(values) - 1
    while at >= 0:
        size = context[at]
        mine = [i for i in members[at] if group[i] == at]
        members[at] = []
        for i in mine:
            length[i] = size
            left[i] = i - 1
        met: dict[int, int] = {}
        for i in mine:
            j = i - 1
            while j >= 0 and (k := left[j]) != j:
                if k >= 0:
                    left[j] = left[k]
                j = k
            left[i] = j
            if j >= 0:
                met[j] = met.get(j, 0) + 1
        parts: dict[tuple[int, int], list[int]] = {}
        for j, copies in met.items():
            parts.setdefault((copies, group[j]), []).append(j)
        for copies, parent in sorted(parts, reverse=True):
            new = len(context)
            context.append(context[parent] + copies * size)
            moved = parts[copies, parent]
            members.append(moved)
            for j in moved:
                group[j] = new
            top = above[parent]
            below.append(parent)
            above.append(top)
            if top < new:
                below[top] = new
            above[parent] = new
        at = below[at]
    return length


def _same(words: np.ndarray, a: int, b: int) -> int:
    """How many words from ``a`` on equal those from ``b`` on (a < b)."""
    n = len(words)
    found, step = 0, 16
    while b + found < n:
        step = min(step, n - b - found)
        differ = words[a + found : a + found + step] != words[b + found : b + found + step]
        first = int(differ.argmax())
        if differ[first]:
            return found + first
        found += step
        step *= 2
    return found


def _same_before(words: np.ndarray, a: int, b: int) -> int:
    """How many words before ``a`` equal those before ``b`` (a < b)."""
    found, step = 0, 16
    while found < a:
        step = min(step, a - found)
        differ = (words[a - found - step : a - found] != words[b - found - step : b - found])[::-1]
        first = int(differ.argmax())
        if differ[first]:
            return found + first
        found += step
        step *= 2
    return found


def runs_of(words: np.ndarray, periods: int = PERIODS, shortest: int = SHORTEST) -> list[Run]:
    """(start, length, period) of each run of at least ``periods`` periods (2 at least) and ``shortest`` words."""
    n = len(words)
    found: set[Run] = set()
    for order in (words, -words):
        length = np.array(lyndon_array(order.tolist()), dtype=np.int64)
        ahead = np.arange(n) + length
        # a root of so many periods is followed by its copies, which are Lyndon words of the same length
        root = np.ones(n, dtype=bool)
        for _ in range(periods - 2):
            root &= ahead < n
            root[root] = length[ahead[root]] == length[root]
            ahead += length
        done: dict[int, int] = {}
        for i in np.flatnonzero(root).tolist():
            period = int(length[i])
            if i + period <= done.get(period, -1) or i + period >= n:
                continue
            end = i + period + _same(words, i, i + period)
            done[period] = end
            start = i - _same_before(words, i, i + period)
            if end - start >= max(shortest, periods * period):
                found.add((start, end - start, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def _stretches(words: np.ndarray, periods: int, shortest: int) -> Iterator[tuple[int, int]]:
    """Stretches outside of which no run can lie, by words that cannot be part of one.

    In a run each pair of neighbouring words comes again one period on or one period back, and the
    period is at most the ``periods``-th part of the stretch that holds the run.
    """
    n = len(words)
    if n < shortest:
        return
    pairs = words[:-1].astype(np.int64) * (int(words.max()) + 1) + words[1:]
    order = np.argsort(pairs, kind="stable")
    gap = np.diff(order)
    gap[pairs[order[1:]] != pairs[order[:-1]]] = n
    near = np.full(len(pairs), n, dtype=np.int64)
    near[order[1:]] = gap
    near[order[:-1]] = np.minimum(near[order[:-1]], gap)
    kept = near <= n // periods
    while kept.any():
        edges = np.flatnonzero(np.diff(np.concatenate([[False], kept, [False]]).astype(np.int8)))
        starts, sizes = edges[::2], edges[1::2] - edges[::2]
        again = np.zeros(len(kept), dtype=bool)
        inside = np.flatnonzero(kept)
        size = np.repeat(sizes, sizes) + 1
        again[inside] = (near[inside] <= size // periods) & (size >= shortest)
        if (again == kept).all():
            yield from zip(starts.tolist(), (starts + sizes + 1).tolist())
            return
        kept = again


def runs_in(words: np.ndarray, periods: int = PERIODS, shortest: int = SHORTEST) -> list[Run]:
    """``runs_of``, after leaving out stretches that cannot hold a run. ``words`` are numbers from 0."""
    return [
        (start + a, size, period)
        for a, b in _stretches(words, periods, shortest)
        for start, size, period in runs_of(words[a:b], periods, shortest)
    ]


def periodic(n: int, name: object) -> tuple[int, int] | None:
    """(a, p) of a document that gets a periodic end: each word i >= a becomes word a + (i - a) % p."""
    if name is None or not n:
        return None
    h = zlib.crc32(str(name).encode())
    g = h // 10
    if h % 10:
        return None
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


_SCHEMA = pa.schema(
    [
        ("n_runs", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("period", pa.int64()),
        ("exponent_milli", pa.int64()),
        ("runs_sha256", pa.string()),
        ("collapsed_sha256", pa.string()),
    ]
)
_DDL = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _numbered(words: list[bytes]) -> np.ndarray:
    number: dict[bytes, int] = {}
    return np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)


def collapsed(words: list[bytes], found: list[Run]) -> bytes:
    """The words that no run repeats, joined by one space."""
    if not found:
        return b" ".join(words)
    kept = np.ones(len(words), dtype=bool)
    for start, size, period in found:
        kept[start + period : start + size] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])


def _row(text: bytes | None, name: object, planted: bool) -> tuple:
    words = (text or b"").split()  # bytes are split at the space and at 9 to 13 only
    end = periodic(len(words), name) if planted else None
    numbers = _numbered(words)
    if end:
        a, p = end
        place = np.arange(len(words))
        place[a:] = a + (place[a:] - a) % p
        numbers = numbers[place]
        words = [words[i] for i in place.tolist()]
    found = runs_in(numbers)
    listed = "".join(f"{start},{size},{period}\n" for start, size, period in found)
    start, size, period = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (
        len(found),
        start,
        size,
        period,
        1000 * size // period if found else None,
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(collapsed(words, found)).hexdigest(),
    )


def detect(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", planted: bool = False) -> DataFrame:
    """The runs of each row's words: doc_id, n_runs, the longest run, digests of all runs and of the text without repeats.

    With ``planted``, documents that their doc_id's checksum names get a periodic end first. Null,
    empty and blank texts have no words and no runs, and the digests of nothing; rows without a
    doc_id are never given a periodic end. Each row is worked on alone: repeated rows repeat,
    an empty table gives none, other columns are not looked at. Memory is that of one text.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                _row(body.as_py(), name.as_py(), planted) for name, body in zip(batch.column(1), batch.column(2))
            ]
            columns = list(zip(*rows)) if rows else [()] * len(_SCHEMA)
            arrays = [pa.array(c, type=f.type) for c, f in zip(columns, _SCHEMA)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", *_SCHEMA.names])

    one = docs.select(
        col(doc_id).alias("doc_id"), col(doc_id).cast("string").alias("name"), col(text).cast("string").cast("binary").alias("text")
    )
    return one.mapInArrow(find, f"doc_id {one.schema['doc_id'].dataType.simpleString()}, {_DDL}")
