"""Token ids on disk, compressed with a Re-Pair grammar per shard.

A shard holds some documents in order. Frequent pairs of neighbouring ids (never across the end
of a document) are replaced by new symbols, round after round: a round takes the most frequent
pairs whose occurrences cannot overlap, because no symbol is the left half of one and the right
half of another. Rules and the number of ids each symbol stands for are stored, so any range of a
document's ids can be read without expanding the rest.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.shared import col, read_whole, scratch_path, settle, task_names, write_once
from lakeloom.llm.tokens import blocks, with_end, word_ids

MAGIC = b"RPAIR001"
#: ids in a shard; a longer document makes a longer shard
SHARD_IDS = 1_000_000
ROUNDS = 5
#: a pair must occur so often to get a symbol
FREQUENT = 16


def _frequent_pairs(keys: np.ndarray, frequent: int) -> list[tuple[int, int]]:
    """All pairs that occur ``frequent`` times, the most frequent first, but those that could overlap
    one before them. ``keys``: both ids of each pair, -1 across the end of a document."""
    keys = np.sort(keys)
    keys = keys[np.searchsorted(keys, 0) :]
    if not len(keys):
        return []
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.diff(np.append(first, len(keys)))
    often = np.flatnonzero(counts >= frequent)
    order = often[np.lexsort((keys[first[often]], -counts[often]))]
    chosen: list[tuple[int, int]] = []
    lefts: set[int] = set()
    rights: set[int] = set()
    ranked = keys[first[order]]
    for a, b in zip((ranked >> 32).tolist(), (ranked & 0xFFFFFFFF).tolist()):
        if a in rights or b in lefts or (a == b and (a in lefts or b in rights)):
            continue
        chosen.append((a, b))
        lefts.add(a)
        rights.add(b)
    return chosen


def _occurrences(symbols: np.ndarray, keys: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a document has one of the pairs, and the number of that pair."""
    most = int(symbols.max()) + 1
    is_left, is_right = np.zeros(most, dtype=bool), np.zeros(most, dtype=bool)
    is_left[pairs[:, 0]], is_right[pairs[:, 1]] = True, True
    where = np.flatnonzero(is_left[symbols[:-1]] & is_right[symbols[1:]])
    ranked = pairs[:, 0].astype(np.int64) << 32 | pairs[:, 1]
    order = np.argsort(ranked)
    ranked, found = ranked[order], keys[where]
    at = np.minimum(np.searchsorted(ranked, found), len(ranked) - 1)
    hit = ranked[at] == found
    return where[hit], order[at[hit]]


@dataclass
class Shard:
    """Symbols of some documents, and the grammar that expands them."""

    doc_ids: list
    first_symbol: int
    left: np.ndarray
    right: np.ndarray
    symbols: np.ndarray
    bounds: np.ndarray
    lengths: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.lengths = np.ones(len(self.left), dtype=np.int64)
        for i, (a, b) in enumerate(zip(self.left.tolist(), self.right.tolist())):
            self.lengths[i] = sum(self.lengths[x - self.first_symbol] if x >= self.first_symbol else 1 for x in (a, b))

    @classmethod
    def compress(cls, doc_ids: list, ids: np.ndarray, bounds: np.ndarray) -> Shard:
        symbols = ids.astype(np.uint32)
        last = np.zeros(len(symbols), dtype=bool)
        last[bounds[1:] - 1] = True  # each document ends with an id of its own
        first = int(symbols.max()) + 1 if len(symbols) else 0
        left: list[int] = []
        right: list[int] = []
        for _ in range(ROUNDS):
            keys = symbols[:-1].astype(np.int64) << 32 | symbols[1:]
            keys[last[:-1]] = -1
            chosen = _frequent_pairs(keys, FREQUENT)
            if not chosen:
                break
            pairs = np.array(chosen, dtype=np.uint32)
            where, which = _occurrences(symbols, keys, pairs)
            twins = symbols[where] == symbols[where + 1]
            if twins.any():  # in a run of one id, every other pair
                run = np.cumsum(np.concatenate([[0], np.diff(where) != 1]))
                begin = np.concatenate([[0], np.flatnonzero(np.diff(run)) + 1])
                odd = (np.arange(len(where)) - begin[run]) % 2 == 1
                where, which = where[~(twins & odd)], which[~(twins & odd)]
            symbols[where] = first + len(left) + which
            keep = np.ones(len(symbols), dtype=bool)
            keep[where + 1] = False
            last[where] = last[where + 1]
            symbols, last = symbols[keep], last[keep]
            left += pairs[:, 0].tolist()
            right += pairs[:, 1].tolist()
        ends = np.flatnonzero(last) + 1
        return cls(
            doc_ids, first, np.array(left, dtype=np.uint32), np.array(right, dtype=np.uint32), symbols,
            np.concatenate([[0], ends]).astype(np.int64),
        )

    def to_bytes(self) -> bytes:
        missing = np.array([d is None for d in self.doc_ids], dtype=np.uint8)
        known = np.array([d or 0 for d in self.doc_ids], dtype="<i8")
        head = MAGIC + struct.pack("<QQQQ", len(known), len(self.left), len(self.symbols), self.first_symbol)
        wide = 3 if self.first_symbol + len(self.left) < 1 << 24 else 4
        packed = self.symbols.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :wide]
        return b"".join(
            [
                head, missing.tobytes(), known.tobytes(), self.bounds.astype("<i8").tobytes(),
                self.left.astype("<u4").tobytes(), self.right.astype("<u4").tobytes(),
                self.lengths.astype("<u4").tobytes(), bytes([wide]), packed.tobytes(),
            ]
        )

    @classmethod
    def from_bytes(cls, content: bytes) -> Shard:
        if content[:8] != MAGIC:
            raise ValueError("not a shard of ids")
        docs, rules, count, first = struct.unpack_from("<QQQQ", content, 8)
        at = 40

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(content, kind, n, at)
            at += found.nbytes
            return found

        missing, known, bounds = take("u1", docs), take("<i8", docs), take("<i8", docs + 1)
        left, right, lengths = take("<u4", rules), take("<u4", rules), take("<u4", rules)
        wide = int(take("u1", 1)[0])
        symbols = np.zeros((count, 4), dtype=np.uint8)
        symbols[:, :wide] = take("u1", count * wide).reshape(-1, wide)
        ids = [None if gone else d for d, gone in zip(known.tolist(), missing.tolist())]
        shard = cls(ids, first, left, right, symbols.view("<u4").reshape(-1), bounds)
        if not np.array_equal(shard.lengths, lengths):
            raise ValueError("expansion lengths do not fit the rules")
        return shard

    def _expansions(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rules, one after the other, and where each begins."""
        begin = np.concatenate([[0], np.cumsum(self.lengths)])
        flat = np.zeros(begin[-1], dtype=np.uint32)
        first = self.first_symbol
        for i, halves in enumerate(zip(self.left.tolist(), self.right.tolist())):
            at = begin[i]
            for x in halves:
                if x < first:
                    flat[at] = x
                    at += 1
                else:
                    size = self.lengths[x - first]
                    flat[at : at + size] = flat[begin[x - first] : begin[x - first] + size]
                    at += size
        return flat, begin

    def sizes(self, symbols: np.ndarray) -> np.ndarray:
        """Ids that each symbol stands for."""
        rules = np.append(self.lengths, 1)
        return rules[np.where(symbols >= self.first_symbol, symbols.astype(np.int64) - self.first_symbol, -1)]

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        flat, begin = self._expansions()
        source = np.concatenate([flat, np.arange(self.first_symbol, dtype=np.uint32)])
        is_rule = symbols >= self.first_symbol
        rule = np.where(is_rule, symbols.astype(np.int64) - self.first_symbol, 0)
        start = np.where(is_rule, begin[rule], len(flat) + symbols.astype(np.int64))
        sizes = self.sizes(symbols)
        out = np.repeat(start - (np.cumsum(sizes) - sizes), sizes)
        out += np.arange(len(out))
        return source[out]

    def all_ids(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents, and the bounds of each."""
        ends = np.concatenate([[0], np.cumsum(self.sizes(self.symbols))])
        return self.expand(self.symbols), ends[self.bounds]

    def ids(self, doc: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop`` of one document; only the symbols that cover them are expanded."""
        symbols = self.symbols[self.bounds[doc] : self.bounds[doc + 1]]
        ends = np.cumsum(self.sizes(symbols))
        stop = int(ends[-1]) if stop is None else min(stop, int(ends[-1]))
        if start >= stop:
            return np.zeros(0, dtype=np.uint32)
        a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
        skipped = start - (ends[a - 1] if a else 0)
        return self.expand(symbols[a:b])[skipped : skipped + stop - start]


def write_ids(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    shard_ids: int = SHARD_IDS,
) -> DataFrame:
    """Encode every text, write shards in ascending doc_id order, return their manifest.

    The manifest (partition, shard, file, docs, ids, start) names the files that count: a file
    of a lost attempt is not in it. ``start`` is the number of ids in all shards before. Null
    texts are empty and have their end id alone. Rows without a doc_id come first; rows that
    repeat one stand in the order of their texts. An empty table writes no file.
    """
    kept = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).cast("string").alias("text"))
    kept = kept.withColumn("mark", F.xxhash64("text"))
    sorted_rows = kept.repartitionByRange("doc_id", "mark").sortWithinPartitions("doc_id", "mark")
    sorted_rows = sorted_rows.select("doc_id", "text")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, (partition, attempt) = word_ids(tokenizer), task_names()
        doc_ids: list = []
        held: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        rows: list[tuple] = []

        def flush() -> None:
            ids = np.concatenate(held)
            bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            name = f"ids-{partition:06d}-{len(rows):06d}.rpair"
            write_once(folder, name, Shard.compress(doc_ids, ids, bounds).to_bytes(), attempt)
            rows.append((partition, len(rows), name, len(doc_ids), len(ids)))
            doc_ids.clear(), held.clear(), sizes.clear()

        for batch in batches:
            for block in blocks(batch, "text", 4 * shard_ids):
                ids, bounds = with_end(*known.of(block.column(1)), end_id)
                doc_ids.extend(block.column(0).to_pylist())
                held.append(ids)
                sizes.append(np.diff(bounds))
                if sum(map(len, held)) >= shard_ids:
                    flush()
        if doc_ids:
            flush()
        if rows:
            columns = [pa.array(c) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays(columns, names=["partition", "shard", "file", "docs", "ids"])

    listed = settle(
        sorted_rows.mapInArrow(written, "partition long, shard long, file string, docs long, ids long"), "shards"
    )
    # one number for each task that wrote; what a partition holds is summed within it
    before, total = [], 0
    for partition, ids in sorted(tuple(r) for r in listed.groupBy("partition").agg(F.sum("ids")).collect()):
        before.append((partition, total))
        total += ids
    bases = docs.sparkSession.createDataFrame(before, "partition long, base long")
    within = Window.partitionBy("partition").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return listed.join(bases, "partition").withColumn(
        "start", F.col("base") + F.coalesce(F.sum("ids").over(within), F.lit(0))
    ).drop("base")


def read_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files."""
    # an explicit number, as files are short rows that would else be put into one task
    tasks = max(1, min(manifest.count(), int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    files = manifest.select("file", "start").repartition(tasks)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = Shard.from_bytes(read_whole(folder, file))
                ids, bounds = shard.all_ids()
                little = ids.astype("<u4", copy=False)
                sums = [zlib.crc32(little[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.doc_ids, pa.int64()),
                        pa.array(start + bounds[:-1], pa.int64()),
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, folder: str | None = None, **options) -> DataFrame:
    """Write the ids of all documents to shards and return what the files say of each."""
    folder = folder or scratch_path(docs.sparkSession, "ids")
    return read_ids(write_ids(docs, folder, tokenizer, **options), folder)
