"""Alignment of two tokenizers, with counts of aligned ids by spilled, merged runs.

Each text is encoded by both tokenizers, and two tokens are linked if their byte ranges overlap. The
links of some documents at a time are counted as records of (pair of ids, document, how often), in
order of the pair with the second side's id first, dealt to radix partitions by that id, and
written as zstd-compressed runs. Three passes over the runs follow, none of which sorts again:

1. The pair totals at the head of the runs are merged with a heap, some runs at a time, until
   each partition has one run. As all pairs of a second-side id stand together, its largest
   count is known as soon as the merge has passed it.
2. Each run is read next to its partition's totals, and sends back to each of its documents what
   the document's records contribute.
3. The contributions of all partitions are added to the documents they came from.

Texts are cut where a single space stands between two characters that are no white space. Neither
tokenizer joins bytes across it (this is checked when they are loaded), so both end a token there,
and each distinct piece of text is encoded and aligned once per worker.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.shared import col, settle, task_names
from lakeloom.llm.tokens import _room, blocks

#: bytes of text whose links make one run in each partition
RUN_BYTES = 8 << 20
RADIXES = 16
#: runs that are merged at a time
FAN_IN = 64
#: bytes of records that are read next to one copy of a partition's totals
NEAR_TOTALS = 64 << 20
#: pairs in a block of a run, which is what a merge holds of each run
BLOCK = 1 << 13
#: distinct pieces kept per worker before the memory is given back
REMEMBERED = 250_000
#: links that are gathered before equal ones are counted
GATHERED = 4 << 20

_LEVEL = 1
#: how a byte-level vocabulary of this kind cuts texts before merging
_WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: a space beside white space or at an end of the text, which does not cut
_ODD_SPACE = "(^ | $| [\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]|[\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}] )"


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones for themselves, others moved up."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    moved = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(moved)}}


class Aligner:
    """Tokens, groups and links of pieces of text, remembered."""

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        letter = _byte_letters()
        vocabulary = Tokenizer.from_file(byte_path).get_vocab(with_added_tokens=False)
        self.a_bytes = {i: bytes(letter[c] for c in token) for token, i in vocabulary.items()}
        # ids are in the order of the merges, so the vocabulary is its own table of ranks
        ranks = {token: i for i, token in self.a_bytes.items()}
        self.a = tiktoken.Encoding("bytes", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece goes on behind a space: texts can't be cut at spaces")
        self.b_bytes = [
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.a_size = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        self.a_size[list(self.a_bytes)] = [len(x) for x in self.a_bytes.values()]
        self.b_size = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        self.listed = [f"{i}{mark}" for i in range(max(len(self.a_size), len(pieces))) for mark in ",|;\n"]
        # links are kept as 32 bits: the second side's id, then the first side's
        if max(vocabulary.values()) >= 1 << 16 or len(pieces) > 1 << 16:
            raise ValueError("ids of more than 16 bits")
        self._clear()

    def _clear(self) -> None:
        self.code: dict[str, int] = {}
        self.groups: list[bytes | None] = []
        self.counts = np.zeros((1 << 12, 3), dtype=np.int64)  # tokens of A, of B, groups
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0
        self.start = np.zeros(1 << 12, dtype=np.int64)
        self.size = np.zeros(1 << 12, dtype=np.int64)

    def _align(self, piece: str, a: list[int], b: list[int]):
        """(tokens of A, of B, groups as text, links) of a piece; None if it can't be rebuilt from either side."""
        bytes_a, bytes_b = [self.a_bytes[i] for i in a], [self.b_bytes[i] for i in b]
        whole = (" " + piece).encode()
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            return None
        # both sides step to the nearer end of a token; where both end, a group ends
        listed, links = [], []
        i = j = first_a = first_b = 0
        end_a, end_b = len(bytes_a[0]), len(bytes_b[0])
        while True:
            links.append(b[j] << 16 | a[i])
            if end_a == end_b:
                i += 1
                j += 1
                listed.append(f"{','.join(map(str, a[first_a:i]))}|{','.join(map(str, b[first_b:j]))}")
                if i == len(a):
                    return len(a), len(b), ";".join(listed).encode(), len(listed), links
                first_a, first_b = i, j
                end_a += len(bytes_a[i])
                end_b += len(bytes_b[j])
            elif end_a < end_b:
                i += 1
                end_a += len(bytes_a[i])
            else:
                j += 1
                end_b += len(bytes_b[j])

    def _together(self, pieces: list[str]):
        """What ``_align`` finds of each piece, of all at once; None if some piece can't be rebuilt.

        The pieces are encoded as one text, as neither side joins bytes across the spaces between them.
        """
        whole = " " + " ".join(pieces)
        a = np.array(self.a(whole), dtype=np.int64)
        b = np.array(self.b.encode(whole[1:]), dtype=np.int64)
        raw = whole.encode()
        if b"".join([self.a_bytes[i] for i in a.tolist()]) != raw or b"".join([self.b_bytes[i] for i in b.tolist()]) != raw:
            return None
        ends_a, ends_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        ends = np.cumsum([1 + len(p.encode()) for p in pieces])
        cuts = np.union1d(ends_a, ends_b)
        links = b[np.searchsorted(ends_b, cuts)] << 16 | a[np.searchsorted(ends_a, cuts)]
        groups = np.intersect1d(ends_a, ends_b, assume_unique=True)
        last_a, last_b = np.searchsorted(ends_a, groups), np.searchsorted(ends_b, groups)
        # each id with what stands behind it: , within a side, | between sides, ; between groups, a line's end between pieces
        text = np.empty(len(a) + len(b), dtype=np.int64)
        behind_a, behind_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
        behind_a[last_a], behind_b[last_b] = 1, 2
        behind_b[np.searchsorted(ends_b, ends)] = 3
        of_a, of_b = np.searchsorted(groups, ends_a), np.searchsorted(groups, ends_b)
        text[np.arange(len(a)) + np.concatenate([[0], last_b + 1])[of_a]] = a * 4 + behind_a
        text[np.arange(len(b)) + (last_a + 1)[of_b]] = b * 4 + behind_b
        listed = "".join([self.listed[i] for i in text.tolist()]).encode().split(b"\n")

        def held(marks: np.ndarray) -> np.ndarray:
            return np.diff(np.searchsorted(marks, ends, side="right"), prepend=0)

        return listed[:-1], np.stack([held(ends_a), held(ends_b), held(groups)], axis=1), held(cuts), links

    def _learn(self, pieces: list[str]) -> None:
        """Adds what is known of new pieces, in the order given."""
        for at in range(0, len(pieces), 500):
            some = pieces[at : at + 500]
            plain = all(p and not p[0].isspace() and not p[-1].isspace() for p in some)
            found = self._together(some) if plain else None
            if found is None:
                each = [self._align(p, self.a(" " + p), self.b.encode(p)) for p in some]
                listed = [x and x[2] for x in each]
                counts = np.array([(x[0], x[1], x[3]) if x else (0, 0, 0) for x in each], dtype=np.int64)
                size = np.array([len(x[4]) if x else 0 for x in each], dtype=np.int64)
                links = np.array([link for x in each if x for link in x[4]], dtype=np.int64)
            else:
                listed, counts, size, links = found
            n = len(self.groups)
            self.groups += listed
            self.start, self.size = _room(self.start, n + len(some)), _room(self.size, n + len(some))
            if len(self.counts) < n + len(some):
                grown = np.zeros((len(self.counts) * 3 // 2 + len(some), 3), dtype=np.int64)
                grown[:n] = self.counts[:n]
                self.counts = grown
            self.counts[n : n + len(some)] = counts
            self.size[n : n + len(some)] = size
            self.start[n : n + len(some)] = self.used + np.cumsum(size) - size
            self.flat = _room(self.flat, self.used + len(links))
            self.flat[self.used : self.used + len(links)] = links
            self.used += len(links)

    def pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pieces of all texts, and the bounds of each text in them; empty texts have none."""
        if len(self.code) > REMEMBERED:
            self._clear()
        parts = pc.split_pattern(texts, " ")
        if pc.any(odd := pc.match_substring_regex(texts, _ODD_SPACE)).as_py():
            lists = [_CUT.split(t) if o else None for t, o in zip(texts.to_pylist(), odd.to_pylist())]
            parts = pa.array(
                [x if x is not None else p for x, p in zip(lists, parts.to_pylist())], pa.large_list(pa.large_string())
            )
        offsets = np.asarray(parts.offsets).astype(np.int64)
        coded = parts.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        code, fresh = self.code, []
        known = coded.dictionary.to_pylist()
        mine = np.empty(len(known), dtype=np.int64)
        for i, piece in enumerate(known):
            at = code.get(piece)
            if at is None:
                at = code[piece] = len(code)
                fresh.append(piece)
            mine[i] = at
        self._learn(fresh)
        order = mine[np.asarray(coded.indices)] if len(known) else np.zeros(0, dtype=np.int64)
        return order, offsets - offsets[0]


@functools.lru_cache(maxsize=1)
def _aligner(byte_path: str, piece_path: str) -> Aligner:
    return Aligner(byte_path, piece_path)


# --- runs ---------------------------------------------------------------------------------------


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one zstd frame, each in the narrowest unsigned type, the bytes of a place together."""
    parts = []
    for array in arrays:
        most = int(array.max()) if len(array) else 0
        width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
        raw = array.astype(f"<u{width}").view(np.uint8).reshape(-1, width)
        parts += [struct.pack("<QB", len(array), width), np.ascontiguousarray(raw.T).tobytes()]
    return zstandard.ZstdCompressor(level=_LEVEL).compress(b"".join(parts))


def _unpacked(packed: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(packed)
    out, at = [], 0
    while at < len(data):
        n, width = struct.unpack_from("<QB", data, at)
        at += 9
        raw = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(raw.T).view(f"<u{width}").reshape(n).astype(np.int64))
        at += n * width
    return out


def _blocks_of(keys: np.ndarray, counts: np.ndarray, *more: np.ndarray) -> bytes:
    """A run of pair totals in blocks, which can be opened one at a time."""
    parts = []
    for at in range(0, len(keys), BLOCK):
        some = slice(at, at + BLOCK)
        steps = np.diff(keys[some], prepend=keys[at])
        block = _packed(keys[at : at + 1], steps, counts[some], *(m[some] for m in more))
        parts += [struct.pack("<I", len(block)), block]
    return b"".join(parts)


def _opened(run: bytes) -> Iterator[list[np.ndarray]]:
    at = 0
    while at < len(run):
        (size,) = struct.unpack_from("<I", run, at)
        first, steps, *rest = _unpacked(run[at + 4 : at + 4 + size])
        yield [first + np.cumsum(steps), *rest]
        at += 4 + size


def merge_runs(runs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys in order with the sum of their counts, by a k-way merge that holds a block of each run.

    The heap knows where each run's open block ends. Everything up to the smallest of these ends is
    complete: it is taken from all open blocks, added up, and the run whose block ended opens its next.
    """
    opened = [_opened(run) for run in runs]
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def advance(i: int) -> None:
        block = next(opened[i], None)
        if block is not None:
            held[i] = block[0], block[1]
            heapq.heappush(heap, (int(block[0][-1]), i))

    for i in range(len(runs)):
        advance(i)
    while heap:
        end = heap[0][0]
        keys, counts = [], []
        for i, (k, c) in held.items():
            n = int(np.searchsorted(k, end, side="right"))
            if n:
                keys.append(k[:n])
                counts.append(c[:n])
                held[i] = k[n:], c[n:]
        while heap and heap[0][0] == end:
            _, i = heapq.heappop(heap)
            del held[i]
            advance(i)
        joined = np.concatenate(keys)
        order = np.argsort(joined, kind="stable")
        joined = joined[order]
        firsts = np.flatnonzero(np.concatenate([[True], joined[1:] != joined[:-1]]))
        yield joined[firsts], np.add.reduceat(np.concatenate(counts)[order], firsts)


def _merged(runs: list[bytes]) -> bytes:
    keys, counts = zip(*merge_runs(runs))
    return _blocks_of(np.concatenate(keys), np.concatenate(counts))


def _with_maxima(runs: list[bytes]) -> bytes:
    """One run of keys, counts and the largest count among the pairs of the same second-side id."""
    keys, counts, maxima = [], [], []
    held_k, held_c = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def close(k: np.ndarray, c: np.ndarray) -> None:
        if len(k):
            side = k >> 16
            firsts = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]]))
            sizes = np.diff(np.append(firsts, len(k)))
            keys.append(k)
            counts.append(c)
            maxima.append(np.repeat(np.maximum.reduceat(c, firsts), sizes))

    for k, c in merge_runs(runs):
        k, c = np.concatenate([held_k, k]), np.concatenate([held_c, c])
        last = int(np.searchsorted(k >> 16, k[-1] >> 16))  # the side that may go on
        close(k[:last], c[:last])
        held_k, held_c = k[last:], c[last:]
    close(held_k, held_c)
    return _blocks_of(np.concatenate(keys), np.concatenate(counts), np.concatenate(maxima))


def _counted(keys: np.ndarray, owners: np.ndarray, counts: np.ndarray | None = None):
    """Distinct (key, owner) in order, and how often each stands there."""
    both = keys.astype(np.uint64) << np.uint64(32) | owners.astype(np.uint64)
    order = np.argsort(both, kind="stable") if counts is not None else None
    both = np.sort(both) if order is None else both[order]
    firsts = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, np.int64)
    total = np.diff(np.append(firsts, len(both))) if order is None else (
        np.add.reduceat(counts[order], firsts) if len(both) else counts
    )
    both = both[firsts]
    return (both >> np.uint64(32)).astype(np.int64), (both & np.uint64(0xFFFFFFFF)).astype(np.int64), total


_RUNS = "run string, radix int, salt long, totals binary, records binary"


def _spilled(docs: DataFrame, paths: tuple[str, str], id_type: str, radixes: int, run_bytes: int) -> DataFrame:
    """One row for each run and partition, and one with the run's documents (radix -1)."""

    def spill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*paths)
        partition, _ = task_names()
        number = 0
        for batch in batches:
            for block in blocks(batch, "text", run_bytes):
                rows = _run(aligner, block, f"{partition}-{number}", radixes, number)
                number += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                    names=["run", "radix", "salt", "totals", "records"],
                )

    return docs.mapInArrow(spill, _RUNS)


def _run(aligner: Aligner, block: pa.RecordBatch, name: str, radixes: int, salt: int) -> list[tuple]:
    texts = pc.fill_null(block.column("text").cast(pa.large_string()), "")
    order, bounds = aligner.pieces(texts)
    n = block.num_rows
    filled = np.asarray(pc.greater(pc.binary_length(texts), 0))
    groups = aligner.groups
    numbers = order.tolist()
    figures = np.zeros((n, 4), dtype=np.int64)  # tokens of A, of B, groups, links
    digests = [""] * n
    good = np.zeros(n, dtype=bool)
    for i in range(n):
        if not filled[i]:
            continue
        listed = [groups[x] for x in numbers[bounds[i] : bounds[i + 1]]]
        if None in listed:
            continue
        good[i] = True
        digest = hashlib.sha256()
        for at in range(0, len(listed), 1 << 16):
            digest.update((b";" if at else b"") + b";".join(listed[at : at + (1 << 16)]))
        digests[i] = digest.hexdigest()
    owner = np.repeat(np.arange(n), np.diff(bounds))
    kept = good[owner]
    order, owner = order[kept], owner[kept]
    sizes = aligner.size[order]
    for at, values in enumerate((*aligner.counts[order].T, sizes)):
        figures[:, at] = np.bincount(owner, weights=values, minlength=n).astype(np.int64)
    # long texts and many documents: equal links are counted as soon as enough are gathered
    keys, owners, counts = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(order):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + GATHERED, side="right")))
        size = sizes[at:to]
        place = np.repeat(aligner.start[order[at:to]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        found = _counted(aligner.flat[place], np.repeat(owner[at:to], size))
        if len(keys):
            found = _counted(*(np.concatenate(x) for x in zip((keys, owners, counts), found)))
        keys, owners, counts = found
        at = to
    rows = []
    radix = (keys >> 16) % radixes
    for r in range(radixes):
        mine = np.flatnonzero(radix == r)
        if len(mine):
            k, o, c = keys[mine], owners[mine], counts[mine]
            firsts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            rows.append((
                name, r, salt, _blocks_of(k[firsts], np.add.reduceat(c, firsts)),
                _packed(np.array([n]), k[firsts], np.diff(np.append(firsts, len(k))), o, c),
            ))
    table = pa.table({
        "doc_id": block.column("doc_id"),
        **{name: pa.array(figures[:, i]) for i, name in enumerate(_FIGURES)},
        "groups_sha256": pa.array(digests),
    })
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    rows.append((name, -1, salt, None, sink.getvalue().to_pybytes()))
    return rows


_FIGURES = ("n_a", "n_b", "n_groups", "n_links")


# --- passes -------------------------------------------------------------------------------------


def _totals(runs: DataFrame, fan_in: int) -> DataFrame:
    """(radix, totals): one run of pair totals and maxima for each partition, merged ``fan_in`` at a time."""

    def merger(combine):
        def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            some = [run.as_py() for batch in batches for run in batch.column("totals")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([key[0].as_py()], pa.int32()), pa.array([combine(some)], pa.binary())], names=["radix", "totals"]
            )

        return merge

    heads = runs.filter("radix >= 0").select("radix", "totals", "run")
    most = heads.groupBy("radix").count().agg(F.max("count")).first()[0] or 0
    level = 0
    while most > fan_in:
        lots = -(-most // fan_in)
        dealt = heads.withColumn("lot", F.pmod(F.xxhash64("run"), F.lit(lots)).cast("int"))
        merged = dealt.groupBy("radix", "lot").applyInArrow(merger(_merged), "radix int, totals binary")
        heads = settle(merged.withColumn("run", F.uuid()), f"merged-{level}")
        most = heads.groupBy("radix").count().agg(F.max("count")).first()[0]
        level += 1
    return heads.groupBy("radix").applyInArrow(merger(_with_maxima), "radix int, totals binary")


def _contributions(runs: DataFrame, totals: DataFrame) -> DataFrame:
    """(run, part) for each run and partition: what its records give to each of the run's documents."""

    def contribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for records, known in zip(batch.column("records"), batch.column("totals")):
                keys, counts, maxima = (np.concatenate(x) for x in zip(*_opened(known.as_py())))
                n, mine, owners_of, owners, times = _unpacked(records.as_py())
                place = np.searchsorted(keys, mine)
                count = np.repeat(counts[place], owners_of)
                best = np.repeat(counts[place] == maxima[place], owners_of)
                sums = np.zeros((2, int(n[0])), dtype=np.int64)
                np.add.at(sums[0], owners[best], times[best])
                np.add.at(sums[1], owners, times * count)
                parts.append(_packed(sums[0], sums[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("run"), pa.array(parts, pa.binary())], names=["run", "part"]
            )

    records = runs.filter("radix >= 0")
    # copies of a partition's totals, so that its records need not meet in one task
    size = records.agg(F.sum(F.octet_length("records"))).first()[0] or 0
    copies = max(1, -(-size // NEAR_TOTALS))
    dealt = records.select("run", "radix", "records", F.pmod(F.xxhash64("run"), F.lit(copies)).alias("salt"))
    salts = F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))
    copied = totals.select("radix", "totals", F.explode(salts).alias("salt"))
    return dealt.join(copied, ["radix", "salt"]).select("run", "records", "totals").mapInArrow(
        contribute, "run string, part binary"
    )


def align(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizers: tuple[str, str] | None = None,
    radixes: int = RADIXES,
    run_bytes: int = RUN_BYTES,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    Null and empty texts, and texts that the bytes of either side's tokens do not give back, have
    no tokens: zeros and an empty groups_sha256. Repeated rows stay repeated and each counts; rows
    without a doc_id are counted like any other; an empty table gives none; other columns are not
    looked at. A run belongs to a block of rows, so neither a long text's pairs nor a frequent
    pair's documents ever meet in one place; a merge holds one block of each of ``fan_in`` runs,
    and the totals of a partition, which are bounded by the two vocabularies.
    """
    paths = tokenizers or default_tokenizers()
    kept = docs.select(col(doc_id).alias("doc_id"), col(text).cast("string").alias("text"))
    id_type = kept.schema["doc_id"].dataType.simpleString()
    runs = settle(_spilled(kept, paths, id_type, radixes, run_bytes), "link-runs")
    totals = settle(_totals(runs, fan_in), "link-totals")
    parts = _contributions(runs, totals)
    heads = runs.filter("radix < 0").select("run", F.lit(True).alias("head"), F.col("records").alias("part"))
    names = ["doc_id", *_FIGURES, "n_best", "count_sum", "groups_sha256"]

    def together(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, sums = None, None
        for batch in batches:
            for head, part in zip(batch.column("head").to_pylist(), batch.column("part")):
                if head:
                    found = pa.ipc.open_stream(part.as_py()).read_all().combine_chunks()
                else:
                    some = np.array(_unpacked(part.as_py()))
                    sums = some if sums is None else sums + some
        if sums is None:
            sums = np.zeros((2, found.num_rows), dtype=np.int64)
        both = found.append_column("n_best", pa.array(sums[0])).append_column("count_sum", pa.array(sums[1]))
        yield from both.select(names).to_batches()

    whole = heads.unionByName(parts.select("run", F.lit(False).alias("head"), "part"))
    kinds = ", ".join(f"{n} long" for n in (*_FIGURES, "n_best", "count_sum"))
    return whole.groupBy("run").applyInArrow(together, f"doc_id {id_type}, {kinds}, groups_sha256 string")
