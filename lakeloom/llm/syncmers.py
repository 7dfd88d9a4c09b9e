"""Document fingerprints from closed syncmers.

A k-mer of a text's UTF-8 bytes is an anchor if the smallest of its inner s-mers (by a mixed
value) stands at one of its ends. Whether a k-mer is chosen depends on nothing outside it, so the
anchors of a text put together from two others are their anchors plus those across the seam. All
anchors are kept, with their positions: the likeness of two texts is the Jaccard similarity of their
distinct anchor hashes, and a passage that both have is found as the longest run of anchors of the same
hashes and distances. The fingerprint is the distinct hashes in order, eight hexadecimal digits each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.shared import col

#: inner substring; read as one 64-bit number
INNER = 8
#: inner substrings in a k-mer, so k is 23 and one k-mer in eight is chosen
WINDOW = 16
K = INNER + WINDOW - 1

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _numbers(data: bytes) -> np.ndarray:
    """The number that each run of eight bytes is."""
    n = len(data) - INNER + 1
    out = np.empty(n, dtype=np.uint64)
    for shift in range(min(INNER, n)):
        part = np.frombuffer(data, "<u8", (len(data) - shift) // INNER, shift)
        out[shift::INNER] = part[: len(out[shift::INNER])]
    return out


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in bytes) and 32-bit hashes of the closed syncmers, in order."""
    if len(data) < K:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint32)
    numbers = _numbers(data)
    order = numbers ^ (numbers >> np.uint64(29))
    order *= _A
    order >>= np.uint64(32)
    order = order.astype(np.uint32)
    least = order
    reach = 1
    while reach < WINDOW:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    at = np.flatnonzero((least == order[: len(least)]) | (least == order[WINDOW - 1 :]))
    mixed = numbers[at] * _A ^ numbers[at + INNER] * _B ^ numbers[at + WINDOW - 1] * _C
    mixed ^= mixed >> np.uint64(31)
    mixed *= _B
    return at, (mixed >> np.uint64(32)).astype(np.uint32)


def distinct(hashes: np.ndarray, data: bytes) -> np.ndarray:
    """The distinct hashes, in order; a text without an anchor is its own, an empty one has none."""
    if not len(hashes):
        if not data:
            return hashes
        return np.frombuffer(hashlib.sha256(data).digest()[:4], "<u4")
    return np.unique(hashes)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1, of distinct hashes; two empty sets are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def _stretches(at: np.ndarray, hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each stretch of ``length`` anchors: their hashes and the distances between them."""
    n = len(hashes) - length + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    if n <= 0:
        return out
    # doubling: a stretch is hashed from two that overlap
    out, size = hashes.astype(np.uint64) * _A, 1
    while size < length:
        step = min(size, length - size)
        gaps = (at[step : step + len(out) - step] - at[: len(out) - step]).astype(np.uint64)
        out = (out[:-step] * _B) ^ (out[step:] * _C + gaps * _A)
        out ^= out >> np.uint64(29)
        size += step
    return out


def passage(own: Marked, other: Marked) -> tuple[int, int, int]:
    """(position in own, position in other, bytes) of the longest run of anchors that both texts have
    at the same distances; of ties the first in own. No bytes if they have no anchor in common."""

    def met(length: int) -> tuple[int, int] | None:
        a, b = _stretches(own.at, own.hashes, length), _stretches(other.at, other.hashes, length)
        where = np.flatnonzero(np.isin(a, b))
        return (int(where[0]), int(np.flatnonzero(b == a[where[0]])[0])) if len(where) else None

    low, high, found = 0, min(len(own.hashes), len(other.hashes)), None
    while low < high:  # a run has all shorter ones in it
        middle = (low + high + 1) // 2
        pair = met(middle)
        if pair is None:
            high = middle - 1
        else:
            low, found = middle, pair
    if found is None:
        return 0, 0, 0
    i, j = found
    return int(own.at[i]), int(other.at[j]), int(own.at[i + low - 1] - own.at[i]) + K


class Marked:
    """A text with its anchors and their distinct hashes."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.data = self.text.encode("utf-8", "surrogatepass")
        self.at, self.hashes = anchors(self.data)
        self.print = distinct(self.hashes, self.data)


def edited(own: Marked, following: Marked) -> tuple[bytes, np.ndarray]:
    """The edited text (the latter half replaced from the next text) and its distinct hashes.

    Anchors that lie in either half are taken over; only the seam is looked at again.
    """
    n = len(own.text)
    a = own.text[: n - n // 2].encode("utf-8", "surrogatepass")
    b = following.text[: n // 2].encode("utf-8", "surrogatepass")
    seam = anchors(a[-(K - 1) :] + b[: K - 1])[1] if a and b else own.hashes[:0]
    hashes = np.concatenate([own.hashes[own.at <= len(a) - K], following.hashes[following.at <= len(b) - K], seam])
    return a + b, distinct(hashes, a + b)


def _shown(hashes: np.ndarray) -> str:
    return hashes.astype(">u4").tobytes().hex()


def _row(own: Marked, following: Marked) -> tuple:
    data, changed = edited(own, following)
    near = likeness(own.print, following.print)
    return (
        len(own.text),
        hashlib.sha256(data).hexdigest(),
        _shown(own.print),
        _shown(changed),
        likeness(own.print, changed),
        near,
        *(passage(own, following) if near else (0, 0, 0)),  # no anchor in common, no passage
        own.at.astype(np.int32),
        own.hashes.astype(np.int64),
    )


_RESULT = [
    ("n_chars", "long"),
    ("edited_sha256", "string"),
    ("fingerprint", "string"),
    ("edited_fingerprint", "string"),
    ("near_edited", "double"),
    ("near_next", "double"),
    ("passage_at", "long"),
    ("passage_next_at", "long"),
    ("passage_bytes", "long"),
    ("anchor_at", "array<int>"),
    ("anchor_hash", "array<long>"),
]
_KINDS = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(),
          "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}


def _buckets(kept: DataFrame, number: int) -> DataFrame:
    """``kept`` with ``bucket``: ranges of about as many rows, in descending order of doc_id.

    Rows without a doc_id are last and fall into ranges of their mark.
    """
    steps = [F.lit(i / number) for i in range(1, number)]
    ids = F.col("doc_id").cast("long")
    found = kept.agg(F.percentile_approx(ids, F.array(*steps), 10_000)).first()[0] if steps else None
    bounds = F.array(*[F.lit(b).cast("long") for b in sorted(set(found or []))]).cast("array<long>")
    nameless = F.lit(number) + F.floor((F.lit(0.5) - F.col("mark") / F.lit(2.0**64)) * number)
    named = F.size(F.filter(bounds, lambda b: b > ids))
    return kept.withColumn("bucket", F.when(F.col("doc_id").isNull(), nameless).otherwise(named).cast("long"))


def fingerprint_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text's anchors, fingerprint, likeness to an edited form and to the next document, and the
    longest passage (positions in bytes) that it shares with the next.

    The next document is the one before in ascending doc_id; the last takes the first. Null texts
    are empty. Rows without a doc_id come last; rows that repeat one stand in the order of a hash of
    their texts. A lone row is its own next. An empty table gives none.

    Texts are shuffled once, by range. A range's first row goes along to the range before as
    well, so that the last row there finds its next. Which rows these are (one for each range,
    without their texts) is all that reaches the driver.
    """
    spark = docs.sparkSession
    kept = docs.select(col(doc_id).alias("doc_id"), col(text).cast("string").alias("text"))
    kind = kept.schema["doc_id"].dataType.simpleString()
    number = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _buckets(kept.withColumn("mark", F.xxhash64("text")), number)
    place = F.struct(F.col("doc_id").isNotNull(), "doc_id", "mark")
    firsts = rows.groupBy("bucket").agg(F.max(place).alias("first")).select("bucket", "first.doc_id", "first.mark")
    listed = sorted((tuple(r) for r in firsts.collect()), key=lambda r: r[0])
    before = [listed[i - 1][0] for i in range(len(listed))]  # the first range's row goes to the last
    guests = spark.createDataFrame(
        [(d, m, b) for (_, d, m), b in zip(listed, before)],
        T.StructType(
            [T.StructField("g_doc", kept.schema["doc_id"].dataType), T.StructField("g_mark", T.LongType()),
             T.StructField("g_bucket", T.LongType())]
        ),
    )
    own = F.struct(F.col("bucket"), F.lit(False).alias("guest"))
    also = F.struct(F.col("g_bucket").alias("bucket"), F.lit(True).alias("guest"))
    placed = (
        rows.join(F.broadcast(guests), F.col("doc_id").eqNullSafe(F.col("g_doc")) & (F.col("mark") == F.col("g_mark")), "left")
        .withColumn("at", F.explode(F.when(F.col("g_bucket").isNull(), F.array(own)).otherwise(F.array(own, also))))
        .select("at.bucket", "at.guest", "doc_id", "mark", "text")
    )
    ordered = (
        placed.repartitionByRange(number, "bucket")
        .sortWithinPartitions("bucket", "guest", F.col("doc_id").desc_nulls_last(), F.col("mark").desc())
        .select("bucket", "guest", "doc_id", "text")
    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple | None = None  # (bucket, doc_id, marked text) of the row that waits for its next

        for batch in batches:
            rows = []
            for bucket, guest, doc, body in zip(*(c.to_pylist() for c in batch.columns[:3]), batch.column(3)):
                if guest and (before is None or before[0] != bucket):
                    continue  # a repeat of the guest that was met
                mark = Marked(body.as_py())
                if before is not None and before[0] == bucket:
                    rows.append((before[1], *_row(before[2], mark)))
                before = None if guest else (bucket, doc, mark)
            for at in range(0, len(rows), 500):
                kinds = [batch.schema.field(2).type, *(_KINDS[k] for _, k in _RESULT)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows[at : at + 500]), kinds)],
                    names=["doc_id", *(n for n, _ in _RESULT)],
                )

    return ordered.mapInArrow(compared, ", ".join(f"{n} {k}" for n, k in [("doc_id", kind), *_RESULT]))
