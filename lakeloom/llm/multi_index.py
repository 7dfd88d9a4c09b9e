"""Near copies by SimHash: fingerprints, links by multi-index hashing, components.

Fingerprints are of word shingles. A fingerprint is cut into segments; two fingerprints within
``distance`` bits agree within ``distance // segments`` bits in one of them, so each looks up a
small Hamming ball of every segment in that segment's table, and the whole distance is verified.
A table entry that many fingerprints share would make candidates grow with its square. Everything
that owns or meets such an entry is linked instead through the small ball of the whole
fingerprint (the same method with one segment, met half-way): two fingerprints within 2 bits have
a point of their radius-1 balls in common, and one point is never shared by more than 65
fingerprints. Both ways are exact, so no link is lost and no row depends on the threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.components import components
from lakeloom.llm.shared import col, settle

#: one table entry that more fingerprints share is served by whole balls
CROWDED = 32


def shingle_hashes(text: str | None, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each run of ``words`` words; a shorter text is one run, one without words has none."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(parts)
    n = len(parts) - words + 1
    digest = xxhash.xxh64_intdigest
    if n <= 1:
        return np.array([digest(joined, seed)], dtype=np.uint64)
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1
    ends = np.cumsum(sizes)
    starts = ends - sizes
    pairs = zip(starts[:n].tolist(), (ends[words - 1 :] - 1).tolist())
    return np.fromiter((digest(joined[a:b], seed) for a, b in pairs), dtype=np.uint64, count=n)


def simhash(text: str | None, words: int = 3, seed: int = 42) -> int:
    """Bits that more than half of the shingles' XXH64 have set; zero without words."""
    hashes = shingle_hashes(text, words, seed)
    n = len(hashes)
    if n <= 1:
        return int(hashes[0]) if n else 0
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 14):  # a long text must not unpack all its bits at once
        some = hashes[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, kept: Sequence[Column] = ()
) -> DataFrame:
    """(doc_id, bits), and more columns to be kept: bits is the fingerprint as a signed long."""

    @F.pandas_udf("long")
    def hashed(texts):
        import pandas as pd

        bits = np.fromiter((simhash(t, words) for t in texts), dtype=np.uint64, count=len(texts))
        return pd.Series(bits.view(np.int64))

    return docs.select(col(doc_id).alias("doc_id"), hashed(col(text).cast("string")).alias("bits"), *kept)


def _segments(segments: int) -> list[tuple[int, int]]:
    """(first bit, number of bits) of each segment."""
    cuts = [64 * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _mask(width: int) -> int:
    return (1 << width) - 1 if width < 64 else -1


def _bit(at: int) -> int:
    return 1 << at if at < 63 else -(1 << 63)


def _ball(width: int, radius: int, first: int = 0) -> list[int]:
    """All patterns of up to ``radius`` set bits among ``width``, as signed longs."""
    found = [0]
    grown = [(0, 0)]
    for _ in range(radius):
        grown = [(value | _bit(first + at), at + 1) for value, begin in grown for at in range(begin, width)]
        found += [value for value, _ in grown]
    return found


def links(bits: DataFrame, distance: int = 2, segments: int = 2, crowded: int = CROWDED) -> DataFrame:
    """Links (u, v), u > v, between distinct fingerprints; their closure joins exactly those
    fingerprints that chains of pairs within ``distance`` bits join.

    ``bits`` has one row per distinct fingerprint, in a column ``bits``.
    """
    if distance != 2:
        raise ValueError("crowded entries are met half-way, which is worked out for 2 bits")
    radius = distance // segments

    def part(first: int, width: int):
        return F.shiftrightunsigned("bits", first).bitwiseAND(F.lit(_mask(width)))

    parts = _segments(segments)
    table = bits.select(
        "bits",
        F.explode(F.array(*[F.struct(F.lit(i).alias("segment"), part(*p).alias("entry")) for i, p in enumerate(parts)])),
    ).select("bits", "col.segment", "col.entry")
    shared = settle(table.groupBy("segment", "entry").agg(F.count("*").alias("owners")).filter("owners > 1"), "entries")
    def looked_up(i: int, first: int, width: int):
        ball = F.array(*[F.lit(x).cast("long") for x in _ball(width, radius)])
        return F.transform(
            ball, lambda x: F.struct(F.lit(i).alias("segment"), part(first, width).bitwiseXOR(x).alias("entry"))
        )

    probes = bits.select(
        "bits", F.explode(F.concat(*[looked_up(i, *p) for i, p in enumerate(parts)]))
    ).select("bits", "col.segment", "col.entry")
    busy = shared.filter(F.col("owners") > crowded).select("segment", "entry")
    near_busy = settle(probes.join(busy, ["segment", "entry"], "left_semi").select("bits").distinct(), "crowded")
    quiet = table.join(busy, ["segment", "entry"], "left_anti").withColumnRenamed("bits", "other")
    met = (
        probes.join(quiet, ["segment", "entry"])
        .filter(F.col("bits") > F.col("other"))
        .filter(F.bit_count(F.col("bits").bitwiseXOR(F.col("other"))) <= distance)
        .select(F.col("bits").alias("u"), F.col("other").alias("v"))
    )
    points = near_busy.select(
        "bits",
        F.explode(
            F.transform(
                F.array(*[F.lit(x).cast("long") for x in _ball(64, 1)]),
                lambda x: F.col("bits").bitwiseXOR(x),
            )
        ).alias("point"),
    )
    least = points.groupBy("point").agg(F.min("bits").alias("v"), F.max("bits").alias("most"))
    halfway = points.join(least.filter("v != most"), "point").filter("bits != v")
    halfway = halfway.select(F.col("bits").alias("u"), "v")
    return met.union(halfway).distinct()


def _labels(marked: DataFrame, distance: int) -> DataFrame:
    """(bits, root, first): the component of each fingerprint, and its smallest doc_id."""
    firsts = settle(marked.groupBy("bits").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = settle(components(links(firsts.select("bits"), distance)), "components")
    named = firsts.join(roots, firsts["bits"] == roots["node"], "left").select(
        firsts["bits"], "first", F.coalesce("root", firsts["bits"]).alias("root")
    )
    ids = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return named.drop("first").join(ids, "root").select("bits", "root", "component_id")


def near_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, distance: int = 2
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    component_id is the smallest doc_id whose fingerprint a chain of links reaches, the row's own
    included. Null texts and texts without words have fingerprint zero and link like any other.
    Rows without a doc_id keep their fingerprint and are linked; they name no component (null if
    all rows of a component lack one). Repeated rows stay repeated; an empty table gives none.
    """
    marked = settle(fingerprints(docs, doc_id, text, words), "fingerprints")
    return marked.join(_labels(marked, distance), "bits", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, distance: int = 2
) -> DataFrame:
    """The rows of ``docs`` with one of each component: that of the smallest doc_id.

    Rows without a doc_id stay only where a component has no other; of rows that repeat an id the
    one whose text has the smallest hash stays, of rows that repeat both any one.
    """
    mark = F.xxhash64(F.coalesce(col(text).cast("string"), F.lit("")))
    marked = settle(
        fingerprints(docs, doc_id, text, words, kept=[mark.alias("mark")]), "fingerprints"
    )
    return chosen(docs, marked.join(_labels(marked, distance), "bits"), doc_id, text)


def chosen(docs: DataFrame, labelled: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows of ``docs`` that ``one_of_each`` keeps; ``labelled`` has doc_id, mark and root of every row."""
    mark = F.xxhash64(F.coalesce(col(text).cast("string"), F.lit("")))
    best = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "mark")
    chosen = labelled.groupBy("root").agg(F.min(best).alias("best")).select(
        F.coalesce("best.doc_id", F.lit(0)).alias("chosen_id"), "best.nameless", "best.mark"
    )
    rows = docs.select(
        F.struct(*[col(c) for c in docs.columns]).alias("document"),
        F.coalesce(col(doc_id), F.lit(0)).alias("chosen_id"),
        col(doc_id).isNull().alias("nameless"),
        mark.alias("mark"),
    )
    # repeats leave before the shuffle, and the join finds the rows where this put them
    first = Window.partitionBy("chosen_id", "nameless", "mark").orderBy("mark")
    rows = rows.withColumn("place", F.row_number().over(first)).filter("place = 1")
    return rows.join(chosen, ["chosen_id", "nameless", "mark"], "left_semi").select("document.*")
