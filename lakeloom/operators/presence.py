"""Incremental append with a presence index: only the batches that may hold a key are looked into.

A table is a folder of batches. ``rows/batch=<id>`` holds a batch's rows, ``presence/batch=<id>``
its index, and ``done/batch=<id>`` is written last and makes it count. An index is a set of bitmaps:
a key's hash names a bitmap and ``BITS`` bits of it. A new batch's keys are looked up in the
indexes of all batches; a key whose bits are all set may be there, and those batches, and no others,
are read to find out. So the answer is exact, and what a run reads is the indexes (some bytes a
key) and the few batches that hold, or seem to hold, one of the new keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.columns import any_of, content_hash
from lakeloom.operators.joins import anti_join
from lakeloom.operators.merge import latest_per_key, replace_table
from lakeloom.session import settle, subfolders

#: bits that a key sets in its bitmap
BITS = 3
#: bits of a bitmap, as Spark's bitmap functions have it
_BITMAP = 32768
#: keys in a bitmap, on average; 32 bits a key and three bits set let one key in about 1400 pass wrongly
KEYS_PER_BITMAP = 1024


def _places(keys: Sequence[str], bitmaps: Column) -> list[Column]:
    """Bitmap of a key, and its bits there."""
    which, where = F.xxhash64(F.lit(1), *keys), F.xxhash64(F.lit(2), *keys)
    bits = [F.shiftrightunsigned(where, 15 * i).bitwiseAND(F.lit(_BITMAP - 1)) for i in range(BITS)]
    return [F.pmod(which, bitmaps).alias("bitmap"), *[b.alias(f"bit_{i}") for i, b in enumerate(bits)]]


def presence_of(rows: DataFrame, keys: Sequence[str], keys_per_bitmap: int = KEYS_PER_BITMAP) -> DataFrame:
    """(bitmaps, bitmap, present): the index of a batch; rows without a key are in none.

    The number of bitmaps goes with the number of keys, so an index is about four bytes a key
    whatever the size of the batch.
    """
    named = rows.select(*keys).dropna()
    count = named.count()
    bitmaps = 1 << max(0, (-(-count // keys_per_bitmap) - 1).bit_length())
    at = named.select(*_places(keys, F.lit(bitmaps)))
    set_bits = at.select(
        "bitmap", F.explode(F.array(*[F.col(f"bit_{i}") for i in range(BITS)])).alias("bit")
    )
    # bits are counted from 0 inside a bitmap, as bitmap_bit_position counts them
    return set_bits.groupBy("bitmap").agg(F.bitmap_construct_agg("bit").alias("present")).select(
        F.lit(bitmaps).cast("long").alias("bitmaps"), F.col("bitmap").cast("long").alias("bitmap"), "present"
    )


def _is_set(present: str, bit: str) -> Column:
    byte = F.conv(F.hex(F.substring(present, F.floor(F.col(bit) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(F.col(bit), F.lit(8)).cast("int")) == 1


def may_hold(index: DataFrame, keys_of: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(batch, *keys): keys whose bits are all set in the index of the batch."""
    sizes = sorted(r[0] for r in index.select("bitmaps").distinct().collect())  # powers of two, so they are few
    asked = keys_of.select(*keys).dropna().distinct()
    each = F.explode(F.array(*[F.lit(n).cast("long") for n in sizes])).alias("bitmaps")
    placed = asked.select(*keys, each).select(*keys, "bitmaps", *_places(keys, F.col("bitmaps")))
    met = placed.join(index, ["bitmaps", "bitmap"])
    for i in range(BITS):
        met = met.where(_is_set("present", f"bit_{i}"))
    return met.select("batch", *keys)


def batches(spark: SparkSession, path: str) -> list[str]:
    """Ids of the batches that count."""
    return sorted(n.partition("=")[2] for n in subfolders(spark, f"{path}/done") if n.startswith("batch="))


def _parts(path: str, part: str, ids: Sequence[str]) -> list[str]:
    return [f"{path}/{part}/batch={b}" for b in ids]


def read_batches(spark: SparkSession, path: str, ids: Sequence[str] | None = None) -> DataFrame | None:
    """Rows of the batches that count (or of those named), with the batch's id; None if there are none."""
    ids = batches(spark, path) if ids is None else ids
    if not ids:
        return None
    # ids are text even where they look like numbers
    found = spark.read.option("mergeSchema", True).parquet(*_parts(path, "rows", ids))
    return found.withColumn("batch", F.regexp_extract("_metadata.file_path", "/batch=([^/]+)/", 1))


def stored_among(spark: SparkSession, path: str, ids: Sequence[str], asked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Those of the asked keys that one of the batches holds. Reads indexes, and the batches they name."""
    index = spark.read.parquet(*_parts(path, "presence", ids))
    index = index.withColumn("batch", F.regexp_extract("_metadata.file_path", "/batch=([^/]+)/", 1))
    candidates = settle(may_hold(index, asked, keys), "candidates")
    named = [r[0] for r in candidates.select("batch").distinct().collect()]  # at most the batches there are
    if not named:
        return candidates.select(*keys)
    rows = read_batches(spark, path, sorted(named))
    return rows.select(*keys, "batch").join(candidates, [*keys, "batch"], "left_semi").select(*keys).distinct()


def append_indexed(
    rows: DataFrame,
    path: str,
    batch: str,
    keys: Sequence[str],
    newest_first: Sequence[Column | str] | None = None,
    keys_per_bitmap: int = KEYS_PER_BITMAP,
) -> DataFrame:
    """Append the rows whose key no other batch holds, as the batch of that id; returns what was added.

    Rows without a key always pass, unless another batch holds the same row. With
    ``newest_first`` one row of each key is kept, else repeats inside the batch stay. A batch that
    is loaded again under its id is compared with the others and written anew, so a job that died
    half-way is simply run again; until ``done`` is written its rows are not read.
    """
    if not batch or any(c in batch for c in "/=%"):
        raise ValueError("a batch id is a plain name")
    spark, path = rows.sparkSession, path.rstrip("/")
    others = [b for b in batches(spark, path) if b != batch]
    no_key = any_of([F.col(k).isNull() for k in keys])
    named, unnamed = rows.where(~no_key), rows.where(no_key)
    if newest_first is not None:
        named = latest_per_key(named, keys, newest_first)
    named = settle(named, "batch")
    if others:
        named = anti_join(named, stored_among(spark, path, others, named, keys), keys)
    if others and not unnamed.isEmpty():
        unnamed = _not_held(unnamed, read_batches(spark, path, others).drop("batch"), no_key)
    replace_table(named.unionByName(unnamed), f"{path}/rows/batch={batch}")
    added = spark.read.schema(rows.schema).parquet(f"{path}/rows/batch={batch}")
    replace_table(presence_of(added, keys, keys_per_bitmap), f"{path}/presence/batch={batch}")
    replace_table(spark.range(1).select(F.current_timestamp().alias("at")), f"{path}/done/batch={batch}")
    return added


def _not_held(rows: DataFrame, stored: DataFrame, no_key: Column) -> DataFrame:
    """``rows`` less those that are stored, column for column; null keys are left to the file statistics."""
    same = [c for c in rows.columns if c in stored.columns]
    seen = stored.where(no_key).select(*[F.col(c).cast(rows.schema[c].dataType) for c in same])
    marks = seen.select(content_hash(seen).alias("__mark")).distinct()
    marked = rows.withColumn("__mark", content_hash(rows.select(*same)))
    return marked.join(marks, "__mark", "left_anti").drop("__mark")
