"""Tables whose rows lie in hash buckets of their key and whose versions are entered one by one.

``rows/load=<id>/bucket=<n>`` holds the rows that a load wrote for a bucket, and never changes.
``versions/<number>`` says which load's folder is the current one of each bucket. A merge reads and
writes the buckets that its updates fall into, beside the old ones, and becomes visible by the one
rename that puts its version in place: a reader sees the table before it or after it, whatever
happens to the job in between. Of two merges that start from the same version the later fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from lakeloom.functions.columns import any_of
from lakeloom.operators.joins import anti_join
from lakeloom.operators.merge import _not_stored, latest_per_key
from lakeloom.session import move_folder, remove_folder, settle, subfolders

#: buckets of a new table; a bucket should hold some hundred megabytes, so a large table has thousands
BUCKETS = 64

_BUCKET = "__bucket"


class StaleVersion(RuntimeError):
    """Another load entered its version first; nothing of this one became visible."""


@dataclass(frozen=True)
class Version:
    """What is current: the load that wrote each bucket, and the columns of the table."""

    number: int
    keys: tuple[str, ...]
    buckets: int
    schema: T.StructType
    loads: dict[int, str]

    def folders(self, path: str, wanted: Sequence[int] | None = None) -> list[str]:
        chosen = sorted(self.loads) if wanted is None else [b for b in wanted if b in self.loads]
        return [f"{path}/rows/load={self.loads[b]}/{_BUCKET}={b}" for b in chosen]


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that can be read, oldest first."""
    return sorted(int(name) for name in subfolders(spark, f"{path}/versions") if name.isdigit())


def version_of(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The current version, or the one of that number; None if there is no such table.

    The driver holds one pair for each bucket.
    """
    known = versions(spark, path)
    if not known or (number is not None and number not in known):
        return None
    number = known[-1] if number is None else number
    entries = spark.read.parquet(f"{path}/versions/{number:010d}").collect()
    about = json.loads(next(r["about"] for r in entries if r["about"]))
    return Version(
        number,
        tuple(about["keys"]),
        about["buckets"],
        T.StructType.fromJson(about["schema"]),
        {r["bucket"]: r["load"] for r in entries if r["bucket"] is not None},
    )


def _read(spark: SparkSession, path: str, version: Version, wanted: Sequence[int] | None = None) -> DataFrame:
    folders = version.folders(path, wanted)
    if not folders:
        return spark.createDataFrame([], version.schema)
    return spark.read.schema(version.schema).parquet(*folders)


def read_table(
    spark: SparkSession, path: str, number: int | None = None, only: Sequence[int] | None = None
) -> DataFrame:
    """The rows of the current version (or an older one), unchanged by later merges; of some buckets only, if named."""
    path = path.rstrip("/")
    version = version_of(spark, path, number)
    if version is None:
        raise LookupError(f"no version {'of a table' if number is None else number} under {path}")
    return _read(spark, path, version, only)


def bucket_of(df: DataFrame, keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a row's key; a row without a key is spread by what it holds, nulls left out.

    So the many rows that may lack a key fill no single bucket, and a row falls where it fell
    before if the table has got more columns since.
    """
    each = [F.when(F.col(c).isNotNull(), F.xxhash64(F.lit(c), F.col(c))).otherwise(0) for c in df.columns]
    content = reduce(lambda a, b: a.bitwiseXOR(b), each)
    no_key = any_of([F.col(k).isNull() for k in keys])
    return F.pmod(F.when(no_key, content).otherwise(F.xxhash64(*keys)), F.lit(buckets)).cast("int")


def merge_table(
    updates: DataFrame,
    path: str,
    keys: Sequence[str],
    newest_first: Sequence[Column | str],
    buckets: int = BUCKETS,
    slot: Column | None = None,
) -> Version:
    """Merge ``updates`` into the table at ``path``: the last update of a key wins, other rows stay.

    The same rules as ``upsert_table``: rows without a key are added once, columns that only one
    side has are kept. ``buckets`` counts when the table is made. Only buckets that an update
    falls into are read and written, each row once. The same updates again give the same rows.

    ``slot`` is another way to lay rows out: a whole number that the key decides, such as the month of
    a date (null counts as -1). It must be the same in every call; ``buckets`` is not used then.
    """

    def bucket(df: DataFrame) -> Column:
        return bucket_of(df, keys, count) if slot is None else F.coalesce(slot, F.lit(-1)).cast("int")

    spark, path = updates.sparkSession, path.rstrip("/")
    current = version_of(spark, path)
    if current is not None and tuple(keys) != current.keys:
        raise ValueError(f"the table at {path} is kept by {current.keys}")
    count = buckets if current is None else current.buckets
    latest = latest_per_key(updates, keys, newest_first)
    latest = settle(latest.withColumn(_BUCKET, bucket(latest)), "updates")
    touched = sorted(r[0] for r in latest.select(_BUCKET).distinct().collect())
    latest = latest.drop(_BUCKET)
    if current is None:
        merged = latest
    elif not touched:
        return current
    else:
        stored = _read(spark, path, current, touched)
        kept = anti_join(stored, latest, keys)
        merged = kept.unionByName(_not_stored(latest, stored, keys), allowMissingColumns=True)
    load = uuid.uuid4().hex
    placed = merged.withColumn(_BUCKET, bucket(merged))
    placed.repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(f"{path}/rows/load={load}")
    about = {"keys": list(keys), "buckets": count, "schema": json.loads(_nullable(merged.schema).json())}
    loads = {**({} if current is None else current.loads), **{b: load for b in touched}}
    number = 1 if current is None else current.number + 1
    _enter(spark, path, number, about, loads)
    return Version(number, tuple(keys), count, _nullable(merged.schema), loads)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def _enter(spark: SparkSession, path: str, number: int, about: dict, loads: dict[int, str]) -> None:
    """Write a version beside the others, then give it its number."""
    entries = [(None, None, json.dumps(about)), *((b, load, None) for b, load in sorted(loads.items()))]
    written = f"{path}/versions/_new-{uuid.uuid4().hex}"
    frame = spark.createDataFrame(entries, "bucket int, load string, about string")
    frame.coalesce(1).write.parquet(written)
    if not move_folder(spark, written, f"{path}/versions/{number:010d}"):
        remove_folder(spark, written)
        raise StaleVersion(f"version {number} of {path} was entered by another load")


def remove_old_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove all but the last ``keep`` versions, and the rows that only they, or failed loads, hold.

    Says how many folders of rows went. To be called while no load is under way.
    """
    path = path.rstrip("/")
    known = versions(spark, path)
    for number in known[: -max(1, keep)]:
        remove_folder(spark, f"{path}/versions/{number:010d}")
    for name in subfolders(spark, f"{path}/versions"):
        if name.startswith("_new-"):
            remove_folder(spark, f"{path}/versions/{name}")
    used = {
        (load, bucket)
        for number in known[-max(1, keep) :]
        for bucket, load in version_of(spark, path, number).loads.items()
    }
    gone = 0
    for load in subfolders(spark, f"{path}/rows"):
        folders = [b for b in subfolders(spark, f"{path}/rows/{load}") if b.startswith(f"{_BUCKET}=")]
        unused = [b for b in folders if (load.partition("=")[2], int(b.partition("=")[2])) not in used]
        if len(unused) == len(folders):
            remove_folder(spark, f"{path}/rows/{load}")
        else:
            for bucket in unused:
                remove_folder(spark, f"{path}/rows/{load}/{bucket}")
        gone += len(unused)
    return gone
