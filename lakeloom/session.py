"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

#: Spark settings every job of the library assumes. Nothing here fixes the degree of
#: parallelism: the number of shuffle partitions comes from the cluster, AQE coalesces it.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app: str = "lakeloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local session (tests) may go without it; it then gets a folder of its own. On a
    cluster a machine-local folder would be lost with its machine, so there it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    own = tempfile.mkdtemp(prefix="lakeloom-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/lakeloom/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage at a table that survives the loss of any executor, and gives Catalyst the
    real size on disk, so it broadcasts the result only when it is below
    ``spark.sql.autoBroadcastJoinThreshold``.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever it lies; nothing happens if it is not there."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is not there."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(hadoop):
        return []
    return [s.getPath().getName() for s in files.listStatus(hadoop) if s.isDirectory()]


def move_folder(spark: SparkSession, path: str, to: str) -> bool:
    """Give a folder its final name; False if something has that name already, which then stays."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(
        hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration()
    )
    parent = hadoop.Path(to).getParent()
    parent.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(parent)
    none = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(hadoop.Path(path), hadoop.Path(to), none)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def remove_scratch(spark: SparkSession) -> None:
    """Delete what this application has settled; for the end of a run, when its results are written."""
    remove_folder(spark, f"{shared_dir(spark)}/lakeloom/{spark.sparkContext.applicationId}")
