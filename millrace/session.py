"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Settings that hold on a laptop and on a cluster.  The number of shuffle
# partitions is left to the caller: AQE merges small ones, so a cluster sets it high.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.ui.enabled": "false",
}


def build_session(app: str = "millrace", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per session, for the Python functions among the operators."""
    context = spark.sparkContext
    if getattr(context, "_millrace_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="millrace-code-")) / "millrace.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, str(file.relative_to(root.parent)))
    context.addPyFile(str(archive))
    context._millrace_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    A local session without that setting gets a temporary folder; a cluster
    session without it is an error, since executors cannot share a local path.
    """
    context = spark.sparkContext
    path = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = context.getCheckpointDir()
    if not path:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        path = tempfile.mkdtemp(prefix="millrace-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder so that later steps read one fixed copy.

    Needed where a column depends on the physical partition (a slice number):
    recomputing it after an executor loss could otherwise give other values.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for some steps; afterwards it is as it was."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shuffles_removed(spark: SparkSession):
    """Spark deletes the shuffle files of every query made and run inside as soon as it ends, whatever the driver's memory still holds.

    For steps whose result is written (``durable``): a frame made inside that is run once more would have to shuffle again.
    """
    return setting(spark, SHUFFLE_CLEANUP, "true")


def release(spark: SparkSession) -> None:
    """Let Spark delete the files of plans that are over; it does so when the driver's JVM finds them unused, so it is not certain when."""
    gc.collect()  # the Python side holds plans too
    spark._jvm.java.lang.System.gc()


def _located(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, location = _located(spark, path)
    return fs.exists(location)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, location = _located(spark, path)
    return fs.exists(location) and fs.getFileStatus(location).isDirectory()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, written by the driver to any store that Spark reaches."""
    fs, location = _located(spark, path)
    out = fs.create(location, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def delete_path(spark: SparkSession, path: str) -> None:
    fs, location = _located(spark, path)
    fs.delete(location, True)
