"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job here relies on.  Time zone: all clock
# arithmetic is in UTC.  Adaptive execution lets Spark resize, split and
# re-plan shuffles from measured sizes.  Rows that go to Python may hold whole
# texts, so a batch of them is kept small.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}

# Whether a query's shuffle files go when it ends, not when the driver's garbage is collected.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_scratch: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_session(app: str = "flightlake", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session; on a cluster the master and memory come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Run a block under other runtime settings; a stream keeps those that it was started with."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``.

    A cluster must name that folder, because executors on other machines (or
    replacements of lost ones) read what is written there.  Only a local master
    may fall back to a temporary folder.  All paths of an application share one
    folder, which can be removed when the application has ended.
    """
    global _local_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if _local_scratch is None:
            _local_scratch = tempfile.mkdtemp(prefix="flightlake-")
        base = _local_scratch
    application = spark.sparkContext.applicationId
    return f"{base.rstrip('/')}/flightlake/{application}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as a shared table and go on from the written rows.

    Later readers then know the exact size (so Spark can decide on a broadcast
    by itself) and a lost executor re-reads files instead of recomputing.  The
    shuffle files of the write are deleted when it ends.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    # Only for the write: a frame that is executed again may still need its shuffles.
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_unused_shuffles(spark: SparkSession, wait: float = 0.0) -> None:
    """Let Spark delete the shuffle files of jobs whose results nobody holds any more.

    Its cleaner learns of them when the driver's garbage is collected, which a
    driver that has little to do may put off for half an hour.  With ``wait``, what
    Python has just dropped counts too, which it tells the driver's JVM a little later.
    """
    if wait:
        gc.collect()
        time.sleep(wait)
    spark._jvm.System.gc()


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder on whatever file system holds it; whether it was there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; empty if there is no such folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in system.listStatus(folder)] if system.exists(folder) else []
