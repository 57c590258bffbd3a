"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession

# Left to Spark's own defaults where those already fit; AQE picks partition counts, splits skewed
# join partitions and turns sort-merge joins into broadcasts once the real sizes are known.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Open a session with the settings above; `master` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """`value` for one setting of the session while the block runs."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def folders_side_by_side(spark: SparkSession) -> AbstractContextManager[None]:
    """While the block runs, a task writes to up to 32 folders at once; only beyond that does it sort its rows by folder."""
    return setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "32")


def small_partitions(spark: SparkSession) -> None:
    """Bounds what AQE joins to one partition, in this session from here on, unless it has a bound of its own.

    Rows of texts that are much alike take ten to a hundred times their size in a shuffle when a
    task holds them by key, so Spark's 64 MB can be gigabytes there.
    """
    if spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None) is None:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`, as named by the cluster.

    A local-mode session that names none gets a fresh temporary folder, which is then set for the
    session. A cluster session that names none is an error, never a machine-local folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="tallymill-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir()


def work_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/tallymill/{name}-{uuid.uuid4().hex}"
