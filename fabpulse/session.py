"""Session settings, and the shared folder in which lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

# UTC everywhere: shifts and event dates are read off the wall clock of the session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

# Settled intermediate results are compressed, and removed once nothing refers to them.
# These can be set only when the application starts.
START_SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.checkpoint.compress": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# For clusters: enough shuffle partitions for tens of TB, of which adaptive execution
# merges the small ones, and files and tasks of a size worth scheduling.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16384",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(app: str = "fabpulse", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the package's settings; `master` is for local runs only.

    `extra` overrides any of them.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sizing = {} if master else CLUSTER_SETTINGS
    for key, value in {**START_SETTINGS, **SETTINGS, **sizing, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def own_session(spark: SparkSession) -> SparkSession:
    """A session with the package's runtime settings on top of those of `spark`, left as it is."""
    session = spark.newSession()
    for key, value in {**spark.conf.getAll, **SETTINGS}.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    return session


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="fabpulse-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_folder(spark: SparkSession, kind: str) -> str:
    """A fresh folder in the shared one, removed when the application ends."""
    folder = f"{shared_folder(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    path, files = file_system(spark, folder)
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def file_system(spark: SparkSession, uri: str) -> tuple[JavaObject, JavaObject]:
    """A path and the file system it is on, as the cluster's file systems name them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def settle(df: DataFrame) -> DataFrame:
    """Materialise `df` reliably, so it can replace files it was computed from."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


@contextmanager
def observing(spark: SparkSession) -> Iterator[None]:
    """For jobs with observed metrics: keep the plan of stages that turn out empty.

    Adaptive execution would replace an empty stage, and the metrics taken in it with it.
    """
    key = "spark.sql.adaptive.optimizer.excludedRules"
    before = spark.conf.get(key, None)
    empty_stages = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"
    spark.conf.set(key, ",".join(filter(None, (before, empty_stages))))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
