"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_RECORDERS: list[list[str]] = []


def build_session(app_name: str = "careweave", **settings: str) -> SparkSession:
    """A session with adaptive execution and skew splitting on; other settings are the caller's."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # A table bucketed by slice serves joins by (slice, part) where it lies.
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
        .config("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Recording a Python stack for every column expression costs more than building it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors: ``spark.checkpoint.dir``; a new local one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="careweave-"))
    return context.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Compute once into a table in the shared folder, and read that from here on.

    Lineage ends at the files, which outlive any executor; later reads prune columns and know
    their size, so the planner can choose joins by it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    for paths in _RECORDERS:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def recorded_tables() -> Iterator[list[str]]:
    """The paths of the tables that ``materialize`` writes meanwhile, for ``discard`` later on."""
    paths: list[str] = []
    _RECORDERS.append(paths)
    try:
        yield paths
    finally:
        _RECORDERS.remove(paths)


def discard(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete tables that ``materialize`` wrote; no frame that is still read may depend on them."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that begin meanwhile delete their shuffle files when they end, not when the driver
    happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def task_slots(spark: SparkSession) -> int:
    """How many tasks to spread CPU-heavy work over."""
    return max(
        spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    )


def spread(table: DataFrame) -> DataFrame:
    """A stored table with fewer splits than task slots, dealt out to all slots.

    Large tables have more splits than slots and stay as they are. Only for tables read from
    files: asking a frame with shuffles for its partitions would run it.
    """
    slots = task_slots(table.sparkSession)
    return table if table.rdd.getNumPartitions() >= slots else table.repartition(slots)
