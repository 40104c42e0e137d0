"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on; a session made elsewhere may set its own.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "vinculo", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; keyword names use ``__`` for a dot."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only a local session may go without the setting; it gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="vinculo-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody uses yet, inside the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session that holds inside only."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shuffles_dropped(spark: SparkSession) -> AbstractContextManager[None]:
    """Writes inside leave no shuffle files: those of a query go as soon as its result is written.

    Otherwise they stay on the executors' disks until the driver happens to collect garbage.
    """
    return setting(spark, SHUFFLE_CLEANUP, "true")


def staged(frame: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``frame`` to the shared folder and read it back: short lineage that survives lost executors."""
    path = scratch_path(frame.sparkSession, label)
    with shuffles_dropped(frame.sparkSession):
        frame.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def spread(frame: DataFrame, scan: DataFrame, *columns: str) -> DataFrame:
    """``frame`` over as many partitions as the session has cores, if ``scan`` comes in fewer splits.

    For costly per-row work on rows of a file with too few splits; with enough splits, the rule at scale,
    ``frame`` is returned as it is. ``scan`` is the plain file scan: counting its splits runs nothing.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return frame if scan.rdd.getNumPartitions() >= cores else frame.repartition(cores, *columns)
