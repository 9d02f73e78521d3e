"""Session helper and the one place that decides where intermediate tables are written."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from lendlens.sources.tables import delete


def local_session(cores: str = "8", app: str = "lendlens", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and for the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # small test tables still spread over the cores
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "20g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def work_dir(spark: SparkSession) -> str:
    """Shared folder of this application for intermediate tables and model checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back to a
    temporary folder: on a cluster, executors would not see it.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not base and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(base or tempfile.mkdtemp(prefix="lendlens-"))
    return f"{base or context.getCheckpointDir()}/{context.applicationId}"


#: Of intermediate tables and prepared sets: repeated numbers take less than under Spark's default.
CODEC = "zstd"
#: Folders that end with the innermost ``scratch`` of this thread.
_OPEN: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def materialize(df: DataFrame, name: str = "table", **options) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back; ``options`` are the writer's.

    Cuts the lineage like a checkpoint does, survives the loss of executors, and later readers
    still get column pruning and filter pushdown.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if (own := _OPEN.get()) is not None:
        own.append(path)
    # the files of a query's shuffles go when it ends, not when the driver's heap is next swept
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    df.write.options(**{"compression": CODEC} | options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that this thread materializes inside are deleted at the end: nothing may read them later."""
    token = _OPEN.set([])
    try:
        yield
    finally:
        for path in _OPEN.get():
            delete(spark, path)
        _OPEN.reset(token)


def discard(df: DataFrame) -> None:
    """Deletes the folder of a materialized table that nothing reads any more."""
    if files := df.inputFiles():
        delete(df.sparkSession, files[0].rsplit("/", 1)[0])
