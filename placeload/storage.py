"""Where intermediate tables go: the folder every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Whether Spark removes the shuffle files of a query as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or set as the checkpoint directory.

    Only a local session without either gets a folder of this machine. On a cluster such a
    folder would not be shared, so there the setting is required.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="placeload-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet, inside the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/placeload/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that run inside go when the query ends, not when the driver collects its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame, name: str = "staged") -> DataFrame:
    """Write ``df`` once into the shared folder and go on from the written files.

    Cuts the lineage, so the result no longer depends on the source: needed before a
    table is overwritten with rows read from it. The files outlive lost executors. What was
    shuffled on the way is not needed any more and leaves the executors' disks at once.
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
