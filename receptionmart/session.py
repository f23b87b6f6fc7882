"""Session settings and lineage cutting shared by all jobs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from .errors import MissingInputError

# Runtime settings every job relies on; all of them may be set on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Little data can be much work here (names are cut into many pieces), so it stays spread out.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    # Shuffles are cut finely (see ``configure``) and merged up to a size, so a task's rows and memory don't grow with the
    # input. Numbers and names compress to some ten bytes a row, so that size is small.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m",
    # What a scan task reads is held until it has been written for a shuffle.
    "spark.sql.files.maxPartitionBytes": "32m",
    # Whole texts go to Python in batches of so many bytes, however many rows these are.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 * 2**20),
}
# Whether the shuffle files of an execution go when it ends.
SHUFFLES_REMOVED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Partitions a shuffle is cut into: at least so many, and one for so many bytes of stored input.
LEAST_PARTITIONS, INPUT_BYTES = 200, 2 * 2**20


def configure(spark: SparkSession, input_bytes: int = 0) -> SparkSession:
    """The session with the settings jobs rely on, for an input of about that size."""
    cuts = max(LEAST_PARTITIONS, -(-input_bytes // INPUT_BYTES))
    for key, value in (RUNTIME_CONF | {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(cuts)}).items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "receptionmart", cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _named_folder(spark: SparkSession) -> None:
    """Checkpoints go to the folder the cluster names. Only a local master may go without: there a private one is made."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local["):
            raise MissingInputError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="receptionmart-checkpoint-"))


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint.

    Used where one result feeds several branches of a plan. The files go to the folder the cluster
    names in ``spark.checkpoint.dir``.
    """
    _named_folder(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is run within leaves no shuffle files behind."""
    before = spark.conf.get(SHUFFLES_REMOVED, None)
    spark.conf.set(SHUFFLES_REMOVED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_REMOVED)
        else:
            spark.conf.set(SHUFFLES_REMOVED, before)


def stored(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into Parquet files beside the checkpoints and remove what its shuffles wrote.

    For steps that shuffle many times what they return. A plain frame keeps its shuffle files for as long as it may be read
    again, so the files of all steps of a job would lie on disk together. Parquet is smaller than a checkpoint and its size is
    known to the planner.
    """
    spark = df.sparkSession
    _named_folder(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/stored-{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_size(df: DataFrame) -> DataFrame:
    """``df`` for a join that must not broadcast it on the planner's estimate.

    A stored frame keeps the estimate of the plan it came from, which doesn't see how much ``explode`` adds, so a large frame
    can pass for a small one and be collected in the driver.
    """
    return df.hint("merge")
