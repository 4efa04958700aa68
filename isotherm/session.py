"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
FILES_PER_ARROW_BATCH = 512
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_CACHE_BYTES = "spark.sql.hive.filesourcePartitionFileCacheSize"
NO_LOCALITY = "spark.sql.sources.ignoreDataLocality"


def configure(spark: SparkSession) -> SparkSession:
    """Set the session options that queries on the results count on: times are shown in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return for_parsers(spark)


def for_parsers(spark: SparkSession) -> SparkSession:
    """Set the session options the parsers need; every public job does so itself.

    A repeated JSON key takes its last value. A row here is a whole file, so
    Arrow batches hold few of them: Spark queues as many rows beside its Python
    workers.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    if int(spark.conf.get(ARROW_ROWS)) > FILES_PER_ARROW_BATCH:
        spark.conf.set(ARROW_ROWS, str(FILES_PER_ARROW_BATCH))
    return spark


def for_file_streams(spark: SparkSession, tasks: int) -> SparkSession:
    """Set the session options that streams of many files need; a stream's source asks its session at each batch.

    Spark lists the files of a batch anew, by default with a task for each up to
    10 000, asks the store where the blocks of each file are, and keeps all that in
    the driver, of no use to the next batch. For other queries of the session:
    tables with partitions, which that cache is for, are listed by each of them, and
    tasks are not sent to where a file's blocks are.
    """
    if int(spark.conf.get(LISTING_TASKS)) > tasks:
        spark.conf.set(LISTING_TASKS, str(tasks))
    spark.conf.set(LISTING_CACHE_BYTES, "0")
    spark.conf.set(NO_LOCALITY, "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Where the setting is absent and the session is local, a temporary folder is
    used. A cluster without the setting is an error: a folder on one machine
    would be invisible to the others.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="isotherm-")
    spark.conf.set(CHECKPOINT_DIR, made)
    return made


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/isotherm/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` as checkpoint files in the shared folder, which outlive executors.

    Values that depend on the partitioning (row numbers) are fixed by it.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()

