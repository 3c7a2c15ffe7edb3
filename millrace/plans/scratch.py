"""Shared storage for intermediate results, in the folder that the session names for checkpoints."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the context, else the one in ``spark.checkpoint.dir``.

    There is no fallback to a local temporary folder: executors on other machines could not read it.
    """
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise RuntimeError(
            "no checkpoint folder: set spark.checkpoint.dir (or call sparkContext.setCheckpointDir) "
            "to a folder that the driver and every executor can reach"
        )
    return folder


def new_dir(spark: SparkSession, label: str) -> str:
    """Path of a folder below the shared one that does not exist yet."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that no later read needs, on whatever file system it is."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def stored(rows: DataFrame, label: str) -> DataFrame:
    """Rows written once as a table below the shared folder and read back: lineage ends here.

    Unlike a cache the copy survives lost executors. The schema is given to the reader, so reading
    back infers nothing and works for an empty result as well.
    """
    path = new_dir(rows.sparkSession, label)
    rows.write.option("compression", "zstd").parquet(path)
    found = rows.sparkSession.read.schema(rows.schema).parquet(path)
    found.stored_at = path
    return found


def freed(*frames: DataFrame) -> None:
    """Remove the files of frames that ``stored`` gave, once everything that reads them has been computed and stored."""
    for frame in frames:
        remove_dir(frame.sparkSession, frame.stored_at)


def checkpointed(rows: DataFrame) -> DataFrame:
    """Rows written once to the checkpoint folder, with their lineage cut.

    For results that must not change between evaluations, such as row positions.
    """
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(rows.sparkSession))
    return rows.checkpoint(eager=True)
