"""Outputs: CSV, JDBC and appends."""

from __future__ import annotations

import datetime
import re

from pyspark.sql import DataFrame, SparkSession

from millrace.sources import commits
from millrace.sources.jdbc import Connection


def write_csv(rows: DataFrame, path: str, files: int | None = None) -> None:
    """CSV with a header, replacing the folder.

    ``files=1`` gives the single file a small report is read as. Left out, every task writes
    its own part, which is the setting for large results.
    """
    placed = rows if files is None else rows.coalesce(files)
    placed.write.mode("overwrite").option("header", True).csv(path)


def write_csv_dated(rows: DataFrame, folder: str, day: datetime.date | str, name: str) -> str:
    """CSV parts below a folder per date; fails when they exist already. Returns the path."""
    path = f"{folder.rstrip('/')}/{day}/{name}"
    rows.write.mode("errorifexists").option("header", True).csv(path)
    return path


def write_jdbc(rows: DataFrame, connection: Connection, table: str, parallel: int = 8) -> None:
    """Replace a database table through at most ``parallel`` connections, keeping its grants and indexes."""
    (
        rows.write.format("jdbc")
        .options(**connection.options())
        .option("dbtable", table)
        .option("numPartitions", parallel)
        .option("truncate", True)
        .mode("overwrite")
        .save()
    )


def append_rows(rows: DataFrame, path: str, *partition_by: str) -> None:
    """Append to a stored Parquet folder."""
    rows.write.mode("append").partitionBy(*partition_by).parquet(path)


BATCH = "batch_folder"


def append_once(rows: DataFrame, path: str, batch: str, *partition_by: str) -> bool:
    """Append a batch to a stored table unless a batch of that key is stored already; returns whether it was added.

    The rows go to a folder of their own, and a commit named by the key makes them part of the table. A writer that
    fails half-way leaves nothing that ``read_appended`` sees, and of two writers of one batch only the first
    counts. Empty batches are remembered too. Keys may hold letters, digits, ``.``, ``_`` and ``-``.
    """
    spark = rows.sparkSession
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", batch):
        raise ValueError(f"not a batch key: {batch!r}")
    if batch in commits.names(spark, path):
        return False
    folder = commits.new_folder(BATCH)
    rows.write.partitionBy(*partition_by).parquet(f"{path}/{folder}")
    if commits.publish(spark, path, batch, {"folder": folder}):
        return True
    commits.discard(spark, path, folder)
    return False


def read_appended(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all committed batches, with the columns of ``schema`` (partition columns included)."""
    folders = [row.folder for row in commits.contents(spark, path, "folder string").collect()]
    if not folders:
        return spark.createDataFrame([], schema)
    held = spark.read.schema(f"{schema}, {BATCH} string").option("basePath", f"{path}/{commits.DATA}")
    return held.parquet(*[f"{path}/{folder}" for folder in folders]).drop(BATCH)
