"""Incremental pick-up of landed archive files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators.activity import typed_events
from millrace.sources import commits

# A landed file is known by where it is, its size and its time; a file that changes counts as a new one.
LANDED_FILE = "landed_file string, landed_size bigint, landed_time timestamp"
_FILE_COLUMNS = [part.split()[0] for part in LANDED_FILE.split(", ")]
_METADATA = ("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")


def land_files(
    spark: SparkSession,
    folder: str,
    load: Callable[[DataFrame, int], None],
    checkpoint: str,
    schema: str = schemas.ARCHIVE_EVENT,
    files_per_batch: int = 1000,
    extra: Sequence[Column] = (),
) -> None:
    """Call ``load(rows, batch)`` for all JSON files that arrived since the last run, then stop.

    The checkpoint remembers the files taken. After a failure the last batch is given again with
    the same number and files, so ``load`` must replace what it stored under that number. ``extra`` adds columns to the
    rows, such as the file's metadata.
    """
    arrivals = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)
    )
    query = (
        arrivals.select("*", *extra)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def taken_files(spark: SparkSession, table: str, batches: Sequence[str] | None = None) -> DataFrame:
    """The table's ledger: the files whose rows it holds, of the given committed batches or of all."""
    batches = commits.names(spark, table) if batches is None else batches
    if not batches:
        return spark.createDataFrame([], LANDED_FILE)
    return spark.read.schema(LANDED_FILE).parquet(*[f"{table}/taken/{batch}" for batch in batches])


def read_landed(spark: SparkSession, table: str) -> DataFrame:
    """The typed events of all committed batches."""
    batches = commits.names(spark, table)
    if not batches:
        return spark.createDataFrame([], schemas.TYPED_EVENT)
    return spark.read.schema(schemas.TYPED_EVENT).parquet(*[f"{table}/{commits.DATA}/{batch}" for batch in batches])


def land_events(spark: SparkSession, folder: str, table: str, checkpoint: str, **options) -> DataFrame:
    """Bring newly landed events into a typed Parquet table and return the whole table.

    Each batch writes its rows and the list of their files (the ledger), then commits both under the name of
    the stream (the checkpoint's own id) and the batch. A repeated batch that was committed does nothing, one that was
    not replaces what it left. A stream with a new checkpoint sees all files again; those that the ledger lists for
    other streams are left out, so they are read once more but never stored twice, and no batch of
    another stream is overwritten. One run at a time may land into a table.
    """

    def load(archive: DataFrame, batch: int) -> None:
        stream = commits.read_json(spark, f"{checkpoint}/metadata")["id"]
        name = f"{stream}-{batch:09d}"
        committed = commits.names(spark, table)
        if name in committed:
            return
        others = [other for other in committed if not other.startswith(stream)]
        if others:
            # Both sides are exchanged or the list of files is broadcast, as its size allows.
            archive = archive.join(taken_files(spark, table, others).distinct(), _FILE_COLUMNS, "left_anti")
        rows = f"{table}/{commits.DATA}/{name}"
        typed_events(archive, keep=_FILE_COLUMNS).write.mode("overwrite").parquet(rows)
        written = spark.read.schema(f"{schemas.TYPED_EVENT}, {LANDED_FILE}").parquet(rows)
        written.select(*_FILE_COLUMNS).distinct().write.mode("overwrite").parquet(f"{table}/taken/{name}")
        commits.publish(spark, table, name, {"stream": stream, "batch": batch})

    extra = [F.col(source).alias(name) for source, name in zip(_METADATA, _FILE_COLUMNS)]
    land_files(spark, folder, load, checkpoint, extra=extra, **options)
    return read_landed(spark, table)
