"""Inputs: JSON lines, CSV, text and JDBC."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameReader, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace import schemas
from millrace.sources.jdbc import Connection, ReadSlices


def read_archive(
    spark: SparkSession, paths: str | Sequence[str], spread: int | None = None
) -> DataFrame:
    """Events from JSON lines, plain or gzip, with the declared schema.

    A gzip file is read by one task. Hourly archives give one task per hour; ``spread`` shuffles
    a few large files over that many partitions when later work is worth it.
    """
    events = spark.read.schema(schemas.ARCHIVE_EVENT).json(paths)
    return events if spread is None else events.repartition(spread)


def read_documents(spark: SparkSession, paths: str | Sequence[str], multi_line: bool = True) -> DataFrame:
    """Latest-rate documents, one per file (multi-line) or one per line."""
    return spark.read.schema(schemas.LATEST_RATE).option("multiLine", multi_line).json(paths)


HEADER_JOBS = 16  # files whose headers are read at the same time


def _headers(spark: SparkSession, paths: str | Sequence[str]) -> dict[str, list[str]]:
    """Files by header: the first line that is not blank. A file without such a line has none.

    One small job a file, which ends with the first line it finds: it reads the begin of the file's first split, however
    long the file is. The jobs run side by side on the executors; the driver holds the list of files, as Spark's reader does.
    """
    files = sorted(unquote(file) for file in spark.read.text(paths).inputFiles())

    def first(file: str) -> Row | None:
        return spark.read.text(file).where(F.trim("value") != "").head()

    with ThreadPoolExecutor(HEADER_JOBS) as pool:
        found: dict[str, list[str]] = {}
        for file, row in zip(files, pool.map(first, files)):
            if row is not None:
                found.setdefault(row.value, []).append(file)
    return found


def read_csv(
    spark: SparkSession, paths: str | Sequence[str], schema: str | None = None
) -> DataFrame:
    """CSV files with a header line each; every column a string unless a schema is given.

    Columns go by name. Files may differ in their columns and in their order: a column that a file lacks is null in
    its rows. With a schema, exactly its columns are returned and text that does not fit a type becomes null.
    A header must not contain line breaks. Headers are read first, a few kilobytes of each file; files with one header are read together.
    """
    reader = spark.read.option("header", True)
    headers = _headers(spark, paths)
    if len(headers) > 1:
        rows, *others = [reader.csv(headers[header]) for header in sorted(headers)]
        for other in others:
            rows = rows.unionByName(other, allowMissingColumns=True)
    elif headers or schema is None:
        rows = reader.csv(paths)
    else:
        return reader.schema(schema).csv(paths)
    if schema is None:
        return rows
    typed = StructType.fromDDL(schema)
    held = {name.lower(): name for name in rows.columns}
    return rows.select(
        *[
            (F.col(f"`{held[f.name.lower()]}`") if f.name.lower() in held else F.lit(None))
            .try_cast(f.dataType)
            .alias(f.name)
            for f in typed
        ]
    )


def read_lines(
    spark: SparkSession, paths: str | Sequence[str], separator: str | None = None
) -> DataFrame:
    """Text lines in the column ``value``."""
    reader = spark.read if separator is None else spark.read.option("lineSep", separator)
    return reader.text(paths)


def _jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrameReader:
    return spark.read.format("jdbc").options(**options)


def read_jdbc_table(
    spark: SparkSession, connection: Connection, table: str, slices: ReadSlices | None = None
) -> DataFrame:
    """A database table; ``slices`` reads ranges of a column in parallel connections."""
    options = connection.options() | {"dbtable": table}
    return _jdbc(spark, options | (slices.options() if slices else {})).load()


def read_jdbc_query(spark: SparkSession, connection: Connection, sql: str) -> DataFrame:
    """The result of a query that the database runs."""
    return _jdbc(spark, connection.options() | {"query": sql}).load()
