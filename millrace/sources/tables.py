"""Stored tables: definition, the warehouse load and the daily rate refresh."""

from __future__ import annotations

import datetime
import re
import uuid
from collections import Counter
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators.rates import daily_rates, parse_rates, rows_of_new_days
from millrace.operators.warehouse import TableSpec, new_rows
from millrace.plans.scratch import remove_dir
from millrace.sources import commits


MOST_FILES = 16  # of a bucket, before a load packs its table
BUCKET_BYTES = 256 << 20  # stored bytes beyond which packing gives a table more buckets
REPLACED = "replaced.location"  # table property: the state before the last packing


def create_table(
    spark: SparkSession,
    name: str,
    ddl: str,
    buckets: tuple[int, Sequence[str]] | None = None,
    partition_by: str | None = None,
) -> None:
    """Parquet table, if absent; optionally bucketed or partitioned."""
    layout = f" PARTITIONED BY ({partition_by})" if partition_by else ""
    if buckets:
        layout += f" CLUSTERED BY ({', '.join(buckets[1])}) INTO {buckets[0]} BUCKETS"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{layout}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def truncate_table(spark: SparkSession, name: str) -> None:
    """Empty a table, keeping its definition; used before a full reload."""
    if _described(spark, name, "Type") == "EXTERNAL":  # such as a table with a new number of buckets
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{_beside(_location(spark, name))}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"TRUNCATE TABLE {name}")


def create_warehouse(
    spark: SparkSession, database: str, specs: Sequence[TableSpec], buckets: int | None = None
) -> None:
    """Tables of a model, bucketed by the keys their loads join on.

    The join with new rows then reads the stored side, which grows without end, in place: only
    the new rows are shuffled. Spark does so when there are at least as many buckets as shuffle
    partitions, hence the default.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    for spec in specs:
        create_table(spark, f"{database}.{spec.name}", spec.ddl, buckets=(buckets, spec.keys))


def drop_warehouse(spark: SparkSession, database: str, specs: Sequence[TableSpec]) -> None:
    for spec in specs:
        drop_table(spark, f"{database}.{spec.name}")


def _described(spark: SparkSession, table: str, what: str) -> str | None:
    found = spark.sql(f"DESCRIBE EXTENDED {table}").where(F.col("col_name") == what).first()
    return found["data_type"] if found else None


def _location(spark: SparkSession, table: str) -> str:
    return _described(spark, table, "Location")


def _beside(location: str) -> str:
    """A new folder for another state of the table that lies at ``location``."""
    return f"{location.rstrip('/').rpartition('/')[0]}/state-{uuid.uuid4().hex}"


def bucket_count(spark: SparkSession, table: str) -> int | None:
    found = _described(spark, table, "Num Buckets")
    return int(found) if found else None


def files_per_bucket(spark: SparkSession, table: str) -> dict[int, int]:
    """How many files each bucket of a table has; Spark keeps a bucket's number in its files' names."""
    found = (re.search(r"_(\d{5})(?:\.c\d+)?\.", file) for file in spark.table(table).inputFiles())
    return Counter(int(match[1]) for match in found if match)


def fitting_buckets(spark: SparkSession, stored_bytes: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """The shuffle partitions, doubled until a bucket of so many stored bytes has at most ``bucket_bytes``.

    With no fewer buckets than shuffle partitions the stored side of a join is read in place.
    """
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    while buckets * bucket_bytes < stored_bytes:
        buckets *= 2
    return buckets


def stored_bytes(spark: SparkSession, table: str) -> int:
    folder = spark._jvm.org.apache.hadoop.fs.Path(_location(spark, table))
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def pack_table(spark: SparkSession, table: str, spec: TableSpec, bucket_bytes: int = BUCKET_BYTES) -> None:
    """Write every bucket of a table as one file, and give the table more buckets if theirs have grown too large.

    The packed state is written beside the old one. With the same number of buckets the table's location is then
    changed, which is one step in the catalog: readers that hold the old state go on with its files, which stay until the
    next packing. A new number of buckets needs a new definition, during whose exchange the name is missing for a moment.
    Nobody else may write to the table meanwhile.
    """
    held, location = bucket_count(spark, table), _location(spark, table)
    buckets = max(held, fitting_buckets(spark, stored_bytes(spark, table), bucket_bytes))
    target, draft = _beside(location), f"{table}_packed_{uuid.uuid4().hex}"
    # Read as plain files: over a bucketed scan Spark leaves the exchange out, and then reads without buckets.
    files = spark.read.schema(spark.table(table).schema).parquet(location)
    rows = files.select(*spec.columns).repartition(buckets, *spec.keys)
    rows.write.bucketBy(buckets, *spec.keys).option("path", target).saveAsTable(draft)
    replaced = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == REPLACED).first()
    if buckets == held:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{target}'")
        drop_table(spark, draft)  # it is external, so the files stay
    else:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{_beside(location)}'")
        drop_table(spark, table)
        spark.sql(f"ALTER TABLE {draft} RENAME TO {table}")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{REPLACED}' = '{location}')")
    spark.catalog.refreshTable(table)
    if replaced:
        remove_dir(spark, replaced["value"])


def append_to_table(rows: DataFrame, table: str, spec: TableSpec) -> None:
    """Append rows, one file per bucket instead of one per bucket and task."""
    buckets = bucket_count(rows.sparkSession, table)
    if buckets:
        rows = rows.repartition(buckets, *spec.keys)
    rows.select(*spec.columns).write.insertInto(table)


def load_warehouse(
    source: DataFrame, database: str, specs: Sequence[TableSpec], time: str = "created_at", most_files: int = MOST_FILES
) -> None:
    """Append what each table lacks. Safe to repeat after any failure: stored rows are not added again.

    A load adds a file to each bucket it has rows for. A table in which a bucket has come to more than ``most_files`` is
    packed: fewer files cost a rewrite more often.

    Each table reads only its columns of the source, so the source should be a columnar table. The
    loads are independent and submitted together, so that small ones do not leave the cluster idle.
    """
    spark = source.sparkSession

    def load(spec: TableSpec) -> None:
        table = f"{database}.{spec.name}"
        append_to_table(new_rows(source, spark.table(table), spec, time), table, spec)
        if max(files_per_bucket(spark, table).values(), default=0) > most_files:
            pack_table(spark, table, spec)

    with ThreadPoolExecutor(max_workers=8) as pool:
        list(pool.map(load, specs))


def table_sizes(spark: SparkSession, database: str, names: Sequence[str]) -> DataFrame:
    """(table_name, row_count) of stored tables."""
    counts = [
        spark.table(f"{database}.{name}")
        .agg(F.count("*").alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name in names
    ]
    total = counts[0]
    for count in counts[1:]:
        total = total.union(count)
    return total


# The daily table has one folder per month: few enough to list in a commit after decades, and the
# newest one is small enough to write anew at every refresh.
UNDATED = "undated"
KEPT_VERSIONS = 3  # readers may go on with the two states before the newest


def _month(day: datetime.date | None) -> str:
    return UNDATED if day is None else f"{day:%Y%m}"


def _folders(state: dict) -> list[str]:
    return [month["folder"] for month in state.get("months", {}).values()]


def create_daily_rates(spark: SparkSession, path: str) -> None:
    """An empty daily rate table, unless something is stored there."""
    if not commits.names(spark, path):
        commits.publish_version(spark, path, 1, {"months": {}})


def _read_folders(spark: SparkSession, path: str, folders: Sequence[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schemas.DAILY_RATE)
    return spark.read.schema(schemas.DAILY_RATE).parquet(*[f"{path}/{folder}" for folder in folders])


def read_daily_rates(spark: SparkSession, path: str) -> DataFrame:
    """The table as its newest commit describes it; later refreshes do not change what this frame reads."""
    return _read_folders(spark, path, _folders(commits.newest(spark, path).content))


def refresh_daily(raw: DataFrame, path: str, attempts: int = 5) -> None:
    """Compute the newest stored day again, add missing days, leave all other days untouched.

    ``raw`` holds text rates or typed ones (with ``symbol``). It is read and aggregated once; of the stored table only
    months that receive a day are read. A newest day for which no raw rates remain stays as it is. Undated rates are
    aggregated anew each time. If nothing arrives, nothing is written.

    Months that receive a day are written to a new folder, together with their other days as stored, and one commit
    names all months' folders. So readers see the whole refresh or nothing of it, a refresh that fails changes
    nothing, and one that finds another's commit in its place starts again from that, ``attempts`` times at most.

    The commit lists days and months, the date type bounds them, whatever is stored. Rebalancing by month gives few
    files per month, while AQE splits a month that is much larger than the others.
    """
    spark = raw.sparkSession
    for _ in range(attempts):
        if _refreshed(spark, raw, path):
            commits.forget_versions(spark, path, KEPT_VERSIONS, _folders)
            return
    raise commits.CommitConflict(f"{path}: {attempts} refreshes by others came first")


def _refreshed(spark: SparkSession, raw: DataFrame, path: str) -> bool:
    """One attempt; False if another commit came first."""
    version = commits.newest(spark, path)
    months = dict(version.content.get("months", {}))
    held = sorted(datetime.date.fromisoformat(day) for month in months.values() for day in month["days"])
    settled = spark.createDataFrame([(day,) for day in held[:-1]], "date date")
    typed = raw if "symbol" in raw.columns else parse_rates(raw)
    arriving = daily_rates(rows_of_new_days(typed, settled)).persist(StorageLevel.DISK_ONLY)
    try:
        found = [row.date for row in arriving.select("date").distinct().collect()]
        if not found:
            return True
        touched = sorted({_month(day) for day in found})
        before = _read_folders(spark, path, [months[m]["folder"] for m in touched if m in months and m != UNDATED])
        days = spark.createDataFrame([(day,) for day in found], "date date")
        rows = before.join(F.broadcast(days), "date", "left_anti").select(*arriving.columns).unionByName(arriving)
        folder = commits.new_folder()
        month = F.coalesce(F.date_format("date", "yyyyMM"), F.lit(UNDATED)).alias("month")
        rows.select("*", month).hint("rebalance", "month").write.partitionBy("month").parquet(f"{path}/{folder}")
    finally:
        arriving.unpersist()
    for name in touched:
        days_of = {day.isoformat() for day in found if day and _month(day) == name} | set(months.get(name, {}).get("days", []))
        months[name] = {"folder": f"{folder}/month={name}", "days": sorted(days_of)}
    if commits.publish_version(spark, path, version.number + 1, {"months": months}):
        return True
    commits.discard(spark, path, folder)
    return False
