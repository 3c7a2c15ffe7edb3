"""Stored dimensions: values with surrogate ids that stay unique and gapless, whatever happens to a load.

A dimension is a folder of data folders and commits (see ``commits``). A commit holds the list of data folders
and the highest id given so far, the mark. A load numbers the values that it does not find from the mark on, writes
them, and publishes folders and mark together. A load that dies before that has given out no id: its
repetition gives the same numbers again. Of two loads that start from one mark the second is refused, and
numbers its values again from the new mark, leaving out what the first has stored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from millrace.operators.warehouse import dim_new_rows, dim_new_values
from millrace.plans.scratch import remove_dir
from millrace.sources import commits

KEPT_VERSIONS = 3
# A load that finds more data folders than this packs them into one as it commits.
MOST_FOLDERS = 16


def _folders(state: dict) -> list[str]:
    return state["folders"]


def create_dimension(spark: SparkSession, path: str, ddl: str) -> None:
    """An empty dimension with the columns of ``ddl``, unless something is stored there."""
    if not commits.names(spark, path):
        commits.publish_version(spark, path, 1, {"ddl": ddl, "folders": [], "mark": 0})


def drop_dimension(spark: SparkSession, path: str) -> None:
    remove_dir(spark, path)


def _read(spark: SparkSession, path: str, state: dict) -> DataFrame:
    schema = StructType.fromDDL(state["ddl"])
    if not state["folders"]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{folder}" for folder in state["folders"]])


def _state(spark: SparkSession, path: str) -> commits.Version:
    version = commits.newest(spark, path)
    if not version.number:
        raise ValueError(f"no dimension at {path}")
    return version


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """The dimension as its newest commit describes it."""
    return _read(spark, path, _state(spark, path).content)


def high_mark(spark: SparkSession, path: str) -> int:
    """The highest id given so far."""
    return int(_state(spark, path).content["mark"])


def load_dimension(
    source: DataFrame, path: str, value: str, id: str, attempts: int = 5, before_commit: Callable[[str], None] | None = None
) -> int:
    """Give ids to the values of ``source`` that the dimension lacks, in value order; returns how many there were.

    Null values get no id. Repeating a load, whether it failed or not, adds nothing twice. The ids follow the mark
    without a gap. Only the new values are shuffled and numbered, in a range sort (see ``dim_new_values``).
    ``before_commit`` is called with the folder of the written rows before they are published, to check or refuse them.
    """

    def fresh(stored: DataFrame, state: dict) -> DataFrame:
        return dim_new_values(source, stored, value, id, highest=state["mark"])

    return _load(source.sparkSession, path, attempts, fresh, True, before_commit)


def load_dimension_rows(source: DataFrame, path: str, value: str, id: str, attempts: int = 5) -> int:
    """Add the (id, value) pairs of ``source`` whose value the dimension lacks; returns how many there were."""

    def fresh(stored: DataFrame, state: dict) -> DataFrame:
        return dim_new_rows(source, stored, value, id)

    return _load(source.sparkSession, path, attempts, fresh, False, None)


def _load(spark: SparkSession, path: str, attempts: int, fresh, numbered: bool, before_commit) -> int:
    for _ in range(attempts):
        version = _state(spark, path)
        state = dict(version.content)
        folder = commits.new_folder()
        columns = StructType.fromDDL(state["ddl"]).names
        fresh(_read(spark, path, state), state).select(*columns).write.parquet(f"{path}/{folder}")
        added = spark.read.schema(state["ddl"]).parquet(f"{path}/{folder}").count()
        if not added:
            commits.discard(spark, path, folder)
            return 0
        state["folders"] = [*state["folders"], folder]
        if numbered:
            state["mark"] += added
        if len(state["folders"]) > MOST_FOLDERS:
            state["folders"] = [_packed(spark, path, state)]
        if before_commit:
            before_commit(f"{path}/{folder}")
        if commits.publish_version(spark, path, version.number + 1, state):
            commits.forget_versions(spark, path, KEPT_VERSIONS, _folders)
            return added
        for unused in {folder, *state["folders"]} - set(version.content["folders"]):
            commits.discard(spark, path, unused)
    raise commits.CommitConflict(f"{path}: {attempts} loads by others came first")


def _packed(spark: SparkSession, path: str, state: dict) -> str:
    """All rows in one new folder, in files that the rebalancing sizes."""
    folder = commits.new_folder()
    _read(spark, path, state).hint("rebalance").write.parquet(f"{path}/{folder}")
    return folder
