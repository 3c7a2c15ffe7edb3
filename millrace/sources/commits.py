"""Commits of stored tables: small JSON files put under a name that did not exist before.

A writer first writes its rows to a folder of its own, which no reader knows, and then publishes a commit that names
it. Publishing is one rename that fails where the name is taken, so a reader sees all of a commit or
nothing of it, a writer that died leaves a folder that nobody reads, and of two writers that build on the
same state one is told that it came second. Commits are named either by the writer (a batch key) or by
version numbers, of which the highest describes the whole table.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

COMMITS = "_commits"  # Spark's readers pass over folders that begin with an underscore
DATA = "data"


class CommitConflict(RuntimeError):
    """Another writer published first, again and again."""


@dataclass(frozen=True)
class Version:
    """A table's state: its number, 0 before anything was published, and what its commit says."""

    number: int
    content: dict[str, Any]


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def new_folder(label: str | None = None) -> str:
    """A folder name for one writer's rows, relative to the table; with a label in the form of a partition."""
    name = uuid.uuid4().hex
    return f"{DATA}/{label}={name}" if label else f"{DATA}/{name}"


def publish(spark: SparkSession, path: str, name: str, content: dict[str, Any]) -> bool:
    """Publish a commit of the table at ``path``; False if that name was published before."""
    files = _files(spark, path)
    target, draft = f"{path}/{COMMITS}/{name}", f"{path}/{COMMITS}/.{uuid.uuid4().hex}"
    out = files.create(_path(spark, draft), True)
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    fs = spark._jvm.org.apache.hadoop.fs
    # Unlike FileSystem.rename this one fails where the target exists, on local disks too.
    context = fs.FileContext.getFileContext(_path(spark, files.makeQualified(_path(spark, path)).toString()).toUri(), spark._jsc.hadoopConfiguration())
    nothing = spark._sc._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        context.rename(files.makeQualified(_path(spark, draft)), files.makeQualified(_path(spark, target)), nothing)
    except Py4JJavaError as error:
        files.delete(_path(spark, draft), False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def names(spark: SparkSession, path: str) -> list[str]:
    """Published names in order."""
    files, folder = _files(spark, path), _path(spark, f"{path}/{COMMITS}")
    if not files.exists(folder):
        return []
    found = (status.getPath().getName() for status in files.listStatus(folder))
    return sorted(name for name in found if not name.startswith("."))


def contents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What all published commits say, one row for each."""
    if not names(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(f"{path}/{COMMITS}")


def content(spark: SparkSession, path: str, name: str) -> dict[str, Any]:
    return read_json(spark, f"{path}/{COMMITS}/{name}")


def read_json(spark: SparkSession, file: str) -> dict[str, Any]:
    stream = _files(spark, file).open(_path(spark, file))
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def newest(spark: SparkSession, path: str) -> Version:
    """The table's state; it stays readable while later versions are published."""
    found = names(spark, path)
    return Version(int(found[-1]), content(spark, path, found[-1])) if found else Version(0, {})


def publish_version(spark: SparkSession, path: str, number: int, state: dict[str, Any]) -> bool:
    return publish(spark, path, f"{number:012d}", state)


def discard(spark: SparkSession, path: str, folder: str) -> None:
    """Remove a folder of the table that no published state names, such as that of a commit that came second."""
    _files(spark, path).delete(_path(spark, f"{path}/{folder}"), True)


def forget_versions(spark: SparkSession, path: str, keep: int, folders) -> None:
    """Remove all but the ``keep`` newest versions, and the folders that only those named.

    ``folders`` gives the folders that a version's content names. Readers of a kept version are not disturbed; folders
    that no version ever named belong to writers, dead or alive, and are left alone.
    """
    found = names(spark, path)
    old, kept = found[:-keep], found[-keep:]
    if not old:
        return
    alive = {folder for name in kept for folder in folders(content(spark, path, name))}
    files = _files(spark, path)
    for name in old:
        for folder in set(folders(content(spark, path, name))) - alive:
            discard(spark, path, folder)
        files.delete(_path(spark, f"{path}/{COMMITS}/{name}"), False)
