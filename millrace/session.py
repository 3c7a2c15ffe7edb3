"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that change results or plan shape. Sizing (memory, cores, shuffle
# partitions) belongs to the cluster and is left to spark-submit.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app: str = "millrace", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**REQUIRED, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the required settings on a session somebody else started."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for operators with Python tasks."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="millrace-")) / "millrace.zip"  # read by the driver only
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, Path(root.name) / path.relative_to(root))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
