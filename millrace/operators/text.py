"""Line counts over text, and row sampling and tagging."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import uuid_hex

SAMPLE_SEED = 123


def line_counts(lines: DataFrame, *parts: str, column: str = "value") -> DataFrame:
    """Lines containing each part, counted in one pass; defaults to 'a' and 'b'."""
    return lines.agg(
        *[
            F.count_if(F.contains(F.col(column), F.lit(part))).alias(f"lines_with_{part}")
            for part in parts or ("a", "b")
        ]
    )


def sample_rows(rows: DataFrame, fraction: float, seed: int = SAMPLE_SEED) -> DataFrame:
    """Each row kept with the given probability."""
    # By name: with a positional fraction, Spark 4.1 ignores a seed given by name.
    return rows.sample(fraction=fraction, seed=seed)


def with_uuid(rows: DataFrame, column: str = "uuid") -> DataFrame:
    """Rows with a random 32-digit hex id."""
    return rows.withColumn(column, uuid_hex())


_COPIES, _COPY = "__copies", "__copy"


def _numbered_copies(rows: DataFrame) -> DataFrame:
    """Every row with the number of its copy among equal rows, from 1; equal rows are counted, never gathered.

    The numbers depend on the rows alone, not on how they are stored, dealt out or computed again.
    """
    held = rows.groupBy(*rows.columns).agg(F.count("*").alias(_COPIES))
    return held.withColumn(_COPY, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(_COPIES)))).drop(_COPIES)


def sample_rows_stable(rows: DataFrame, fraction: float, seed: int = SAMPLE_SEED) -> DataFrame:
    """Each row kept with the given probability, by a seeded hash of its content and copy number.

    The same rows come out whatever the layout, and after a lost executor, unlike with ``sample_rows``; the price is
    one exchange of the distinct rows. Columns must be comparable (no maps).
    """
    lot = F.pmod(F.xxhash64(F.lit(seed), *rows.columns, _COPY), F.lit(1 << 53))
    return _numbered_copies(rows).where(lot < F.lit(fraction * (1 << 53))).select(*rows.columns)


def with_stable_uuid(rows: DataFrame, column: str = "uuid", seed: int = SAMPLE_SEED) -> DataFrame:
    """Rows with a 32-digit hex id named by the run's seed, the row's content and its copy number.

    A stage that runs again gives its rows the same ids, which random ones do not keep.
    """
    name = F.to_json(F.struct(F.lit(seed).alias("seed"), F.struct(*rows.columns).alias("row"), F.col(_COPY)), {"ignoreNullFields": "false"})
    return _numbered_copies(rows).withColumn(column, F.md5(name)).select(*rows.columns, column)
