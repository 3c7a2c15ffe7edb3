"""Joins that stay balanced when one key holds a large share of the rows.

A join whose sides are both exchanged by the join key itself is one that AQE splits at run time where a partition of
the many side is oversized. An aggregate over the same key would bring its own partitioning, which AQE
does not split. Comparing the keys as one struct exchanges both sides anew, so statistics of a group join their rows that
way. (A null-safe comparison does so only while a key may be null.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_group_stats(rows: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of rows with one-row-per-group stats; null keys match, as in a window partition.

    Unlike a window function it gathers no group in one task: AQE splits a hot group's rows over several tasks, each with
    a copy of the group's single stats row.
    """
    inner = {key: f"_stats_{key}" for key in keys}
    # Structs are equal where their fields are equal or both null.
    here = F.struct(*[F.col(key).alias(key) for key in inner])
    there = F.struct(*[F.col(name).alias(key) for key, name in inner.items()])
    return rows.join(stats.withColumnsRenamed(inner), here == there).drop(*inner.values())
