"""Pairs of differing members inside groups, balanced for groups of any size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from millrace.session import ship_package

# Members that a single task compares with each other at most (on each side); it holds a byte for each of their pairs.
BLOCK = 8_000
# Rows of a block on average at most, one per member and group; members in many groups make more blocks.
BLOCK_ROWS = 1_000_000
# Pairs that a task forms or returns at once.
CHUNK = 1 << 20
# Every group above a block is looked at. The list of those that hold more than this share of all members, at
# most 100,000 by that definition, is broadcast; the others fit one task as rows and join it by group.
SPLIT_SHARE = 0.00001


def _split_groups(
    members: DataFrame, group: str, low: str, high: str, block: int
) -> tuple[DataFrame, DataFrame]:
    """Groups of more than a block, with the number of blocks that their members fill: hot ones, others.

    Groups in which every member has the same single code yield no pair and get no block.
    """
    sizes = members.groupBy(group).agg(
        F.count("*").alias("_size"), F.min(low).alias("_low"), F.max(high).alias("_high")
    )
    pairing = F.col("_low") < F.col("_high")
    # Counting only groups that can yield pairs is what a share should refer to. It also uses every
    # column of ``sizes``, so this subquery reads the same exchange as the other uses of members.
    able = F.coalesce(F.sum(F.when(pairing, F.col("_size"))), F.lit(0))
    limit = sizes.agg(able * F.lit(SPLIT_SHARE)).scalar()
    blocks = F.when(pairing, F.ceil(F.col("_size") / F.lit(block)))
    large = sizes.where(F.col("_size") > F.lit(block))

    def listed(groups: DataFrame) -> DataFrame:
        return groups.select(F.col(group).alias("_group"), F.coalesce(blocks, F.lit(0)).alias("_blocks"))

    return listed(large.where(F.col("_size") > limit)), listed(large.where(F.col("_size") <= limit))


def differing_pairs(
    members: DataFrame, group: str, member: str, low: str, high: str, block: int = BLOCK
) -> DataFrame:
    """(left, right), each once, for members left > right of a common group whose codes differ there somewhere.

    ``members`` has one row per group and member, with the range [low, high] of its codes. Two
    members differ in some code unless all their codes are one and the same, which shows in the
    ranges alone. A member without codes differs from nobody.

    Members are cut into blocks by a hash, over all groups. Each two blocks, and each with itself, are a
    cell: one task gets the cell's rows of all groups, so it sees every group in which two members meet
    and returns their pair once. Rows of members are sent, one copy per block, and pairs never are. No pair is
    left out, and no task compares more than a block with a block at a time.
    """
    spark = members.sparkSession
    ship_package(spark)
    # Filtered before the sizes are taken, so that all uses share one exchange.
    members = members.where(F.col(group).isNotNull() & F.col(member).isNotNull() & F.col(low).isNotNull())
    # True of every row. It uses the codes, so that this subquery reads the same exchange as well.
    coded = F.col(low) <= F.col(high)
    by_members = F.ceil(F.approx_count_distinct(F.when(coded, F.col(member))) / F.lit(block))
    by_rows = F.ceil(F.count_if(coded) / F.lit(BLOCK_ROWS))
    blocks = members.agg(F.greatest(by_members, by_rows, F.lit(1).cast("bigint"))).scalar()
    hot, others = _split_groups(members, group, low, high, block)
    in_group = F.col(group) == F.col("_group")
    rows = members
    for large in (F.broadcast(hot), others):
        rows = rows.join(large.where("_blocks = 0"), in_group, "left_anti")
    own, other = F.pmod(F.xxhash64(member), F.col("_blocks")), F.col("_other")
    copies = (
        rows.withColumn("_blocks", blocks)
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1)))
        .select(
            F.least(own, other).alias("_row"),
            F.greatest(own, other).alias("_column"),
            (own <= other).alias("_first"),
            F.col(group).alias("_group"),
            F.col(member).alias("_member"),
            F.when(F.col(low) == F.col(high), F.col(low)).alias("_code"),
        )
    )
    # A given number of partitions: cells are small to send, but must not be gathered into few tasks for that.
    spread = copies.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "_row", "_column")
    kind = members.schema[member].dataType
    pair = StructType([StructField("left", kind), StructField("right", kind)])
    return spread.groupBy("_row", "_column").applyInArrow(_cell_pairs, pair)


def _numbers(values: pa.ChunkedArray) -> np.ndarray:
    """Equal values as equal numbers from 0, null as -1."""
    indices = values.combine_chunks().dictionary_encode().indices
    return pc.fill_null(indices, -1).to_numpy(zero_copy_only=False)


def _cell_pairs(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a cell, each once: members of its first block with those of its second."""
    cell = pa.Table.from_batches(list(batches))
    values = cell["_member"].combine_chunks()
    names = pc.unique(values)
    names = names.take(pc.sort_indices(names))
    member = pc.index_in(values, value_set=names).to_numpy()
    group, code = _numbers(cell["_group"]), _numbers(cell["_code"])
    first = cell["_first"].to_numpy()
    alone = key[0] == key[1]
    one = np.flatnonzero(first)
    two = one if alone else np.flatnonzero(~first)
    two = two[np.argsort(group[two], kind="stable")]
    rows, row = np.unique(member[one], return_inverse=True)
    columns, column = np.unique(member[two], return_inverse=True)
    found = np.zeros((rows.size, columns.size), bool)
    begin, end = (np.searchsorted(group[two], group[one], side) for side in ("left", "right"))
    ends = np.cumsum(end - begin)
    start = 0
    while start < one.size:
        done = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + CHUNK, "right")))
        meets = end[start:stop] - begin[start:stop]
        a = np.repeat(np.arange(start, stop), meets)
        b = np.arange(a.size) + np.repeat(begin[start:stop] - (np.cumsum(meets) - meets), meets)
        mine = code[one[a]]
        differ = (mine != code[two[b]]) | (mine < 0)
        if alone:
            differ &= row[a] > column[b]
        found[row[a[differ]], column[b[differ]]] = True
        start = stop
    step = max(1, CHUNK // max(columns.size, 1))
    for start in range(0, rows.size, step):
        a, b = np.nonzero(found[start : start + step])
        a, b = rows[a + start], columns[b]
        if a.size:
            yield pa.record_batch([names.take(pa.array(x)) for x in (np.maximum(a, b), np.minimum(a, b))], ["left", "right"])
