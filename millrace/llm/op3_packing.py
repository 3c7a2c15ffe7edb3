"""Best-fit packing of token pieces into fixed-size sequences, with matching of large items.

Pieces of equal length are interchangeable, so the packing is planned on the histogram of lengths (at most
``capacity`` rows whatever the table's size) and the plan says for each length how many of its
pieces go to which kind of bin. Pieces then find their bin by their rank among pieces of their length.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.columns import id_and_text, ids_of, ids_to_arrow, table
from millrace.llm.tokens import encoded
from millrace.plans.scratch import stored

CAPACITY = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
# Pieces of one length that are ranked together; a longer run of equal lengths is ranked in parts.
RANKED = 50_000


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian u32): each document's ids and the end id, cut at ``capacity``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ids in encoded(batches, path, end_id):
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            counts = -(-sizes // capacity)
            owner = np.repeat(np.arange(sizes.size), counts)
            piece = np.arange(owner.size) - np.repeat(np.cumsum(counts) - counts, counts)
            start = piece * capacity
            length = np.minimum(sizes[owner] - start, capacity)
            blobs = [ids[o][s : s + n].astype("<u4").tobytes() for o, s, n in zip(owner.tolist(), start.tolist(), length.tolist())]
            yield pa.record_batch(
                [ids_to_arrow(ids_of(rows.column("doc_id"))[owner]), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(blobs, pa.binary())],
                ["doc_id", "piece", "start", "length", "ids"],
            )

    return id_and_text(docs).mapInArrow(cut, "doc_id bigint, piece int, start bigint, length bigint, ids binary")


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, pieces, first bin, offset) entries: ranks first.. go to bins first bin.. one by one.

    Bins that hold the same lengths are kept as one group with a multiplicity. Large items, above a
    third of the capacity, open the bins: the largest goes with the largest other one that still fits
    beside it (a bin takes two at most, as a third never fits). Smaller ones then go, longest first, to
    the bin with the least sufficient room, else open a new bin.
    """
    out: list[tuple[int, int, int, int, int]] = []
    used = dict.fromkeys(counts, 0)
    left = {n: c for n, c in counts.items() if c > 0}
    gaps: dict[int, list[tuple[int, int]]] = {}  # room -> (first bin, bins)
    rooms: list[int] = []  # sorted keys of gaps
    bins = 0

    def leave(room: int, first_bin: int, count: int) -> None:
        if room > 0 and count > 0:
            if room not in gaps:
                gaps[room] = []
                bisect.insort(rooms, room)
            gaps[room].append((first_bin, count))

    def put(length: int, count: int, first_bin: int, offset: int) -> None:
        out.append((length, used[length], count, first_bin, offset))
        used[length] += count

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        top = large[-1]
        room = capacity - top
        at = bisect.bisect_right(large, room) - 1
        mate = large[at] if at >= 0 else 0
        if not mate:
            count = left[top]
            put(top, count, bins, 0)
            leave(room, bins, count)
            left[top] = 0
        elif mate == top and left[top] == 1:
            # One of its kind: the next shorter large item is its mate.
            mate = large[at - 1] if at >= 1 else 0
            count = 1
            put(top, 1, bins, 0)
            left[top] = 0
            if mate:
                put(mate, 1, bins, top)
                left[mate] -= 1
            leave(room - mate, bins, 1)
        else:
            count = left[top] // 2 if mate == top else min(left[top], left[mate])
            put(top, count, bins, 0)
            left[top] -= count
            put(mate, count, bins, top)
            left[mate] -= count
            leave(room - mate, bins, count)
        bins += count
        large = [n for n in large if left[n]]

    for length in sorted((n for n in left if left[n]), reverse=True):
        while left[length]:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                first, count, room = bins, -(-left[length] // (capacity // length)), capacity
                bins += count
            else:
                room = rooms[at]
                first, count = gaps[room].pop()
                if not gaps[room]:
                    del gaps[room], rooms[at]
            # As many as fit, round by round, into all bins of the group: a bin just filled has the least
            # room of all that still take this length.
            each = min(room // length, -(-left[length] // count))
            full = min(count, left[length] // each)
            for k in range(each):
                put(length, full, first, capacity - room + k * length)
            left[length] -= full * each
            leave(room - each * length, first, full)
            leave(room, first + full, count - full)
    return out


def assign_bins(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length and more columns) with sequence_id and offset.

    Every piece gets a place of its own; a sequence's places are gapless from 0. Full pieces need no
    plan: each is its own sequence. Ranks are taken within parts of a length, by a hash of the
    document, so one very frequent length does not end in one task.
    """
    spark = pieces.sparkSession
    # The histogram: at most ``capacity`` rows, whatever the number of pieces.
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    entries = plan_bins(counts, capacity)
    most = max(counts.values(), default=0)
    parts = max(1, -(-most // RANKED))
    salted = pieces.withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)).cast("int"))
    sizes = salted.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    before = sizes.selectExpr(
        "length AS _length", "_part AS _in",
        "coalesce(sum(_n) OVER (PARTITION BY length ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS _before",
    )
    ranked = salted.selectExpr("*", "row_number() OVER (PARTITION BY length, _part ORDER BY doc_id, piece) - 1 AS _row").join(
        before, (F.col("length") == F.col("_length")) & (F.col("_part") == F.col("_in"))
    ).withColumn("_rank", F.col("_row") + F.col("_before"))
    # Entries of one length are consecutive rank ranges; a piece finds its own by binary search, and
    # the plan's size is bounded by the capacity, not by the table.
    by_length: dict[int, list[tuple[int, int, int]]] = {}
    for length, rank, _, first_bin, offset in entries:
        by_length.setdefault(length, []).append((rank, first_bin, offset))
    tables = {n: tuple(np.array(x, np.int64) for x in zip(*rows)) for n, rows in by_length.items()}
    plan = spark.sparkContext.broadcast(tables)
    kept = [c for c in pieces.columns]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(length.size, np.int64), np.zeros(length.size, np.int64)
            for n in np.unique(length):
                own = np.flatnonzero(length == n)
                ranks, bins, offsets = plan.value[int(n)]
                at = np.searchsorted(ranks, rank[own], "right") - 1
                sequence[own] = bins[at] + rank[own] - ranks[at]
                offset[own] = offsets[at]
            yield pa.record_batch([*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema), "sequence_id bigint", "offset bigint"])
    return ranked.select(*kept, "_rank").mapInArrow(find, schema)


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = True) -> DataFrame:
    """Pieces of all documents with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset and ids.

    Null text is the empty text: one piece of the end id. A null doc_id is kept; rows with the same
    doc_id are packed each; other columns are not read; an empty table packs into no sequence. Pieces are
    tokenized once and stored, as ranks must not change between evaluations; without ``ids`` only their
    digest is stored.
    """
    pieces = token_pieces(docs, path, capacity, end_id).withColumn("ids_crc32", F.crc32("ids"))
    return assign_bins(stored(pieces if ids else pieces.drop("ids"), "pieces"), capacity)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), ids=False)
