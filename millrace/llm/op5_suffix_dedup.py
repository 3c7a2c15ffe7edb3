"""Removal of repeated byte strings by prefix doubling over sampled suffixes.

Classic distributed prefix doubling ranks every suffix by its first byte and then sorts pairs
(rank of the prefix at p, rank of the prefix at p + h) at growing h until suffixes are unique or
known for the threshold's length. Here h grows 8, 16, 26, 50 (a pair may overlap), with two economies:

* A rank is a name (hash) of its pair, not its place in a global order. Equal pairs get equal names, which
  is all that this operator asks of ranks, and names of the first rounds need no exchange.
* At h = 26 only sampled suffixes are exchanged: the smallest name in each stretch of 25 positions. Every
  50-byte string holds one, at the same place in all its copies, so a string whose sample is unique is
  unique. Those drop out. The round to h = 50 is exchanged for the positions that remain.

See ``repeats`` for the exchanges. Sorting all positions in every round would move 16 bytes for each
byte of text and round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.blocks import read_block, read_extra, store_blocks, with_replies
from millrace.llm.columns import id_and_text, ids_to_arrow, lean, mix, table
from millrace.llm.repeats import Units, covered, find_repeats

LENGTH = 50
ROWS_BYTES = 1 << 20
# Text in one block: its anchors and runs take about twelve times this in a worker.
BLOCK = 4 << 20


def _doubled(data: np.ndarray, gram: int) -> np.ndarray:
    """Names of the ``gram`` bytes (9 to 32) at each position, by doubling: 8 bytes, 16, then the rest."""
    names = data.astype(np.uint64)
    for reach in (1, 2, 4):
        names = names[:-reach] | (names[reach:] << np.uint64(8 * reach))
    have = 8
    while have < gram:
        step = min(have, gram - have)
        names = mix(names[:-step] * np.uint64(3) + names[step:])
        have += step
    return names


def byte_units(length: int) -> Units:
    gram = length // 2 + 1
    if not 9 <= gram <= 32:
        raise ValueError("lengths of 16 to 63 bytes can be searched for")

    def grams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (_doubled(data, gram) if data.size >= gram else np.zeros(0, np.uint64)), bounds

    return Units(grams, length, gram, content=True, same_document=False)


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep: list[str] | None = None) -> DataFrame:
    """Each document without the bytes of ``length``-byte strings that start in a document of smaller doc_id too.

    Returns doc_id, n_bytes, n_removed, spans (array of start, end; maximal removed runs), kept (the
    remaining bytes) and the ``keep`` columns of the input as one struct ``row``. Strings are judged on the
    input and never cross documents. Null text is empty; a text shorter than ``length`` loses nothing;
    a null doc_id counts as larger than all others; rows with one doc_id are separate documents of which
    none is smaller; an empty table gives an empty result.
    """
    keep = list(keep or [])
    kept_fields = [f for f in docs.schema if f.name in keep]
    plain = id_and_text(docs)
    if keep:
        plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.struct(*keep).alias("row"))
    units = byte_units(length)
    blocks = store_blocks(plain, ["row"] if keep else [], BLOCK)
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob, extra, replies in zip(*(batch.column(c).to_pylist() for c in ("texts", "extra", "replies"))):
                ids, bounds, data = read_block(blob)
                gone = covered(data.size, length, replies)
                begins = gone.copy()
                begins[1:] &= ~gone[:-1]
                ends = gone.copy()
                ends[:-1] &= ~gone[1:]
                inner = bounds[1:-1][(bounds[1:-1] < data.size) & (bounds[1:-1] > 0)]
                begins[inner] |= gone[inner]
                ends[inner - 1] |= gone[inner - 1]
                start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
                del begins, ends
                rest = data[~gone]
                del data, gone
                at = np.searchsorted(start, bounds)
                owner = np.searchsorted(bounds, start, "right") - 1
                removed = np.zeros(ids.size, np.int64)
                np.add.at(removed, owner, end - start)
                left = bounds - np.concatenate([[0], np.cumsum(removed)])
                start, end = start - bounds[owner], end - bounds[owner]
                sizes = np.diff(bounds)
                row = read_extra(extra).column("row") if keep else None
                del extra
                # Rows of about ROWS_BYTES bytes at once.
                first = 0
                while first < ids.size:
                    last = min(max(first + 1, int(np.searchsorted(left, left[first] + ROWS_BYTES, "right")) - 1), first + 2000, ids.size)
                    own = slice(first, last)
                    inside = slice(at[first], at[last])
                    spans = pa.ListArray.from_arrays(pa.array(at[first : last + 1] - at[first], pa.int32()), pa.StructArray.from_arrays([pa.array(start[inside]), pa.array(end[inside])], ["start", "end"]))
                    columns = {
                        "doc_id": ids_to_arrow(ids[own]),
                        "n_bytes": pa.array(sizes[own]),
                        "n_removed": pa.array(removed[own]),
                        "spans": spans.cast(spans_type),
                        "kept": pa.array([rest[a:b].tobytes() for a, b in zip(left[first:last].tolist(), left[first + 1 : last + 1].tolist())], pa.binary()),
                    }
                    if keep:
                        columns["row"] = row.slice(first, last - first).combine_chunks()
                    yield pa.record_batch(list(columns.values()), list(columns))
                    first = last

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"
    if keep:
        schema += ", row struct<" + ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in kept_fields) + ">"
    return with_replies(blocks, find_repeats(blocks, units)).select("texts", "extra", "replies").mapInArrow(lean(cut), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
