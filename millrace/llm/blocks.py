"""Documents in compressed blocks, stored once, so that later passes read them without shuffling text."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.columns import ids_of, lean, pack, partitions, unpack
from millrace.plans.scratch import new_dir

# Text in one block; a longer document is a block of its own.
BLOCK_BYTES = 8 << 20


def store_blocks(docs: DataFrame, keep: list[str], size: int = BLOCK_BYTES) -> DataFrame:
    """A table of (block, texts, extra), bucketed by block; ``docs`` has doc_id and text (not null).

    ``texts`` packs doc_ids, byte lengths and bytes, ascending by doc_id; ``extra`` holds the ``keep``
    columns of the same rows as an Arrow stream. Written where the documents are read: no shuffle. A join
    by block reads the table bucket by bucket, so only what joins it moves.
    """
    spark = docs.sparkSession

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        total = 0

        def block() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            order = np.argsort(ids_of(rows.column("doc_id")), kind="stable")
            rows = rows.take(pa.array(order))
            texts = rows.column("text").cast(pa.binary()).to_pylist()
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            sink = pa.BufferOutputStream()
            extra = rows.select(keep) if keep else rows.select(["doc_id"])
            with pa.ipc.new_stream(sink, extra.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(extra)
            data = np.frombuffer(b"".join(texts), np.uint8)
            blob = pack(ids_of(rows.column("doc_id")), sizes, data, level=3)
            return pa.record_batch([pa.array([number]), pa.array([blob], pa.binary()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "texts", "extra"])

        for batch in batches:
            sizes = np.cumsum(batch.column("text").cast(pa.binary()).to_pandas().str.len().to_numpy(np.int64))
            start = 0
            while start < batch.num_rows:
                done = int(sizes[start - 1]) if start else 0
                stop = int(np.searchsorted(sizes, done + size - total)) + 1
                part = batch.slice(start, stop - start)
                held.append(part)
                total += int(sizes[min(stop, batch.num_rows) - 1]) - done
                start = stop
                if total >= size:
                    yield block()
                    number, held, total = number + 1, [], 0
        if held:
            yield block()

    name = f"millrace_blocks_{uuid.uuid4().hex}"
    (
        docs.select("doc_id", "text", *[c for c in keep if c not in ("doc_id", "text")])
        .mapInArrow(lean(fill), "block bigint, texts binary, extra binary")
        .write.bucketBy(partitions(spark), "block")
        .option("path", new_dir(spark, "blocks"))
        .option("compression", "none")
        .saveAsTable(name)
    )
    return spark.table(name)


def with_replies(blocks: DataFrame, replies: DataFrame) -> DataFrame:
    """Blocks with ``replies``: the array of their (bucket, blob) answers, null if there are none."""
    gathered = replies.groupBy("block").agg(F.collect_list(F.struct("bucket", "blob")).alias("replies"))
    return blocks.join(gathered, "block", "left")


def read_block(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc_ids, bounds, bytes) of a block; document i has bytes bounds[i]:bounds[i + 1]."""
    ids, sizes, data = unpack(blob)
    return ids, np.concatenate([[0], np.cumsum(sizes)]), data


def read_extra(blob: bytes) -> pa.Table:
    with pa.ipc.open_stream(blob) as stream:
        return stream.read_all()
