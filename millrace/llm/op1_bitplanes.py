"""Token-id files of bit planes: fixed-size blocks of ids, transposed and compressed plane by plane.

File format. The ids of all documents, in ascending doc_id order, are one long sequence. It is cut
into shards (ranges of doc_id), each shard into blocks of ``block`` ids; only a shard's last block is
shorter. A block is one frame::

    magic "BPL1" | planes u8 | bits per plane u8 (1 or 8) | ids u32 | documents u32
    | compressed size of each plane u32 ... | compressed size of the document part u32
    | planes, each a zstandard frame | document part, a zstandard frame

Plane k holds bit (or byte) k of every id, so the high planes of small ids are nearly constant. The
document part lists doc_id i64, null flag, place of the piece in its document i64 and its length u32, for
each document that has ids in the block. Frames are the ``frame`` column of a Parquet table, which makes
them readable from any store and gives commits that survive lost executors. Beside it stands the chunk
index: shard, block, global start, ids, documents and bytes of every frame.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.columns import NULL_ID, id_and_text, ids_of, ids_to_arrow, table
from millrace.llm.tokens import encoded
from millrace.plans.scratch import new_dir

BLOCK = 1 << 16
END_ID = 2
TOKENIZER = "word_bpe_49k.json"
_MAGIC = b"BPL1"
_HEAD = struct.Struct("<4sBBII")


@dataclass(frozen=True)
class TokenFile:
    """Where a token file lies: its frames, and the chunk index beside them."""

    frames: str
    index: str


def to_frame(ids: np.ndarray, docs: np.ndarray, places: np.ndarray, sizes: np.ndarray, bits: int = 8, level: int = 3) -> bytes:
    """One block as bytes; ``bits`` is 1 for bit planes, 8 for byte planes."""
    if bits not in (1, 8):
        raise ValueError("planes hold 1 or 8 bits of each id")
    octets = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)
    if bits == 8:
        planes = [octets[:, k] for k in range(4)]
    else:
        planes = [np.packbits((octets[:, k // 8] >> np.uint8(k % 8)) & np.uint8(1)) for k in range(32)]
    while planes and not planes[-1].any():  # planes above the largest id
        planes.pop()
    pack = zstandard.ZstdCompressor(level=level).compress
    parts = [pack(np.ascontiguousarray(p).tobytes()) for p in planes]
    listed = docs.astype("<i8").tobytes() + places.astype("<i8").tobytes() + sizes.astype("<u4").tobytes()
    parts.append(pack(listed))
    head = _HEAD.pack(_MAGIC, len(planes), bits, ids.size, docs.size)
    return head + b"".join(len(p).to_bytes(4, "little") for p in parts) + b"".join(parts)


def from_frame(frame: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, doc_ids, places, sizes) of a block."""
    magic, count, bits, n, docs = _HEAD.unpack_from(frame)
    if magic != _MAGIC:
        raise ValueError("not a block of this format")
    sizes = np.frombuffer(frame, "<u4", count + 1, _HEAD.size)
    at = _HEAD.size + 4 * (count + 1)
    parts = []
    for size in sizes.tolist():
        parts.append(zstandard.ZstdDecompressor().decompress(frame[at : at + size]))
        at += size
    octets = np.zeros((n, 4), np.uint8)
    for k, part in enumerate(parts[:-1]):
        raw = np.frombuffer(part, np.uint8)
        if bits == 8:
            octets[:, k] = raw
        else:
            octets[:, k // 8] |= np.unpackbits(raw, count=n) << np.uint8(k % 8)
    listed = parts[-1]
    return (
        octets.reshape(-1).view("<u4"),
        np.frombuffer(listed, "<i8", docs),
        np.frombuffer(listed, "<i8", docs, 8 * docs),
        np.frombuffer(listed, "<u4", docs, 16 * docs),
    )


def _shards(docs: DataFrame, count: int) -> list[int]:
    """At most ``count`` - 1 ascending doc_ids that cut the table into ranges of similar row counts.

    An approximate quantile of the id column alone; where the cuts fall affects balance, not results.
    """
    if count < 2:
        return []
    found = docs.select("doc_id").where(F.col("doc_id").isNotNull()).approxQuantile(
        "doc_id", [i / count for i in range(1, count)], 0.2 / count
    )
    return sorted({int(x) for x in found})


def write_tokens(
    docs: DataFrame, path: str, end_id: int = END_ID, block: int = BLOCK, bits: int = 8, shards: int | None = None
) -> TokenFile:
    """Write the ids of all documents, each followed by ``end_id``, as a token file; returns its place.

    ``docs`` has doc_id and text. Null text is the empty text (its ids are the end id alone); a null
    doc_id sorts last; rows with one doc_id stay apart, ordered by text; other columns are not read; an
    empty table gives a file without blocks. Texts are encoded where they are read; only ids are
    shuffled, to one group per shard, and each task streams its shard's rows, so it holds a block and
    a batch of documents and no more.
    """
    spark = docs.sparkSession
    docs = id_and_text(docs)
    if shards is None:
        shards = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = _shards(docs, shards)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array(cuts, np.int64)
        for rows, ids in encoded(batches, path, end_id):
            keys = ids_of(rows.column("doc_id"))
            shard = pa.array(np.searchsorted(edges, keys, "left"), pa.int32())
            blobs = pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())
            null = pa.array(keys == NULL_ID)
            yield pa.record_batch([shard, null, pa.array(keys, pa.int64()), blobs], ["shard", "last", "doc_id", "ids"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = -1, 0
        ids: list[np.ndarray] = []
        listed: list[tuple[int, int, int]] = []
        held = 0

        def frame() -> pa.RecordBatch:
            docs, places, sizes = (np.array(x, np.int64) for x in zip(*listed))
            data = to_frame(np.concatenate(ids), docs, places, sizes, bits)
            return pa.record_batch(
                [pa.array([x], t) for x, t in ((shard, pa.int32()), (number, pa.int64()), (held, pa.int64()), (len(listed), pa.int64()), (len(data), pa.int64()), (data, pa.binary()))],
                ["shard", "block", "n_ids", "n_docs", "n_bytes", "frame"],
            )

        for batch in batches:
            for s, key, blob in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "ids"))):
                if s != shard:
                    if held:
                        yield frame()
                    shard, number, ids, listed, held = s, 0, [], [], 0
                rest = np.frombuffer(blob, "<u4")
                place = 0
                while rest.size:
                    part = rest[: block - held]
                    ids.append(part)
                    listed.append((key, place, part.size))
                    held, place, rest = held + part.size, place + part.size, rest[part.size :]
                    if held == block:
                        yield frame()
                        number, ids, listed, held = number + 1, [], [], 0
        if held:
            yield frame()

    out = new_dir(spark, "tokens")
    made = TokenFile(f"{out}/frames", f"{out}/index")
    (
        docs.mapInArrow(encode, "shard int, last boolean, doc_id bigint, ids binary")
        .repartition("shard")
        .sortWithinPartitions("shard", "doc_id", "last", "ids")
        .select("shard", "doc_id", "ids")
        .mapInArrow(cut, "shard int, block bigint, n_ids bigint, n_docs bigint, n_bytes bigint, frame binary")
        .write.option("compression", "none")
        .parquet(made.frames)
    )
    frames = spark.read.parquet(made.frames)
    # One row per shard; their number is a setting, so this window over all of them stays small.
    totals = frames.groupBy("shard").agg(F.sum("n_ids").alias("total")).selectExpr(
        "shard", "coalesce(sum(total) OVER (ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS before"
    )
    within = "coalesce(sum(n_ids) OVER (PARTITION BY shard ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L)"
    (
        frames.select("shard", "block", "n_ids", "n_docs", "n_bytes")
        .join(totals, "shard")
        .selectExpr("shard", "block", f"before + {within} AS start", "n_ids", "n_docs", "n_bytes")
        .write.parquet(made.index)
    )
    return made


def crc32_joined(first: int, second: int, length: int) -> int:
    """crc32 of two byte strings in a row, from theirs and the second's length (squaring of the shift matrix)."""

    def times(matrix: list[int], vector: int) -> int:
        out = 0
        for row in matrix:
            if not vector:
                break
            if vector & 1:
                out ^= row
            vector >>= 1
        return out

    shift = [0xEDB88320, *(1 << n for n in range(31))]  # one zero bit appended
    for _ in range(3):
        shift = [times(shift, row) for row in shift]
    while length:  # shift now appends 2**k zero bytes
        if length & 1:
            first = times(shift, first)
        shift = [times(shift, row) for row in shift]
        length >>= 1
    return first ^ second


def read_tokens(spark: SparkSession, file: TokenFile) -> DataFrame:
    """Pieces of documents read back: shard, block, doc_id, start, place, length, ids (one row per document and block).

    ``start`` is the global place of the piece's document: the ids of all documents before it.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["shard", "block", "doc_id", "start", "place", "length", "ids"]
        for batch in batches:
            for shard, number, start, frame in zip(*(batch.column(c).to_pylist() for c in ("shard", "block", "start", "frame"))):
                ids, docs, places, sizes = from_frame(frame)
                ends = np.cumsum(sizes.astype(np.int64))
                begins = ends - sizes
                blobs = [ids[a:b].tobytes() for a, b in zip(begins.tolist(), ends.tolist())]
                yield pa.record_batch(
                    [pa.array(np.full(docs.size, shard), pa.int32()), pa.array(np.full(docs.size, number), pa.int64()), ids_to_arrow(docs), pa.array(start + begins - places), pa.array(places, pa.int64()), pa.array(sizes.astype(np.int64)), pa.array(blobs, pa.binary())],
                    names,
                )

    index = spark.read.parquet(file.index).select("shard", "block", "start")
    frames = spark.read.parquet(file.frames).select("shard", "block", "frame")
    return frames.join(index, ["shard", "block"]).mapInArrow(
        parse, "shard int, block bigint, doc_id bigint, start bigint, place bigint, length bigint, ids binary"
    )


def token_digests(spark: SparkSession, file: TokenFile) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the file.

    A document's pieces are digested where they are read and only the digests are joined, so a
    document of any length needs no gathering of its ids.
    """

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = batch.column("one").to_numpy(zero_copy_only=False).copy()
            many = np.flatnonzero(batch.column("n_pieces").to_numpy(zero_copy_only=False) > 1)
            for i, parts in zip(many.tolist(), batch.column("parts").take(pa.array(many)).to_pylist()):  # a part per block, a handful at most for ordinary documents
                whole = 0
                for part in sorted(parts, key=lambda p: p["place"]):
                    whole = crc32_joined(whole, part["crc"], 4 * part["length"])
                crc[i] = whole
            yield pa.record_batch([batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    pieces = read_tokens(spark, file).withColumn("crc", F.crc32("ids")).drop("ids")
    whole = (
        pieces.groupBy("shard", "start")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.sum("length").alias("n_tokens"),
            F.count("*").alias("n_pieces"),
            F.first("crc").alias("one"),
            F.collect_list(F.struct("place", "length", "crc")).alias("parts"),
        )
    )
    parts = F.when(F.col("n_pieces") > 1, F.col("parts")).alias("parts")
    return whole.select("doc_id", "start", "n_tokens", "n_pieces", "one", parts).mapInArrow(chained, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through a byte-plane token file; digests are of what was read back."""
    file = write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return token_digests(spark, file)
