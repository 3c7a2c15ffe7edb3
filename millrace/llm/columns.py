"""Small helpers shared by the operators of this package: inputs, packed arrays, hashing."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import cache, wraps

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A null id sorts behind all others; inside packed arrays this number stands for it.
NULL_ID = np.iinfo(np.int64).max


# Bytes of one batch between Spark and a Python worker. Each batch exists several times at once (Arrow in the executor and
# in the worker, Python values, results), so Spark's default of 64 MB costs a task several hundred.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Batches of at most about BATCH_BYTES (one row may be larger), unless the session asks for fewer already."""
    unit = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    given = spark.conf.get(_BATCH_SETTING, "64m").strip().lower()
    digits = given.rstrip("bkmgi")
    size = int(digits) * unit[(given[len(digits) :] or "b")[0]]
    if not 0 < size <= BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def col(name: str, of: str | None = None) -> Column:
    """A column by its exact name, dots, spaces and backticks included; or that field of the struct ``of``."""
    quoted = "`" + name.replace("`", "``") + "`"
    return F.col(f"{of}.{quoted}" if of else quoted)


_KEPT: list = []


def kept_in_worker(make: Callable) -> Callable:
    """``functools.cache`` for what a worker process keeps from task to task, until a step calls ``let_go``."""
    made = cache(make)
    _KEPT.append(made)
    return made


def let_go() -> None:
    """Free what steps before keep in this worker process, such as tokenizers and stored words.

    Spark runs the tasks of all steps in the same worker processes. A step that needs none of it so has
    their memory; one that needs it again makes it anew.
    """
    if any(made.cache_info().currsize for made in _KEPT):
        for made in _KEPT:
            made.cache_clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    give_back()


try:
    # What numpy has freed stays with the process until the C library (glibc) is asked for it.
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError, TypeError):
    _trim = None


def give_back() -> None:
    """Hand memory that this process has freed back to the system."""
    if _trim:
        _trim(0)


def lean(step: Callable) -> Callable:
    """A step over batches that needs nothing kept in the worker: it begins without that and leaves no freed memory behind."""

    @wraps(step)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        yield from step(batches)
        let_go()

    return run


def lean_group(step: Callable) -> Callable:
    """``lean`` for a step over groups."""

    @wraps(step)
    def run(group: pa.Table) -> pa.Table:
        let_go()
        try:
            return step(group)
        finally:
            let_go()

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names and types; other columns are not read.

    Null text becomes the empty text here; operators that must tell the two apart do not use this.
    """
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def partitions(spark: SparkSession) -> int:
    """Buckets for a hand-made exchange: as many as Spark's own exchanges get."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ids_of(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def ids_to_arrow(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NULL_ID)


def pack(*arrays: np.ndarray, level: int = 1) -> bytes:
    """Arrays as one zstandard frame, with their dtypes and lengths in front."""
    head = ";".join(f"{a.dtype.str},{a.size}" for a in arrays).encode()
    body = b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    frame = len(head).to_bytes(4, "little") + head + body
    return zstandard.ZstdCompressor(level=level).compress(frame)


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    at = 4 + int.from_bytes(raw[:4], "little")
    arrays = []
    for item in raw[4:at].decode().split(";") if at > 4 else []:
        kind, size = item.split(",")
        arrays.append(np.frombuffer(raw, np.dtype(kind), int(size), at))
        at += arrays[-1].nbytes
    return arrays


def mix(a: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit (multiply and xor-shift)."""
    a = a * np.uint64(0x9E3779B97F4A7C15)
    a ^= a >> np.uint64(29)
    a *= np.uint64(0xBF58476D1CE4E5B9)
    a ^= a >> np.uint64(32)
    return a


def rows_by_size(
    batches: Iterator[pa.RecordBatch], limit: int
) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(doc_ids, UTF-8 texts) of whole documents, together about ``limit`` bytes; one document is never cut."""
    ids: list[np.ndarray] = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        batch_ids = ids_of(batch.column("doc_id"))
        values = batch.column("text").cast(pa.binary()).to_pylist()
        start = 0
        for i, value in enumerate(values):
            size += len(value)
            if size >= limit:
                ids.append(batch_ids[start : i + 1])
                texts.extend(values[start : i + 1])
                yield np.concatenate(ids), texts
                ids, texts, size, start = [], [], 0, i + 1
        ids.append(batch_ids[start:])
        texts.extend(values[start:])
    if texts:
        yield np.concatenate(ids), texts
