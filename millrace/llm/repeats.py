"""Which windows of a corpus occur more than once: local sampling, then naming of what is left.

A window is ``width`` consecutive units (bytes or words) of one document; a gram is its first ``gram``
units' hash. Every window has an anchor: its smallest gram, leftmost among equals. Equal windows have
equal anchors at equal places, so windows can be compared anchor by anchor:

1. Each block of documents sends the hashes of its anchors (once each) to buckets; a bucket
   answers which of them occur elsewhere too. Unique ones drop out, and with them their windows.
2. Each block sends the windows of the remaining anchors, whose name is the pair of the ranks of
   their first and last gram (they overlap, so the pair stands for the whole window), to the
   anchor's bucket. The bucket sorts them by name and document and answers which are repeats.

Inside a block a run of windows that another document of the block has too is sent once. Runs at the ends
of a shared passage hold its context too, so each occurrence sends its own. Buckets hold packed arrays and are as many
as Spark's shuffle partitions; nothing passes through the driver. Names are 64-bit hashes that only meet
inside one anchor's 64-bit hash, 128 bits together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.blocks import read_block, with_replies
from millrace.llm.columns import lean, lean_group, mix, pack, partitions, unpack

SLICE = 1 << 18  # units worked on at once; a longer document is a slice of its own
JUDGED = 250_000  # windows sorted at once
SENT = 1 << 20  # bytes in a batch of windows
_SENT = "block bigint, bucket int, blob binary"


@dataclass(frozen=True)
class Units:
    """How an operator sees its documents.

    ``grams(data, bounds)`` gives the gram hashes and the documents' bounds in units. ``content``
    says that windows are sent as their bytes (and named by the receiver) instead of by names.
    ``same_document`` counts repeats inside one document.
    """

    grams: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
    width: int
    gram: int
    content: bool
    same_document: bool

    def names(self, grams: np.ndarray, at: np.ndarray) -> np.ndarray:
        return mix(grams[at] * np.uint64(3) + grams[at + (self.width - self.gram)])


def leftmost_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the smallest of each ``width`` consecutive values, the leftmost among equals."""
    at = np.arange(values.size, dtype=np.int64 if values.size > 1 << 31 else np.int32)
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        later = values[step:] < values[:-step]
        values = np.where(later, values[step:], values[:-step])
        at = np.where(later, at[step:], at[:-step])
        reach += step
    return at


@dataclass
class Runs:
    """Runs of windows with one anchor: hash of the anchor, document, first window, number of windows.

    ``doc`` counts documents inside the block, ``start`` units inside it. ``first`` and ``last``
    name the outer windows, which overlap and so stand for the run's content.
    """

    key: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    count: np.ndarray
    first: np.ndarray
    last: np.ndarray


def slices(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of documents with about SLICE bytes each."""
    begin = 0
    while begin < bounds.size - 1:
        end = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + SLICE, "right")) - 1)
        yield begin, end
        begin = end


def runs_of(units: Units, bounds: np.ndarray, data: np.ndarray) -> tuple[Runs, np.ndarray, list[np.ndarray]]:
    """Runs of a block, its documents' bounds in units, and the names of all windows of the runs (if not ``content``)."""
    found: list[tuple[np.ndarray, ...]] = []
    unit_bounds = [np.zeros(1, np.int64)]
    names: list[np.ndarray] = []
    base = 0
    for begin, end in slices(bounds):
        own = bounds[begin : end + 1] - bounds[begin]
        grams, places = units.grams(data[bounds[begin] : bounds[end]], own)
        unit_bounds.append(base + places[1:])
        sizes = np.maximum(np.diff(places) - units.width + 1, 0)
        total = int(sizes.sum())
        if total:
            owner = np.repeat(np.arange(sizes.size), sizes)
            windows = np.arange(total) + np.repeat(places[:-1] - (np.cumsum(sizes) - sizes), sizes)
            anchor = leftmost_minimum(grams, units.width - units.gram + 1)[windows]
            new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])]))
            count = np.diff(np.concatenate([new, [total]]))
            start = windows[new]
            if not units.content:
                names.append(units.names(grams, windows))
            found.append((grams[anchor[new]], owner[new] + begin, start + base, count, units.names(grams, start), units.names(grams, start + count - 1)))
        base += int(places[-1])
    if found:
        fields = [list(x) for x in zip(*found)][::-1]
        found.clear()
        runs = Runs(*(np.concatenate(fields.pop()) for _ in range(len(fields))))  # slices of a field go when it is joined
    else:
        none, zero = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        runs = Runs(none, zero, zero, zero, none, none)
    return runs, np.concatenate(unit_bounds), names


def _by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places of its keys), keeping the order inside a bucket."""
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)):
        yield int(b), order[cuts[b] : cuts[b + 1]]


def _batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    block, bucket, blob = zip(*rows) if rows else ((), (), ())
    return pa.record_batch([pa.array(block, pa.int64()), pa.array(bucket, pa.int32()), pa.array(blob, pa.binary())], ["block", "bucket", "blob"])


def _batches(rows: Iterator[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    """``rows`` in batches of about SENT bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2])
        if size >= SENT:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _squeeze(keys: np.ndarray) -> np.ndarray:
    """The upper 40 bits of ascending keys as differences, in byte planes (they compress to about 3 bytes a key)."""
    steps = np.diff(keys >> np.uint64(24), prepend=np.uint64(0))
    return np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].T).reshape(-1)


def _stretch(planes: np.ndarray) -> np.ndarray:
    octets = np.zeros((planes.size // 5, 8), np.uint8)
    octets[:, :5] = planes.reshape(5, -1).T
    return np.cumsum(octets.reshape(-1).view("<u8"), dtype=np.uint64)


def _grouped(doc_ids: np.ndarray, runs: Runs, same_document: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct anchor hashes, index of each run's hash, whether the block alone repeats it)."""
    order = np.argsort(runs.key, kind="stable")
    keys = runs.key[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]]) if keys.size else np.zeros(0, bool)
    begins = np.flatnonzero(new)
    inverse = np.empty(keys.size, np.int64)
    inverse[order] = np.cumsum(new) - 1
    ends = np.concatenate([begins[1:], [keys.size]]) - 1 if keys.size else begins
    docs = doc_ids[runs.doc[order]] if keys.size else doc_ids[:0]
    multi = begins != ends if same_document else docs[begins] != docs[ends]
    return keys[begins], inverse, multi


def find_repeats(blocks: DataFrame, units: Units) -> DataFrame:
    """(block, bucket, blob): blobs hold starts and ends of runs of windows that also occur earlier.

    Earlier means in a document with a smaller doc_id, or (``same_document``) at an earlier place of
    the documents in ascending doc_id order.
    """
    buckets = partitions(blocks.sparkSession)

    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, blob in zip(batch.column("block").to_pylist(), batch.column("texts").to_pylist()):
                ids, bounds, data = read_block(blob)
                runs, _, _ = runs_of(units, bounds, data)
                keys, _, multi = _grouped(ids, runs, units.same_document)
                yield _batch([(block, b, pack(_squeeze(keys[at]), np.packbits(multi[at]))) for b, at in _by_bucket(keys, buckets)])

    def answer(group: pa.Table) -> pa.Table:
        sent = [unpack(blob) for blob in group.column("blob").to_pylist()]
        keys = [_stretch(planes) for planes, _ in sent]
        multi = [np.unpackbits(bits, count=k.size) for (_, bits), k in zip(sent, keys)]
        _, inverse, counts = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        often = (counts >= 2) | (np.bincount(inverse, np.concatenate(multi), counts.size) > 0)
        cuts = np.cumsum([k.size for k in keys])[:-1]
        blobs = [np.packbits(x).tobytes() for x in np.split(often[inverse], cuts)]
        return group.set_column(2, "blob", pa.array(blobs, pa.binary()))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, blob, replies in zip(*(batch.column(c).to_pylist() for c in ("block", "texts", "replies"))):
                if replies:
                    yield from _batches(_sent_windows(units, buckets, block, blob, {r["bucket"]: r["blob"] for r in replies}))

    def judge(group: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_batch(_judged(units, group))])

    once = blocks.select("block", "texts").mapInArrow(lean(fingerprints), _SENT).groupBy("bucket").applyInArrow(lean_group(answer), _SENT)
    asked = with_replies(blocks.select("block", "texts"), once).mapInArrow(lean(windows), _SENT)
    return asked.groupBy("bucket").applyInArrow(lean_group(judge), _SENT)


def _sent_windows(units: Units, buckets: int, block: int, blob: bytes, replies: dict[int, bytes]) -> Iterator[tuple[int, int, bytes]]:
    ids, bounds, data = read_block(blob)
    runs, _, names = runs_of(units, bounds, data)
    keys, inverse, _ = _grouped(ids, runs, units.same_document)
    often = np.zeros(keys.size, bool)
    for b, at in _by_bucket(keys, buckets):
        often[at] = np.unpackbits(np.frombuffer(replies[b], np.uint8), count=at.size).astype(bool)
    kept = np.flatnonzero(often[inverse])
    # One run of equal windows is sent for the whole block: that of the earliest document.
    order = kept[np.lexsort((kept, runs.last[kept], runs.first[kept], runs.count[kept], runs.key[kept]))]
    fields = (runs.key, runs.count, runs.first, runs.last)
    new = np.ones(order.size, bool)
    new[1:] = np.logical_or.reduce([f[order[1:]] != f[order[:-1]] for f in fields])
    group = np.cumsum(new) - 1
    lead = order[new]
    doc = ids[runs.doc]
    again = order != lead[group] if units.same_document else doc[order] != doc[lead[group]]
    local, kept = order[again], np.sort(order[~again])
    # Marked by a first array of size 0: repeats that the block has settled itself.
    if local.size:
        local = np.sort(local)
        yield block, int(block % buckets), pack(np.zeros(0, np.uint64), runs.start[local], runs.count[local])
    flat = np.concatenate(names) if names else np.zeros(0, np.uint64)
    first = np.cumsum(runs.count) - runs.count
    for b, at in _by_bucket(runs.key[kept], buckets):
        own = kept[at]
        size = runs.count[own] + (units.width - 1 if units.content else 0)
        source = runs.start[own] if units.content else first[own]
        places = np.arange(int(size.sum())) + np.repeat(source - (np.cumsum(size) - size), size)
        content = data[places] if units.content else flat[places]
        yield block, b, pack(runs.key[own], np.diff(runs.start[own], prepend=0), runs.count[own].astype(np.int32), np.diff(doc[own], prepend=0), content)


def _judged(units: Units, group: pa.Table) -> list[tuple[int, int, bytes]]:
    blocks = group.column("block").to_pylist()
    settled: list[tuple[int, int, bytes]] = []
    source: list[np.ndarray] = []
    parts: list[tuple[np.ndarray, ...]] = []
    for i, blob in enumerate(group.column("blob").to_pylist()):
        arrays = unpack(blob)
        if len(arrays) == 3:
            settled.append((blocks[i], 0, pack(arrays[1], arrays[1] + arrays[2])))
            continue
        key, start, count, doc, content = arrays
        parts.append((key, np.cumsum(start), count.astype(np.int64), np.cumsum(doc), content))
        source.append(np.full(key.size, i))
    if not parts:
        return settled
    arrays = [np.concatenate(x) for x in zip(*parts)]
    del parts
    src = np.concatenate(source)
    # Equal windows have equal anchors, so a bucket can be judged in shares of its anchors.
    shares = -(-int(arrays[2].sum()) // JUDGED)
    share = ((arrays[0] >> np.uint64(17)) % np.uint64(max(shares, 1))).astype(np.int64)
    found = [_judged_share(units, np.array(blocks), src, *arrays, np.flatnonzero(share == i)) for i in range(shares)]
    owner, starts, ends = (np.concatenate(x) for x in zip(*found))
    by_owner = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[by_owner], np.arange(len(blocks) + 1))
    for i in np.flatnonzero(np.diff(cuts)):
        own = by_owner[cuts[i] : cuts[i + 1]]
        settled.append((blocks[i], 0, pack(starts[own], ends[own])))
    return settled


def _judged_share(units: Units, blocks: np.ndarray, src: np.ndarray, key: np.ndarray, start: np.ndarray, count: np.ndarray, doc: np.ndarray, content: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sender, first, end) of stretches of repeated windows among the runs ``own``."""
    size = count + (units.width - 1 if units.content else 0)
    begin = (np.cumsum(size) - size)[own]
    size, key, start, count, doc, src = (x[own] for x in (size, key, start, count, doc, src))
    content = content[np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)]
    begin = np.cumsum(size) - size
    order = np.lexsort((start, blocks[src], doc))
    repeated = count[order]
    at = np.arange(int(count.sum())) + np.repeat(begin[order] - (np.cumsum(repeated) - repeated), repeated)
    if units.content:
        grams, _ = units.grams(content, np.array([0, content.size]))
        names = units.names(grams, at)
    else:
        names = content[at]
    names = mix(names ^ np.repeat(key[order], repeated))
    sort = np.argsort(names, kind="stable")
    sorted_names = names[sort]
    new = np.concatenate([[True], sorted_names[1:] != sorted_names[:-1]])[: sort.size]
    lead = sort[new][np.cumsum(new) - 1]
    run = np.repeat(np.arange(order.size), repeated)
    again = np.empty(sort.size, bool)
    again[sort] = sort != lead if units.same_document else doc[order][run[sort]] > doc[order][run[lead]]
    # Windows of a run follow each other, so flagged ones are gathered into stretches.
    place = start[order][run] + (np.arange(run.size) - np.repeat(np.cumsum(repeated) - repeated, repeated))
    edge = np.diff(np.concatenate([[0], again.view(np.int8), [0]]))
    cut = np.concatenate([[True], run[1:] != run[:-1], [True]])
    starts = np.flatnonzero(again & ((edge[:-1] == 1) | cut[: run.size]))
    ends = np.flatnonzero(again & ((edge[1:] == -1) | cut[cut.size - run.size :]))
    return src[order][run[starts]], place[starts], place[ends] + 1


def covered(size: int, width: int, replies: list[dict] | None) -> np.ndarray:
    """Mask of the block's units that some repeated window covers; it takes a byte per unit, beside the stretches."""
    mask = np.zeros(size + 1, np.int8)
    sent = [unpack(reply["blob"]) for reply in replies or ()]
    if sent:
        starts, ends = (np.concatenate(x) for x in zip(*sent))
        order = np.argsort(starts, kind="stable")
        starts, ends = starts[order], np.maximum.accumulate(ends[order]) + width - 1
        # Stretches that overlap or touch become one, so that edges are steps of one.
        new = np.flatnonzero(np.concatenate([[True], starts[1:] > ends[:-1]])[: starts.size])
        mask[starts[new]] = 1
        mask[ends[np.append(new[1:], starts.size)[: new.size] - 1]] = -1
        np.cumsum(mask, dtype=np.int8, out=mask)
    return mask[:-1].view(bool)
