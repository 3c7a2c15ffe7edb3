"""Alignment of two tokenizers' tokens over the same bytes, by diagonal run skipping.

Both tokenizers cut the bytes of space + text. Where a token of A and a token of B end at the same byte,
a group ends. Walking both arrays of ends, the current shift (index in B less index in A) stays as it is
as long as the tokens correspond one to one: exponential probing compares growing slices of the two arrays at
that shift, then halves the last one, and jumps the stretch. Where they differ, the irregular group is
closed by stepping the array that lies behind, which gives the next shift.

Links join the last tokens of a group. How often an id pair is linked in the whole corpus needs all
documents: blocks of documents send their distinct pairs with counts to hash buckets of pairs, which send
the totals back. The highest count of each B id is a table bounded by B's vocabulary. Texts are read once,
and each worker encodes a unit (what stands between two single spaces) once as long as its store holds it.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.blocks import with_replies
from millrace.llm.columns import bound_batches, id_and_text, ids_to_arrow, kept_in_worker, let_go, mix, pack, partitions, rows_by_size, table, unpack
from millrace.plans.scratch import stored

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"

SLICE = 1 << 20  # bytes of text whose units are looked up together
SEGMENT = 1 << 16  # characters of a text aligned together, if it has a place to cut
JOINED = 500  # units encoded as one string
STORED_UNITS = 1_000_000  # units kept with their ids per worker process
BLOCK_LINKS = 1 << 22  # links whose id pairs are combined before they are sent
SUMMED = 1 << 18  # links of whole documents summed at a time

# A single space between two characters that are not white space begins a new unit for both kinds of tokenizers:
# what lies before it is encoded as if nothing followed. Limited to characters about which all libraries agree.
_CUT = re.compile("(?<=[!-~À-ɏ]) (?=[!-~À-ɏ])")
_LATIN = re.compile("[\x00-ɏ]*")
_WHOLE = re.compile("[!-~À-ɏ](?:.*[!-~À-ɏ])?", re.DOTALL)


NEAR = 4  # ends compared one by one before slices are


def align(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int]]:
    """Indexes of the last token of each group, in A and in B; both lists ascend strictly."""
    last_a: list[int] = []
    last_b: list[int] = []
    add_a, add_b = last_a.append, last_b.append
    i = j = 0
    n, m = len(ends_a), len(ends_b)
    while i < n and j < m:
        a, b = ends_a[i], ends_b[j]
        if a != b:  # an irregular group: step the one behind until both end together
            while a != b:
                if a < b:
                    i += 1
                    if i == n:
                        return last_a, last_b
                    a = ends_a[i]
                else:
                    j += 1
                    if j == m:
                        return last_a, last_b
                    b = ends_b[j]
            add_a(i)
            add_b(j)
            i += 1
            j += 1
            continue
        run, limit = 1, min(n - i, m - j)
        while run < limit and run < NEAR and ends_a[i + run] == ends_b[j + run]:
            run += 1
        if run == 1:
            add_a(i)
            add_b(j)
            i += 1
            j += 1
            continue
        step = NEAR if run == NEAR else 0
        while step and run < limit:  # probe further and further at this shift
            step = min(step, limit - run)
            if ends_a[i + run : i + run + step] != ends_b[j + run : j + run + step]:
                break
            run += step
            step *= 2
        else:
            step = 0
        while step > 1:  # the stretch ends within the last probe
            half = step // 2
            if ends_a[i + run : i + run + half] == ends_b[j + run : j + run + half]:
                run += half
                step -= half
            else:
                step = half
        last_a.extend(range(i, i + run))
        last_b.extend(range(j, j + run))
        i += run
        j += run
    return last_a, last_b


def _byte_values() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a printable character: itself, or the next one from 256 up."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


class Pair:
    """Both tokenizers, the bytes of their entries and the written form of their ids."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one task per core already
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # a special token's string in a text is ordinary text
        self.b = SentencePieceProcessor(model_file=path_b)
        values = _byte_values()
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.bytes_a[i] = bytes(values[c] for c in entry) if all(c in values for c in entry) else entry.encode()
        self.bytes_b = []
        joining = False
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            joining |= re.search("[^▁]▁", piece) is not None
            self.bytes_b.append(bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.size_a = np.fromiter(map(len, self.bytes_a), np.int64)
        self.size_b = np.fromiter(map(len, self.bytes_b), np.int64)
        if not self.size_b.all():
            raise ValueError(f"{path_b}: an empty entry has no end of its own")
        # A text may only be cut into units if A splits before such a space and no entry of B reaches over one.
        rules = json.loads(self.a.to_str())
        first = rules["pre_tokenizer"] or {}
        self.cuts = not joining and rules["normalizer"] is None and first.get("type") == "ByteLevel" and first["use_regex"] and not first["add_prefix_space"]
        self.quick = self._quick(rules["model"]) if self.cuts else None
        self.known_a: dict[str, bytes | None] = {}
        self.known_b: dict[str, bytes | None] = {}
        # Ids as written in a group: followed by "," or by what closes their half of it.
        self.shown = [f"{i}{end}".encode() for last, size in (("|", len(self.bytes_a)), (";", len(self.bytes_b))) for end in (",", last) for i in range(size)]

    def _quick(self, model: dict):
        """An encoder of A's vocabulary that is about three times as fast, if the file's merges go by its ids."""
        from tiktoken import Encoding

        vocabulary = model["vocab"]
        merges = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        merged = [vocabulary[a + b] for a, b in merges]
        if model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges") or merged != sorted(merged) or len(merged) + 256 != len(vocabulary) - self._special(vocabulary):
            return None
        ranks = {self.bytes_a[i]: i for entry, i in vocabulary.items() if i not in self.a.get_added_tokens_decoder()}
        return Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _special(self, vocabulary: dict[str, int]) -> int:
        return sum(i in vocabulary.values() for i in self.a.get_added_tokens_decoder())

    def _ids_of_a(self, text: str) -> list[int]:
        # About the classes of these characters both libraries agree; others go to the tokenizer itself.
        if self.quick and _LATIN.fullmatch(text):
            return self.quick.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def _segments(self, texts: list[bytes]) -> Iterator[tuple[int, int, list[str]]]:
        """(text, characters, units) of every segment of every text that is not empty, in order."""
        for i, text in enumerate(x.decode() for x in texts):
            begin = 0
            while begin < len(text):
                found = _CUT.search(text, begin + SEGMENT) if self.cuts and len(text) - begin > SEGMENT else None
                end = found.start() if found else len(text)
                yield i, end - begin, _CUT.split(text[begin:end]) if self.cuts else [text]
                begin = found.end() if found else end

    def _learn(self, units: set[str]) -> None:
        """Encode the units that are not stored yet; when the store is full it starts anew with these."""
        new = units.difference(self.known_a)
        if len(self.known_a) + len(new) > STORED_UNITS:
            self.known_a.clear()
            self.known_b.clear()
            new = units
        # Units that begin and end as at a cut are encoded many in a string, as they are in a text.
        plain = list(filter(_WHOLE.fullmatch, new))
        groups = [plain[i : i + JOINED] for i in range(0, len(plain), JOINED)]
        groups += [[u] for u in new.difference(plain)]
        while groups:
            groups = [[u] for group in groups if not self._store(group) for u in group]

    def _store(self, units: list[str]) -> bool:
        """Store the ids of some units as bytes, or the fact that a tokenizer changes a lone one; False to try them one by one."""
        text = " ".join(units)
        whole = f" {text}".encode()
        ids_a = self._ids_of_a(f" {text}")
        ids_b = self.b.encode(text)
        same = b"".join([self.bytes_a[x] for x in ids_a]) == whole == b"".join([self.bytes_b[x] for x in ids_b])
        if not same and len(units) > 1:
            return False
        ends = np.cumsum([len(u.encode()) + 1 for u in units])
        for ids, sizes, known in ((ids_a, self.size_a, self.known_a), (ids_b, self.size_b, self.known_b)):
            if not same:
                known[units[0]] = None
                continue
            ids = np.array(ids, "<i4")
            raw = ids.tobytes()
            cuts = [0, *(4 * (np.searchsorted(np.cumsum(sizes[ids]), ends) + 1)).tolist()]
            known.update((u, raw[a:b]) for u, a, b in zip(units, cuts, cuts[1:]))
        return True

    def _aligned(self, batch: list[tuple[int, list[str]]]) -> Iterator[tuple]:
        self._learn(set().union(*(units for _, units in batch)))
        for i, units in batch:
            found = list(map(self.known_a.__getitem__, units))
            if None in found:
                yield i, None
                continue
            a = np.frombuffer(b"".join(found), "<i4").astype(np.int64)
            b = np.frombuffer(b"".join(map(self.known_b.__getitem__, units)), "<i4").astype(np.int64)
            last = align(np.cumsum(self.size_a[a]).tolist(), np.cumsum(self.size_b[b]).tolist())
            yield i, (a, b, np.array(last[0], np.int64), np.array(last[1], np.int64))

    def segments(self, texts: list[bytes]) -> Iterator[tuple]:
        """(text, (ids of A, ids of B, last tokens of each group in A, in B)) for each segment of UTF-8 texts, in order.

        None in place of the arrays says that a tokenizer's bytes are not those of space + text. A cut is an
        end in both tokenizers, so no group reaches over it.
        """
        batch, size = [], 0
        for i, chars, units in self._segments(texts):
            batch.append((i, units))
            size += chars
            if size >= SLICE:
                yield from self._aligned(batch)
                batch, size = [], 0
        yield from self._aligned(batch)

    def encode(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """The four arrays of each whole text: all empty for an empty text and where bytes differ."""
        parts: list[list | None] = [[] for _ in texts]
        for i, found in self.segments(texts):
            if found is None:
                parts[i] = None
            elif parts[i] is not None:
                parts[i].append(found)
        out = []
        for own in parts:
            own = own or [(np.zeros(0, np.int64),) * 4]
            before = [np.cumsum([0, *(x[k].size for x in own[:-1])]) for k in (0, 1)]
            out.append((*(np.concatenate([x[k] for x in own]) for k in (0, 1)), *(np.concatenate([x[k + 2] + n for x, n in zip(own, before[k])]) for k in (0, 1))))
        return out

    def written(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> bytes:
        """Groups as ``a1,a2|b1;a3|b2,b3``."""
        if not last_a.size:
            return b""
        known = len(self.bytes_a)
        code_a, code_b = a.copy(), b + 2 * known
        code_a[last_a] += known
        code_b[last_b] += len(self.bytes_b)
        counts_a, counts_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        order = np.empty(a.size + b.size, np.int64)
        # A token of group g stands behind the B tokens of earlier groups, one of B behind A's of its own too.
        order[np.arange(a.size) + np.repeat(last_b + 1 - counts_b, counts_a)] = code_a
        order[np.arange(b.size) + np.repeat(last_a + 1, counts_b)] = code_b
        shown = self.shown
        return b"".join(map(shown.__getitem__, order.tolist()))[:-1]


@kept_in_worker
def tokenizer_pair(path_a: str, path_b: str) -> Pair:
    """One pair per worker process and files."""
    return Pair(path_a, path_b)


def _sums(values: np.ndarray, place: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per document the sum of values[place] over its links, bounds[i] to bounds[i + 1]; some documents at a time."""
    out = np.zeros(bounds.size - 1, np.int64)
    begin = 0
    while begin < out.size:
        end = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + SUMMED, "right")) - 1)
        own = np.cumsum(values[place[bounds[begin] : bounds[end]]], dtype=np.int64)
        out[begin:end] = np.diff(np.concatenate([[0], own])[bounds[begin : end + 1] - bounds[begin]])
        begin = end
    return out


def alignments(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, ids_a, ids_b, last_a, last_b per document: ids, and the index of each group's last token in both.

    Null and empty texts, and texts that a tokenizer changes, have empty arrays. Rows are treated one by one, so
    null and repeated doc_ids need no care; other columns are not read.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(path_a, path_b)
        for ids, texts in rows_by_size(batches, SLICE):
            found = pair.encode(texts)
            arrays = [pa.array([x[k].astype(np.int32) for x in found], pa.list_(pa.int32())) for k in range(4)]
            yield pa.record_batch([ids_to_arrow(ids), *arrays], ["doc_id", "ids_a", "ids_b", "last_a", "last_b"])

    return id_and_text(docs).mapInArrow(rows, "doc_id bigint, ids_a array<int>, ids_b array<int>, last_a array<int>, last_b array<int>")


def _linked(docs: DataFrame, path_a: str, path_b: str, buckets: int) -> DataFrame:
    """(block, bucket, blob): documents with the places of their links' pairs (bucket -1), and each block's pairs by bucket."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        held: list[tuple[int, int, int, bytes]] = []
        links: list[np.ndarray] = []
        total = 0

        def block() -> pa.RecordBatch:
            doc_ids, n_a, n_b, _ = zip(*held)
            sizes = np.fromiter(map(len, links), np.int64, len(links))
            digests = np.frombuffer(b"".join(x[3] for x in held), np.uint8)
            pairs, place, counts = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
            own = pack(np.array(doc_ids, np.int64), np.array(n_a, np.int64), np.array(n_b, np.int64), sizes, digests, place.astype(np.uint32))
            bucket = (mix(pairs) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1)) if order.size else np.zeros(1, np.int64)
            spans = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
            blobs = [own, *(pack(pairs[s], counts[s]) for s in spans)]
            keys = [-1, *(int(bucket[s[0]]) for s in spans)]
            return pa.record_batch([pa.array([number] * len(keys)), pa.array(keys, pa.int32()), pa.array(blobs, pa.binary())], ["block", "bucket", "blob"])

        for ids, texts in rows_by_size(batches, SLICE):
            counts = np.zeros((len(texts), 2), np.int64)
            digests = [hashlib.sha256() for _ in texts]
            own: list[list[np.ndarray] | None] = [[] for _ in texts]
            for i, found in pair.segments(texts):
                if found is None:
                    own[i] = None
                if own[i] is None:
                    continue
                a, b, last_a, last_b = found
                digests[i].update((b";" if own[i] else b"") + pair.written(a, b, last_a, last_b))
                own[i].append((a[last_a].astype(np.uint64) << np.uint64(32)) | b[last_b].astype(np.uint64))
                counts[i] += a.size, b.size
            for doc_id, count, digest, found in zip(ids.tolist(), counts.tolist(), digests, own):
                held.append((doc_id, *(count if found else (0, 0)), digest.digest()))
                links.append(np.concatenate(found or [np.zeros(0, np.uint64)]))
                total += links[-1].size + 1
                if total >= BLOCK_LINKS:
                    yield block()
                    number, total = number + 1, 0
                    held.clear()
                    links.clear()
        if held:
            yield block()

    return id_and_text(docs).mapInArrow(rows, "block bigint, bucket int, blob binary")


def _totals(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
    """Answers to the blocks of one bucket: their pairs with counts over all blocks; and each B id's highest (block -1).

    A bucket holds the distinct pairs of a share of the hash range, each once per block, so a pair that
    holds a third of all links weighs as much as any other.
    """
    let_go()
    blocks = group.column("block").to_pylist()
    parts = [unpack(x) for x in group.column("blob").to_pylist()]
    pairs, place = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
    totals = np.zeros(pairs.size, np.int64)
    np.add.at(totals, place, np.concatenate([c for _, c in parts]))
    ids, own = np.unique(pairs & np.uint64(0xFFFFFFFF), return_inverse=True)
    highest = np.zeros(ids.size, np.int64)
    np.maximum.at(highest, own, totals)
    blobs = [pack(p, totals[np.searchsorted(pairs, p)]) for p, _ in parts]
    blobs.append(pack(ids.astype(np.int64), highest))
    size = len(blobs)
    return pa.table({"block": pa.array([*blocks, -1], pa.int64()), "bucket": pa.array([key[0].as_py()] * size, pa.int32()), "blob": pa.array(blobs, pa.binary())})


def _highest(answers: DataFrame, size: int) -> np.ndarray:
    """The highest count of each B id; what reaches the driver has at most one row per entry of B's vocabulary."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("blob").to_pylist():
                ids, counts = unpack(blob)
                yield pa.record_batch([pa.array(ids), pa.array(counts)], ["id", "n"])

    found = answers.where("block = -1").select("blob").mapInArrow(rows, "id bigint, n bigint").groupBy("id").agg(F.max("n").alias("n")).collect()
    out = np.zeros(size, np.int64)
    for r in found:
        out[r.id] = r.n
    return out


def link_statistics(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and the digest of its groups.

    Null and empty texts, and texts that a tokenizer changes, have zeros and an empty digest. Rows are documents
    of their own, whatever their doc_id; an empty table gives an empty result; other columns are not read. A
    text is aligned in segments, so of a long one a task holds the text and its links besides one segment.
    """
    spark = docs.sparkSession
    bound_batches(spark)  # a batch is whole rows, and the rows of the last step are blocks with all their answers
    buckets = partitions(spark)
    blocks = stored(_linked(docs, path_a, path_b, buckets), "links")
    asked = blocks.where("bucket >= 0")
    answers = stored(asked.groupBy("bucket").applyInArrow(_totals, "block bigint, bucket int, blob binary"), "link-counts")
    shared = spark.sparkContext.broadcast(_highest(answers, _entries(path_b)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        highest = shared.value
        for batch in batches:
            for blob, replies in zip(batch.column("blob").to_pylist(), batch.column("replies").to_pylist()):
                doc_ids, n_a, n_b, sizes, digests, place = unpack(blob)
                known = [unpack(r["blob"]) for r in replies or []]
                pairs = np.concatenate([np.zeros(0, np.uint64), *(p for p, _ in known)])
                order = np.argsort(pairs)
                totals = np.concatenate([np.zeros(0, np.int64), *(c for _, c in known)])[order]
                best = totals == highest[(pairs[order] & np.uint64(0xFFFFFFFF)).astype(np.int64)]
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                sums = [_sums(x, place, bounds) for x in (best, totals)]
                texts = [digests[32 * i : 32 * i + 32].tobytes().hex() if sizes[i] else "" for i in range(sizes.size)]
                yield pa.record_batch(
                    [ids_to_arrow(doc_ids), *(pa.array(x) for x in (n_a, n_b, sizes, sizes, *sums)), pa.array(texts, pa.string())],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
                )

    documents = blocks.where("bucket = -1").select("block", "blob")
    return with_replies(documents, answers.where("block >= 0")).select("blob", "replies").mapInArrow(
        rows, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    )


def _entries(path: str) -> int:
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path).get_piece_size()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_statistics(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER_A), public_tokenizers.path(TOKENIZER_B))
