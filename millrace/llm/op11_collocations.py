"""Collocations: phrases of two and three words that occur often and whose words keep together, per language.

Counting every n-gram of a corpus takes a counter for each distinct one, and most occur once. A Misra-Gries
summary with k counters keeps every n-gram that occurs more than mass / (k + 1) times, and summaries merge
by adding counters and taking the (k+1)-th largest off all of them. So:

* First pass: each block of documents counts its own n-grams, and sends them by hash of the n-gram. A hash
  bucket adds up its mass and merges the blocks' counts in a summary whose capacity exceeds mass / threshold: whatever
  occurs ``threshold`` times in the corpus is among its survivors, whatever else there was.
* Second pass: the bucket goes through the same counts again and counts its survivors exactly.

Survivors that reach the threshold are sent to one block each that holds them, and come back as words.
Scores and the choice among phrases are joins and aggregates on those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.blocks import read_block, read_extra, store_blocks, with_replies
from millrace.llm.columns import mix, pack, partitions, table, unpack
from millrace.llm.words import ngram_hashes, word_hashes
from millrace.plans.scratch import stored

LONGEST = 3  # words in a phrase
THRESHOLD = 10  # occurrences of a candidate
COVERED = 50  # a phrase goes if a longer candidate holds it and has this percentage of its occurrences
TOP = 2000  # phrases reported for each language
SLICE = 4 << 20  # bytes of a block whose words are looked at together
SALTS = 64  # shares in which a language's phrases are ranked first

_WORD_ENDS = np.zeros(256, bool)
_WORD_ENDS[[0x20, 0x09]] = True
_PIECE_ENDS = np.zeros(256, bool)
_PIECE_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_ENDS = _WORD_ENDS | _PIECE_ENDS
_LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))
_SIZES = mix(np.arange(1, LONGEST + 2, dtype=np.uint64))


def _word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word."""
    edge = np.flatnonzero(np.diff(_ENDS[data], prepend=True, append=True))
    return edge[0::2], edge[1::2]


def _slices(data: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(begin, end, reach): words that start in begin..end belong to the slice, bytes up to reach hold the next words too."""
    begin = 0
    while begin < data.size:
        end, reach = begin + SLICE, data.size
        if end < data.size:  # on to the end of a word
            end = _next(data, end)
        end = min(end, data.size)
        if end < data.size:
            reach = end
            for _ in range(LONGEST - 1):
                reach = _next(data, _skip(data, reach))
        yield begin, end, reach
        begin = end


def _next(data: np.ndarray, at: int) -> int:
    """The first separator from ``at`` on."""
    return _first(data, at, True)


def _skip(data: np.ndarray, at: int) -> int:
    """The first byte of a word from ``at`` on."""
    return _first(data, at, False)


def _first(data: np.ndarray, at: int, ends: bool) -> int:
    step = 1 << 10
    while at < data.size:
        found = _ENDS[data[at : at + step]]
        place = int(found.argmax() if ends else found.argmin())
        if found[place] == ends:
            return at + place
        at, step = at + step, step * 2
    return data.size


class Grams:
    """The n-grams of one slice: for each n the places of their first words and their hashes, language included."""

    def __init__(self, data: np.ndarray, begin: int, end: int, reach: int, bounds: np.ndarray, codes: np.ndarray):
        self.data = data[begin:reach]
        self.starts, self.ends = _word_spans(self.data)
        own = int(np.searchsorted(self.starts, end - begin))
        hashes = word_hashes(self.data, self.starts, self.ends, lower=True)
        self.doc = np.searchsorted(bounds, self.starts + begin, side="right") - 1
        # Documents are joined by a line end, so a change of the piece number keeps them apart too.
        piece = np.cumsum(_PIECE_ENDS[self.data])[self.starts] if self.starts.size else np.zeros(0, np.int64)
        self.words = np.bincount(self.doc[:own], minlength=codes.size) if own else np.zeros(codes.size, np.int64)
        self.by_size: list[tuple[np.ndarray, np.ndarray]] = []
        for n in range(1, LONGEST + 1):
            count = min(own, hashes.size - n + 1)
            if count <= 0:
                self.by_size.append((np.zeros(0, np.int64), np.zeros(0, np.uint64)))
                continue
            first = np.flatnonzero(piece[:count] == piece[n - 1 : n - 1 + count])
            self.by_size.append((first, mix(ngram_hashes(hashes, n)[first] ^ codes[self.doc[first]] ^ _SIZES[n])))

    def phrase(self, first: int, n: int) -> str:
        data = self.data
        return b" ".join(data[a:b].tobytes() for a, b in zip(self.starts[first : first + n].tolist(), self.ends[first : first + n].tolist())).translate(_LOWER).decode()


def _block_grams(texts: bytes, extra: bytes) -> tuple[list[str], np.ndarray, Iterator[Grams]]:
    """(languages, language of each document, slices) of a block."""
    _, bounds, data = read_block(texts)
    langs, places = np.unique(np.array(read_extra(extra).column("lang").to_pylist(), object), return_inverse=True)
    codes = np.array([_lang_code(x) for x in langs], np.uint64)[places]
    starts = bounds[:-1] + np.arange(bounds.size - 1)
    joined = np.full(data.size + starts.size, 0x0A, np.uint8)
    joined[np.arange(data.size) + np.repeat(np.arange(starts.size), np.diff(bounds))] = data
    return list(langs), places, (Grams(joined, *cut, starts, codes) for cut in _slices(joined))


def _lang_code(lang: str) -> np.uint64:
    data = np.frombuffer(lang.encode() + b"\0", np.uint8)
    return word_hashes(data, np.array([0]), np.array([data.size]), radix=1)[0]


def _counted(blocks: DataFrame, buckets: int) -> DataFrame:
    """(block, bucket, blob) of every block's distinct n-grams: hashes ascending, and counts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, texts, extra in zip(*(batch.column(c).to_pylist() for c in ("block", "texts", "extra"))):
                parts = [np.unique(h, return_counts=True) for grams in _block_grams(texts, extra)[2] for _, h in grams.by_size]
                hashes, counts = _added(parts)
                # Buckets are ranges of the hash, so a bucket's n-grams lie together.
                cuts = np.searchsorted(_bucket_of(hashes, buckets), np.arange(buckets + 1))
                used = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
                blobs = []
                for b in used:
                    own = slice(cuts[b], cuts[b + 1])
                    blobs.append(pack(hashes[own], counts[own].astype(np.uint32)))
                yield pa.record_batch([pa.array([block] * len(used), pa.int64()), pa.array(used, pa.int32()), pa.array(blobs, pa.binary())], ["block", "bucket", "blob"])

    return blocks.select("block", "texts", "extra").mapInArrow(rows, "block bigint, bucket int, blob binary")


def _bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys ascending, with their counts summed."""
    keys = np.concatenate([np.zeros(0, np.uint64), *(p[0] for p in parts)])
    counts = np.concatenate([np.zeros(0, np.int64), *(p[1].astype(np.int64) for p in parts)])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.diff(keys, prepend=np.uint64(0)) != 0) if keys.size else np.zeros(0, np.int64)
    if keys.size and (not first.size or first[0] != 0):
        first = np.concatenate([[0], first])
    return keys[first], np.add.reduceat(counts, first) if first.size else counts


class Summary:
    """Misra-Gries counters. ``taken`` never exceeds mass / (capacity + 1), and bounds what any key has lost."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.keys = np.zeros(0, np.uint64)
        self.counts = np.zeros(0, np.int64)
        self.taken = 0

    def merge(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.keys, self.counts = _added([(self.keys, self.counts), *parts])
        if self.keys.size > self.capacity:
            at = self.keys.size - self.capacity - 1
            off = int(np.partition(self.counts, at)[at])  # the (capacity + 1)-th largest
            kept = self.counts > off
            self.keys, self.counts = self.keys[kept], self.counts[kept] - off
            self.taken += off


def _frequent(threshold: int):
    """What a bucket's task does: both passes over its blocks' counts; answers go to one block for each n-gram."""

    def judge(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        blocks = np.array(group.column("block").to_pylist(), np.int64)
        blobs = group.column("blob")
        mass = sum(int(unpack(x.as_py())[1].sum(dtype=np.int64)) for x in blobs)
        summary = Summary(mass // threshold + 1)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for x in blobs:
            waiting.append(tuple(unpack(x.as_py())))
            size += waiting[-1][0].size
            if size >= max(summary.capacity, 1 << 18):
                summary.merge(waiting)
                waiting, size = [], 0
        summary.merge(waiting)
        survivors = summary.keys[summary.counts + summary.taken >= threshold]
        exact = np.zeros(survivors.size, np.int64)
        chosen = np.zeros(survivors.size, np.int64)
        lot = np.full(survivors.size, np.iinfo(np.uint64).max)
        for number, x in enumerate(blobs):
            hashes, counts = unpack(x.as_py())
            at = np.searchsorted(survivors, hashes)
            at[at == survivors.size] = 0
            found = np.flatnonzero(survivors[at] == hashes) if survivors.size else at[:0]
            at = at[found]
            exact[at] += counts[found]
            # One of the blocks that hold an n-gram shows its words: dealt by lot, so that no block shows most of them.
            draw = mix(hashes[found] ^ mix(blocks[number : number + 1].astype(np.uint64) + np.uint64(1)))
            better = draw <= lot[at]
            lot[at[better]] = draw[better]
            chosen[at[better]] = number
        kept = np.flatnonzero(exact >= threshold)
        order = kept[np.argsort(chosen[kept], kind="stable")]
        cuts = np.flatnonzero(np.diff(chosen[order], prepend=-1, append=-1)) if order.size else np.zeros(1, np.int64)
        spans = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        return pa.table({
            "block": pa.array([int(blocks[chosen[s[0]]]) for s in spans], pa.int64()),
            "bucket": pa.array([key[0].as_py()] * len(spans), pa.int32()),
            "blob": pa.array([pack(survivors[s], exact[s]) for s in spans], pa.binary()),
        })

    return judge


def frequent_ngrams(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """lang, phrase, size and n of every n-gram of 1 to LONGEST words with ``threshold`` occurrences or more.

    Rows with size 0 and an empty phrase give all word occurrences of a language, in parts to be added up. ``docs``
    has text and lang; a null text is empty, a null lang is ``und``; other columns are not read; rows with equal or
    null ids are documents like any other; an empty table gives an empty result. N-grams are told apart
    by 64-bit hashes.
    """
    buckets = partitions(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    blocks = store_blocks(docs.select(F.lit(0).cast("bigint").alias("doc_id"), text, lang), keep=["lang"])
    counted = _counted(blocks, buckets)
    answers = counted.groupBy("bucket").applyInArrow(_frequent(threshold), "block bigint, bucket int, blob binary")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, extra, replies in zip(*(batch.column(c).to_pylist() for c in ("texts", "extra", "replies"))):
                known = [unpack(r["blob"]) for r in replies or []]
                keys = np.concatenate([np.zeros(0, np.uint64), *(k for k, _ in known)])
                order = np.argsort(keys)
                keys, counts = keys[order], np.concatenate([np.zeros(0, np.int64), *(c for _, c in known)])[order]
                open_ = np.ones(keys.size, bool)
                langs, places, slices = _block_grams(texts, extra)
                words = np.zeros(places.size, np.int64)
                out: list[tuple[str, str, int, int]] = []
                for grams in slices:
                    words += grams.words
                    for n, (first, hashes) in enumerate(grams.by_size, 1):
                        if not keys.size:
                            continue
                        at = np.minimum(np.searchsorted(keys, hashes), keys.size - 1)
                        hit = np.flatnonzero((keys[at] == hashes) & open_[at])
                        asked, place = np.unique(at[hit], return_index=True)
                        open_[asked] = False
                        for k, i in zip(asked.tolist(), first[hit[place]].tolist()):
                            out.append((langs[places[grams.doc[i]]], grams.phrase(i, n), n, int(counts[k])))
                totals = np.bincount(places, words, minlength=len(langs)).astype(np.int64)
                out += [(x, "", 0, int(t)) for x, t in zip(langs, totals)]
                kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, kinds)], ["lang", "phrase", "size", "n"])

    return with_replies(blocks, answers).select("texts", "extra", "replies").mapInArrow(rows, "lang string, phrase string, size int, n bigint")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, covered: int = COVERED, top: int = TOP) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n and score.

    a, l and r count the phrase, its first part and the rest at its weakest cut; score is floor(10^6 a^2 / (l r)),
    in decimals, which hold it exactly for counts below 10^16. Phrases that lie within a longer candidate with
    ``covered`` percent of their occurrences or more are left out. Ties go by a, then by the phrase's bytes.
    """
    found = stored(frequent_ngrams(docs, threshold), "ngrams")
    totals = found.where("size = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    grams = found.where("size > 0").select("lang", "phrase", "size", F.col("n").alias("a"))
    phrases = grams.where("size > 1").withColumn("words", F.split("phrase", " "))
    # Every cut is looked up as two parts; a part that many phrases share is one key of a join that AQE can split.
    cuts = phrases.select("lang", "phrase", "size", "a", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.selectExpr("lang", "phrase", "size", "a", "k", "array_join(slice(words, 1, k), ' ') AS first", "array_join(slice(words, k + 1, size - k), ' ') AS rest")
    first = grams.selectExpr("lang", "phrase AS first", "a AS l")
    rest = grams.selectExpr("lang", "phrase AS rest", "a AS r")
    whole = "CAST({} AS DECIMAL(16, 0))"
    score = f"(({whole.format('a')} * {whole.format('a')} * 1000000) div ({whole.format('l')} * {whole.format('r')}))"
    scored = cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"]).selectExpr("lang", "phrase", "a", "k", "l", "r", f"{score} AS score")
    weakest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # Candidates hold each of their shorter phrases once for each place; only the largest holder counts.
    inner = phrases.where("size > 2").selectExpr(
        "lang", "a AS held", "explode(flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), i -> array_join(slice(words, i, m), ' '))))) AS phrase"
    )
    holders = inner.groupBy("lang", "phrase").agg(F.max("held").alias("held"))
    left = weakest.join(holders, ["lang", "phrase"], "left").where(f"held IS NULL OR 100 * held < {covered} * a")
    order = "ORDER BY score DESC, a DESC, phrase"
    flat = left.selectExpr("lang", "phrase", "a", "cut.l AS l", "cut.r AS r", "cut.score AS score")
    # A language may hold most phrases: the best of each share first, then the best of those.
    shares = flat.selectExpr("*", f"row_number() OVER (PARTITION BY lang, pmod(xxhash64(phrase), {SALTS}) {order}) AS place").where(F.col("place") <= top)
    ranked = shares.selectExpr("*", f"row_number() OVER (PARTITION BY lang {order}) AS rank").where(F.col("rank") <= top)
    return ranked.join(totals, "lang").selectExpr(
        "lang", "CAST(rank AS BIGINT) AS rank", "phrase", "a", "l", "r", "n", "score"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang),
placed AS (SELECT lang, w, s, i FROM worded, (SELECT unnest([1, 2, 3]) AS s) sizes, unnest(range(1, len(w) - s + 2)) AS t(i)),
grams AS (
    SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, s AS size, CAST(count(*) AS BIGINT) AS a
    FROM placed GROUP BY ALL HAVING count(*) >= 10),
cuts AS (
    SELECT lang, phrase, size, a, k,
           array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head, array_to_string(string_split(phrase, ' ')[k + 1:size], ' ') AS tail
    FROM grams, unnest(range(1, size)) AS t(k)),
scored AS (
    SELECT c.lang, c.phrase, c.size, c.a, c.k, h.a AS l, t.a AS r,
           CAST((1000000::HUGEINT * c.a * c.a) // (h.a::HUGEINT * t.a) AS BIGINT) AS score
    FROM cuts c JOIN grams h ON h.lang = c.lang AND h.phrase = c.head JOIN grams t ON t.lang = c.lang AND t.phrase = c.tail),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
    SELECT * FROM weakest p WHERE NOT EXISTS (
        SELECT 1 FROM grams g WHERE g.size > p.size AND g.lang = p.lang AND 100 * g.a >= 50 * p.a
        AND contains(' ' || g.phrase || ' ', ' ' || p.phrase || ' '))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, CAST(r.rank AS BIGINT) AS rank, r.phrase, r.a, r.l, r.r, t.n, r.score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
"""
