"""Quality classification from positive and unlabelled texts.

Only texts marked as good are trusted. Against them stand unlabelled web texts, in which good and bad
ones mix: a share ``prior`` of them is good. With the logistic loss l and a scorer g the risk

    prior * mean_P l(g, +1) + max(0, mean_U l(g, -1) - prior * mean_P l(g, -1))

estimates the risk on labelled good and bad texts; the maximum keeps the second part, the risk on bad texts, from being
fitted below zero (the non-negative estimator). The prior is estimated first: a plain classifier of P against U,
fitted on one half, ranks the other half, and the share of U above a threshold over the share of P above
it, where that ratio is surest to be small, is the prior (best-bin estimation).

The scorer is linear in features of a whole text (shares of characters by kind, repeated words and word
pairs, word lengths) and their squares.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.columns import id_and_text, ids_to_arrow, rows_by_size, table
from millrace.llm.words import ngram_hashes, words_of

SAMPLE = 8000  # distinct texts at most that fitting reads of each kind, good and unlabelled
SLICE = 4 << 20  # bytes of texts looked at together; longer texts are read in parts of this size
STEPS = 600
RATE = 0.05
DECAY = 1e-3
DECIDE = 0.3

_SPACES = [0x20, *range(0x09, 0x0E)]
_PUNCTUATION = [b for b in range(33, 127) if not chr(b).isalnum()]
_LETTER = np.array([chr(b).isalpha() and b < 128 or b >= 128 for b in range(256)])
_MARK = np.zeros(256, bool)
_MARK[_PUNCTUATION] = True
WIDTH = 12 + len(_PUNCTUATION)


@dataclass(frozen=True)
class Model:
    """Centre and scale of the features, weights (features, squares, constant) and the estimated prior."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        return _sigmoid(_expanded(features, self.centre, self.scale) @ self.weights)


class _Counts:
    """What the features of one text are made of, added up over its parts."""

    def __init__(self) -> None:
        self.bytes = np.zeros(256, np.int64)
        self.words = self.bare = self.again = self.doubled = 0
        self.last: np.uint64 | None = None
        self.seen: list[np.ndarray] = []
        self.pairs: list[np.ndarray] = []

    def add(self, data: np.ndarray, hashes: np.ndarray, lettered: np.ndarray) -> None:
        self.bytes += np.bincount(data, minlength=256)
        self.doubled += int((_MARK[data[1:]] & (data[1:] == data[:-1])).sum())
        if not hashes.size:
            return
        self.words += hashes.size
        self.bare += int((~lettered).sum())
        chain = hashes if self.last is None else np.concatenate([[self.last], hashes])
        self.again += int((chain[1:] == chain[:-1]).sum())
        self.last = hashes[-1]
        self.seen.append(np.unique(hashes))
        self.pairs.append(np.unique(ngram_hashes(chain, 2)))

    def features(self) -> np.ndarray:
        distinct, pairs = (_distinct(x) for x in (self.seen, self.pairs))
        size, words = max(int(self.bytes.sum()), 1), max(self.words, 1)
        upper = int(self.bytes[65:91].sum())
        letters = max(upper + int(self.bytes[97:123].sum()), 1)
        spaces = int(self.bytes[_SPACES].sum())
        return np.concatenate([
            [np.log1p(self.words), np.log1p((size - spaces) / words), upper / letters, self.bytes[48:58].sum() / size,
             spaces / size, self.bytes[128:].sum() / size, self.bytes[10] / size, self.bare / words,
             self.again / words, np.log1p(distinct) / np.log1p(words), (pairs + 1) / words, np.log1p(100 * self.doubled / size)],
            np.log1p(1000 * self.bytes[_PUNCTUATION] / size),
        ])


def _distinct(parts: list[np.ndarray]) -> int:
    return parts[0].size if len(parts) == 1 else np.unique(np.concatenate(parts)).size if parts else 0


def _parts(text: bytes) -> Iterator[bytes]:
    """The text in parts of about SLICE bytes, cut at white space where there is any."""
    begin = 0
    while len(text) - begin > SLICE:
        end = begin + SLICE
        cut = max(text.rfind(b" ", begin, end), text.rfind(b"\n", begin, end))
        end = cut if cut > begin else end
        yield text[begin:end]
        begin = end
    yield text[begin:]


def text_features(texts: list[bytes]) -> np.ndarray:
    """One row of features for each whole UTF-8 text."""
    out = np.zeros((len(texts), WIDTH))
    short = [i for i, t in enumerate(texts) if len(t) <= SLICE]
    for group in ([i] for i in range(len(texts)) if len(texts[i]) > SLICE):
        counts = _Counts()
        for part in _parts(texts[group[0]]):
            _add(counts, [part])
        out[group[0]] = counts.features()
    if short:
        counted = [_Counts() for _ in short]
        _add(counted, [texts[i] for i in short])
        out[short] = [c.features() for c in counted]
    return out


def _add(counts: _Counts | list[_Counts], texts: list[bytes]) -> None:
    data, starts, ends, hashes, bounds = words_of(texts)
    known = np.concatenate([[0], np.cumsum(_LETTER[data])])
    lettered = known[ends] > known[starts]
    at = 0
    for i, text in enumerate(texts):
        own = slice(bounds[i], bounds[i + 1])
        (counts if isinstance(counts, _Counts) else counts[i]).add(data[at : at + len(text)], hashes[own], lettered[own])
        at += len(text) + 1


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _expanded(features: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((features - centre) / scale, -6, 6)
    return np.concatenate([z, z * z / 6, np.ones((z.shape[0], 1))], axis=1)


def _descend(gradient, width: int) -> np.ndarray:
    """Adam on the whole sample, from zero; the constant's weight does not decay."""
    w, first, second = np.zeros(width), np.zeros(width), np.zeros(width)
    decay = np.full(width, DECAY)
    decay[-1] = 0
    for step in range(1, STEPS + 1):
        g = gradient(w) + decay * w
        first += 0.1 * (g - first)
        second += 0.001 * (g * g - second)
        w -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w


def fit_non_negative(good: np.ndarray, unlabelled: np.ndarray, prior: float) -> np.ndarray:
    """Weights that minimise the non-negative risk on expanded features.

    Where the bad texts' risk is below zero, a step goes back up along it instead of further down.
    """

    def gradient(w: np.ndarray) -> np.ndarray:
        at_good, at_unlabelled = good @ w, unlabelled @ w
        rising = prior * good.T @ (_sigmoid(at_good) - 1) / len(good)
        bad = np.logaddexp(0, at_unlabelled).mean() - prior * np.logaddexp(0, at_good).mean()
        falling = unlabelled.T @ _sigmoid(at_unlabelled) / len(unlabelled) - prior * good.T @ _sigmoid(at_good) / len(good)
        return rising + falling if bad >= 0 else -falling

    return _descend(gradient, good.shape[1])


def estimate_prior(good: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of good texts among the unlabelled ones, from expanded features; within 0.01 and 0.99."""

    def plain(p: np.ndarray, u: np.ndarray) -> np.ndarray:
        return _descend(lambda w: p.T @ (_sigmoid(p @ w) - 1) / len(p) + u.T @ _sigmoid(u @ w) / len(u), p.shape[1])

    if min(len(good), len(unlabelled)) < 4:
        return 0.5
    found = []
    for fold in (0, 1):
        w = plain(good[fold::2], unlabelled[fold::2])
        p, u = np.sort(good[1 - fold :: 2] @ w), np.sort(unlabelled[1 - fold :: 2] @ w)
        above_p = 1 - np.arange(len(p)) / len(p)
        above_u = 1 - np.searchsorted(u, p, side="left") / len(u)
        unsure = np.sqrt(np.log(40) / 2 / len(u)) + np.sqrt(np.log(40) / 2 / len(p))
        best = int(np.argmin((above_u + unsure) / above_p))
        found.append(above_u[best] / above_p[best])
    return float(np.clip(np.mean(found), 0.01, 0.99))


def _sampled(keys: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` smallest of distinct hashes ``h``: thinned by their count first, so that few are sorted."""
    distinct = keys.groupBy("h").agg(F.lit(1).alias("one"))
    count = distinct.count()
    share = min(1.0, 4.0 * limit / max(count, 1))
    lot = F.pmod(F.xxhash64("h"), F.lit(1 << 30))
    return distinct.where(lot < share * (1 << 30)).orderBy(lot, "h").limit(limit).select(F.col("h").alias("k"))


def fit(docs: DataFrame, labels: DataFrame, training: Column, sample: int = SAMPLE) -> Model | None:
    """Fit on at most ``sample`` distinct good texts and as many distinct texts of all kinds, among rows where ``training`` holds.

    ``labels`` gives doc_id and quality; rows with quality 1 are trusted, no other label is used. Texts are chosen by
    hash of their content, so neither copies nor the table's layout matter; their features (WIDTH numbers
    a text) are all that reaches the driver. Null texts count as empty; without good or other texts there is no model.
    """
    rows = docs.where(training).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    hashed = rows.select("doc_id", F.xxhash64("text").alias("h"))
    trusted = labels.where("quality = 1").select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    chosen = _sampled(hashed.join(trusted, "doc_id"), sample).withColumn("good", F.lit(1))
    chosen = chosen.unionByName(_sampled(hashed, sample).withColumn("good", F.lit(0)))
    kinds = chosen.groupBy("k").agg(F.max("good").alias("good"), F.min("good").alias("all"))  # at most 2 * sample rows
    texts = rows.withColumn("h", F.xxhash64("text")).join(F.broadcast(kinds), F.col("h") == F.col("k"))
    texts = texts.groupBy("h", "good", "all").agg(F.min("text").alias("text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = text_features(batch.column("text").cast(pa.binary()).to_pylist())
            yield pa.record_batch([*(batch.column(c) for c in ("h", "good", "all")), pa.array(list(found), pa.list_(pa.float64()))], ["h", "good", "all", "x"])

    found = sorted(texts.mapInArrow(features, "h bigint, good int, all int, x array<double>").collect(), key=lambda r: r.h)
    good = np.array([r.x for r in found if r.good == 1])
    unlabelled = np.array([r.x for r in found if r["all"] == 0])
    if not len(good) or not len(unlabelled):
        return None
    centre, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-3
    p, u = (_expanded(x, centre, scale) for x in (good, unlabelled))
    prior = estimate_prior(p, u)
    return Model(centre, scale, fit_non_negative(p, u, prior), prior)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of every row, from its whole text alone; a null text counts as empty.

    Without a model every score is 0.5. Each row is scored on its own, so null and repeated ids need no care; an
    empty table gives an empty result; other columns are not read. A task holds the features' counts and one part
    (SLICE) of a long text besides the text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed by WIDTH

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows_by_size(batches, SLICE):
            found = shared.value.scores(text_features(texts)) if shared.value else np.full(len(texts), 0.5)
            yield pa.record_batch([ids_to_arrow(ids), pa.array(found)], ["doc_id", "score"])

    return id_and_text(docs).mapInArrow(rows, "doc_id bigint, score double")


HELD_OUT = "coalesce(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0, false)"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"), F.expr(f"NOT {HELD_OUT}"))
    return score(docs, model).selectExpr("doc_id", f"{HELD_OUT} AS held_out", "score", f"CAST(score >= {DECIDE} AS INT) AS predicted")
