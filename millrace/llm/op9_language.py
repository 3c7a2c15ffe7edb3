"""Language identification with a blended-spectrum string kernel and kernel ridge regression.

The kernel of two texts is the number of character n-grams (n = 1 to 3, lower case) that both hold,
divided by the root of the product of their numbers: a presence kernel. With m landmark texts (Nyström) a
text becomes m kernel values, mapped by the landmarks' inverse root so that dot products approximate the
kernel. One ridge regression per language on those (one versus rest) gives its score; the best wins.

Scoring is matrix products over batches: a 0/1 matrix of texts by n-grams of the landmarks, times a
matrix (n-grams by languages) into which landmarks, map and weights are folded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm.columns import bound_batches, col, let_go, pack, table, unpack

# Texts per language that fitting reads, whole, whatever the table's size. Prediction reads all texts, whole.
SAMPLE = 400
DENSE = 1 << 24  # n-grams are looked up in a table of all combinations up to this size, else by search
LANDMARKS = 48  # per language
RIDGE = 0.1
NGRAMS = 3
_CHUNK = 1 << 20  # characters whose n-grams are looked at at once; longer texts go in slices


@dataclass(frozen=True)
class Model:
    """Languages, the landmarks' n-grams (ascending codes) and what each adds to each language's score."""

    languages: list[str]
    grams: np.ndarray
    weights: np.ndarray


def _codes(data: np.ndarray, n: int) -> np.ndarray:
    """Codes of all n-grams of a sequence of code points: 21 bits for each character."""
    out = data.astype(np.uint64)
    for i in range(1, n):
        out = (out[:-1] << np.uint64(21)) | data[i:].astype(np.uint64)
    return out | (np.uint64(n) << np.uint64(62)) if n < 3 else out


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")


def _slices(data: np.ndarray) -> Iterator[np.ndarray]:
    """A sequence of code points in slices that overlap, so that each n-gram lies whole in one of them."""
    for begin in range(0, max(data.size - NGRAMS + 1, 1), _CHUNK):
        yield data[begin : begin + _CHUNK + NGRAMS - 1]


def _grams_of(data: np.ndarray, longest: int = NGRAMS) -> np.ndarray:
    found = np.zeros(0, np.uint64)
    for part in _slices(data):
        own = [_codes(part, n) for n in range(1, longest + 1) if part.size >= n]
        found = np.unique(np.concatenate([found, *own]))
    return found


def text_grams(text: str, longest: int = NGRAMS) -> np.ndarray:
    """Distinct n-gram codes of a text of any length, ascending."""
    return _grams_of(_points(text), longest)


def _kernel(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    vocabulary = np.unique(np.concatenate(b))

    def presence(sets: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(sets), vocabulary.size), np.float32)
        for i, s in enumerate(sets):
            at = np.searchsorted(vocabulary, s)
            at[at == vocabulary.size] = 0
            out[i, at[vocabulary[at] == s]] = 1
        return out

    sizes = np.sqrt(np.outer([max(s.size, 1) for s in a], [max(s.size, 1) for s in b]))
    right = presence(b).T
    shared = [presence(a[first : first + 256]) @ right for first in range(0, len(a), 256)]
    return np.concatenate(shared) / sizes


def fit(docs: DataFrame, training: str, sample: int = SAMPLE, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Fit on the ``sample`` distinct texts per language with the smallest hash, among rows where ``training`` holds.

    Texts are chosen by content, so the model does not depend on the table's layout or order, nor on how
    often a text is repeated: each language keeps all of its distinct texts up to ``sample``. The executors reduce
    each to its set of n-grams, from the whole text; these sets, bounded by the alphabets, are all that reaches the driver.
    """

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [pack(text_grams(text.as_py())) for text in batch.column("text")]
            yield pa.record_batch([batch.column("lang"), batch.column("r"), pa.array(blobs, pa.binary())], ["lang", "r", "grams"])

    rows = docs.where(training).where("lang IS NOT NULL AND text IS NOT NULL AND text RLIKE '\\\\p{L}'").select("lang", "text", F.xxhash64("text").alias("h"))
    # Copies are reduced to one key on the map side, before anything is counted, thinned or ranked.
    distinct = rows.groupBy("lang", "h").agg(F.lit(1).alias("one"))
    counts = distinct.groupBy("lang").agg(F.count("*").alias("c")).select(F.col("lang").alias("l"), "c")
    # Thin the texts by hash first (about four times the sample remains), then rank exactly.
    thin = distinct.join(counts, F.col("lang") == F.col("l")).where(
        F.pmod("h", F.lit(1 << 30)) < F.greatest(F.lit(1.0), F.lit(4.0 * sample) / F.col("c") * (1 << 30))
    )
    ranked = thin.selectExpr("lang AS l", "h AS k", "row_number() OVER (PARTITION BY lang ORDER BY pmod(h, 1073741824), h) AS r").where(F.col("r") <= sample)
    # The sample bounds what is broadcast; equal texts are again combined on the map side.
    chosen = rows.join(F.broadcast(ranked), (F.col("lang") == F.col("l")) & (F.col("h") == F.col("k")))
    chosen = chosen.groupBy("lang", "r").agg(F.min("text").alias("text")).mapInArrow(reduced, "lang string, r int, grams binary")
    found = sorted(chosen.collect(), key=lambda x: (x.lang, x.r))
    languages = sorted({r.lang for r in found})
    if not languages:
        return Model([], np.zeros(0, np.uint64), np.zeros((0, 0), np.float32))
    sets = [unpack(r.grams)[0] for r in found]
    labels = np.array([languages.index(r.lang) for r in found])
    marks = [s for s, r in zip(sets, found) if r.r <= landmarks]
    values, vectors = np.linalg.eigh(_kernel(marks, marks).astype(np.float64))
    kept = values > 1e-6 * values.max()
    root = vectors[:, kept] / np.sqrt(values[kept])
    x = _kernel(sets, marks) @ root
    x = np.concatenate([x, np.ones((x.shape[0], 1))], axis=1)
    y = np.where(labels[:, None] == np.arange(len(languages)), 1.0, 0.0)
    share = np.bincount(labels, minlength=len(languages))
    weight = (1 / share)[labels][:, None] * labels.size / len(languages)
    w = np.linalg.solve(x.T @ (x * weight) + ridge * np.eye(x.shape[1]), x.T @ (y * weight))
    grams = np.unique(np.concatenate(marks))
    folded = np.zeros((grams.size, len(marks)))
    for j, m in enumerate(marks):
        folded[np.searchsorted(grams, m), j] = 1 / np.sqrt(max(m.size, 1))
    weights = np.concatenate([folded @ (root @ w[:-1]), w[-1:]])
    return Model(languages, grams, weights.astype(np.float32))


class Scorer:
    """Scores texts with a model; finds n-grams by the ranks of their characters, in a table or by search."""

    def __init__(self, model: Model):
        self.model = model
        grams = model.grams
        points = np.unique(np.concatenate([(grams >> np.uint64(s)) & np.uint64(0x1FFFFF) for s in (0, 21, 42)])) if grams.size else grams
        points = points[points < 0x110000].astype(np.int64)
        self.rank = np.zeros(0x110000 + 1, np.int32)  # 0: in no landmark
        self.rank[points] = np.arange(1, points.size + 1)
        self.base = base = points.size + 1
        self.width = grams.size
        kind = grams >> np.uint64(62)
        self.place: list[tuple[np.ndarray, np.ndarray | None]] = []
        for n in (1, 2, 3):
            own = np.flatnonzero(kind == (n if n < 3 else 0))
            parts = [self.rank[((grams[own] >> np.uint64(21 * (n - 1 - i))) & np.uint64(0x1FFFFF)).astype(np.int64)].astype(np.int64) for i in range(n)]
            key = np.zeros(own.size, np.int64)
            for part in parts:
                key = key * base + part
            if base**n <= DENSE:
                table = np.full(base**n, self.width, np.int32)
                table[key] = own
                self.place.append((table, None))
            else:
                order = np.argsort(key)
                self.place.append((own[order].astype(np.int32), key[order]))

    def _found(self, n: int, key: np.ndarray) -> np.ndarray:
        """Places of the n-grams with these keys among the model's, ``width`` for others."""
        places, sought = self.place[n - 1]
        if sought is None:
            return places[key]
        if not sought.size:
            return np.full(key.size, self.width, np.int32)
        at = np.minimum(np.searchsorted(sought, key), sought.size - 1)
        return np.where(sought[at] == key, places[at], np.int32(self.width))

    def _places(self, data: np.ndarray) -> list[np.ndarray]:
        """For each n, the place among the model's n-grams of the one that starts at each code point."""
        rank = self.rank[data].astype(np.int64)
        keys = [rank]
        keys.append(keys[0][:-1] * self.base + rank[1:])
        keys.append(keys[1][:-1] * self.base + rank[2:])
        return [self._found(n, key) for n, key in enumerate(keys, 1)]

    def _score(self, present: np.ndarray, total: np.ndarray) -> np.ndarray:
        weights = self.model.weights
        present[:, self.width] = 0
        return (present[:, : self.width] @ weights[: self.width]) / np.sqrt(np.maximum(total, 1))[:, None] + weights[self.width]

    def _long(self, points: np.ndarray) -> np.ndarray:
        """The scores of one text, looked at slice by slice."""
        present = np.zeros((1, self.width + 1), np.float32)
        for part in _slices(points):
            for n, places in enumerate(self._places(np.concatenate([part, np.zeros(3, "<u4")])), 1):
                present[0, places[: max(0, part.size - n + 1)]] = 1
        return self._score(present, np.array([_grams_of(points).size]))[0]

    def scores(self, texts: list[str]) -> np.ndarray:
        """One row per text, one column per language."""
        lists = [_points(t) for t in texts]
        out = np.zeros((len(texts), len(self.model.languages)), np.float64)
        short = [i for i, points in enumerate(lists) if points.size <= _CHUNK]
        for i in sorted(set(range(len(lists))) - set(short)):
            out[i] = self._long(lists[i])
        if not short:
            return out
        data = np.concatenate([*(lists[i] for i in short), np.zeros(3, "<u4")])
        sizes = np.array([lists[i].size for i in short])
        begins = np.cumsum(sizes) - sizes
        found = self._places(data)
        rows = max(1, (1 << 24) // (self.width + 1))
        for first in range(0, len(short), rows):
            group = range(first, min(first + rows, len(short)))
            present = np.zeros((len(group), self.width + 1), np.float32)
            total = np.zeros(len(group))
            for row, i in enumerate(group):
                for n, places in enumerate(found, 1):
                    present[row, places[begins[i] : max(begins[i], begins[i] + sizes[i] - n + 1)]] = 1
                total[row] = self._distinct(data[begins[i] : begins[i] + sizes[i]])
            out[short[group.start : group.stop]] = self._score(present, total)
        return out

    @staticmethod
    def _distinct(points: np.ndarray) -> int:
        """Number of distinct n-grams of a text of at most _CHUNK characters."""
        return sum(np.unique(_codes(points, n)).size for n in range(1, NGRAMS + 1) if points.size >= n)


def predict(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """doc_id, lang_pred and score of every row, from its whole text, with the ``keep`` columns as one struct ``row``.

    ``und`` with score 0 if the text is null or has no letter, or if nothing was learned. A text that shares no
    n-gram with any landmark gets a learned language with a low score. The score is the winner's
    regression value, within 0 and 1; equal values go to the first language in order. Each row is scored on
    its own, so repeated rows and ids need no care; other columns are not read.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # its size is fixed by the landmarks

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        scorer = Scorer(shared.value) if shared.value.languages else None
        names = np.array([*shared.value.languages, "und"])
        for batch in batches:
            texts = batch.column("text").to_pylist()
            lettered = batch.column("lettered").to_pylist()
            begin = total = 0
            for i, text in enumerate(texts):
                total += len(text or "")
                if total < _CHUNK and i + 1 < len(texts):
                    continue
                part = range(begin, i + 1)
                best = np.full(len(part), len(names) - 1)
                value = np.zeros(len(part))
                used = [j for j, k in enumerate(part) if lettered[k]] if scorer else []
                if used:
                    found = scorer.scores([texts[begin + j] for j in used])
                    best[used] = found.argmax(1)
                    value[used] = np.clip(found.max(1), 0, 1)
                carried = {c: batch.column(c).slice(begin, len(part)) for c in ("text", "row") if keep}
                made = {"doc_id": batch.column("doc_id").slice(begin, len(part)), "lang_pred": pa.array(names[best].tolist(), pa.string()), "score": pa.array(value)}
                yield pa.record_batch([*made.values(), *carried.values()], [*made, *carried])
                begin, total = i + 1, 0

    columns = [F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered")]
    if not keep:
        return docs.select(*columns).mapInArrow(score, "doc_id bigint, lang_pred string, score double")
    # The text goes to the workers and back once, not again inside ``row``.
    others = [c for c in keep if c != "text"] or ["doc_id"]
    rows = docs.select(*columns, F.struct(*[col(c) for c in others]).alias("row"))
    kinds = StructType.fromDDL("doc_id bigint, lang_pred string, score double, text string").add(rows.schema["row"])
    found = rows.mapInArrow(score, kinds)
    row = F.struct(*[F.col("text") if c == "text" else col(c, "row").alias(c) for c in keep])
    return found.select("doc_id", "lang_pred", "score", row.alias("row"))


HELD_OUT = "crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, f"NOT ({HELD_OUT})")
    return predict(docs, model).selectExpr("doc_id", f"{HELD_OUT} AS held_out", "lang_pred", "score")
