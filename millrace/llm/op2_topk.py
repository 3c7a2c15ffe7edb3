"""Exact top-k by inner product, pruned with segment statistics from coarse to fine.

A vector is cut into segments; with the segments' means m and deviations s (both scaled by the root of the
segment's length) the squared distance of two vectors is at least |m - m'|^2 + |s - s'|^2. With both
norms known that is an upper bound m.m' + s.s' of the inner product. Candidates that the coarse
bound cannot exclude are bounded with shorter segments, and what is left is computed exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.columns import partitions, table

K = 5
# Candidates and queries that one task compares: both bounded in rows and in bytes of their components.
STRIPE = 1 << 16
WAVE = 1 << 17
HELD_BYTES = 64 << 20
# Scores are exact: in doubles while no squared length reaches the first bound, in integers up to the second.
DOUBLES = 1 << 53
LONGS = 1 << 62
_NONE = -LONGS  # below every score
_QUERIES = 64  # queries bounded at once
_LEVELS = (4, 16)


def segment_statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Scaled means and deviations of each row's segments, side by side."""
    parts = np.array_split(vectors, min(segments, max(vectors.shape[1], 1)), axis=1)
    roots = [np.sqrt(p.shape[1]) for p in parts]
    means = [p.mean(1) * r for p, r in zip(parts, roots)]
    return np.stack(means + [p.std(1) * r for p, r in zip(parts, roots)], axis=1)


def best_of(asked: np.ndarray, query_ids: np.ndarray, held: np.ndarray, ids: np.ndarray, k: int, wide: bool = False) -> list[tuple[int, int, int]]:
    """(place of the query, id, score) of each query's k best rows with another id; ``held`` ascends by id.

    Vectors of integers. Bounds are taken in doubles with some slack; scores are exact, ``wide`` ones by
    integer products.
    """
    queries, rows = asked.astype(np.float64), held.astype(np.float64)
    exact_queries, exact_rows = (asked, held) if wide else (queries, rows)
    levels = [(segment_statistics(queries, n), segment_statistics(rows, n)) for n in _LEVELS]
    slack = 1e-9 * (1 + np.linalg.norm(queries, axis=1) * (np.linalg.norm(rows, axis=1).max() if len(rows) else 0))
    out: list[tuple[int, int, int]] = []
    for first in range(0, len(queries), _QUERIES):
        part = slice(first, min(first + _QUERIES, len(queries)))
        own = query_ids[part][:, None] == ids[None, :]
        bound = levels[0][0][part] @ levels[0][1].T + slack[part][:, None]
        bound[own] = -np.inf
        keep = min(k, bound.shape[1])
        # Exact scores of the most promising rows give each query a score to beat.
        top = np.argpartition(-bound, keep - 1, axis=1)[:, :keep]
        seeds = np.einsum("qd,qkd->qk", exact_queries[part], exact_rows[top])
        seeds[np.take_along_axis(own, top, 1)] = _NONE
        beat = seeds.min(1)[:, None]
        left = bound >= beat
        columns = np.flatnonzero(left.any(0))
        fine = levels[1][0][part] @ levels[1][1][columns].T + slack[part][:, None]
        left = left[:, columns] & (fine >= beat)
        columns = columns[left.any(0)]
        scores = exact_queries[part] @ exact_rows[columns].T
        scores[own[:, columns]] = _NONE
        keep = min(k, columns.size)
        if not keep:
            continue
        last = -np.partition(-scores, keep - 1, axis=1)[:, keep - 1 : keep]
        row, at = np.nonzero((scores >= last) & (scores > _NONE))
        order = np.lexsort((ids[columns[at]], -scores[row, at], row))
        row, at = row[order], at[order]
        rank = np.arange(row.size) - np.searchsorted(row, row)
        few = rank < k
        out += zip((first + row[few]).tolist(), ids[columns[at[few]]].tolist(), scores[row[few], at[few]].astype(np.int64).tolist())
    return out


def top_k(vectors: DataFrame, queries: str, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: for rows where ``queries`` holds, their k highest integer inner products.

    ``vectors`` has vec_id and embedding; components become floor(256 * x). Ties go to the smaller
    vec_id. A query's own vec_id is no candidate for it. Of rows that repeat a vec_id and vector one counts;
    rows with one vec_id and different vectors are queries and candidates of their own, so such a query_id
    has k rows for each of its vectors and such a vec_id may be listed for each of its vectors. Scores are
    exact; a table with a squared length of 2^62 or more, whose scores need not fit a long, is refused with an error. Null ids, null vectors, and those holding null or non-finite components take no part; vectors are
    compared with those of their own length; an empty table gives an empty result. Queries meet rows in
    blocks of bounded size, and a query's best rows of each stripe are merged.
    """
    spark = vectors.sparkSession
    whole = "vec_id IS NOT NULL AND embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf'))"
    rows = (
        vectors.where(whole)
        .selectExpr("cast(vec_id AS bigint) AS vec_id", f"coalesce({queries}, false) AS asked", "transform(embedding, x -> cast(floor(256 * cast(x AS double)) AS bigint)) AS v")
        .distinct()
        .withColumn("print", F.xxhash64("vec_id", "v"))
    )
    squares = F.expr("aggregate(v, 0D, (sum, x) -> sum + cast(x AS double) * cast(x AS double))")
    size = rows.agg(F.count("*").alias("n"), F.count_if("asked").alias("q"), F.max(F.size("v")).alias("d"), F.max(squares).alias("square")).first()
    if (size.square or 0) >= LONGS * (1 - 1e-9):
        raise ValueError(f"the squared length of a vector in 1/256 is {size.square:.3g}; scores are exact below 2^62 only")
    wide = (size.square or 0) >= DOUBLES * (1 - 1e-9)
    most = max(1, HELD_BYTES // (8 * max(size.d or 1, 1)))
    stripes = max(partitions(spark), -(-size.n // min(STRIPE, most)))
    waves = max(1, -(-size.q // min(WAVE, most)))
    stripe = F.pmod("print", F.lit(stripes)).alias("stripe")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(waves - 1).cast("bigint"))).alias("wave")
    held = rows.select(stripe, every, F.size("v").alias("d"), F.lit(False).alias("asked"), "vec_id", "print", "v")
    spread = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(stripes - 1).cast("bigint"))).alias("stripe")
    wave = F.pmod("print", F.lit(waves)).alias("wave")
    sent = rows.where("asked").select(spread, wave, F.size("v").alias("d"), "asked", "vec_id", "print", "v")

    def compare(group: pa.Table) -> pa.Table:
        asked = group.column("asked").to_numpy(zero_copy_only=False).astype(bool)
        ids = group.column("vec_id").to_numpy()
        values = group.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        matrix = values.reshape(len(ids), -1)
        rows = np.flatnonzero(~asked)
        rows = rows[np.argsort(ids[rows], kind="stable")]
        found = best_of(matrix[asked], ids[asked], matrix[rows], ids[rows], k, wide) if asked.any() and rows.size else []
        place, vec_id, score = (np.array(c, np.int64) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        prints = group.column("print").to_numpy()[asked]
        return pa.table([ids[asked][place], prints[place], vec_id, score], ["query_id", "print", "vec_id", "score"])

    best = held.unionByName(sent).groupBy("stripe", "wave", "d").applyInArrow(compare, "query_id bigint, print bigint, vec_id bigint, score bigint")
    ranked = best.selectExpr("query_id", "vec_id", "score", "row_number() OVER (PARTITION BY query_id, print ORDER BY score DESC, vec_id) AS rank")
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")


ORACLE_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
