"""Benchmark decontamination by winnowing, in DataFrame functions only.

Items' windows of ten words (or a shorter item as a whole) are looked for in documents. Of each window's six
5-word grams the one with the smallest hash is its fingerprint; equal windows have equal ones, so a
document without a fingerprint of the items has no window of theirs. Documents that share one are
compared word by word: every window of theirs against the items' windows as text, and hits that overlap
are extended into one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.columns import table
from millrace.plans.scratch import stored

WINDOW = 10
GRAM = 5
# What is broadcast of the benchmark side is counted first, in rows and in bytes of their text; beyond either
# bound a join is an ordinary one, which Spark shuffles and splits by skew.
BROADCAST_WINDOWS = 200_000
BROADCAST_BYTES = 32 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = "".join(c for c in map(chr, range(128)) if not c.isalnum())


def _words(text: str) -> Column:
    """Lower-cased words; A-Z and separators are replaced in one go, which costs less than half of a regular expression."""
    spaced = F.translate(text, _UPPER + _BETWEEN, _LOWER + " " * len(_BETWEEN))
    return F.coalesce(F.array_remove(F.split(spaced, " "), ""), F.array().cast("array<string>"))


def _fingerprints(rows: DataFrame, window: int, gram: int, lengths: list[int]) -> DataFrame:
    """Adds ``prints``: distinct hashes of ``words``; winnowed fingerprints for ``window``, of all runs of a smaller length."""
    span = window - gram + 1

    def runs(n: int) -> str:
        terms = ", ".join(f"hashes[i + {k}]" for k in range(n))
        return f"CASE WHEN size(hashes) >= {n} THEN transform(sequence(0, size(hashes) - {n}), i -> xxhash64({terms})) END"

    winnowed = f"CASE WHEN size(hashes) >= {window} THEN transform(sequence(1, size(grams) - {span - 1}), i -> array_min(slice(grams, i, {span}))) END"
    lists = ", ".join(f"coalesce({winnowed if n == window else runs(n)}, cast(array() AS array<bigint>))" for n in lengths)
    return (
        rows.withColumn("hashes", F.expr("transform(words, w -> xxhash64(w))"))
        .withColumn("grams", F.expr(runs(gram)))
        .withColumn("prints", F.expr(f"array_distinct(concat({lists}))"))
        .drop("hashes", "grams")
    )


def _sent_whole(rows: DataFrame, bytes_of: str) -> Callable[[DataFrame], DataFrame]:
    """A broadcast hint when ``rows`` are few and small enough to be sent whole, else no hint."""
    size = rows.agg(F.count("*").alias("n"), F.sum(F.expr(bytes_of)).alias("bytes")).first()
    return F.broadcast if size.n <= BROADCAST_WINDOWS and (size.bytes or 0) <= BROADCAST_BYTES else lambda x: x


def _windows(rows: DataFrame, lengths: list[int], *keys: str) -> DataFrame:
    """One row per window of each length: the keys, place, length and the window's words as one text."""
    lists = [
        f"CASE WHEN size(words) >= {n} THEN transform(sequence(1, size(words) - {n - 1}), i -> struct(i - 1 AS place, {n} AS length, array_join(slice(words, i, {n}), ' ') AS window)) END"
        for n in lengths
    ]
    empty = "cast(array() AS array<struct<place:int,length:int,window:string>>)"
    whole = f"concat({', '.join(f'coalesce({x}, {empty})' for x in lists)})"
    # explode() would let the optimizer test the arrays' sizes below, and there compute them once per element.
    return rows.select(*keys, F.explode_outer(F.expr(whole)).alias("w")).select(*keys, "w.*")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM, keep: list[str] | None = None) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, item_ids of every document, with the ``keep`` columns as one struct ``row``.

    ``docs`` has doc_id and text, ``items`` item_id and text. Words are runs of letters, digits and
    non-ASCII characters, A-Z lower-cased. n_hit counts the document's words inside any occurrence of an
    item's window, item_ids (as strings, sorted) lists the items with occurring windows. Items with a null
    item_id hit like others and count in n_items as one, but are not in the list. Null and
    empty texts have no words and hit nothing; a null doc_id is kept; rows with one doc_id are judged by
    their own text; repeated items are counted by distinct item_id; an empty table of items leaves all
    documents clean; other columns are not read.
    """
    carried = ["row"] if keep else []
    row = [F.struct(*keep).alias("row")] if keep else []
    docs = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("print"), *row)
    held = items.select(F.col("item_id").cast("string").alias("item"), _words("text").alias("words")).where("size(words) > 0")
    sizes = held.select(F.least(F.size("words"), F.lit(window)).alias("n"))
    # At most ``window`` values: the lengths of windows that the items have.
    lengths = sorted(r.n for r in sizes.distinct().collect())
    short = [n for n in lengths if n < window]
    sought = _windows(held.where(f"size(words) >= {window}"), [window], "item") if window in lengths else None
    for n in short:
        more = held.where(f"size(words) = {n}").selectExpr("item", "0 AS place", f"{n} AS length", "array_join(words, ' ') AS window")
        sought = more if sought is None else sought.unionByName(more)
    worded = docs.select("doc_id", "print", _words("text").alias("words"))
    counted = docs.select("doc_id", "print", F.size(_words("text")).alias("n_words"), *carried)
    if sought is None:
        none = F.lit(0).cast("bigint")
        return counted.select("doc_id", F.col("n_words").cast("bigint").alias("n_words"), none.alias("n_hit"), none.alias("n_items"), F.array().cast("array<string>").alias("item_ids"), *carried)
    sought = stored(sought.where("window IS NOT NULL").select("item", "length", "window").distinct(), "windows")
    distinct = stored(sought.select("length", "window").distinct(), "distinct-windows")
    sent = _sent_whole(distinct, "octet_length(window)")
    # Items' fingerprints are as many as their distinct windows at most, and of eight bytes.
    sent_prints = _sent_whole(distinct, "0")
    # One window may stand in many items, so rows with the items' names are counted apart.
    sent_names = _sent_whole(sought, "octet_length(window) + coalesce(octet_length(item), 0)")

    # Documents that share a fingerprint, or hold a short item's hash: all lengths in one pass over the documents.
    # Hashes of different lengths that are equal make a document a suspect, which is then compared in full.
    prints = [_fingerprints(held.where(f"size(words) >= {window}"), window, gram, [window]).select(F.explode_outer("prints").alias("p"))] if window in lengths else []
    prints += [_fingerprints(held.where(f"size(words) = {n}"), window, gram, [n]).select(F.explode_outer("prints").alias("p")) for n in short]
    wanted = reduce(DataFrame.unionByName, prints).where("p IS NOT NULL").distinct()
    own = _fingerprints(worded, window, gram, lengths).select("doc_id", F.explode_outer("prints").alias("p"))
    found = own.join(sent_prints(wanted), "p", "left_semi").select("doc_id")
    suspects = found.distinct().withColumnRenamed("doc_id", "suspect")
    near = docs.join(suspects, F.col("doc_id").eqNullSafe(F.col("suspect")), "left_semi").select("doc_id", "print", _words("text").alias("words"))
    hits = _windows(near, lengths, "doc_id", "print").join(sent(distinct), ["length", "window"])
    hits = stored(hits, "hits")
    # One row per document, place and window; a place is counted once however many windows cover it.
    places = hits.select("doc_id", "print", F.explode(F.expr("sequence(place, place + length - 1)")).alias("at")).distinct()
    covered = places.groupBy("doc_id", "print").agg(F.count("*").alias("n_hit"))
    named = hits.select("doc_id", "print", "length", "window").distinct().join(sent_names(sought), ["length", "window"]).select("doc_id", "print", "item").distinct()
    listed = named.groupBy("doc_id", "print").agg(F.count("*").alias("n_items"), F.array_sort(F.collect_list("item")).alias("item_ids"))
    facts = covered.join(listed, covered["doc_id"].eqNullSafe(listed["doc_id"]) & (covered["print"] == listed["print"])).select(
        covered["doc_id"].alias("hit_id"), covered["print"].alias("hit_print"), "n_hit", "n_items", "item_ids"
    )
    joined = counted.join(facts, counted["doc_id"].eqNullSafe(F.col("hit_id")) & (F.col("print") == F.col("hit_print")), "left")
    return joined.select(
        "doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        *carried,
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("item_ids", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_SQL_WORDS = r"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_SQL_WORDS.format(text='text')}, []) AS w FROM documents),
b AS (SELECT item_id, {_SQL_WORDS.format(text='text')} AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (SELECT item_id, 10 AS n, unnest(list_transform(range(1, len(w) - 8), lambda i: array_to_string(w[i : i + 9], ' '))) AS x FROM b WHERE len(w) >= 10
  UNION ALL SELECT item_id, len(w), array_to_string(w, ' ') FROM b WHERE len(w) BETWEEN 1 AND 9),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: {{'p': i, 'x': array_to_string(w[i : i + n - 1], ' ')}})) AS u FROM d, ns WHERE len(w) >= n),
dx AS (SELECT doc_id, n, u.p AS p, u.x AS x FROM dw),
hit AS (SELECT doc_id, n, p, x FROM dx WHERE EXISTS (SELECT 1 FROM bw WHERE bw.n = dx.n AND bw.x = dx.x)),
cov AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY doc_id),
named AS (SELECT DISTINCT doc_id, cast(item_id AS VARCHAR) AS item FROM hit JOIN bw USING (n, x)),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM named GROUP BY doc_id)
SELECT d.doc_id, cast(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN listed USING (doc_id)
"""
