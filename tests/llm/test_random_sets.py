"""Random near copies around the threshold, names that clash, and texts far beyond one slice."""

import random
import sys
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402

from millrace.llm import op8_url_lists, op9_language, op10_jaccard_groups  # noqa: E402
from millrace.llm.columns import BATCH_BYTES, bound_batches  # noqa: E402
from millrace.session import ship_package  # noqa: E402


def near_copies(seed, documents=300):
    """Clusters around 85 percent: copies of a few bases with some words replaced, and one passage that many share."""
    rnd = random.Random(seed)
    bases = [[f"w{rnd.randrange(4000)}" for _ in range(rnd.choice([12, 60, 120]))] for _ in range(6)]
    passage = [f"p{i}" for i in range(50)]
    rows = []
    for key in range(documents):
        words = list(rnd.choice(bases))
        for _ in range(rnd.randrange(4)):
            words[rnd.randrange(len(words))] = f"x{rnd.randrange(10**6)}"
        if rnd.random() < 0.3:
            words = [f"o{rnd.randrange(10**6)}" for _ in range(rnd.randrange(1, 14))] + passage
        rows.append((key, " ".join(words)))
    return rows


def test_random_near_copies_equal_brute_force(spark):
    ship_package(spark)
    rows = near_copies(7)
    found = op10_jaccard_groups.jaccard_classes(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == brute.classes(rows)


def test_first_shared_shingle_keeps_every_similar_pair():
    """The condition on a list holds at the first shared shingle of each pair that is similar enough."""
    rnd = random.Random(3)
    for _ in range(400):
        union = list(range(rnd.randrange(2, 60)))
        a, b = ({x for x in union if rnd.random() < 0.93} for _ in range(2))
        both = sorted(a & b)
        if not both or 100 * len(both) < 85 * len(a | b):
            continue
        i, j = sorted(a).index(both[0]), sorted(b).index(both[0])
        n, m = len(a), len(b)
        assert 100 * min(n, m) >= 85 * max(n, m) and 185 * min(n - i, m - j) >= 85 * (n + m)


def test_stages_take_any_column_names(spark):
    ship_package(spark)
    given = spark.createDataFrame([(1, "some words of a text", 1, "a", 2), (2, "some words of a text", 3, "b", 4)], "doc_id bigint, text string, `my col` int, _none string, `_` int")
    kept = op10_jaccard_groups.one_of_each_class(given, 5, 80)
    assert kept.columns == given.columns and kept.collect()[0] == given.where("doc_id = 1").first()
    model = op9_language.fit(given.withColumn("lang", given["_none"]), "true")
    found = op9_language.predict(given, model, keep=given.columns).select("row.*")
    assert found.columns == given.columns and sorted(found.collect()) == sorted(given.collect())


def test_long_texts_are_fitted_and_scored_whole(spark, monkeypatch):
    ship_package(spark)
    tail = " zzyzx qoph" * 40
    rows = [("en", "the quick brown fox " * 400 + tail), ("en", "a lazy dog sleeps"), ("fr", "le vif renard brun"), ("fr", "un chien qui dort")]
    model = op9_language.fit(spark.createDataFrame(rows, "lang string, text string"), "true")
    grams = set(model.grams.tolist())
    assert set(op9_language.text_grams(tail).tolist()) <= grams  # from behind the first 4,000 characters
    texts = [t for _, t in rows]
    whole = op9_language.Scorer(model).scores(texts)
    sets = [op9_language.text_grams(t) for t in texts]
    monkeypatch.setattr(op9_language, "_CHUNK", 50)
    assert all(np.array_equal(a, op9_language.text_grams(t)) for a, t in zip(sets, texts))
    assert np.allclose(op9_language.Scorer(model).scores(texts), whole)


def test_batches_are_bounded_but_never_widened(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    try:
        for given, expected in (("64m", BATCH_BYTES), ("1m", 1 << 20), ("4096", 4096)):
            spark.conf.set(key, given)
            bound_batches(spark)
            assert spark.conf.get(key) == (str(expected) if given == "64m" else given)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_captures_with_columns_named_like_ours(spark):
    captures = spark.sql("SELECT 'http://a.example.org/x' AS url, DATE '2024-01-05' AS fetched, 1 AS of, 2 AS `on`, 3 AS domain, 4 AS name")
    events = spark.sql("SELECT 'example.org' AS domain, DATE '2024-01-01' AS day, true AS added")
    (row,) = op8_url_lists.blocked_captures(captures, events).collect()
    assert (row["of"], row["on"], row["domain"], row["name"], row["host"], row["blocked"], row["entry"]) == (1, 2, 3, 4, "a.example.org", True, "example.org")
