import hashlib
import re
import sys
import zlib
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402

from millrace.llm import (  # noqa: E402
    op1_bitplanes,
    op2_topk,
    op3_packing,
    op4_chat,
    op5_suffix_dedup,
    op6_seed_extend,
    op7_decontamination,
    op8_url_lists,
    op9_language,
    op10_jaccard_groups,
)
from millrace.llm.columns import pack, unpack  # noqa: E402
from millrace.llm import components as stars_of  # noqa: E402
from millrace.llm.components import components  # noqa: E402
from millrace.llm.repeats import leftmost_minimum  # noqa: E402
from millrace.llm.tokens import WordTokenizer  # noqa: E402
from millrace.session import ship_package  # noqa: E402

WORDS = public_tokenizers.path("word_bpe_49k.json")
ITEM = "the quick brown fox jumps over the lazy dog while eleven owls watch"
DDL = "doc_id bigint, text string, lang string, token string"


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    return spark.createDataFrame(brute.awkward(ITEM), DDL)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


@pytest.fixture(scope="module")
def tokens():
    encode = Tokenizer.from_file(WORDS).encode
    return {r[0]: encode(r[1] or "", add_special_tokens=False).ids for r in brute.awkward(ITEM)}


def by_id(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.collect()}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("bits", [1, 8])
def test_token_file_gives_back_all_ids(spark, docs, tokens, bits):
    file = op1_bitplanes.write_tokens(docs, WORDS, block=64, bits=bits, shards=3)
    found = by_id(op1_bitplanes.token_digests(spark, file), "start", "n_tokens", "ids_crc32")
    at, expected = 0, {}
    for key in sorted(tokens):
        ids = [*tokens[key], 2]
        expected[key] = (at, len(ids), crc(ids))
        at += len(ids)
    assert found == expected


def test_token_file_of_no_documents(spark, empty):
    file = op1_bitplanes.write_tokens(empty, WORDS)
    assert op1_bitplanes.token_digests(spark, file).count() == 0


def test_frames_round_trip_and_crc_join():
    ids = np.array([0, 1, 65535, 70000, 2**31], np.uint32)
    for bits in (1, 8):
        frame = op1_bitplanes.to_frame(ids, np.array([3]), np.array([0]), np.array([5]), bits)
        assert [x.tolist() for x in op1_bitplanes.from_frame(frame)] == [ids.tolist(), [3], [0], [5]]
    a, b = b"some bytes", b"and more of them" * 9
    assert op1_bitplanes.crc32_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert op1_bitplanes.crc32_joined(zlib.crc32(a), zlib.crc32(b""), 0) == zlib.crc32(a)


def test_top_k_equals_sql_and_skips_bad_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(0, 0.2, (160, 12)).astype(np.float32))]
    rows += [(200, rows[7][1]), (201, rows[7][1]), (250, None), (300, [float("nan")] * 12), (350, [None] * 12), (None, rows[3][1])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = sorted(tuple(r) for r in op2_topk.top_k(vectors, "vec_id % 50 = 0").collect())
    embeddings = vectors.where("vec_id IS NOT NULL").toPandas()
    assert len(embeddings)
    con = duckdb.connect()
    con.register("embeddings", embeddings)
    assert found == sorted(con.execute(op2_topk.ORACLE_SQL).fetchall())
    assert op2_topk.top_k(vectors.where("vec_id < 0"), "vec_id % 50 = 0").count() == 0


def test_top_k_with_repeated_ids_and_scores_beyond_doubles(spark):
    far = 2.0**21 + 1 / 256  # squares of 2^58 and more in 1/256
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (50, [1.0, 0.0]), (51, [0.5, 0.25]), (51, [0.25, 0.5]), (52, [far, far]), (100, [far, -1.0])]
    for data in ([r for r in rows if r[0] < 52], rows):
        whole = sorted({(i, tuple(int(256 * x // 1) for x in v)) for i, v in data})
        expected = []
        for i, v in whole:
            if i % 50 == 0:
                scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in whole if j != i)
                expected += [(i, n + 1, j, -x) for n, (x, j) in enumerate(scores[:5])]
        vectors = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
        assert sorted(map(tuple, op2_topk.top_k(vectors, "vec_id % 50 = 0").collect())) == sorted(expected)
    for x in (1e15, -1e300):
        with pytest.raises(ValueError, match="squared length"):
            op2_topk.top_k(spark.createDataFrame([(50, [x]), (51, [x])], "vec_id bigint, embedding array<double>"), "vec_id % 50 = 0")


@pytest.mark.parametrize("size", [1, 100, 10**9])
def test_top_k_in_stripes_of_few_bytes(spark, monkeypatch, size):
    rng = np.random.default_rng(2)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(0, 0.2, (60, 4)))], "vec_id bigint, embedding array<double>")
    monkeypatch.setattr(op2_topk, "HELD_BYTES", size * 32)
    con = duckdb.connect()
    con.register("embeddings", vectors.toPandas())
    assert sorted(map(tuple, op2_topk.top_k(vectors, "vec_id % 50 = 0").collect())) == sorted(con.execute(op2_topk.ORACLE_SQL).fetchall())


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_of_any_tokenizer_file_equal_the_library(file):
    path = public_tokenizers.path(file)
    rng = np.random.default_rng(3)
    letters = list("abzAZ 09.,'\n\t<|>") + ["'s", "é", "e\u0301", "\u00a0", "ß", "İ", "中", "😀", "<|endoftext|>", " ", " "]
    texts = ["", " ", "It's  two\n\nLINES"] + ["".join(rng.choice(letters, rng.integers(1, 60))) for _ in range(300)]
    tokenizer, library = WordTokenizer(path), Tokenizer.from_file(path)
    found = tokenizer.encode_many([x.encode() for x in texts])
    assert [x.tolist() for x in found] == [library.encode(x, add_special_tokens=False).ids for x in texts]
    assert tokenizer.by_words == (file == "word_bpe_49k.json")


def test_packing_with_another_tokenizer_file(docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    encode = Tokenizer.from_file(path).encode
    ids = {r[0]: [*encode(r[1] or "", add_special_tokens=False).ids, 1] for r in brute.awkward(ITEM)}
    for r in op3_packing.pack_documents(docs, path, capacity=64).collect():
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert (r.ids_crc32, r.length) == (crc(piece), len(piece))


def test_packing_places_every_piece_once(docs, empty, tokens):
    rows = op3_packing.pack_documents(docs, WORDS, capacity=64).collect()
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        ids = [*tokens[r.doc_id], 1][r.start : r.start + r.length]
        assert (r.ids_crc32, r.length, r.start) == (crc(ids), len(ids), 64 * r.piece)
    for places in bins.values():
        ends = [0, *(a + n for a, n in sorted(places))]
        assert [a for a, _ in sorted(places)] == ends[:-1] and ends[-1] <= 64
    assert sum(r.length for r in rows) == sum(len(x) + 1 for x in tokens.values())
    assert op3_packing.pack_documents(empty, WORDS).count() == 0


def test_plan_matches_large_items_and_fills_gaps():
    rng = np.random.default_rng(2)
    counts = {int(n): int(c) for n, c in zip(rng.choice(np.arange(1, 101), 60, False), rng.integers(1, 40, 60))}
    plan = op3_packing.plan_bins(dict(counts), 100)
    room = {}
    for length, _, count, first, offset in plan:
        for b in range(first, first + count):
            room.setdefault(b, []).append((offset, length))
    assert {n: sum(c for m, _, c, _, _ in plan if m == n) for n in counts} == counts
    for items in room.values():
        items.sort()
        assert all(o == sum(n for _, n in items[:i]) for i, (o, _) in enumerate(items)) and sum(n for _, n in items) <= 100
        assert sum(3 * n > 100 for _, n in items) <= 2
    gaps = []  # plain best-fit decreasing, item by item
    for n in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else 100) - n)
    assert len(room) <= 1.01 * len(gaps)


def test_chat_reads_back_turns_and_loss(spark):
    ship_package(spark)
    said = "\\### Assistant: </turn> ok"
    rows = [(-7, 0, "user", said, 1), (-7, 1, "assistant", said, 1), (1, 0, "a\nb#", "##### \\n \\\\ </turn></turn>", 1), (1, 1, "assistant", None, 1),
            (1, 1, "assistant", "dé 中 <|endoftext|>", 1), (2, None, None, "x", 1), (2, 0, "user", "y", 1), (None, 0, "assistant", "z", 1)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, ids int")
    path = public_tokenizers.path(op4_chat.TOKENIZER)
    formatted = op4_chat.format_turns(turns, path)
    found = {r.conv_id: r for r in op4_chat.read_back(formatted, path).collect()}
    shown = {}
    for r in sorted(op4_chat.rendered(formatted, path).collect(), key=lambda r: (r.conv_id is None, r.conv_id, r.place)):
        shown[r.conv_id] = shown.get(r.conv_id, "") + r.formatted
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        told = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        got = found[key]
        assert (got.n_turns, got.turns_sha256, got.loss_chars, got.loss_sha256) == (len(own), sha(told), len(loss), sha(loss))
        assert got.formatted_chars == len(shown[key]) and shown[key].count("### ") == len(own)
    assert op4_chat.read_back(op4_chat.format_turns(turns.limit(0), path), path).count() == 0


def test_repeated_bytes(docs, empty):
    found = op5_suffix_dedup.remove_repeats(docs, keep=["doc_id", "token"])
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in found.collect()}
    assert got == brute.removed_bytes([(r[0], (r[1] or "").encode()) for r in brute.awkward(ITEM)])
    assert {r.row.token for r in found.collect()} == {"a", "b", "x", None}
    assert op5_suffix_dedup.remove_repeats(empty).count() == 0


def test_repeated_passages(docs, empty):
    got = by_id(op6_seed_extend.remove_passages(docs), "n_words", "n_removed", "kept")
    got = {k: (n, r, hashlib.sha256(t.encode()).hexdigest()) for k, (n, r, t) in got.items()}
    assert got == brute.removed_words([(r[0], r[1] or "") for r in brute.awkward(ITEM)])
    assert op6_seed_extend.remove_passages(empty).count() == 0


def test_null_ids_count_as_largest(spark):
    text = " ".join(f"w{i}" for i in range(40))
    twice = spark.createDataFrame([(None, text), (5, text), (None, "")], "doc_id bigint, text string")
    got = {(r.doc_id, r.n_bytes): r.n_removed for r in op5_suffix_dedup.remove_repeats(twice).collect()}
    assert got == {(None, len(text)): len(text), (5, len(text)): 0, (None, 0): 0}
    got = {(r.doc_id, r.n_words): r.n_removed for r in op6_seed_extend.remove_passages(twice).collect()}
    assert got == {(None, 40): 40, (5, 40): 0, (None, 0): 0}


def test_contamination_equals_sql(spark, docs, empty):
    items = spark.createDataFrame([(1, ITEM, "x"), (2, "lazy DOG", "x"), (30, ITEM + " twice", "x"), (4, "", "x"), (5, None, "x")], "item_id bigint, text string, doc_id string")
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas())
    con.register("benchmark", items.select("item_id", "text").toPandas())
    digest = lambda r: (r.doc_id, r.n_words, r.n_hit, r.n_items, hashlib.sha256(",".join(r.item_ids).encode()).hexdigest(), r.n_hit > 0)
    got = sorted(map(digest, op7_decontamination.contamination(docs, items).collect()))
    want = con.execute("SELECT doc_id, n_words, n_hit, n_items, items_sha256, contaminated FROM (" + op7_decontamination.ORACLE_SQL + ") ORDER BY 1").fetchall()
    assert got == want and any(r[2] for r in got)
    assert not op7_decontamination.contamination(docs, items.limit(0)).where("n_hit > 0").count()
    assert op7_decontamination.contamination(empty, items).count() == 0


def test_items_without_id_hit_too(spark):
    docs = spark.createDataFrame([(1, f"lead {ITEM} tail"), (2, "a lazy dog"), (3, "clean")], "doc_id bigint, text string")
    items = spark.createDataFrame([(None, ITEM), (None, "lazy dog"), (9, ITEM)], "item_id bigint, text string")
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    con.register("benchmark", items.toPandas().astype({"item_id": "Int64"}))
    got = sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.item_ids) for r in op7_decontamination.contamination(docs, items).collect())
    assert got == [(1, 15, 13, 2, ["9"]), (2, 3, 2, 1, []), (3, 1, 0, 0, [])]
    assert [r[:4] for r in got] == con.execute("SELECT doc_id, n_words, n_hit, n_items FROM (" + op7_decontamination.ORACLE_SQL + ") ORDER BY 1").fetchall()


def test_host_comes_after_user_information(spark):
    urls = ["http://user@Blocked.org/", "ftp://u:p@a.b.org:8/x@y", "http://u@v@c.org", "http://d.org/@e.org", "http://@f.org", "http://g.org?x@h.org", "u@i.org"]
    got = spark.createDataFrame([(u,) for u in urls], "url string").selectExpr(f"{op8_url_lists.host('url')} AS host").collect()
    assert [r.host for r in got] == ["blocked.org", "a.b.org", "c.org", "d.org", "f.org", "g.org", None]


def test_url_lists_hold_from_addition_to_removal(spark):
    events = spark.createDataFrame(
        [("b.org", "2024-01-05", True), ("b.org", "2024-01-09", False), ("b.org", "2024-01-09", False), ("x.b.org", "2024-01-08", True), ("c.org", "2024-01-03", False),
         ("c.org", "2024-01-04", True), ("c.org", "2024-01-04", False), (None, "2024-01-01", True), ("d.org", None, True)],
        "domain string, day string, added boolean").selectExpr("domain", "cast(day AS date) AS day", "added")
    captures = spark.createDataFrame(
        [(1, "http://A.b.ORG/x", "2024-01-04"), (2, "http://a.b.org", "2024-01-05"), (3, "https://x.b.org:80/?q", "2024-01-09"), (4, "http://b.org/", "2024-01-09"),
         (5, "c.org", "2024-02-01"), (6, None, "2024-02-01"), (7, "http://c.org#f", None), (8, "http://c.org#f", "2024-02-01"), (9, "http://org", "2024-02-01")],
        "n int, url string, fetched string").selectExpr("n", "url", "cast(fetched AS date) AS fetched", "n AS entry")
    got = {r.n: r.entry for r in op8_url_lists.blocked_captures(captures, events).collect()}
    assert got == {1: None, 2: "b.org", 3: "x.b.org", 4: None, 5: None, 6: None, 7: None, 8: "c.org", 9: None}
    assert op8_url_lists.blocked_captures(captures.limit(0), events).count() == 0


def test_language_on_held_out_rows(spark):
    ship_package(spark)
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = op9_language.fit(table, f"NOT ({op9_language.HELD_OUT})")
    rows = op9_language.predict(table, model).join(table, "doc_id").where(op9_language.HELD_OUT).collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    odd = spark.createDataFrame([(1, None, None), (2, "", "en"), (3, "123 !?", "en"), (4, "жук " * 9, "en"), (None, "the and of " * 3000, "en")], "doc_id bigint, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in op9_language.predict(odd, model).collect()}
    assert [got[i] for i in (1, 2, 3)] == [("und", 0.0)] * 3
    assert got[4][0] in model.languages and 0 <= got[4][1] < 0.5 and got[None][0] == "en"
    assert {r.lang_pred for r in op9_language.predict(odd, op9_language.fit(odd.limit(0), "true")).collect()} == {"und"}


def test_language_keeps_distinct_texts_of_often_copied_rows(spark):
    ship_package(spark)
    few = [(f"der wald und die stadt {'ab'[i % 2]}{i}", "de") for i in range(3)]
    many = [(f"the house and the {i} trees of {i * 7}", "en") for i in range(500)]
    rows = [x for x in few for _ in range(40)] + many + [(many[0][0], "en")] * 3000
    model = op9_language.fit(spark.createDataFrame(rows, "text string, lang string"), "true", sample=6, landmarks=4)
    plain = op9_language.fit(spark.createDataFrame(few + many, "text string, lang string"), "true", sample=6, landmarks=4)
    assert model.languages == ["de", "en"]
    assert model.grams.tolist() == plain.grams.tolist() and np.allclose(model.weights, plain.weights)
    assert set(np.concatenate([op9_language.text_grams(t) for t, _ in few]).tolist()) <= set(model.grams.tolist())


def test_language_samples_whole_texts_of_many_characters(spark):
    ship_package(spark)
    signs = "".join(map(chr, range(0x4E00, 0x4E00 + 6000)))
    grams = op9_language.text_grams(signs)
    weights = np.random.default_rng(4).normal(size=(grams.size + 1, 2)).astype(np.float32)
    model = op9_language.Model(["ja", "zh"], grams, weights)
    texts = [signs[:500], signs[5990:] + "abc", "abc", signs[7] + "b" + signs[9:12]]
    got = op9_language.Scorer(model).scores(texts)
    place = {int(g): i for i, g in enumerate(grams)}
    for row, text in zip(got, texts):  # plainly, gram by gram
        own = op9_language.text_grams(text)
        plain = sum((weights[place[int(g)]].astype(float) for g in own if int(g) in place), np.zeros(2))
        assert np.allclose(row, plain / np.sqrt(own.size) + weights[-1], atol=1e-3)
    head = "0 " * 4000
    rows = [(head + "der wald und die stadt " * 400, "de"), (head + "the house and the trees " * 400, "en")] * 2
    fitted = op9_language.fit(spark.createDataFrame(rows, "text string, lang string"), "true")
    assert set(op9_language.text_grams("wald").tolist()) | set(op9_language.text_grams("house").tolist()) <= set(fitted.grams.tolist())


def test_jaccard_classes(docs, empty):
    got = by_id(op10_jaccard_groups.jaccard_classes(docs), "n_shingles", "component_id")
    assert got == brute.classes([(r[0], r[1] or "") for r in brute.awkward(ITEM)])
    assert op10_jaccard_groups.jaccard_classes(empty).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 199), (None, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()))
    assert got == {**dict.fromkeys(range(21), 0), **dict.fromkeys(range(100, 140), 100), 199: 199, 200: 199}


def test_stars_take_no_round_and_a_chain_few(spark, monkeypatch):
    star, taken = stars_of._star, []
    monkeypatch.setattr(stars_of, "_star", lambda pairs, large: taken.append(large) or star(pairs, large))

    def found(edges):
        taken.clear()
        got = components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
        assert len(got) == len(set(got))
        return dict(map(tuple, got)), len(taken)

    assert found([(5, i) for i in range(6, 30)] + [(2, 1), (None, 5)]) == ({**dict.fromkeys(range(5, 30), 5), 1: 1, 2: 1}, 0)
    assert found([(1, 1), (None, None), (3, None)]) == ({}, 0)
    assert found([(3, 2), (3, 1)]) == ({1: 1, 2: 1, 3: 1}, 2)
    assert found([(1, 2), (2, 3)]) == ({1: 1, 2: 1, 3: 1}, 2)


def test_turns_that_link_nothing_make_no_new_components(spark, monkeypatch):
    made, of = [], op10_jaccard_groups.stars
    monkeypatch.setattr(op10_jaccard_groups, "stars", lambda edges: made.append(1) or of(edges))
    base = [f"w{i}" for i in range(60)]
    near, other = [*base[:59], "x"], [f"v{i}" for i in range(40)]
    docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(other)), (4, None)], "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in op10_jaccard_groups.jaccard_classes(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}
    assert len(made) == 1


def test_leftmost_minimum_and_packing_of_arrays():
    values = np.random.default_rng(3).integers(0, 4, 200).astype(np.uint64)
    for width in (1, 2, 7, 25):
        assert leftmost_minimum(values, width).tolist() == [i + int(values[i : i + width].argmin()) for i in range(200 - width + 1)]
    arrays = [np.arange(5), np.zeros(0, np.uint64), np.array([True])]
    assert [a.tolist() for a in unpack(pack(*arrays))] == [a.tolist() for a in arrays]


def test_items_that_share_one_window_are_not_broadcast(spark, monkeypatch):
    words = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame([(f"i{n}", words) for n in range(300)] + [("s", "rare pair"), (None, "lone")], "item_id string, text string")
    docs = spark.createDataFrame([(1, f"a {words} b"), (2, "a Rare, pair"), (3, "clean"), (4, "lone"), (5, None)], "doc_id bigint, text string")

    def found():
        rows = op7_decontamination.contamination(docs, items)
        hints = rows._jdf.queryExecution().analyzed().toString().count("strategy=broadcast")
        return hints, {r.doc_id: (r.n_words, r.n_hit, r.n_items, tuple(r.item_ids)) for r in rows.collect()}

    expected = {1: (12, 10, 300, tuple(sorted(f"i{n}" for n in range(300)))), 2: (3, 2, 1, ("s",)), 3: (1, 0, 0, ()), 4: (1, 1, 1, ()), 5: (0, 0, 0, ())}
    hints, rows = found()
    assert rows == expected
    monkeypatch.setattr(op7_decontamination, "BROADCAST_WINDOWS", 100)  # three windows, but 302 rows with their items
    few, rows = found()
    assert rows == expected and few < hints
    monkeypatch.setattr(op7_decontamination, "BROADCAST_BYTES", 1)
    none, rows = found()
    assert rows == expected and none < hints


def test_the_mask_of_repeats_takes_about_a_byte_per_unit():
    """Counters of eight bytes, summed into as many again, made a worker's memory 16 times its block."""
    import tracemalloc

    from millrace.llm.columns import pack
    from millrace.llm.repeats import covered

    replies = [{"blob": pack(np.array([5, 100, 7], np.int64), np.array([9, 101, 60], np.int64))}, {"blob": pack(np.array([3_999_949], np.int64), np.array([3_999_951], np.int64))}]
    tracemalloc.start()
    mask = covered(4_000_000, 50, replies)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * 4_000_000
    assert np.flatnonzero(mask).tolist() == [*range(5, 150), *range(3_999_949, 4_000_000)]
    assert not covered(10, 50, None).any() and covered(0, 50, []).size == 0


def test_benchmark_words_are_split_without_regular_expressions(spark, frame):
    """Two of the three passes over the texts spent most of their time in them."""
    marks = "".join(map(chr, range(128))) * 2 + "ÄÖ É\u0085ß\u2028x\u3000Y\x00z" + "A1 b2  C3"
    texts = [marks, marks[::-1], "", " ", "\n\t", None, "a", "A.b", "x Y"]
    docs = frame(list(enumerate(texts)), "doc_id bigint, text string")
    lowered = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    expected = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(lowered)) for t in texts]
    found = docs.select("doc_id", op7_decontamination._words("text").alias("w")).orderBy("doc_id").collect()
    assert [r.w for r in found] == expected
    result = op7_decontamination.contamination(docs, frame([("i", "a b")], "item_id string, text string"))
    assert "regexp" not in result._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.n_words, r.n_hit) for r in result.orderBy("doc_id").collect()][4:] == [(0, 0), (0, 0), (1, 0), (2, 2), (1, 0)]
