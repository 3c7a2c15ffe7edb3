"""What worker processes keep between steps, and sums over the links of a block."""

import sys
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa

from millrace.llm import op13_alignment, repeats, tokens, words
from millrace.llm.columns import BATCH_BYTES, lean, lean_group, let_go, pack, unpack
from millrace.llm.op5_suffix_dedup import byte_units
from millrace.session import ship_package


def test_steps_of_op13_that_read_no_text_free_the_tokenizers():
    paths = public_tokenizers.path(op13_alignment.TOKENIZER_A), public_tokenizers.path(op13_alignment.TOKENIZER_B)
    op13_alignment.tokenizer_pair(*paths).encode([b"some words"])
    blob = pack(np.array([5, 9], np.uint64), np.array([2, 3]))
    group = pa.table({"block": [1, 2], "bucket": [0, 0], "blob": [blob, blob]})
    found = op13_alignment._totals((pa.scalar(0),), group).to_pylist()
    assert op13_alignment.tokenizer_pair.cache_info().currsize == 0
    assert [x.tolist() for x in unpack(found[0]["blob"])] == [[5, 9], [4, 6]]


def test_op13_bounds_its_batches(spark):
    ship_package(spark)
    given = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "64m")
        docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
        paths = public_tokenizers.path(op13_alignment.TOKENIZER_A), public_tokenizers.path(op13_alignment.TOKENIZER_B)
        assert op13_alignment.link_statistics(docs, *paths).count() == 1
        assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) == BATCH_BYTES
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", given)


def test_sums_by_parts_equal_sums_at_once(monkeypatch):
    monkeypatch.setattr(op13_alignment, "SUMMED", 7)
    rng = np.random.default_rng(3)
    sizes = rng.integers(0, 20, 50)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    values, place = rng.integers(0, 1 << 40, 30), rng.integers(0, 30, int(sizes.sum())).astype(np.uint32)
    for x in (values, values % 2 == 0):
        assert op13_alignment._sums(x, place, bounds).tolist() == [int(x[place[a:b]].sum()) for a, b in zip(bounds[:-1], bounds[1:])]
    assert op13_alignment._sums(values, place[:0], np.zeros(1, np.int64)).tolist() == []


def test_steps_free_stored_words_of_steps_before():
    tokens.word_tokenizer(public_tokenizers.path("word_bpe_49k.json")).encode_many([b"some words"])
    assert tokens.word_tokenizer.cache_info().currsize
    let_go()
    assert not tokens.word_tokenizer.cache_info().currsize


def test_each_new_piece_is_encoded_once_for_all_words_of_a_slice(monkeypatch):
    tokenizer = tokens.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    encode = tokenizer.tokenizer.encode
    monkeypatch.setattr(tokens, "_WORDS", 5)
    some = ["Straße", "can't", "wide\u4e2d\u6587", "\xa0", "\x85\xad", "'s", "\u0130x", "12a", "a\x00b", "\x1c", "\u212b", "end</s>", "x" * 300, "d\xc9j\xc0", "\u4e2d", "''re"]
    some += [t.content for t in tokenizer.tokenizer.get_added_tokens_decoder().values()]
    flat, sizes = tokenizer._encode_words([w.encode() for w in some])
    expected = [encode(w, add_special_tokens=False).ids for w in some]
    assert sizes.tolist() == [len(x) for x in expected]
    assert flat.tolist() == [i for x in expected for i in x]
    texts = [" ".join(some), "", "\n", " ".join(some[::-1]), "a\tb  c"]
    assert [x.tolist() for x in tokenizer.encode_many([t.encode() for t in texts])] == [encode(t, add_special_tokens=False).ids for t in texts]


def test_both_word_hashes_equal_those_alone(monkeypatch):
    monkeypatch.setattr(words, "_AT_ONCE", 3)
    data, _ = words.joined([b"one three", b"", b"a bc def ghij klmno", b"\xc3\xa9 x"])
    starts, ends = words.word_spans(data)
    both = words.two_word_hashes(data, starts, ends)
    assert [x.tolist() for x in both] == [words.word_hashes(data, starts, ends, radix=k).tolist() for k in (0, 1)]
    assert [x.size for x in words.two_word_hashes(data[:0], starts[:0], ends[:0])] == [0, 0]


def test_runs_of_a_block_are_held_once():
    data = np.random.default_rng(7).integers(0, 256, 8 << 20, dtype=np.uint8)
    bounds = np.arange(0, data.size + 1, 1 << 16)
    tracemalloc.start()
    try:
        runs, _, _ = repeats.runs_of(byte_units(50), bounds, data)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 1.7 * sum(x.nbytes for x in vars(runs).values())


def test_windows_of_a_block_go_in_small_batches(monkeypatch):
    monkeypatch.setattr(repeats, "SENT", 1000)
    text = np.random.default_rng(8).integers(97, 123, 3000, dtype=np.uint8)
    blob = pack(np.array([4, 5]), np.array([3000, 3000]), np.concatenate([text, text[::-1]]))
    replies = {b: b"\xff" * 1000 for b in range(7)}
    rows = list(repeats._sent_windows(byte_units(50), 7, 3, blob, replies))
    batches = list(repeats._batches(iter(rows)))
    assert len(batches) > 1
    assert [tuple(r.values()) for b in batches for r in b.to_pylist()] == rows
    assert list(repeats._batches(iter(()))) == []


def test_ids_of_stored_pieces_take_few_bytes():
    tokenizer = tokens.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    letters = np.random.default_rng(9).integers(97, 123, (3000, 9), dtype=np.uint8)
    tokenizer.encode_many([b" ".join(x.tobytes() for x in letters)])
    held = [sys.getsizeof(x) + (sum(map(sys.getsizeof, x)) if isinstance(x, tuple) else 0) for x in tokenizer.pieces.values()]
    assert sum(held) / len(held) < 80


def test_lean_steps_free_what_the_worker_keeps_and_give_the_same():
    batch = pa.record_batch([pa.array([1, 2])], ["x"])
    path = public_tokenizers.path("word_bpe_49k.json")

    def step(batches):
        assert not tokens.word_tokenizer.cache_info().currsize
        for given in batches:
            tokens.word_tokenizer(path)
            yield given

    tokens.word_tokenizer(path)
    assert list(lean(step)(iter([batch, batch]))) == [batch, batch]
    assert not tokens.word_tokenizer.cache_info().currsize
    table = pa.table({"x": [1, 2]})
    assert lean_group(lambda group: group.slice(1))(table) == table.slice(1)
