import re
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from millrace.llm import op3_packing, op9_language  # noqa: E402
from millrace.session import ship_package  # noqa: E402


def edited(words, *places):
    """The words as text, those at ``places`` exchanged."""
    return " ".join(f"edit{i}" if i in places else w for i, w in enumerate(words))


NEAR = [f"near{i}" for i in range(144)]


def test_near_copies_take_five_words_at_eighty_percent(spark):
    rows = [(1, edited(NEAR)), (2, edited(NEAR, 30, 70, 110)), (3, edited(NEAR, 20, 50, 90, 120))]
    assert [brute.classes(rows)[k][1] for k in (1, 2, 3)] == [1, 2, 3]
    assert [brute.classes(rows, 5, 80)[k][1] for k in (1, 2, 3)] == [1, 1, 3]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()) == [1, 3]


def test_stages_judge_rows_and_not_ids(spark, tmp_path):
    item = "the quick brown fox jumps over the lazy dog while eleven owls watch"
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    ddl = "doc_id bigint, text string, lang string"
    clean = [(None, "the first clean text of the fixture", "en"), (7, "the other clean text of that fixture", "en")]
    learned = [(i, f"the house and the {i} trees", "en") for i in range(100, 106)]

    def left(stage, rows):
        return sorted(map(tuple, stage(spark, spark.createDataFrame(rows, ddl), str(tmp_path)).collect()), key=repr)

    bad = [(None, None, "en"), (None, "12 !", None), (7, "", "en")]
    assert left(corpus_pipeline.language, learned + clean + clean + bad) == sorted(learned + clean + clean, key=repr)
    dirty = [(None, f"some lead {item}", "en"), (7, item.upper(), "en")]
    assert left(corpus_pipeline.decontaminated, clean + clean + dirty) == sorted(clean + clean, key=repr)
    copy = edited(NEAR)
    rows = [*clean, clean[1], (3, copy, "en"), (3, copy, "en"), (None, edited(NEAR, 9), "en"), (None, "all null ids", "en"), (None, "ALL null ids", "en"), (None, None, "fr"), (None, None, "fr")]
    found = left(corpus_pipeline.near_copies, rows)
    lone = [r for r in found if r[1] and r[1].lower() == "all null ids"]
    assert len(lone) == 1
    assert sorted(set(found) - set(lone), key=repr) == sorted([*clean, (3, copy, "en"), (None, None, "fr")], key=repr) and len(found) == 6


ITEM = "the quick brown fox jumps over the lazy dog while eleven owls watch"
Row = tuple  # doc_id, text, lang, n_chars


def plain_near_copies(rows: list[Row]) -> list[Row]:
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0]))
    root = brute.classes([(i, r[1]) for i, r in enumerate(ordered)], 5, 80)
    return [r for i, r in enumerate(ordered) if root[i][1] == i]


def plain_repeats(rows: list[Row], length: int = 50) -> list[Row]:
    seen, out = set(), []
    for r in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        data = r[1].encode()
        windows = [data[i : i + length] for i in range(len(data) - length + 1)]
        gone = {i + k for i, w in enumerate(windows) if w in seen for k in range(length)}
        seen.update(windows)
        text = bytes(b for i, b in enumerate(data) if i not in gone).decode("utf-8", "ignore")
        if not gone or len(gone) < len(data):
            out.append((r[0], text, r[2], len(text) if gone else r[3]))
    return out


def plain_decontaminated(rows: list[Row], n: int = 10) -> list[Row]:
    def windows(text: str) -> set[tuple]:
        words = re.findall("[0-9a-z\x80-\U0010ffff]+", text.translate(brute.LOWER))
        return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}

    return [r for r in rows if not windows(r[1]) & windows(ITEM)]


def plain_packed(rows: list[Row]) -> list[tuple]:
    encode = Tokenizer.from_file(public_tokenizers.path(op3_packing.TOKENIZER)).encode
    found = [(r[0], [*encode(r[1], add_special_tokens=False).ids, 1]) for r in rows]
    return [(key, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for key, ids in found]


def test_pipeline_equals_plain_version(spark, tmp_path):
    shared = " ".join(f"shared{i}" for i in range(12)) + " é"
    texts = [
        (1, edited(NEAR), "en"), (2, edited(NEAR, 30, 70, 110), "en"), (3, edited(NEAR, 20, 50, 90, 120), "en"), (4, edited(NEAR), "en"), (4, edited(NEAR), "en"),
        (5, f"one beginning {shared} and its own end", "en"), (6, f"une autre {shared} et sa fin à part", "fr"), (None, f"no id at all {shared} but other words", "en"), (8, shared, "fr"),
        (None, f"a planted passage {ITEM} and a tail", "en"), (9, f"LOUD {ITEM.upper()}", "de"), (10, ITEM.replace("fox", "cat").replace("eleven", "ten"), "en"),
        (None, None, "en"), (None, "1 2 !", "de"), (11, "", None), (11, "der wald und die stadt", "de"), (None, "a clean text of no id", "en"), (None, "a clean text of no id", "en"),
        (12, "same row twice in this table", "en"), (12, "same row twice in this table", "en"), (12, "other words under that same id", None),
    ]
    rows = [(*t, len(t[1] or "")) for t in texts]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    steps = {
        "language": lambda rows: [r for r in rows if r[1] and re.search("[^\\W\\d_]", r[1])],
        "near_copies": plain_near_copies,
        "repeats": plain_repeats,
        "decontaminated": plain_decontaminated,
    }
    assert [name for name, _ in corpus_pipeline.STAGES] == [*steps, "packed"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, rows = len(rows), steps[name](rows)
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert sorted(map(tuple, docs.select("doc_id", "text", "lang", "n_chars").collect()), key=repr) == sorted(rows, key=repr), name
        assert len(rows) < before
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.length, r.ids_crc32) for r in found), key=repr) == sorted(plain_packed(rows), key=repr)


def test_language_equals_plain_kernel_ridge(spark):
    ship_package(spark)
    rows = [(1, "the house and the trees", "en"), (2, "der wald und die stadt", "de"), (3, "a road by the sea", "en"), (4, "ein weg an der see", "de"), (5, "The SEE 12", None), (6, "жук", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")

    def grams(text: str) -> set[str]:
        return {text.lower()[i : i + n] for n in (1, 2, 3) for i in range(len(text) - n + 1)}

    def kernel(a: list[set], b: list[set]) -> np.ndarray:
        return np.array([[len(x & y) / np.sqrt(len(x) * len(y)) for y in b] for x in a])

    marks = [grams(t) for _, t, lang in rows if lang]
    y = np.array([[lang == x for x in ("de", "en")] for *_, lang in rows if lang], float)
    values, vectors = np.linalg.eigh(kernel(marks, marks))
    root = vectors / np.sqrt(values)
    x = np.column_stack([kernel(marks, marks) @ root, np.ones(len(marks))])
    w = np.linalg.solve(x.T @ x + op9_language.RIDGE * np.eye(x.shape[1]), x.T @ y)
    plain = kernel([grams(t) for _, t, _ in rows], marks) @ root @ w[:-1] + w[-1]
    got = sorted(op9_language.predict(docs, op9_language.fit(docs, "true")).collect())
    assert [r.lang_pred for r in got] == [("de", "en")[i] for i in plain.argmax(1)]
    assert np.allclose([r.score for r in got], plain.max(1).clip(0, 1), atol=1e-3)
