"""Removal of repeated word passages by seed and extend.

Seeds are winnowed: of the 11 ten-word grams in each window of 20 words the smallest hash, so equal windows
share a seed at the same place. Seeds that occur more than once keep their windows, which are named by
64 bits (the hashes of their first and last ten words) and compared by name inside the seed's group; no
documents are joined on seeds and no match is extended word by word. Neighbouring repeats join into maximal
ones. Comparing is by sorting, not by pairs, so a passage of any frequency costs its number of copies (see
``repeats``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.blocks import read_block, store_blocks, with_replies
from millrace.llm.columns import id_and_text, ids_to_arrow, lean, table
from millrace.llm.repeats import Units, covered, find_repeats
from millrace.llm.words import ngram_hashes, words_of

WINDOW = 20


def word_units(window: int) -> Units:
    gram = window // 2

    def grams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        *_, hashes, words = words_of([raw[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())])
        return ngram_hashes(hashes, gram), words

    return Units(grams, window, gram, content=False, same_document=True)


def remove_passages(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Each document without the words of ``window``-word windows that also start earlier.

    Earlier is a smaller doc_id, or the same document at an earlier place. Returns doc_id, n_words,
    n_removed, spans (array of start, end in words: the maximal repeats) and kept (the remaining words,
    joined by one space). Words are runs of anything but ASCII white space, unchanged; windows are
    judged on the input. Null and empty texts have no words; texts shorter than a window lose none; a null
    doc_id counts as larger than all others; rows with one doc_id are told apart by the block they are
    in; an empty table gives an empty result; other columns are not read.
    """
    if window < 2 or window % 2:
        raise ValueError("the window takes an even number of words")
    units = word_units(window)
    blocks = store_blocks(id_and_text(docs), [])
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob, replies in zip(*(batch.column(c).to_pylist() for c in ("texts", "replies"))):
                ids, bounds, data = read_block(blob)
                raw = data.tobytes()
                lists = [raw[a:b].split() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                words = np.concatenate([[0], np.cumsum([len(w) for w in lists])]).astype(np.int64)
                gone = covered(int(words[-1]), window, replies)
                kept, removed, spans = [], [], []
                for own, begin, end in zip(lists, words[:-1].tolist(), words[1:].tolist()):
                    mask = gone[begin:end]
                    hit = int(mask.sum())
                    removed.append(hit)
                    if not hit:
                        kept.append(b" ".join(own))
                        spans.append([])
                        continue
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
                    spans.append([{"start": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)])
                    kept.append(b" ".join(own[i] for i in np.flatnonzero(~mask).tolist()))
                rows = pa.record_batch(
                    [ids_to_arrow(ids), pa.array(np.diff(words)), pa.array(removed, pa.int64()), pa.array(spans, spans_type), pa.array(kept, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "n_removed", "spans", "kept"],
                )
                for at in range(0, rows.num_rows, 2000):
                    yield rows.slice(at, 2000)

    schema = "doc_id bigint, n_words bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept string"
    return with_replies(blocks, find_repeats(blocks, units)).select("texts", "replies").mapInArrow(lean(cut), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
