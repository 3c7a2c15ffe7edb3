"""Chat formatting on token level: segments encoded apart, reserved ids between them, masks by prefix sums.

A turn reads, as text::

    ### role
    text </turn>

The three control strings are single reserved ids, which no encoded text can hold: "### " opens a turn, a
line end closes its role, " </turn>" with a line end closes it. In roles and texts a backslash stands before
every backslash, every "#" of three or more in a row, and the "<" of "</turn>"; a line end in a role is
written as backslash n. So the rendered text holds control strings only where the format put them, and
escaping can be undone.

The output has one row per turn with its ids and its place in the conversation, so a conversation of any
length is never gathered in one row.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.columns import table
from millrace.plans.scratch import stored

TOKENIZER = "byte_bpe_50k.json"
# Reserved ids follow the tokenizer's own, in this order.
CONTROLS = ("### ", "\n", " </turn>\n")
ASSISTANT = "assistant"
_HASHES = re.compile(r"#{3,}")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\").replace("</turn>", "\\</turn>")
    return _HASHES.sub(lambda m: "\\#" * len(m[0]), text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # a special token's string in a text is ordinary text
    return tokenizer


def format_turns(turns: DataFrame, path: str) -> DataFrame:
    """conv_id, turn, role and per turn: ids, token_start, loss_start, loss_end, char_start, n_chars.

    ``turns`` has conv_id, turn, role and text; other columns are not read. Rows go by turn, ties by role
    and then text; a null turn comes first; null role or text is the empty string; rows with a null conv_id
    form one conversation; repeated rows are turns of their own; an empty table gives an empty result. token_start and
    char_start count from the conversation's begin (prefix sums over its turns). The loss mask of a turn
    covers ids loss_start to loss_end of the conversation: an assistant's text, nothing else.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        first = tokenizer.get_vocab_size()
        head, middle, tail = range(first, first + 3)
        for batch in batches:
            rows = batch.num_rows
            roles = [escape_role(x) for x in batch.column("role").to_pylist()]
            texts = [escape(x) for x in batch.column("text").to_pylist()]
            known = {r: tokenizer.encode(r, add_special_tokens=False).ids for r in set(roles)}
            ids, begins, sizes, chars = [], [], [], []
            for at in range(0, rows, 200):
                found = tokenizer.encode_batch(texts[at : at + 200], add_special_tokens=False)
                for role, text, encoding in zip(roles[at : at + 200], texts[at : at + 200], found):
                    start = [head, *known[role], middle]
                    ids.append([*start, *encoding.ids, tail])
                    begins.append(len(start))
                    sizes.append(len(encoding.ids))
                    chars.append(len(role) + len(text) + sum(map(len, CONTROLS)))
            own = ["conv_id", "turn", "role", "text"]
            yield pa.record_batch(
                [*(batch.column(c) for c in own), pa.array(ids, pa.list_(pa.int32())), pa.array(begins, pa.int64()), pa.array(sizes, pa.int64()), pa.array(chars, pa.int64())],
                [*own, "ids", "begin", "size", "n_chars"],
            )

    empty = F.lit("")
    plain = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    encoded = plain.mapInArrow(encode, "conv_id bigint, turn bigint, role string, text string, ids array<int>, begin bigint, size bigint, n_chars bigint")
    over = "OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    placed = encoded.selectExpr(
        "*", f"coalesce(sum(size(ids)) {over}, 0L) AS token_start", f"coalesce(sum(n_chars) {over}, 0L) AS char_start",
        "row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place",
    )
    learned = F.col("role") == ASSISTANT
    start = F.col("token_start") + F.col("begin")
    return placed.select(
        "conv_id", "turn", "place", "role", "ids", "token_start",
        F.when(learned, start).alias("loss_start"), F.when(learned, start + F.col("size")).alias("loss_end"),
        "char_start", "n_chars",
    )


def read_back(formatted: DataFrame, path: str) -> DataFrame:
    """Digests of each conversation from its ids and mask alone: n_turns, turns, loss text, formatted text.

    A conversation's turns pass through one task in order, as a stream; the task keeps hash states only.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        first = tokenizer.get_vocab_size()
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        done: list[tuple] = []
        state: list = []
        current: object = state  # equal to no id

        def close() -> None:
            if state:
                done.append((current, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        def rows() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            out = pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done) if done else [[]] * 6, kinds)], names)
            done.clear()
            return out

        for batch in batches:
            for conv, ids, start, low, high in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "ids", "token_start", "loss_start", "loss_end"))):
                if conv is not current and conv != current or not state:
                    close()
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                cuts = [i for i, x in enumerate(ids) if x >= first]
                shown = [tokenizer.decode(ids[a + 1 : b], skip_special_tokens=False) for a, b in zip(cuts, cuts[1:])]
                role, text = map(unescape, shown)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[4] += sum(map(len, shown)) + sum(len(CONTROLS[ids[i] - first]) for i in cuts)
                if low is not None:
                    learned = unescape(tokenizer.decode(ids[low - start : high - start], skip_special_tokens=False))
                    state[2] += len(learned)
                    state[3].update(learned.encode())
            yield rows()
        close()
        yield rows()

    needed = formatted.select("conv_id", "place", "ids", "token_start", "loss_start", "loss_end")
    return needed.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(
        digest, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )


def rendered(formatted: DataFrame, path: str) -> DataFrame:
    """conv_id, place and the turn's text with its control strings, as a reader of the training text sees it."""

    def show(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        first = tokenizer.get_vocab_size()
        for batch in batches:
            texts = []
            for ids in batch.column("ids").to_pylist():
                cuts = [i for i, x in enumerate(ids) if x >= first]
                parts = [tokenizer.decode(ids[a + 1 : b], skip_special_tokens=False) for a, b in zip(cuts, cuts[1:])]
                texts.append("".join(x for i, c in enumerate(cuts) for x in (CONTROLS[ids[c] - first], *parts[i : i + 1])))
            yield pa.record_batch([batch.column("conv_id"), batch.column("place"), pa.array(texts, pa.string())], ["conv_id", "place", "formatted"])

    return formatted.select("conv_id", "place", "ids").mapInArrow(show, "conv_id bigint, place int, formatted string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    path = public_tokenizers.path(TOKENIZER)
    return read_back(stored(format_turns(turns, path), "chat"), path)
