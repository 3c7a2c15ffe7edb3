"""Token ids of whole texts with a public tokenizer file, computed once per distinct word and task process."""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

from millrace.llm.columns import give_back, kept_in_worker
from millrace.llm.words import joined, two_word_hashes, word_spans

# Words kept per worker process; when full the store starts anew, so memory stays bounded.
STORED_WORDS = 700_000

# The word pattern of the tokenizer file, with the letters and digits among the first 256 code points
# written out: its classes \p{L}, \p{N} and \s. Fixed values. Words are matched many at a time, a line each; a line
# break is a piece of its own.
_LETTERS = "a-zªµºß-öø-ÿ"
_NUMBERS = "0-9²³¹¼½¾"
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\t-\r \x85\xa0{_LETTERS}{_NUMBERS}]+|\n")
_WIDE = re.compile("[^\x00-\xff]")
_BREAK = (1 << 32) - 1
_ID = next(kind for kind in "IL" if array(kind).itemsize == 4)
# Words encoded at once.
_WORDS = 1 << 15

# The settings of a tokenizer file that the pattern above and the splitting at white space stand for. Fixed values.
_KNOWN = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
}
# Texts that the library encodes at once when a file's settings are others.
_TEXTS = 64


def _byte_letters() -> dict[int, int]:
    """Byte-level vocabularies write each byte as a printable character: itself, or the next one from 256 up."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(hidden)}


class WordTokenizer:
    """Ids equal to ``Tokenizer.encode(text, add_special_tokens=False).ids`` of whole texts, without truncation or padding.

    Word by word for a file whose settings are the ones written out above; any other file's texts
    go to the library whole. White space only separates for this kind of tokenizer file (byte-level BPE with word ends, lower
    case, white space dropped), so a text's ids are its words' ids in order. Words are told apart by two
    64-bit hashes of their bytes, computed for all words of a slice at once; only a word that the
    process has not seen is encoded. Words outside the first 256 code points, or with a special
    token's string inside, are encoded by the library as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = list(self.tokenizer.get_added_tokens_decoder().values())
        settings = json.loads(self.tokenizer.to_str())
        model = settings["model"]
        self.by_words = (
            all(settings[name] == value for name, value in _KNOWN.items())
            and model["type"] == "BPE"
            and not model["dropout"]
            and not any(t.lstrip or t.rstrip or t.single_word or t.normalized or t.content.split() != [t.content] for t in added)
        )
        self.special = re.compile("|".join(re.escape(t.content) for t in added) or r"(?!)")
        letters = _byte_letters()
        self.shown = np.array([letters.get(b, b) if b != 10 else b for b in range(256)], "<u2")
        self.dtype = np.dtype(np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32)
        self._reset()

    def _reset(self) -> None:
        # Ids of a piece as their bytes: a third of what a tuple of numbers takes.
        self.pieces: dict[str, bytes] = {"\n": array(_ID, [_BREAK]).tobytes()}
        self.keys = np.zeros(0, np.uint64)
        self.checks = np.zeros(0, np.uint64)
        self.begins = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.ids = np.zeros(0, self.dtype)

    def _encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in order, how many each word has)."""
        lines = b"\n".join(words).decode()
        whole: dict[int, list[int]] = {}
        if _WIDE.search(lines) or self.special.search(lines):
            each = lines.split("\n")
            whole = {i: self.tokenizer.encode(w, add_special_tokens=False).ids for i, w in enumerate(each) if _WIDE.search(w) or self.special.search(w)}
            lines = "\n".join(["" if i in whole else w for i, w in enumerate(each)])
        pieces = _PIECES.findall(lines.lower())
        if new := list(set(pieces) - self.pieces.keys()):
            shown = self.shown[np.frombuffer("\n".join(new).encode(), np.uint8)].tobytes().decode("utf-16-le")
            tokenize = self.model.tokenize
            for piece, text in zip(new, shown.split("\n")):
                self.pieces[piece] = array(_ID, [t.id for t in tokenize(text)]).tobytes()
        flat = np.frombuffer(b"".join(map(self.pieces.__getitem__, pieces)), np.uint32)
        breaks = flat == _BREAK
        sizes = np.diff(np.flatnonzero(breaks), prepend=-1, append=flat.size) - 1
        flat = flat[~breaks]
        if whole:
            at = np.array(list(whole))
            more = np.array([len(ids) for ids in whole.values()])
            flat = np.insert(flat, np.repeat((np.cumsum(sizes) - sizes)[at], more), np.fromiter(chain.from_iterable(whole.values()), np.uint32))
            sizes[at] = more
        return flat.astype(self.dtype), sizes

    def _add(self, keys: np.ndarray, checks: np.ndarray, words: list[bytes]) -> None:
        if self.keys.size + len(words) > STORED_WORDS:
            self._reset()
        made = [self._encode_words(words[i : i + _WORDS]) for i in range(0, len(words), _WORDS)]
        sizes = np.concatenate([x for _, x in made])
        begins = self.ids.size + np.cumsum(sizes) - sizes
        order = np.argsort(all_keys := np.concatenate([self.keys, keys]), kind="stable")
        self.keys = all_keys[order]
        self.checks = np.concatenate([self.checks, checks])[order]
        self.begins = np.concatenate([self.begins, begins])[order]
        self.sizes = np.concatenate([self.sizes, sizes])[order]
        self.ids = np.concatenate([self.ids, *(x for x, _ in made)])

    def _find(self, keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, whether it is the word there)."""
        if not self.keys.size:
            return np.zeros(keys.size, np.int64), np.zeros(keys.size, bool)
        at = np.minimum(np.searchsorted(self.keys, keys), self.keys.size - 1)
        return at, (self.keys[at] == keys) & (self.checks[at] == checks)

    def encode_many(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each UTF-8 text, as unsigned 16- or 32-bit arrays."""
        if not self.by_words:
            found: list[np.ndarray] = []
            for at in range(0, len(texts), _TEXTS):
                some = [x.decode() for x in texts[at : at + _TEXTS]]
                found += (np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch(some, add_special_tokens=False))
            return found
        data, begins = joined(texts)
        starts, ends = word_spans(data)
        bounds = np.searchsorted(starts, begins)
        keys, checks = two_word_hashes(data, starts, ends)
        keys, first, back = np.unique(keys, return_index=True, return_inverse=True)
        checks_of = checks[first]
        if not np.array_equal(checks_of[back], checks):
            raise ValueError("two words of one slice share a 64-bit hash")
        at, found = self._find(keys, checks_of)
        if not found.all():
            new = np.flatnonzero(~found)
            if self.keys.size + new.size > STORED_WORDS:  # the store starts anew with this slice's words
                new = np.arange(keys.size)
            raw = data.tobytes()
            words = [raw[a:b] for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())]
            self._add(keys[new], checks_of[new], words)
            at, found = self._find(keys, checks_of)
            if not found.all():
                raise ValueError("two words share a 64-bit hash")
        begins, sizes = self.begins[at][back], self.sizes[at][back]
        stops = np.cumsum(sizes)
        ids = self.ids[np.arange(int(sizes.sum())) + np.repeat(begins - (stops - sizes), sizes)]
        cuts = np.concatenate([[0], stops])[bounds]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


@kept_in_worker
def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer, with its stored words, per worker process and file."""
    return WordTokenizer(path)


def encoded(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int, size: int = 1 << 20
) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of the batches, each of about ``size`` bytes, with the ids of their ``text`` and the end id."""
    tokenizer = word_tokenizer(path)
    tail = np.array([end_id], tokenizer.dtype)
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        begin = total = 0
        for i, text in enumerate(texts):
            total += len(text)
            if total >= size or i + 1 == len(texts):
                ids = tokenizer.encode_many(texts[begin : i + 1])
                yield batch.slice(begin, i + 1 - begin), [np.concatenate([x, tail]) for x in ids]
                begin, total = i + 1, 0
        give_back()
