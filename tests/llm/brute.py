"""Plain versions of the operators, for small inputs, and a table of awkward documents."""

from __future__ import annotations

import hashlib
import re

WORD = "[^\x20\x09-\x0d]+"
LOWER = {i: i + 32 for i in range(65, 91)}


def awkward(benchmark_text: str) -> list[tuple]:
    """(doc_id, text, lang, token): nulls, empties, copies, near copies, long and repeated texts, a clashing name."""
    base = " ".join(f"word{i % 97}x{i}" for i in range(120))
    near = base.replace("word5x5", "other")
    shared = " ".join(f"shared{i}" for i in range(60))
    return [
        (1, base, "en", "a"),
        (2, base, "en", "b"),
        (3, near, "en", None),
        (4, None, "en", None),
        (5, "", None, "x"),
        (6, " \t\n", "fr", "x"),
        (7, "Hi", "en", "x"),
        (8, "hI", "en", "x"),
        (9, f"Une préface à part. {shared} Ça suffit", "fr", "x"),
        (10, f"Avant, d'autres mots ici. {shared} et après çà", "fr", "x"),
        (11, "ab" * 3000, "en", "x"),
        (12, "same words again " * 40, "en", "x"),
        (13, f"Some lead. {benchmark_text.upper()} Some tail", "en", "x"),
        (14, "x" * 20000 + " end", "en", "x"),
        (15, "中文 текст <|endoftext|> É", "de", "x"),
        (16, base, "en", "a"),
    ]


def removed_bytes(rows: list[tuple[int, bytes]], length: int = 50) -> dict[int, tuple]:
    seen: set[bytes] = set()
    out = {}
    for key, data in sorted(rows):
        windows = [data[i : i + length] for i in range(len(data) - length + 1)]
        gone = bytearray(len(data))
        for i, w in enumerate(windows):
            if w in seen:
                gone[i : i + length] = b"\1" * length
        seen.update(windows)
        rest = bytes(b for b, g in zip(data, gone) if not g)
        out[key] = (len(data), sum(gone), len(re.findall(b"\x01+", bytes(gone))), hashlib.sha256(rest).hexdigest())
    return out


def removed_words(rows: list[tuple[int, str]], window: int = 20) -> dict[int, tuple]:
    seen: set[tuple] = set()
    out = {}
    for key, text in sorted(rows):
        words = re.findall(WORD, text)
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            if w in seen:
                gone[i : i + window] = [True] * window
            seen.add(w)
        rest = " ".join(w for w, g in zip(words, gone) if not g)
        out[key] = (len(words), sum(gone), hashlib.sha256(rest.encode()).hexdigest())
    return out


def classes(rows: list[tuple[int, str]], n: int = 4, percent: int = 85) -> dict[int, tuple]:
    sets = {}
    for key, text in rows:
        words = re.findall(WORD, text.translate(LOWER))
        grams = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
        sets[key] = grams if len(words) >= n else ({tuple(words)} if words else set())
    root = {key: key for key in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= percent * len(sets[a] | sets[b]) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return {key: (len(sets[key]), root[key]) for key in sets}
