"""Plain loops that the operators are held against, and awkward tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: Columns whose names the operators use inside.
CLASHES = ("row", "id", "body", "place", "lines", "words", "fp", "ids", "starts", "kept", "component", "rate", "window")

LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
SHARED = "a line that is shared by very many documents, with enough characters"
PASSAGE = " ".join(f"passage{i}" for i in range(60))

AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, "one"),
    (5, f"{SHARED}\nown line of five, which is long enough to be looked at\n{SHARED}"),
    (6, f"  {SHARED.upper()} \nsix"),
    (7, f"\n\n{SHARED}\t\n\n"),
    (8, f"{SHARED}\nÉÀ ß İ Σ 汉字 🙂  nbsp em\x85nel\x1c"),
    (9, f"x\n{SHARED}"),
    (9, f"x\n{SHARED}"),
    (9, f"another text of the same id\n{SHARED}"),
    (None, f"no id\n{SHARED}"),
    (None, PASSAGE),
    (10, f"before {PASSAGE} after"),
    (11, f"{PASSAGE} {PASSAGE}"),
    (12, LONG),
    (13, LONG + " end"),
    (14, "the same words again and again " * 40),
    (15, "### $$$ ||| <<>> %%% &&& ***"),
    (16, "a" * 50_000),
]


def awkward(spark, rows=AWKWARD):
    """documents, with further columns of clashing names."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    full = [(i, t, "en" if k % 2 else None, "s", len(t or "")) for k, (i, t) in enumerate(rows)]
    frame = spark.createDataFrame(full, schema)
    return frame.selectExpr("*", *(f"'clash' AS `{c}`" for c in CLASHES)).repartition(3)


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(text.count(x) for x in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def line_dedup(rows):
    """(doc_id, n_lines, n_dropped, sha) for each row."""
    least = float("-inf")
    holders = defaultdict(set)
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(least if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        own = least if i is None else i
        stay = [x for x in lines if len(holders[key(x)]) < 5 or max(holders[key(x)]) == own]
        out.append((i, len(lines), len(lines) - len(stay), sha("\n".join(stay))))
    return out


def fingerprint(text, width=3):
    w = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    """The least node that each node reaches."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def substring_dedup(rows, width=13):
    """(doc_id, n_words, n_removed, sha) for each row."""
    most = float("inf")
    owner = {}
    split = [(i, most if i is None else i, WORD.findall(t or "")) for i, t in rows]
    for _, own, w in split:
        for k in range(len(w) - width + 1):
            window = tuple(w[k : k + width])
            owner[window] = min(owner.get(window, most), own)
    out = []
    for i, own, w in split:
        gone = {
            k + j for k in range(len(w) - width + 1) if owner[tuple(w[k : k + width])] < own for j in range(width)
        }
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)
