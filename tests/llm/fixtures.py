"""Small documents with every awkward case, and brute-force helpers."""

from __future__ import annotations

import random
import re

import numpy as np
import xxhash

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row long, name string, size int, "
          "h string, node long, component long, score double, _key string, label string, digest binary, unit long, "
          "slot int, keep_id long, first string, n int, `key` string, `table` string, occ int")
#: Columns named like ones the operators use inside.
EXTRA = (7, "n", 1, "h", 3, 4, 0.5, "k", "l", b"d", 5, 6, 8, "f", 9, "key", "t", 10)


def words(n: int, seed: int, alphabet: str = "abcdefghijklmnop") -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice(alphabet) for _ in range(r.randint(2, 8))) for _ in range(n)]


def text(n: int, seed: int) -> str:
    return " ".join(words(n, seed))


def awkward() -> list[tuple]:
    """(doc_id, text, lang, source): nulls, empties, ties, repeats, a very long text."""
    base = text(120, 1)
    return [
        (1, base, "en", "a"), (2, base, "en", "b"), (2, base, "en", "b"),
        (3, base.replace(" ", "\n\t"), None, "a"), (4, base + " tail", "en", None),
        (5, None, "en", "a"), (6, "", "en", "b"), (7, " \t\n", None, None),
        (None, "some words without an id", "en", "b"), (None, None, None, None),
        (8, "One", "en", "a"), (9, "One Two", "en", "a"), (10, text(60_000, 2), "en", "a"),
        (11, "Ünïcödé ß 漢字 \U0001F600 " + text(30, 3), "de", "b"), (12, text(80, 4), "en", "ü"),
    ]


def frame(spark, rows, extra: bool = True):
    full = [(i, t, lang, source, None if t is None else len(t), *EXTRA) for i, t, lang, source in rows]
    df = spark.createDataFrame(full, SCHEMA)
    return df if extra else df.select("doc_id", "text", "lang", "source", "n_chars")


def split(t: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def lower(t: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def fingerprint(t: str | None, width: int = 4) -> int:
    w = split(lower(t or ""))
    if not w:
        return 0
    hs = [xxhash.xxh64(" ".join(w[k:k + width]).encode(), seed=42).intdigest() for k in range(max(1, len(w) - width + 1))]
    bits = np.unpackbits(np.array(hs, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=int)
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(hs))


def components(n: int, links) -> list[int]:
    """Smallest member of each place's set."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
