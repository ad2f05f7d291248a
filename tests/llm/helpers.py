"""Small document tables and brute-force twins shared by the tests."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rep long, size long, component string"


def frame(spark, texts, langs=None, sources=None, ids=None, schema=SCHEMA):
    """A documents table with extra columns that clash with names used inside the operators."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, langs[k] if langs else None, sources[k] if sources else None, None if t is None else len(t), 1, 2, "x")
            for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, schema)


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def shingles(text: str | None, k: int) -> set:
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def find_components(nodes, edges):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}
