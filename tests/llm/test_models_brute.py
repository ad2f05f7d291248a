"""Features, log-count ratios, n-grams and votes of the classifiers against plain versions."""

import math
import pickle
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from helpers import frame

from ridgeline.llm import language, quality
from ridgeline.llm.common import BASE, prefix_hash, segment_hash, text_bytes

MASK = (1 << 64) - 1
TEXTS = ["", " ", "One two  two\tTHREE!", "a", "a a a a", "Ünï 12 x-1 中文 中文", "end. End. END.", "w" * 70 + " " + "w" * 70, None,
         "É À Ø x×y", "ab", "a1b2 c3", "z"]


def mix(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def word_hash(word):
    return int(segment_hash(prefix_hash(np.frombuffer(word, np.uint8)), np.array([0]), np.array([len(word)]))[0])


def kind(byte):
    return 1 if 65 <= byte < 91 else 2 if 97 <= byte < 123 else 4 if 48 <= byte < 58 else 8 if byte >= 128 else 16


def plain_features(text):
    words = (text or "").encode().split()
    hashes, shapes, loose = [word_hash(w) for w in words], [], []
    for i, w in enumerate(words):
        bits = 0
        for byte in w:
            bits |= kind(byte)
        again = int(i > 0 and words[i - 1] == w)
        ending = min(w[-1], 128) if kind(w[-1]) == 16 else 0
        shapes.append(mix(bits | kind(w[0]) << 8 | ending << 16 | again << 32 | min(len(w) // 4, 7) << 40))
        loose.append(mix(bits | again << 32))
    high, base = BASE & MASK, 1 << quality.WORD_BITS
    three = BASE ^ 0xFFFF0000

    def column(value, bits, offset):
        return (mix(value & MASK) >> (64 - bits)) + offset

    out = {column(h, quality.WORD_BITS, 0) for h in hashes} | {column(s, quality.SHAPE_BITS, base) for s in shapes}
    for i in range(len(words) - 1):
        out.add(column(hashes[i] * high + hashes[i + 1], quality.WORD_BITS, 0))
        out.add(column(loose[i] * high + loose[i + 1], quality.SHAPE_BITS, base))
    for i in range(len(words) - 2):
        out.add(column(((loose[i] * high + loose[i + 1]) & MASK) * three + loose[i + 2], quality.SHAPE_BITS, base))
    return out


def test_quality_features():
    rng = random.Random(1)
    texts = TEXTS + [" ".join(rng.choices(["Aa", "b.", "b.", "3", "ü", "long-word,"], k=rng.randrange(30))) for _ in range(40)]
    row, column = quality.features(*text_bytes(pa.array(texts, pa.string())))
    got = [set(column[row == i].tolist()) for i in range(len(texts))]
    assert got == [plain_features(t) for t in texts]
    assert len(row) == sum(map(len, got))


def test_log_count_ratios(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["good", "fine", "text"] if i % 2 else ["BUY", "now", "text"], k=1 + rng.randrange(9))) for i in range(30)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, label int")
    _, ratio, _, _, _ = pickle.loads(quality.fit_quality(frame(spark, texts), labels))
    counts = [Counter(c for i, t in enumerate(texts) if i % 2 == k for c in plain_features(t)) for k in (0, 1)]
    total = [sum(c.values()) + quality.COLUMNS for c in counts]
    for c in {*counts[0], *counts[1], 5, quality.COLUMNS - 1}:
        want = math.log((counts[1][c] + 1) / total[1]) - math.log((counts[0][c] + 1) / total[0])
        assert abs(float(ratio[c]) - want) < 1e-5


def plain_grams(text):
    """Letters in lower case, every other stretch one space; columns of all byte n-grams."""
    raw, out = (text or "").encode(), bytearray()
    for i, b in enumerate(raw):
        if 65 <= b < 91:
            b += 32
        elif b >= 128:
            if i and raw[i - 1] == 0xC3 and 0x80 <= b <= 0x9E and b != 0x97:
                b += 0x20
        elif not 97 <= b < 123:
            b = 32
        out.append(b)
    flat = bytearray(b for i, b in enumerate(out) if b != 32 or i == 0 or out[i - 1] != 32)
    columns = Counter()
    for n in range(2, 5):
        for i in range(len(flat) - n + 1):
            value = 0
            for b in flat[i:i + n]:
                value = (value * 257 + b + 1) & MASK
            columns[((value * BASE) & MASK) >> (64 - language.BITS)] += 1
    return columns


def test_language_grams():
    for text in TEXTS + ["Hello, World! 12", "ÀÉ×ß straße", "x" * 500]:
        row, column = language.grams(*text_bytes(pa.array([text], pa.string())))
        assert Counter(column.tolist()) == plain_grams(text)
    # texts of one block do not run into each other (but for a space at the start of a text, which may go)
    texts = ["abc def", "ghi", "", "é1x", "zz top"]
    row, column = language.grams(*text_bytes(pa.array(texts, pa.string())))
    assert [Counter(column[row == i].tolist()) for i in range(len(texts))] == [plain_grams(t) for t in texts]


def test_language_votes():
    rng = np.random.default_rng(0)
    names = ["a", "b", "c", "d"]
    machines = {p: (rng.normal(size=language.COLUMNS).astype(np.float32), rng.normal(), 1.5, 0.1) for p in combinations(names, 2)}
    texts = ["some words here", "others", "x y z"]
    row, column = language.grams(*text_bytes(pa.array(texts)))
    got = language._among(names, machines, "", row, column, np.bincount(row, minlength=3))
    for i, text in enumerate(texts):
        grams = plain_grams(text)
        size = sum(grams.values())
        for j, name in enumerate(names):
            votes = []
            for (x, y), (weights, bias, a, b) in machines.items():
                mean = sum(float(weights[c]) * n for c, n in grams.items()) / size
                p = 1 / (1 + math.exp(-(a * (language.SCALE * mean + bias) + b)))
                votes += [p] if name == x else [1 - p] if name == y else []
            assert abs(got[i, j] - sum(votes) / 3) < 1e-6
