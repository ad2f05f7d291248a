"""Winnowing and source mixing against brute force."""

import hashlib
import random

import pytest
from helpers import SCHEMA, frame, prose, words
from pyspark.sql import functions as F

from ridgeline.llm.mixing import mix_sources, source_targets, take_copies
from ridgeline.llm.winnowing import CUT_AFTER, TOKEN, fingerprint_documents, with_next


def parsed(text):
    return [tuple(p.split(":")) for p in text.split()]


def test_edits_and_order(spark):
    rng = random.Random(1)
    texts = [None, "", "a", "ab", "é中🙂x", *(" ".join(prose(rng, rng.randrange(1, 200))) for _ in range(120))]
    ids = rng.sample(range(-1000, 1000), len(texts))
    out = {r.doc_id: r for r in fingerprint_documents(frame(spark, texts, ids=ids).repartition(5)).collect()}
    order = sorted(zip(ids, (t or "" for t in texts)))
    for (i, t), (j, u) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        edited = t[:len(t) - half] + u[:half]
        r = out[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        mine, next_, new = ({h for h, _ in parsed(x)} for x in (r.fingerprint, out[j].fingerprint, r.edited_fingerprint))
        for got, other in ((r.near_next, next_), (r.near_edited, new)):
            assert got == pytest.approx(len(mine & other) / len(mine | other) if mine | other else 1.0)


def test_winnowing_guarantee(spark):
    k, w = 3, 5
    rng = random.Random(2)
    texts = [" ".join(prose(rng, 80, 30)) for _ in range(40)] + ["same " * 50]
    out = {r.doc_id: parsed(r.fingerprint) for r in fingerprint_documents(frame(spark, texts), k, w).collect()}
    hashes = {}
    for i, t in enumerate(texts):
        tokens = words(t)
        runs = [tuple(tokens[p:p + k]) for p in range(len(tokens) - k + 1)]
        for h, p in out[i]:  # a run's hash is the same everywhere
            assert hashes.setdefault(runs[int(p)], h) == h
        places = sorted(int(p) for _, p in out[i])
        assert places[0] < w and len(runs) - places[-1] <= w and all(b - a <= w for a, b in zip(places, places[1:]))
    known = {}
    for r, h in hashes.items():
        known[r] = int(h, 16)
    for i, t in enumerate(texts):  # the smallest known hash of each window is chosen at its rightmost place
        tokens = words(t)
        runs = [tuple(tokens[p:p + k]) for p in range(len(tokens) - k + 1)]
        chosen = {int(p): int(h, 16) for h, p in out[i]}
        for a in range(len(runs) - w + 1):
            best = min((chosen[p], -p) for p in chosen if a <= p < a + w)
            assert all(known.get(runs[p], 1 << 40) > best[0] or (known[runs[p]] == best[0] and p <= -best[1]) for p in range(a, a + w))


def brute_tokens(text):
    """Tokens by a walk over the characters of every word."""
    out = []
    for word in words(text or ""):
        if len(word) <= 16 and all(ord(c) < 0x0E00 for c in word):
            out.append(word)
            continue
        at = ""
        for c in word:
            at += c
            if ord(c) >= 0x0E00 or c in CUT_AFTER or len(at) == 16:
                out.append(at)
                at = ""
        out += [at] if at else []
    return out


def test_tokens_and_windows_brute_force(spark):
    rng = random.Random(12)
    alphabet = "bcdfghjklmnpqrstvwxyz0123456789+-_aeiou/;,=&.\u4e2d\u6587\u0e01\U00020000\u2019"
    texts = [None, "", " ", "a" * 16, "b" * 16, "b" * 17, "b" * 33, "\u4e2d", "x\u4e2dy",
             *(" ".join("".join(rng.choices(alphabet, k=rng.choice([1, 5, 15, 16, 17, 40, 90]))) for _ in range(rng.randrange(1, 60)))
               for _ in range(150))]
    rows = frame(spark, texts).select("doc_id", F.regexp_extract_all(F.lower("text"), F.lit(TOKEN), F.lit(0)).alias("tokens"))
    assert {r.doc_id: r.tokens or [] for r in rows.collect()} == {i: brute_tokens(t) for i, t in enumerate(texts)}
    out = {r.doc_id: parsed(r.fingerprint) for r in fingerprint_documents(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        tokens = brute_tokens(t)
        n = max(len(tokens) - 4, 1) if tokens else 0
        w = max(1, min(16, -(-n // 8)))
        places = [int(p) for _, p in out[i]]
        assert places == sorted(places) and bool(places) == bool(n)
        assert all(any(a <= p < a + w for p in places) for a in range(n - w + 1)) and len(places) >= min(n, 8) / 2


def test_text_without_spaces(spark):
    rng = random.Random(13)
    chinese = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(3000))
    code = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789+/", k=6000))
    short = " ".join(f"word{i}" for i in range(18))
    texts = [chinese, "x" + chinese, code, "bbb" + code, short, "other words " * 9]
    out = {r.doc_id: r for r in fingerprint_documents(frame(spark, texts)).collect()}
    assert out[0].near_next > 0.9 and out[2].near_next > 0.9
    assert 0 < out[4].near_edited < 1


def test_odd_fingerprint_rows(spark):
    out = fingerprint_documents(frame(spark, ["x y", "x y", None, "z"], ids=[4, 4, None, None])).collect()
    assert len(out) == 4 and len({r.fingerprint for r in out if r.doc_id == 4}) == 1
    assert fingerprint_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    one = fingerprint_documents(frame(spark, ["only one text here"])).collect()[0]
    assert one.near_next == 1.0


def test_ranges_do_not_matter(spark):
    docs = frame(spark, [f"t{i}" for i in range(300)], ids=[(i * 7919) % 1000 for i in range(300)])
    assert with_next(docs, range_docs=10).where("_copy = 1").count() > 20


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: float(weights[k % len(weights)]) for k, s in enumerate(order)}
    fixed, total = {}, float(sum(sizes.values()))
    while True:
        free = [s for s in order if s not in fixed]
        rate = (total - sum(fixed.values())) / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if weight[s] * rate > most * sizes[s]]
        if not over:
            return {**fixed, **{s: weight[s] * rate for s in free}}
        fixed.update({s: float(most * sizes[s]) for s in over})


def test_targets(spark):
    rng = random.Random(3)
    for _ in range(6):
        sizes = {s: rng.choice([0, 1, 5, 100, 1000, 5000]) for s in [None, *"aZé中bcd"][:rng.randrange(1, 9)]}
        rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
        got = {r.source: r.target for r in source_targets(rows, (1, 2, 3), 3).collect()}
        assert got == pytest.approx(brute_targets(sizes))


def test_mix(spark):
    rng = random.Random(4)
    sources = [rng.choice(["hot", "hot", "hot", "b", "c", "small", None]) if i % 50 else "tiny" for i in range(3000)]
    texts = [" ".join(prose(rng, rng.randrange(0, 40))) for _ in sources]
    docs = frame(spark, texts, sources=sources).repartition(7)
    out = mix_sources(docs, range_rows=100).collect()
    again = mix_sources(docs.repartition(3), range_rows=100).collect()
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, again), key=str)
    assert sorted((r.doc_id, r.size) for r in out) == [(i, len(words(t))) for i, t in enumerate(texts)]
    sizes, taken = {}, {}
    for r in out:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    want = brute_targets(sizes)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 120, (s, taken[s], want[s])
    assert sum(taken.values()) <= sum(sizes.values())
    # brute force: every copy by its finishing time, until the budget is spent
    key = {r.doc_id: r.k for r in docs.select("doc_id", F.xxhash64(F.lit(0), F.col("doc_id")).alias("k")).collect()}
    rank = {s: k for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    copies, ranges = [], -(-3000 // 100)
    for s in sizes:
        own = sorted((r for r in out if r.source == s), key=lambda r: ((key[r.doc_id] % (1 << 64)) >> 33) % ranges * (1 << 70) + key[r.doc_id])
        sent = 0
        for e in range(3):
            for r in own:
                sent += r.size
                if sizes[s]:
                    copies.append((sent / want[s], rank[s], key[r.doc_id], r.doc_id, r.size))
    spent, count = 0, {}
    for f, _, _, i, n in sorted(copies):
        spent += n
        if spent > sum(sizes.values()):
            break
        count[i] = count.get(i, 0) + n
    differ = sum(count.get(r.doc_id, 0) != r.taken for r in out)
    assert differ <= 2  # the order of equal times only


def test_odd_mix_rows(spark):
    docs = frame(spark, ["a b", "a b", None, "c", "c"], sources=["x", "x", None, None, "y"], ids=[1, 1, 2, None, None])
    out = mix_sources(docs).collect()
    assert len(out) == 5 and all(0 <= r.taken <= 3 * r.size for r in out)
    assert take_copies(docs, mix_sources(docs)).columns == docs.columns
    assert mix_sources(spark.createDataFrame([], SCHEMA)).count() == 0
    empty = mix_sources(frame(spark, [None, "", " "], sources=["a", "b", "a"])).collect()
    assert [(r.size, r.taken) for r in empty] == [(0, 0)] * 3
