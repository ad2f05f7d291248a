"""Suffix order and removal of repeats against brute force."""

import hashlib
import os
import random
import time

import numpy as np
import pyarrow as pa
from helpers import SCHEMA, frame, prose

from ridgeline.llm import suffix_dedup
from ridgeline.llm.common import written
from ridgeline.llm.suffix_dedup import LENGTH, remove_repeats, sha256
from ridgeline.llm.suffix_order import suffix_arrays
from ridgeline.session import shared_dir


def test_suffix_arrays():
    rng = np.random.default_rng(1)
    for _ in range(200):
        rows, n = int(rng.integers(1, 12)), int(rng.integers(1, 40))
        text = rng.integers(0, int(rng.integers(1, 5)), (rows, n)).astype(np.int16)
        length = rng.integers(0, n + 1, rows)
        got = suffix_arrays(text, length)
        for r in range(rows):
            s = text[r, :length[r]].tolist()
            assert got[r, :length[r]].tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def brute(ids, texts):
    seen, out = set(), {}
    for i, t in sorted(zip(ids, texts)):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - LENGTH + 1):
            s = raw[p:p + LENGTH]
            if s in seen:
                gone[p:p + LENGTH] = True
            seen.add(s)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for p in range(len(raw)) if gone[p] and (p == 0 or not gone[p - 1]))
        out[i] = (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus():
    rng = random.Random(5)
    passage = " ".join(prose(rng, 60, 5000))
    texts = [None, "", "x" * 99, "ab" * 300, "ab" * 301, "é" * 250, "y" * 1000, "line of text\n" * 60]
    for i in range(40):  # a frequent passage between different words
        texts.append(" ".join(prose(rng, 20, 9000)) + f" {passage} " + " ".join(prose(rng, 20, 9000)))
    for _ in range(15):  # copies and edited copies
        base = prose(rng, 150, 5000)
        texts.append(" ".join(base))
        for _ in range(3):
            base = list(base)
            base[rng.randrange(150)] = f"ü{rng.randrange(10**6)}"
            texts.append(" ".join(base))
        texts.append(texts[-1])
    texts.append(passage[7:140])
    texts.append(passage[20:140] + "é" + passage[:130])
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [texts[i] for i in order]


def test_removal_as_brute_force(spark):
    texts = corpus()
    ids = [7 * i - 100 for i in range(len(texts))]
    out = sha256(remove_repeats(frame(spark, texts, ids=ids).repartition(6))).collect()
    want = brute(ids, texts)
    assert len(out) == len(texts)
    for r in out:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], (r, texts[ids.index(r.doc_id)])


def test_odd_rows(spark):
    text = " ".join(prose(random.Random(2), 80, 9999))
    out = remove_repeats(frame(spark, [text] * 4, ids=[None, 5, 5, 9])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in out) == [(0, 0), (5, 0), (5, 0), (9, len(text))]
    more = [text, text, "a " + text[:170] + " b", "c " + text[30:] + " d"]  # repeated rows among different stretches
    out = sha256(remove_repeats(frame(spark, more, ids=[5, 5, 6, 7]))).collect()
    want = brute([5, 6, 7], more[1:])
    assert all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id] for r in out) and len(out) == 4
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeats_inside_one_stretch(spark):
    texts = ["y" * 150, "ab" * 75, "z" * 253, "cde" * 84 + "c", "no repeat " + "".join(map(str, range(90))), "q" * 253, "q" * 253]
    for some in ([t] for t in texts[:2]):
        out = sha256(remove_repeats(frame(spark, some))).collect()
        assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out] == [brute([0], some)[0]]
    want = brute(range(len(texts)), texts)
    out = sha256(remove_repeats(frame(spark, texts))).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out} == want


def scratch(spark):
    return set(os.listdir(shared_dir(spark).removeprefix("file://")))


def test_rounds_leave_only_the_spans(spark, monkeypatch):
    texts, rounds = corpus(), []
    one = suffix_dedup._round_spans
    monkeypatch.setattr(suffix_dedup, "ROUND_BYTES", 1)
    monkeypatch.setattr(suffix_dedup, "_round_spans", lambda *a: rounds.append(a) or one(*a))
    texts += [" ".join(prose(random.Random(k // 3), 60, 9000)[k % 3:]) + f" {k}" for k in range(90)]  # most of it is cut
    before = scratch(spark)
    out = sha256(remove_repeats(frame(spark, texts).repartition(4)))
    assert len(rounds) > 1
    assert sorted(name.split("-")[0] for name in scratch(spark) - before) == ["spans"]
    want = brute(range(len(texts)), texts)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()} == want


def test_shuffle_files_go_with_the_write(spark):
    def files():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {blocks.apply(i).getName() for i in range(blocks.size()) if blocks.apply(i).getName().startswith("shuffle_")}

    before = files()
    out = written(spark.range(1000).selectExpr("id % 500 AS k").groupBy("k").count(), "counted")
    end = time.time() + 10
    while files() - before and time.time() < end:
        time.sleep(0.1)
    assert not files() - before
    assert out.count() == 500


def test_windows_of_several_strings_are_few_bytes():
    rng = random.Random(4)
    gram = b"a gram of two dozen byte"
    rows = [(k, bytes(rng.choices(b"bcdefgh", k=76)) + gram + bytes(rng.choices(b"bcdefgh", k=76))) for k in range(12)]
    prefix = suffix_dedup.prefix_hash(np.frombuffer(gram, np.uint8))
    h = int(suffix_dedup.segment_hash(prefix, np.array([0]), np.array([len(gram)])).view(np.int64)[0])
    batch = pa.RecordBatch.from_arrays(
        [pa.array([h] * 12), pa.array([0] * 12, pa.int32()), pa.array([2] * 12, pa.int32()), pa.array([k for k, _ in rows]),
         pa.array([5] * 12), pa.array([raw for _, raw in rows], pa.binary())], ["h", "part", "parts", "doc_id", "low", "bytes"])
    out = pa.Table.from_batches(suffix_dedup._sorted_windows(iter([batch])))
    windows = [(r["core"], r["doc_id"], r["low"] - d) for r in out.to_pylist() for d in range(8) if r["n"] >> d & 1]
    assert sorted(w[1:] for w in windows) == [(k, 5 + a) for k in range(12) for a in range(77)]
    assert out.nbytes < 8 * len(windows)
