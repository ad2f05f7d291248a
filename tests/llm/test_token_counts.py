"""Token counts against the library on whole texts."""

import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from helpers import SCHEMA, frame
from hypothesis import given, settings
from hypothesis import strategies as st

from ridgeline.llm.common import text_bytes
from ridgeline.llm.queries import QUERIES
from ridgeline.llm.token_counts import Counter, count_tokens
from ridgeline.llm.tokens import tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")
WHOLE = sentencepiece.SentencePieceProcessor(model_file=PATH)
TEXTS = [None, "", " ", "  ", "a", " a  b ", "x▁y ▁ z", "a<s>b</s><unk> <0x0A>", "l'été é́ ﬁ İ ≠", "中文字。日本語、テスト한국어 ไทย",
         "🙂👨‍👩‍👧\x00\x1f\t\n\r\n  a", "word " * 40000, "x" * 100000, "中文字。" * 30000, "\n" * 70000, " " * 70000]


def counted(text, piece):
    data, offsets = text_bytes(pa.array([text], pa.string()))
    return int(Counter(PATH, piece).counts(data, offsets)[0])


def whole(text):
    return len(WHOLE.encode(text or ""))


COUNTERS = {n: Counter(PATH, n) for n in (1, 3, 10)}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "th", "e", " ", "  ", "\n", "▁", "中", "文", "。", "é", "́", "🙂", "<s>", "1", ".", "\t", "ing", "\x00"]), max_size=60).map("".join),
       st.sampled_from(sorted(COUNTERS)))
def test_pieces_count_like_whole_texts(text, piece):
    cut, extra = COUNTERS[piece].pieces(text)
    assert sum(map(len, map(WHOLE.encode, cut))) - extra == whole(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60), st.sampled_from(sorted(COUNTERS)))
def test_any_text(text, piece):
    text = text.encode("utf-8", "replace").decode()
    cut, extra = COUNTERS[piece].pieces(text)
    assert sum(map(len, map(WHOLE.encode, cut))) - extra == whole(text)


def test_long_texts_are_cut():
    cut, _ = Counter(PATH).pieces("word " * 40000)
    assert len(cut) > 2 and max(map(len, cut)) < (1 << 16) + 10
    cut, extra = Counter(PATH, 100).pieces("中文字。" * 300)
    assert len(cut) > 5 and extra > 0


@pytest.mark.parametrize("piece", [64, 1 << 16])
def test_texts(piece):
    for text in TEXTS:
        assert counted(text, piece) == whole(text)


def test_operator(spark):
    rng = random.Random(1)
    texts = TEXTS + [" ".join(rng.choices(["alpha", "Beta", "γάμμα", "\n\n", "12.5", "中文"], k=rng.randrange(2000))) for _ in range(40)]
    ids = [None, *range(len(texts) - 2), 3]
    rows = count_tokens(frame(spark, texts, ids=ids).repartition(3), PATH, limit=500).collect()
    want = [(i, len((t or "").encode()), whole(t), whole(t) > 500) for i, t in zip(ids, texts)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)
    assert count_tokens(spark.createDataFrame([], SCHEMA), PATH).collect() == []


def test_query(spark):
    got = {r.doc_id: r for r in QUERIES["op13_token_counts"](spark, "/root/testdata/sf0.001").collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert got.keys() == texts.keys()
    assert all(got[i].n_tokens == whole(t) and got[i].n_bytes == len((t or "").encode()) for i, t in texts.items())
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got.values())
    assert np.sum([r.n_tokens for r in got.values()]) > 0
