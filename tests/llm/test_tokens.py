"""Token files and packing against encoding whole texts."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import SCHEMA, frame
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ridgeline.llm.packing import pack_documents, sum_of_squares
from ridgeline.llm.token_files import encode_documents, read_token_files, token_table, write_token_files
from ridgeline.llm.tokens import Encoder, tokenizer_path

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
TEXTS = [None, "", " ", "a", "The  quick\tbrown\r\n fox's don't can't 'tis 12ab.c 3,14", "l'été é à ß Ü ﬁ İ K ≠ ≠ x́ . ́y", "中文 字  日本語。テスト",
         "a\x1cb\x1f c\x85d\xa0e f　g", "!!!WOW!!! (foo) [bar]'s 'S'RE''s", "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>",
         "word " * 5000, "x" * 3000, "🙂👍🏽 family 👨‍👩‍👧", "\n\n\n a \n\n b"]


@pytest.fixture(scope="module", params=FILES)
def pair(request):
    path = tokenizer_path(request.param)
    return Encoder(path), Tokenizer.from_file(path)


def same(pair, texts):
    own, library = pair
    ids, at = own.encode(pa.array(texts, pa.string()), 7)
    for i, t in enumerate(texts):
        assert ids[at[i]:at[i + 1]].tolist() == library.encode(t or "", add_special_tokens=False).ids + [7], repr(t)


def test_chunks_as_whole_texts(pair):
    same(pair, TEXTS)
    rng = random.Random(1)
    alphabet = list("ab'sS.,! \n\té  中1Z\x1cćß’≠|-")
    same(pair, ["".join(rng.choices(alphabet, k=rng.randrange(80))) for _ in range(3000)])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_any_text_as_whole(texts):
    for name in FILES:
        path = tokenizer_path(name)
        same((ENCODERS.setdefault(name, Encoder(path)), LIBRARY.setdefault(name, Tokenizer.from_file(path))), texts)


ENCODERS, LIBRARY = {}, {}


def test_token_files(spark, tmp_path):
    path = tokenizer_path(FILES[0])
    library = Tokenizer.from_file(path)
    texts = TEXTS * 3
    ids = [5 * i - 20 for i in range(len(texts))]
    docs = frame(spark, texts, ids=ids).repartition(4)
    out = sorted(token_table(docs, path, 2).collect(), key=lambda r: r.doc_id)
    start = 0
    for r, t in zip(out, texts):
        want = library.encode(t or "", add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        start += len(want)
    folder = str(tmp_path / "tokens")
    write_token_files(encode_documents(docs, path, 2), folder, row_group_bytes=1 << 16, page_bytes=1 << 12)
    table = read_token_files(spark, folder)
    assert [r.doc_id for r in table.where("doc_id = -10").collect()] == [-10]
    ranges = []
    for f in sorted(p for p in (tmp_path / "tokens").iterdir() if p.suffix == ".parquet"):
        meta = pq.ParquetFile(f)
        column = [meta.metadata.row_group(0).column(i) for i in range(3)]
        assert column[0].path_in_schema == "doc_id" and "DELTA_BINARY_PACKED" in column[0].encodings
        assert column[0].has_offset_index and column[0].has_column_index
        rows = meta.read(["doc_id"])["doc_id"].to_pylist()
        assert rows == sorted(rows)
        ranges.append((rows[0], rows[-1]))
    ranges.sort()
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_odd_token_rows(spark):
    path = tokenizer_path(FILES[0])
    out = token_table(frame(spark, ["b", "a a", None, "a a"], ids=[3, None, None, 3]), path, 2).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in out) == [(0, 1), (0, 3), (3, 2), (3, 3)]
    spans = sorted((r.start, r.start + r.n_tokens) for r in out)
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert token_table(spark.createDataFrame([], SCHEMA), path, 2).count() == 0
    assert pack_documents(spark.createDataFrame([], SCHEMA), tokenizer_path(FILES[1])).count() == 0


def test_packing(spark):
    path = tokenizer_path(FILES[1])
    library = Tokenizer.from_file(path)
    rng = random.Random(4)
    texts = [*TEXTS, *(" ".join(rng.choices(["alpha", "beta", "x1", "."], k=rng.randrange(1, 120))) for _ in range(400))]
    ids = [None, *range(1, len(texts) - 1), 1]  # a null id, and a repeated one
    rows = pack_documents(frame(spark, texts, ids=ids).repartition(3), path, end_id=1, capacity=64, shard_docs=150).collect()
    want = sorted((i or 0, p, 64 * p, zlib.crc32(np.array(whole[64 * p:64 * p + 64], "<u4").tobytes()), len(whole[64 * p:64 * p + 64]))
                  for i, t in zip(ids, texts) for whole in [library.encode(t or "", add_special_tokens=False).ids + [1]]
                  for p in range(-(-len(whole) // 64)))
    assert sorted((r.doc_id or 0, r.piece, r.start, r.ids_crc32, r.length) for r in rows) == want
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in bins.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))]
        assert sum(n for _, n in pieces) <= 64
    assert len(bins) <= 1.05 * -(-sum(r.length for r in rows) // 64) + 3


def test_sum_of_squares_choice():
    rng = random.Random(6)
    sizes = sorted((rng.randrange(1, 33) for _ in range(200)), reverse=True)
    bins, offsets = sum_of_squares(np.array(sizes), 32)
    free: dict[int, int] = {}
    for size, b, offset in zip(sizes, bins.tolist(), offsets.tolist()):
        def cost(gap):
            left = {k: g for k, g in free.items()}
            key = next(k for k, g in left.items() if g == gap)
            left[key] -= size
            count = np.bincount([g for g in left.values() if g], minlength=1)
            return int((count ** 2).sum()), gap
        fits = sorted({g for g in free.values() if g >= size})
        if size == 32 or not fits:
            assert b not in free and offset == 0
            free[b] = 32 - size
        else:
            assert free[b] == min(map(cost, fits))[1] and offset == 32 - free[b]
            free[b] -= size
