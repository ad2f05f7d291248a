"""The stages, one after the other, on planted documents."""

import os
import random

import corpus_pipeline as cp
from helpers import SCHEMA, frame, prose, words

from ridgeline.llm.mixing import word_count
from ridgeline.session import shared_dir


def written(df, tmp_path, name):
    path = str(tmp_path / name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def test_stages(spark, tmp_path):
    rng = random.Random(1)
    english, german = "the and of with house street people".split(), "der und von mit haus strasse leute".split()
    texts, langs, sources = [], [], []

    def add(text, lang="en", source="a"):
        texts.append(text)
        langs.append(lang)
        sources.append(source)
        return len(texts) - 1

    def sentence(own, n):
        return " ".join(rng.choice(own) + str(rng.randrange(10**6)) if rng.random() < 0.5 else rng.choice(own) for _ in range(n))

    for k in range(60):
        add(sentence(english if k % 2 else german, 60), "en" if k % 2 else "de", "abc"[k % 3])
    no_letters, empty = add("123 !!"), add(None)
    first = add(sentence(english, 100))
    copy = add(texts[first])
    edited = add(texts[first].replace(words(texts[first])[50], "other", 1))
    passage = sentence(english, 40)
    carriers = [add(f"{sentence(english, 30)} {passage} {sentence(english, 30)}") for _ in range(4)]
    ids = list(range(len(texts)))
    docs = frame(spark, texts, langs=langs, sources=sources, ids=ids)
    docs = docs.union(docs.where("doc_id = 5")).union(docs.where("doc_id = 6").selectExpr("cast(null as long)", *docs.columns[1:]))
    columns, kept = docs.columns, []
    for name, function in cp.STAGES[:-1]:
        docs = written(function(spark, docs, ""), tmp_path, name.replace(" ", "_"))
        assert docs.columns == columns, name
        kept.append({r.doc_id: r for r in docs.collect()})
        if name == "language ID":
            assert set(ids) - set(kept[-1]) == {no_letters, empty} and docs.count() == len(ids)
            assert all(kept[-1][i].lang == langs[i] for i in range(60))
        if name == "MinHash near-dedup":
            assert set(kept[-2]) - set(kept[-1]) == {copy, edited} and docs.count() == len(kept[-1])
        if name == "suffix-array dedup":
            assert passage in kept[-1][carriers[0]].text
            assert all(passage[20:-20] not in kept[-1][i].text for i in carriers[1:])
            assert all(r.n_chars == len(r.text) for r in kept[-1].values())
            assert kept[-1][0].text == texts[0]
            before = {r[0]: r[1] for r in docs.groupBy("source").agg({"n_chars": "count"}).collect()}
        if name == "mixing sources":
            assert docs.groupBy("doc_id").count().where("count > 3").count() == 0
            sized = docs.select(word_count(docs["text"]).alias("n")).agg({"n": "sum"}).first()[0]
            assert sized <= sum(len(words(r.text)) for r in kept[-2].values()) and before
    packed = cp.STAGES[-1][1](spark, docs, "").collect()
    assert {r.doc_id for r in packed} == set(kept[-1])
    assert sum(r.piece == 0 for r in packed) == docs.count()


def test_empty_and_odd_tables(spark, tmp_path):
    odd = [frame(spark, [None, "", "x", "x", "y" * 300], ids=[None, 1, 2, 2, 3], langs=[None, None, "en", "en", "en"]),
           spark.createDataFrame([], SCHEMA)]
    for k, docs in enumerate(odd):
        for name, function in cp.STAGES[1:]:
            out = function(spark, docs, "")
            assert out.count() >= 0
            if name != cp.STAGES[-1][0]:
                assert out.columns == docs.columns
        assert cp.STAGES[0][1](spark, docs, "").columns == docs.columns


def test_run(spark, tmp_path):
    rng = random.Random(3)
    texts = [" ".join(prose(rng, 50, 3000)) for _ in range(40)]
    frame(spark, texts, langs=["en"] * 40, sources=["s"] * 40).write.parquet(str(tmp_path / "documents.parquet"))
    assert cp.run(spark, str(tmp_path)).count() > 0


def test_run_keeps_only_the_output_that_is_read(spark, tmp_path):
    rng = random.Random(4)
    frame(spark, [" ".join(prose(rng, 40, 3000)) for _ in range(20)], langs=["en"] * 20, sources=["s"] * 20).write.parquet(str(tmp_path / "documents.parquet"))
    shared = shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(shared))
    assert cp.run(spark, str(tmp_path)).count() > 0
    assert [name.rpartition("-")[0] for name in set(os.listdir(shared)) - before if name.startswith("stage-")] == ["stage-mixing-sources"]
