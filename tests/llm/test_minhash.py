"""Near duplicates against brute force."""

import random

from helpers import SCHEMA, find_components, frame, prose, shingles

from ridgeline.llm.graph import components
from ridgeline.llm.minhash import near_duplicates


def brute(ids, texts, k, percent=80):
    sets = {i: shingles(t, k) for i, t in zip(ids, texts)}
    order = sorted(sets)
    edges = [(a, b) for x, a in enumerate(order) for b in order[x + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {i: len(s) for i, s in sets.items()}, find_components(order, edges)


def corpus(seed=3):
    rng = random.Random(seed)
    texts = [None, "", " \n\t", "one two", "One\ttwo", "one two three", "a b c d", "A B  C D"]
    for _ in range(25):  # groups of copies with edits: similarities on both sides of the limit
        base = prose(rng, rng.randrange(6, 120))
        for _ in range(rng.randrange(1, 8)):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 15)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    base = prose(rng, 60)
    for i in range(60):  # a chain: neighbours link, ends do not
        base = base[1:] + [f"c{i}"]
        texts.append(" ".join(base))
    texts += [" ".join(prose(rng, 3000)), texts[10], texts[10], texts[11].upper()]
    return texts


def test_links_as_brute_force(spark):
    texts = corpus()
    for k in (4, 5):
        out = near_duplicates(frame(spark, texts).repartition(5), size=k).collect()
        n, component = brute(range(len(texts)), texts, k)
        assert {r.doc_id: r.n_shingles for r in out} == n
        assert {r.doc_id: r.component_id for r in out} == component
        assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_odd_rows(spark):
    texts = ["a b c d e f", "a b c d e f", "a b c d e f", None, "x"]
    out = near_duplicates(frame(spark, texts, ids=[7, 7, None, None, 3]), size=4).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in out) == [
        (-1, -1, True), (-1, -1, True), (3, 3, True), (7, 7, True), (7, 7, True)]
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 7 for i in [7, *range(200, 260)]}}
