"""Near copies among rows of repeated and missing ids: rows are documents, sets are the nodes."""

import random

import pytest

import corpus_pipeline
from lateline.llm.minhash import link_documents
from llm.cases import documents, sorted_rows
from llm.test_operators import shingles


def words(seed, n=80):
    return [f"w{random.Random(f'{seed}-{i}').randrange(5000)}" for i in range(n)]


def near(seed, n=80):
    return " ".join([*words(seed, n)[:-1], "changed"])


def rows_of(*pairs):
    return [(i, t, "en", "a", 1) for i, t in pairs]


def test_an_unrelated_text_of_a_shared_id_stays(spark):
    b, c, copy = " ".join(words("b")), " ".join(words("c")), near("b")
    docs = documents(spark, rows_of((5, b), (5, c), (2, copy)))
    got = sorted_rows(link_documents(docs), "doc_id", "component_id", "kept")
    assert got == [(2, 2, True), (5, 2, False), (5, 5, True)]
    kept = {(r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    assert kept == {(2, copy), (5, c)}


def test_texts_without_an_id_find_their_copies(spark):
    pairs = [(None, " ".join(words(n))) for n in range(6)] + [(10 + n, near(n)) for n in range(6)]
    got = link_documents(documents(spark, rows_of(*pairs)))
    assert sorted_rows(got.where("doc_id IS NULL"), "component_id", "kept") == [(10 + n, False) for n in range(6)]
    kept = corpus_pipeline.near_dedup(spark, documents(spark, rows_of(*pairs)), "")
    assert sorted(r.doc_id for r in kept.collect()) == [10 + n for n in range(6)]


def test_copies_without_any_id_leave_one_row(spark):
    pairs = [(None, " ".join(words("x"))), (None, near("x")), (None, near("x")), (None, " ".join(words("y"))), (None, None), (None, "")]
    kept = corpus_pipeline.near_dedup(spark, documents(spark, rows_of(*pairs)), "").collect()
    texts = [r.text for r in kept]
    assert len([t for t in texts if t and "w" in t]) == 2 and " ".join(words("y")) in texts and len(texts) == 3


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, seed):
    rng = random.Random(seed)
    pairs = []
    for n in range(90):
        text = list(words(n % 25, rng.choice([3, 30, 60, 200])))
        for _ in range(rng.choice([0, 0, 1, 2])):
            text[rng.randrange(len(text))] = f"e{rng.randrange(9)}"
        pairs.append((rng.choice([None, *range(20)]), " ".join(text)))
    sets = [shingles(t) for _, t in pairs]
    parent = list(range(len(pairs)))

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for a in range(len(pairs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    least = {}
    for i, (ident, _) in enumerate(pairs):
        known = least.get(root(i))
        least[root(i)] = ident if known is None else known if ident is None else min(known, ident)
    want = sorted(((ident, least[root(i)], len(sets[i])) for i, (ident, _) in enumerate(pairs)), key=repr)
    result = link_documents(documents(spark, rows_of(*pairs)))
    assert sorted_rows(result, "doc_id", "component_id", "n_shingles") == want
    firsts = result.where("first").select("doc_id", "text_md5").distinct().count()
    assert firsts == len({root(i) for i in range(len(pairs))})
