"""Words are looked at one by one; the result is that of one search for runs and words over the whole text."""

import math
import re
from collections import Counter

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lateline.llm import toxicity
from lateline.llm.toxicity import SIGNED, SPACED, Restorer, features_of, letter_costs, symbol_of, words_of

BOTH = re.compile(f"{SPACED}|{SIGNED}")


@pytest.fixture(scope="module")
def texts():
    found = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).to_pydict()["text"]
    return [t or "" for t in found]


@pytest.fixture(scope="module")
def restorer(texts):
    import numpy as np

    counts = np.zeros(toxicity.LETTERS**toxicity.ORDER)
    for text in texts[:50]:
        seen = [symbol_of(c) for c in f"    {text.lower()} "]
        for i in range(len(seen) - 3):
            counts[((seen[i] * 28 + seen[i + 1]) * 28 + seen[i + 2]) * 28 + seen[i + 3]] += 1
    return Restorer(letter_costs(counts))


def at_once(restorer, text):
    return BOTH.sub(lambda m: restorer._restored(m.group()), text.lower())


def test_whole_texts(restorer, texts):
    runs = 0
    for text in texts:
        runs += bool(BOTH.search(text.lower()))
        assert restorer.words(text) == words_of(at_once(restorer, text))
    assert runs > 20


PIECES = st.sampled_from(["a", "b", "i", "id10t", "x.y", " ", " ", "\t", " ", "\x1c", ".", "-", "*", "_", "(", "@", "$", "1", "3", "aaa", "ss", "ü", "i d i o t", "s-t-u-p", "\n"])


@settings(max_examples=600, deadline=None)
@given(st.lists(PIECES, max_size=40).map("".join))
def test_any_text(restorer, text):
    assert restorer.restore(text) == at_once(restorer, text)
    assert restorer.words(text) == words_of(at_once(restorer, text))


def test_scores_are_those_of_the_restored_words(restorer, texts):
    weights = {"^" + w[:4]: 0.5 for t in texts[:30] for w in t.lower().split()[:9]} | {w: -0.3 for w in texts[0].lower().split()}
    score = toxicity.Model(restorer.costs, weights, -0.1).scorer()
    for text in [*texts[:300], None, "", "i d i o t", texts[0]]:
        counts = Counter(f for w, n in restorer.words(text or "").items() for f in features_of(w) * n if f in weights)
        z = sum(weights[f] * math.log1p(n) for f, n in counts.items()) - 0.1
        assert score(text) == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))), abs=1e-12)
