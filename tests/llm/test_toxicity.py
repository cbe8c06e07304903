import math
import zlib
from itertools import product

import numpy as np
import pytest

from acerto.llm import toxicity as t


@pytest.fixture(scope="module")
def corpus(words):
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        text = words(60, i).split()
        if toxic:
            for k in range(4):
                text[(i * 7 + k * 13) % 60] = ("idiot", "scumbag", "scumlike")[(i // 4 + k) % 3]
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def model(corpus):
    rows, labels = corpus
    return t.fit([(x, y) for (i, x), (_, y) in zip(rows, labels) if zlib.crc32(str(i).encode()) % 5])


def test_held_out_accuracy(corpus, model):
    rows, labels = corpus
    right = 0
    out = [(x, y) for (i, x), (_, y) in zip(rows, labels) if zlib.crc32(str(i).encode()) % 5 == 0]
    for text, toxic in out:
        evidence = [model.evidence(w) for w in text.split()]
        places = [i for i, e in enumerate(evidence) if e]
        right += (model.score(model.marginals(places, [evidence[i] for i in places], len(evidence))) >= 0.5) == toxic
    assert right >= 0.95 * len(out)


def test_marginals_are_those_of_all_paths(model):
    evidence = [0, 0, 3.0, 0, 1.5, 0, 0, 5.0, 0]
    weights = np.zeros((len(evidence), 2))
    for path in product((0, 1), repeat=len(evidence)):
        score, before = 0.0, 0
        for state, e in zip(path, evidence):
            score += model.transitions[before, state] + state * (model.bias + e)
            before = state
        for i, state in enumerate(path):
            weights[i, state] += math.exp(score)
    places = [i for i, e in enumerate(evidence) if e]
    wanted = (weights[:, 1] / weights.sum(axis=1))[places]
    assert model.marginals(places, [evidence[i] for i in places], len(evidence)) == pytest.approx(list(wanted), rel=1e-6)


def test_table(spark, frame, edge, corpus):
    rows, labels = corpus
    table = frame(rows)
    marks = spark.createDataFrame(labels + labels[:3] + [(None, 1), (5000, None)], "doc_id long, toxic int")
    trained = t.train(table, marks)
    found = {r.doc_id: r for r in t.score(frame(rows + edge[:1]), trained).collect()}
    text = dict(rows)[0]
    assert {text[s.start:s.end] for s in found[0].spans} <= {"idiot", "scumbag", "scumlike"} and found[0].spans
    assert t.score(frame(edge), trained).count() == len(edge)
    assert t.score(frame([]), trained).count() == 0
    assert t.train(frame([]), marks).weights == {}
    assert 0 <= t.train(table, marks.limit(0)).score([]) <= 1


def test_short_texts_and_tails_train(words):
    rows = []
    for i in range(200):
        rows.append((words(9, i) + (" scumbag" if i % 2 else ""), i % 2))  # no text fills a window
    short = t.fit(rows)
    assert short.evidence("scumbag") > 1 > short.evidence("harmless")
    tails = t.fit([(f"{words(24, 1000 + i)} {'idiot ' * (i % 2)}{words(3, i)}", i % 2) for i in range(200)])
    assert tails.evidence("idiot") > 1


def test_masked_places_change_nothing(words):
    """A clean tail of one token: the same fit but for that token's own evidence."""
    rows = [(f"{words(20, i)} {'scumbag' if i % 2 else 'x'} {words(3, 500 + i)}", i % 2) for i in range(100)]
    whole, longer = t.fit(rows), t.fit([(text + " y", toxic) for text, toxic in rows])
    assert longer.evidence("scumbag") == pytest.approx(whole.evidence("scumbag"), rel=0.2)


def test_windows_are_spread_over_the_sample(words):
    rows = []
    for i in range(400):
        word = "scumbag" if i < 200 else "idiot"
        rows.append((f"{words(20, i)} {word if i % 2 else ''} {words(8, 900 + i)}", i % 2))
    few = t.fit(rows, windows=80)
    assert few.evidence("scumbag") > 0.5 and few.evidence("idiot") > 0.5
