import random
import re
from itertools import permutations

import numpy as np
import pytest

from acerto.llm.filter_audit import audit, survivors

LABELS = "doc_id long, quality int, toxic int"


def fails(docs):
    """The filters that each (id, text, part) fails."""
    out = []
    for i, text, _ in docs:
        body = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", body)
        copy = any(i is not None and j is not None and j < i and (other or "") == body for j, other, _ in docs)
        out.append({name for name, test in {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", body)) > 3 * len(body),
            "D": bool(re.search(r"[#$%&*|]", body)), "E": copy}.items() if test})
    return out


def expected(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    failed, out = fails(docs), {}
    for part in {d[2] or "" for d in docs}:
        rows = [(d[0], f) for d, f in zip(docs, failed) if (d[2] or "") == part]
        summed = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = rows
            for step, name in enumerate(order, 1):
                gone = [r for r in left if name in r[1]]
                left = [r for r in left if name not in r[1]]
                summed[name] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(name in f for _, f in rows) - len(gone), sum(f == {name} for _, f in rows),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(summed[order[step - 1]])
    return out


def documents(spark, docs):
    return spark.createDataFrame([(i, t, p, "x", 1, "y") for i, t, p in docs],
                                 "doc_id long, text string, lang string, part string, mask int, digest string")


def found(spark, docs, labels):
    rows = audit(documents(spark, docs), spark.createDataFrame(labels, LABELS)).collect()
    result = {(r[0], r[1], r[2]): list(r)[3:] for r in rows}
    assert len(result) == len(rows)
    return result


def test_same_as_brute_force(spark, words):
    pick = random.Random(2)
    long = words(300, 5)
    texts = [None, "", long, words(210, 6).upper(), "one two " * 150, long + " #", words(80, 7) + " & SOME CAPITALS", "É ü" * 90]
    docs = [(pick.choice([None, *range(40)]), pick.choice(texts), pick.choice(["en", "de", None, "", "x y"])) for _ in range(120)]
    docs += [(900 + i, long, "en") for i in range(60)] + [(7, long, "en")] * 3 + [(1000, words(60_000, 8), "de")]
    labels = [(i, pick.choice([0, 1, None]), pick.choice([0, 1])) for i in range(0, 60, 2)] + [(2, 1, 0), (2, 0, 1), (None, 1, 1), (901, 1, 1)]
    assert found(spark, docs, labels) == expected(docs, labels)


def test_empty_tables(spark):
    assert found(spark, [], [(1, 1, 1)]) == {}
    docs = [(3, "a", "en"), (1, "a", "fr")]
    result = found(spark, docs, [])
    assert result == expected(docs, []) and len(result) == 1200


@pytest.mark.parametrize("seed", range(3))
def test_walk_counts_each_subset(seed):
    counts = np.random.default_rng(seed).integers(0, 9, (4, 32))
    expected_states = np.array([[sum(row[m] for m in range(32) if not m & s) for s in range(32)] for row in counts])
    assert (survivors(counts) == expected_states).all()
