import random
import re

import numpy as np
import pyarrow as pa
import pytest

from acerto.llm import components as rounds
from acerto.llm import near_ngrams as ng
from acerto.llm.components import components


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").encode().lower().decode())
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def brute(rows):
    sets = {i: shingles(t) for i, t, *_ in rows}
    root = {i: i for i in sets}
    for _ in sets:
        before = dict(root)
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    return {i: (len(sets[i]), root[i]) for i in sets}


@pytest.fixture(scope="module")
def family(words):
    """Copies, near copies on both sides of the threshold, and a passage that many texts share."""
    pick, rows = random.Random(5), []
    passage = words(30, 99)
    for k in range(12):
        base = words(60 + 5 * k, 200 + k).split()
        for j in range(8):
            text = list(base)
            for _ in range(j):
                text[pick.randrange(len(text))] = f"w{pick.random()}"
            rows.append((1000 - 20 * k - j, " ".join(text)))
    rows += [(2000 + i, f"{words(12 + i, 400 + i)} {passage} {words(9, 500 + i)}") for i in range(25)]
    rows += [(3000, "one two"), (3001, "ONE  two\n"), (3002, "one two three"), (3003, None), (3004, " "), (3005, rows[0][1].upper())]
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("options", [{}, {"most_broadcast": 0}, {"sketch_bits": 4}])
def test_same_as_brute_force(frame, family, options):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ng.jaccard_join(frame(family), **options).collect()}
    assert found == brute(family)


def test_sets(words):
    texts = [None, "", "a", "A", "a b c d", "a b c d e", "a b c d e f", words(500), "é ü x y z w", words(500)]
    hashes, bounds = ng.shingle_sets(pa.array(texts), 5)
    assert list(np.diff(bounds)) == [len(shingles(t)) for t in texts]
    parts = [tuple(hashes[a:b]) for a, b in zip(bounds, bounds[1:])]
    assert parts[2] == parts[3] and parts[7] == parts[9] and set(parts[5]) < set(parts[6])
    assert [tuple(ng.shingle_sets(pa.array(texts[7:8]), 5)[0])] == [parts[7]]


def test_words_are_cut_alike_in_every_chunk(words, monkeypatch):
    text = pa.array([words(3000, 8), "x" * 500, words(50, 9)])
    whole = ng.shingle_sets(text, 5)
    monkeypatch.setattr(ng, "_CHUNK", 64)
    parts = ng.shingle_sets(text, 5)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_edges(frame, edge):
    found = ng.jaccard_join(frame(edge)).collect()
    assert len(found) == len(edge)
    by_id = {r.doc_id: (r.n_shingles, r.component_id) for r in found}
    assert by_id[1] == (0, 1) and by_id[3] == (0, 3) and by_id[4] == by_id[5] == (1, 4) and by_id[None] == (1, None)
    assert ng.jaccard_join(frame([])).count() == 0


def test_one_id_with_several_texts(frame, words):
    def changed(text, n):
        parts = text.split()
        return " ".join([*parts[:n], "other", *parts[n + 1:]])

    a, b = words(62, 31), words(62, 32)
    rows = [(1, a), (1, b), (2, changed(a, 30)), (3, changed(b, 30)), (0, b), (4, words(62, 33)), (4, None), (5, ""), (None, a)]
    found = ng.jaccard_join(frame(rows)).collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [(1, 58, 1), (1, 58, 0), (2, 58, 1), (3, 58, 0), (0, 58, 0), (4, 58, 4), (4, 0, 4), (5, 0, 5), (None, 58, None)], key=str)


def test_bitmaps_never_differ_in_more_places_than_sets(words):
    pick = random.Random(9)
    texts = [None, "", "a"]
    for n in (20, 60, 200, 3000):
        base = words(n, n).split()
        for edits in (0, 1, 3, 10, 40):
            text = list(base)
            for _ in range(edits):
                text[pick.randrange(n)] = f"w{pick.random()}"
            texts.append(" ".join(text))
    hashes, bounds = ng.shingle_sets(pa.array(texts * 60), 5)
    maps, wide = ng.parities(hashes, bounds)
    wide = [np.array(w.as_py() or list(m)) for w, m in zip(wide, maps)]
    assert {len(w) for w in wide} == {8, 128} and all((w.reshape(-1, 8)[0] if len(w) == 8 else np.bitwise_xor.reduce(w.reshape(-1, 8))).tolist()
                                                      == m.tolist() for w, m in zip(wide, maps))
    sets = [set(hashes[a:b]) for a, b in zip(bounds, bounds[1:])][:len(texts)]
    assert (maps[:len(texts)] == maps[-len(texts):]).all()
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            differ = int(np.bitwise_count((maps[i] ^ maps[j]).view(np.uint64)).sum())
            assert differ <= len(x ^ y)
            if len(x ^ y) <= 20:
                assert differ > len(x ^ y) / 2 or x == y
            if len(wide[i]) == len(wide[j]):
                assert differ <= int(np.bitwise_count((wide[i] ^ wide[j]).view(np.uint64)).sum()) <= len(x ^ y)


@pytest.fixture(scope="module")
def crowd(words):
    """One large family: copies with 0 to 9 changed words, most of them linked with the base only or with nothing."""
    pick, base, rows = random.Random(11), words(150, 77).split(), []
    for k in range(260):
        text = list(base)
        for _ in range(k % 10):
            text[pick.randrange(len(text))] = f"w{pick.random()}"
        rows.append((k, " ".join(text)))
    return rows


def test_long_texts(frame, words):
    pick, rows = random.Random(12), []
    for base in (words(700, 1).split(), words(1600, 2).split()):
        for k in range(12):
            text = list(base)[:len(base) - 20 * (k % 3)]
            for _ in range([0, 5, 20, 30, 60, 80][k % 6]):
                text[pick.randrange(len(text))] = f"w{pick.random()}"
            rows.append((len(rows), " ".join(text)))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ng.jaccard_join(frame(rows)).collect()} == brute(rows)


@pytest.mark.parametrize("part", [4096, 16])
def test_large_family(frame, crowd, monkeypatch, part):
    monkeypatch.setattr(ng, "_PART", part)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ng.jaccard_join(frame(crowd)).collect()}
    assert found == brute(crowd)


def test_components(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, 7), (3, 9), (9, 200), (200, 3), (None, 1), (50, 51), (51, 50)]
    links += [(500, 500 + i) for i in range(1, 40)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "left long, right long")).collect()}
    wanted = {i: 100 for i in range(100, 161)} | {3: 3, 9: 3, 200: 3, 50: 50, 51: 50} | {i: 500 for i in range(500, 540)}
    assert found == wanted


def test_rounds_of_few_links_have_few_tasks(spark, monkeypatch):
    parts, kept = [], {n: spark.conf.get(n) for n in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}

    def counting(df, checkpointed=rounds.checkpointed):
        parts.append(df.rdd.getNumPartitions())
        return checkpointed(df)

    monkeypatch.setattr(rounds, "checkpointed", counting)
    spark.conf.set("spark.sql.shuffle.partitions", 50)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        links = spark.createDataFrame([(k, k + 1) for k in range(20)], "left long, right long")
        found = components(links)
        assert {(r.node, r.component) for r in found.collect()} == {(k, 0) for k in range(21)}
        assert len(parts) > 2 and max(parts[1:]) == 1
        parts.clear()
        monkeypatch.setattr(rounds, "_LINKS_A_TASK", 5)
        assert {(r.node, r.component) for r in components(links).collect()} == {(k, 0) for k in range(21)}
        assert max(parts[1:]) > 1
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
