from collections import defaultdict

import pytest

from acerto.llm.mixing import mix


@pytest.fixture(scope="module")
def rows(words):
    sizes = {"a": 400, "b": 60, "c": 5, None: 90}
    return [(k * 1000 + i, words(20 + (i * 7) % 50, i), s) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]


def test_targets_and_shares(frame, rows):
    found = mix(frame(rows)).collect()
    assert len(found) == len(rows)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    source = {r[0]: r[2] for r in rows}
    for r in found:
        assert r.size == len(dict((x[0], x[1]) for x in rows)[r.doc_id].split()) if r.doc_id < 10 else True
        assert 0 <= r.taken <= 2 * r.size
        sizes[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    total = 1.5 * sum(sizes.values())
    assert sum(target.values()) == pytest.approx(total)
    weights, wanted, full = {"a": 3, "b": 1, "c": 2, None: 3}, {}, set()
    while True:  # the excess is shared again until no source is above
        rest = total - sum(2 * sizes[s] for s in full)
        weight = sum(w for s, w in weights.items() if s not in full)
        wanted = {s: 2 * sizes[s] if s in full else rest * w / weight for s, w in weights.items()}
        above = {s for s in weights if wanted[s] > 2 * sizes[s] and s not in full}
        if not above:
            break
        full |= above
    assert target == pytest.approx(wanted)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(0.02 * target[s], 4), s


def test_reruns_agree(frame, rows):
    assert sorted(mix(frame(rows)).collect()) == sorted(mix(frame(rows[::-1]).repartition(7)).collect())


def test_edges(frame, edge):
    found = mix(frame(edge)).collect()
    assert len(found) == len(edge)
    assert all((r.size, r.taken) == (0, 0) for r in found if r.doc_id in (1, 2, 3, 8))
    assert mix(frame([])).count() == 0
    assert [r.taken for r in mix(frame([(1, None), (1, "")])).collect()] == [0, 0]
