import hashlib
from collections import defaultdict

import pytest

from acerto.llm.exact_dedup import deduplicate


def expected(rows, best):
    groups = defaultdict(list)
    for row in rows:
        groups[(row[1] or "").encode().lower()].append(row[0])
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = best(known) if known else None
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text).hexdigest()) for i in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("keep, best", [("smallest", min), ("largest", max)])
def test_same_as_brute_force(frame, edge, keep, best):
    rows = edge + [(100 + i, "copy" if i % 3 else "COPY") for i in range(300)]
    found = deduplicate(frame(rows), keep=keep)
    assert sorted(map(tuple, found.collect()), key=str) == expected(rows, best)


def test_group_without_ids_and_empty_table(frame):
    assert [tuple(r)[:4] for r in deduplicate(frame([(None, "a"), (None, "A")])).collect()] == [(None, None, 2, True)] * 2
    assert deduplicate(frame([])).count() == 0


@pytest.mark.parametrize("rounds", [1, 2])
def test_rounds_do_not_matter(frame, edge, rounds):
    assert sorted(map(str, deduplicate(frame(edge), rounds=rounds).collect())) == \
        sorted(map(str, deduplicate(frame(edge)).collect()))


def test_no_python_and_no_broadcast(frame, edge):
    plan = deduplicate(frame(edge))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
