import math
import re
from collections import defaultdict

import pytest
from hypothesis import given, settings, strategies as st

from acerto.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")) \
                    or kind == "card" and 13 <= len(digits) <= 19 and pii.luhn(digits) \
                    or kind == "phone" and 9 <= len(digits) <= 15:
                found.append((kind, *m.span()))
    return found


@pytest.mark.parametrize("text", [
    "a@b.c@d.e", "x@y.zz+w@q.rr", "@b.c", "a@b", "a@@b.c", "1.2.3.4.5.6.7.8.9", "256.1.1.1.1", "4111 1111 1111 1111",
    "4111-1111-1111-1111 1", "+1 (415) 555-0100", "++49 30 1234567", "+1(", "a.b%c+d@e-f.g.h,i@j.k"])
def test_base(text):
    assert pii.base_spans(text) == brute(text)


@settings(max_examples=400, deadline=None)
@given(st.text("a1924.@+- ()%é\n", max_size=60))
def test_base_of_any_text(text):
    assert pii.base_spans(text) == brute(text)


@pytest.fixture(scope="module")
def field():
    texts = [f"call +1 (415) 555-01{i:02} or 4111 1111 1111 1111, mail u{i}@ex.org from 10.0.{i}.1 in {1900 + i} 77"
             for i in range(40)]
    return pii.fit([e for t in texts for e in pii._training(t)])


def test_field_tries_other_boundaries(field):
    text = "id 12 4111 1111 1111 1111 end"
    assert pii.base_spans(text) == []
    assert [s for a in pii.stretches(text) for s in field.best(text, a)] == [("card", 6, 25)]
    for clean in ("in 1999 and 12 of 340", "4111 1111 1111 1112", "300.1.1.1", "no digits"):
        assert [s for a in pii.stretches(clean) for s in field.best(clean, a)] == []


def test_table(frame, edge, field):
    rows = edge + [(50, "a@b.cd 12 4111 1111 1111 1111"), (51, "1" * 50_000), (52, "1 " * 20_000), (53, "@" * 30_000)]
    found = {r.doc_id: r for r in pii.scan(frame(rows), field=field).collect()}
    assert [tuple(s) for s in found[50].base] == [("email", 0, 6)]
    assert [tuple(s) for s in found[50].added] == [("card", 10, 29)]
    assert all(not found[i].base for i in (1, 2, 51, 53))
    assert pii.scan(frame([])).count() == 0
    assert pii.scan(frame(rows)).count() == len(rows)


def test_long_run_of_zeros():
    """Python turns at most 4,300 digits into a number."""
    assert pii.base_spans("0" * 5000 + ".1.2.3")[0][0] == "ip"


def segmentations(count):
    """All ways to cut `count` atoms into spans (start, end, kind), kind "" for one atom outside."""
    if count == 0:
        yield []
        return
    for size in range(1, min(count, pii.LONGEST) + 1):
        for rest in segmentations(count - size):
            yield from ([*rest, (count - size, count, kind)] for kind in (*pii.KINDS, *([""] if size == 1 else [])))


@pytest.mark.parametrize("text", [
    "12 4111 1111 1111 1111", "a@b.cd 10.0.0.1 77", "+1 415 555 0100 9", "1.2.3.4 x9 a@b.c", "4111 1111 1111 1111 +1 415 555 0100"])
def test_best_segmentation_and_likelihood_by_enumeration(field, text):
    atoms = [a for part in pii.stretches(text) for a in part]
    spans = pii._candidates(text, atoms)

    def score(cut):
        return sum(field.scores(dict(spans[end - 1])[end - start])[pii.KINDS.index(kind)] for start, end, kind in cut if kind)

    every = [(score(cut), cut) for cut in segmentations(len(atoms))]
    found = field.best(text, atoms)
    best = max(s for s, _ in every)
    wanted = [(kind, atoms[a][0], atoms[b - 1][1]) for a, b, kind in next(c for s, c in every if s == best) if kind]
    assert found == wanted
    # One step moves each weight along the gradient: what the labels have less what the field expects.
    total = pii._log_sum([s for s, _ in every])
    weights, gold = dict(field.weights), set(wanted[:1])
    expected = {}
    for s, cut in every:
        for start, end, kind in cut:
            if kind:
                for f in dict(spans[end - 1])[end - start]:
                    expected[kind, f] = expected.get((kind, f), 0.0) + math.exp(s - total)
    squares = defaultdict(float)
    pii.Field(changed := dict(weights)).learn(text, atoms, gold, 1e-3, squares)
    for kind, a, b in gold:
        last = [e for _, e in atoms].index(b)
        size = last - [x for x, _ in atoms].index(a) + 1
        for f in dict(spans[last])[size]:
            step = 1 - expected[kind, f] - 0.002 * weights.get((kind, f), 0.0)
            if abs(step) > 0.01 and sum(f in features for row in spans for _, features in row) == 1:
                assert math.sqrt(squares[kind, f]) == pytest.approx(abs(step), rel=0.02)
                assert (changed[kind, f] > weights.get((kind, f), 0.0)) == (step > 0)


def test_long_address_may_be_added(field):
    text = "a" * 1500 + "@b.cd"
    assert pii.span_features(text, 0, len(text), 1)[3:] == ["address", "letters"]
