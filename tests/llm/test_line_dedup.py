import random
import time
from collections import defaultdict

from acerto.llm.line_dedup import drop_repeated_lines

SPACE = " \t\n\x0b\f\r"


def expected(rows, length=10, documents=2):
    def key(line):
        return line.strip(SPACE).encode().lower().decode()

    holders = defaultdict(set)
    for row in rows:
        for line in (row[1] or "").split("\n"):
            holders[key(line)].add(row[0])
    first = {k: min((i for i in ids if i is not None), default=None) for k, ids in holders.items()
             if len(k) >= length and len(ids) >= documents}
    out = []
    for row in rows:
        lines = (row[1] or "").split("\n")
        kept = [line for line in lines if key(line) not in first or first[key(line)] == row[0]]
        out.append((row[0], len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def check(found, rows, **options):
    assert found.columns == ["doc_id", "n_lines", "n_dropped", "text"]
    assert sorted(map(tuple, found.collect()), key=str) == expected(rows, **options)


def test_same_as_brute_force(frame, edge):
    pick = random.Random(1)
    pool = ["Common Line %d" % i for i in range(30)] + ["short", "", "  \t", "\xa0nine char", "ten  chars", "ÀÉ common ÀÉ"]
    rows = edge + [(100 + i, "\n".join(pick.choice([" %s\t", "%s", "\r%s\x0b"]) % pick.choice(pool).swapcase()
                                       for _ in range(pick.randint(0, 12)))) for i in range(200)]
    check(drop_repeated_lines(frame(rows)), rows)
    check(drop_repeated_lines(frame(rows), least_documents=40, least_length=6), rows, length=6, documents=40)


def test_ids_and_keeper(frame):
    same = "a line of its own\nanother line here"
    rows = [(5, same), (3, "x\nA LINE OF ITS OWN"), (3, "another line here\nanother line here"), (None, same), (None, same),
            (7, "only here, twice\nonly here, twice"), (8, "\n\n"), (8, same)]
    check(drop_repeated_lines(frame(rows)), rows)
    only = [(None, same), (None, same)]
    check(drop_repeated_lines(frame(only)), only)
    assert drop_repeated_lines(frame([])).count() == 0


def test_hot_lines_and_long_texts(frame):
    rows = [(i, f"the line that all have\nown line number {i}\nthe line that all have") for i in range(400)]
    rows += [(1000, "\n".join(f"line number {i}" for i in range(60_000))),
             (1001, "\n".join(f"line number {2 * i}" for i in range(60_000))), (1002, " " * 200_000 + "x\n" + "y" * 200_000)]
    began = time.time()
    check(drop_repeated_lines(frame(rows)), rows)
    assert time.time() - began < 60


def test_no_python(frame, edge):
    plan = drop_repeated_lines(frame(edge))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
