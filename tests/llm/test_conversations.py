import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from acerto.llm import conversations as c

SCHEMA = "conv_id long, turn long, role string, text string, audit string, part int, result string, digest string"
AFTER_INSERT = {0: 2, 1: 2, 2: 3, 3: 2}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], SCHEMA)


def cheapest(codes):
    """Least (cost, audit) by carrying every state's whole audit along."""
    def inserted(best):
        for _ in range(4):
            for state, (cost, audit) in list(best.items()):
                way = (cost + 5, audit + "I")
                best[AFTER_INSERT[state]] = min(best.get(AFTER_INSERT[state], way), way)
        return best

    best = {0: (0, "")}
    for code in codes:
        found = {}
        cut = 5 if code.isupper() else 0
        for state, (cost, audit) in inserted(best).items():
            ways = [(state, cost + 2, "D")]
            if code != "x":
                ways.append((AFTER_INSERT[state], cost + cut + 1, "R"))
                kept = {"s": (0, 1), "u": (0, 1, 3, 2), "a": (2, 3)}.get(code.lower())
                if kept and state in kept[:-1]:
                    ways.append((kept[-1], cost + cut, "K"))
            for reached, total, letter in ways:
                found[reached] = min(found.get(reached, (total, audit + letter)), (total, audit + letter))
        best = found
    best = inserted(best)
    return min(best[s] for s in (0, 3) if s in best)


def expected(rows):
    conversations = defaultdict(list)
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        conversations[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = []
    for conv, found in conversations.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        counts = dict(blank=0, duplicate=0, truncated=0)
        seen, codes = set(), ""
        for _, role, text in found:
            body = text.rstrip(" \t\n\x0b\f\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            code = "x" if fault in ("blank", "duplicate") else role[0] if role[:1] in ("s", "u", "a") else "o"
            codes += code.upper() if fault == "truncated" else code
        turns = {r[0] for r in found} - {None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(found, found[1:]))
        cost, audit = cheapest(codes)
        queue, lines, state = iter(found), [], 0
        for letter in audit:
            if letter == "I":
                state = AFTER_INSERT[state]
                lines.append({2: "user:", 3: "assistant:"}[state])
                continue
            _, role, text = next(queue)
            if letter == "R":
                state = AFTER_INSERT[state]
                role = {2: "user", 3: "assistant"}[state]
            elif letter == "K":
                state = {"s": 1, "u": 2, "a": 3}[role[0]]
            if letter != "D":
                lines.append(f"{role}:{text}")
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, partitions=4):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        damaged = c.damage(frame(spark, rows))
        found = c.digests(damaged, c.audits(damaged))
        assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        assert sorted(map(tuple, found.collect()), key=str) == expected(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def conversation(pick, conv, turns):
    rows = []
    for turn in range(turns):
        role = pick.choice(["user", "assistant"] * 4 + ["system", "tool", None, "", "assistant"])
        text = pick.choice(["Yes.", "No!", "Why?  ", "cut off", "", " \t", None, f"text {pick.random()}.", "É?"])
        rows.append((conv, pick.choice([turn, turn, turn, turn + 5, None]), role, text))
    return rows


def test_core_same_as_whole_audits():
    pick = random.Random(3)
    for _ in range(3000):
        codes = "".join(pick.choice("xsuaoSUAOuaua") for _ in range(pick.randint(0, 13)))
        assert c.audit_of(codes.encode())[::-1] == cheapest(codes)


def test_same_as_brute_force(spark):
    pick = random.Random(4)
    rows = [row for conv in [None, *range(150)] for row in conversation(pick, conv, pick.randint(1, 9))]
    rows += rows[:40] + [(500, None, "user", "a."), (500, None, "user", "a."), (501, 3, "user", "x" * 100_000)]
    check(spark, rows)


def test_conversation_over_many_partitions(spark):
    pick = random.Random(5)
    rows = conversation(pick, 7, 600) + conversation(pick, 8, 300) + conversation(pick, 9, 2)
    rows += [(6, turn, ("user", "assistant")[turn % 2], f"{turn}.") for turn in range(500)]
    check(spark, rows, partitions=12)


def test_dropped_rows_and_empty_table(spark):
    gone = [(conv, turn) for conv in range(60) for turn in range(3) if zlib.crc32(f"{conv}:{turn}".encode()) % 20 == 0]
    check(spark, [(*key, "user", "a.") for key in gone])
    assert c.digests(c.damage(frame(spark, [])), c.audits(c.damage(frame(spark, [])))).count() == 0


def test_repaired_rows(spark):
    rows = c.undamaged(frame(spark, [(1, 0, "user", "Hello."), (1, 1, "user", "And this?"), (1, 2, "user", "And this?"),
                                     (2, 0, "assistant", "Long answer."), (2, 1, "user", "Thanks."), (2, 2, "assistant", "Welcome.")]))
    found = c.audits(rows)
    assert {r.conv_id: (r.audit, r.cost, r.duplicate) for r in found.collect()} == {1: ("KRD", 3, 1), 2: ("DKK", 2, 0)}
    got = [tuple(r) for r in c.repaired(rows, found).orderBy("conv_id", "position").collect()]
    assert got == [(1, 0, "K", 0, "user", "Hello."), (1, 1, "R", 1, "assistant", "And this?"),
                   (2, 0, "K", 1, "user", "Thanks."), (2, 1, "K", 2, "assistant", "Welcome.")]
    lone = c.undamaged(frame(spark, [(3, t, r, f"{t}.") for t, r in enumerate(["system", "user", "assistant", "tool", "tool", "user"])]))
    assert [r.role for r in c.repaired(lone, c.audits(lone)).orderBy("position").collect()] == \
        ["system", "user", "assistant", "user", "assistant"]


@pytest.mark.parametrize("turns", [20_000])
def test_long_conversation_in_linear_space(turns):
    pick = random.Random(6)
    codes = "".join(pick.choice("uaUAx") for _ in range(turns)).encode()
    audit, cost = c.audit_of(codes)
    assert len(audit) - audit.count("I") == turns and cost <= 2 * turns
