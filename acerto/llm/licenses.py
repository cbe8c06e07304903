"""Licence scan: one automaton for identifier tags and notice phrases, and a parser for
licence expressions.

A text is lower-cased in A-Z and cut into words of letters, digits and characters beyond ASCII.
An Aho-Corasick automaton over the words, joined by single spaces, finds all places of
all phrases in one pass. Where it meets an identifier tag, the expression behind it is
read from the text as it is: a shunting-yard parser brings it into postfix order, and the
evaluation gives its licences and whether a policy allows it.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices

_WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
#: Phrases that always count, and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Further notice phrases and their labels.
NOTICES = {
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "bsd 2 clause": "bsd-2",
    "bsd 3 clause": "bsd-3",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "cc by sa": "cc-by-sa",
    "creative commons attribution": "cc-by",
    "cc0 1 0": "cc0",
    "all rights reserved": "reserved",
}
_TAG = "spdx license identifier"
_MARK = re.compile(r"SPDX-License-Identifier[ \t]*:[ \t]*", re.IGNORECASE)
_LINE_END = re.compile(r"[\r\n]")
#: What ends an expression: a comment closer, or a full stop that is not part of an identifier.
_CLOSED = re.compile(r"-->|\*/|\.(?![A-Za-z0-9.+:_-])")
_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+:_-]+")
_TOKENS = _TOKEN.findall
#: Identifiers whose label differs from their lower-case form.
_LABELS = {"apache-2.0": "apache-2", "gpl-2.0": "gpl-2", "gpl-2.0-only": "gpl-2", "gpl-2.0-or-later": "gpl-2",
           "gpl-3.0": "gpl-3", "gpl-3.0-only": "gpl-3", "gpl-3.0-or-later": "gpl-3", "cc-by-nc-4.0": "cc-by-nc",
           "cc-by-4.0": "cc-by", "cc-by-sa-4.0": "cc-by-sa", "bsd-2-clause": "bsd-2", "bsd-3-clause": "bsd-3",
           "mpl-2.0": "mpl", "cc0-1.0": "cc0"}
#: What a policy allows by default.
ALLOWED = frozenset({"mit", "apache-2", "bsd", "bsd-2", "bsd-3", "cc0", "cc-by", "isc", "mpl"})
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}
#: How much one label of each kind of evidence adds: 1 minus the product of the complements.
_WEIGHTS = {"base": 0.7, "notice": 0.5, "expression": 0.9, "broken expression": 0.3}


def postfix(expression: str) -> list[str] | None:
    """The tokens of a licence expression in postfix order; None if it is not one."""
    out, stack, operand = [], [], True  # operand: whether one is due
    for token in _TOKENS(expression):
        name = token.lower()
        if token == "(" and operand:
            stack.append(token)
        elif token == ")" and not operand:
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        elif name in _PRECEDENCE and not operand:
            while stack and stack[-1] != "(" and _PRECEDENCE[stack[-1]] >= _PRECEDENCE[name]:
                out.append(stack.pop())
            stack.append(name)
            operand = True
        elif name not in _PRECEDENCE and operand and any(map(str.isalnum, token)):
            out.append(token)
            operand = False
        else:
            return None
    if operand or "(" in stack:
        return None
    return out + stack[::-1]


def _is_identifier(token: str) -> bool:
    """Whether `token` looks like an identifier and not like a word of prose."""
    name = token.lower().rstrip("+")
    return _LABELS.get(name, name) in ALLOWED or any(c in "0123456789-" for c in token) or len(token) > 1 and token.isupper()


def beginning(text: str) -> str:
    """The licence expression that `text` begins with; "" if none.

    It ends at a comment closer or a full stop. What stands before that is the expression if it is one as a whole,
    else its longest beginning that is one. There, prose may follow: an operator in small letters counts only
    before what looks like an identifier, and any other character behind an operand ends the expression.
    """
    closed = _CLOSED.search(text)
    text = text[:closed.start() if closed else len(text)].strip()
    if postfix(text) is not None:
        return text
    depth, operand, small, at, end = 0, True, False, 0, 0
    for match in _TOKEN.finditer(text):
        token, name = match[0], match[0].lower()
        if not operand and text[at:match.start()].strip():
            break
        at = match.end()
        if token == "(" and operand:
            depth += 1
        elif token == ")" and not operand and depth:
            depth -= 1
        elif name in _PRECEDENCE and not operand:
            operand, small = True, token.islower()
        elif (token not in "()" and name not in _PRECEDENCE and operand and any(map(str.isalnum, token))
              and (not small or _is_identifier(token))):
            operand = small = False
        else:
            break
        if not operand and not depth:
            end = at
    return text[:end]


def _tagged(text: str) -> Iterator[str]:
    """What stands behind each identifier tag, up to the end of its line or the next tag."""
    marks = list(_MARK.finditer(text))
    for mark, after in zip(marks, [*(m.start() for m in marks[1:]), len(text)]):
        line = _LINE_END.search(text, mark.end(), after)
        yield text[mark.end():line.start() if line else after]


def evaluate(expression: str, allowed: frozenset[str] = ALLOWED) -> tuple[list[str], bool] | None:
    """Labels of the licences in `expression` and whether `allowed` permits it; None if
    it cannot be parsed.

    `and` needs both sides, `or` one; `with` adds permissions, so the licence before it decides
    unless the pair itself (licence-with-exception) is allowed.
    """
    tokens = postfix(expression)
    if tokens is None:
        return None
    labels, stack = [], []
    for token in tokens:
        if token not in _PRECEDENCE:
            name = token.lower().rstrip("+")
            label = _LABELS.get(name, name)
            stack.append((label, label in allowed, [label]))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            pair = f"{left[0]}-with-{right[0]}"
            stack.append((pair, left[1] or pair in allowed, left[2]))
        else:
            both = left[1] and right[1] if token == "and" else left[1] or right[1]
            stack.append(("", both, left[2] + right[2]))
    labels = sorted(set(stack[0][2]))
    return labels, stack[0][1]


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrases, kind in ((BASE, "base"), (NOTICES, "notice"), ({_TAG: ""}, "tag")):
        for phrase, label in phrases.items():
            found.add_word(f" {phrase} ", (len(phrase) + 2, kind, label))
    found.make_automaton()
    return found


def scan_text(text: str, allowed: frozenset[str] = ALLOWED) -> dict:
    """Words, places (first word, kind, label), expressions (text, labels, allowed) and score."""
    words = _WORDS(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))
    hits = [(end - size + 1, kind, label)
            for end, (size, kind, label) in _automaton().iter(f" {' '.join(words)} ")]
    places, expressions, weights = [], [], {}
    if hits:
        begins = list(accumulate((len(w) + 1 for w in words), initial=0))
        hits.sort()
        places = [(bisect_left(begins, at), kind, label) for at, kind, label in hits if kind != "tag"]
        weights = {(kind, label): _WEIGHTS[kind] for _, kind, label in places}
    if any(kind == "tag" for _, kind, _ in hits):
        for behind in _tagged(text):
            expression = beginning(behind)
            found = evaluate(expression, allowed)
            labels, good = found if found else ([], None)
            expressions.append((expression or behind, labels, good))
            for label in labels or [behind]:
                weights["expression", label] = _WEIGHTS["expression" if found else "broken expression"]
    rest = 1.0
    for key in sorted(weights):
        rest *= 1 - weights[key]
    return {"n_words": len(words), "places": [dict(zip(("word", "kind", "label"), p)) for p in places],
            "expressions": [dict(zip(("text", "labels", "allowed"), e)) for e in expressions],
            "score": 1 - rest}


_FIELDS = pa.schema([
    ("n_words", pa.int64()),
    ("places", pa.list_(pa.struct([("word", pa.int64()), ("kind", pa.string()), ("label", pa.string())]))),
    ("expressions", pa.list_(pa.struct([("text", pa.string()), ("labels", pa.list_(pa.string())),
                                        ("allowed", pa.bool_())]))),
    ("score", pa.float64())])


def scan(rows: DataFrame, id_column: str = "doc_id", text_column: str = "text",
         allowed: frozenset[str] = ALLOWED) -> DataFrame:
    """One row for each row of `rows`: its id, n_words, places, expressions, score.

    `places` are all places of phrases, sorted by their first word (from 0), kind ("base" or
    "notice") and label; phrases may overlap. `expressions` are those behind identifier tags:
    text, labels, and whether the policy allows them (null: no valid expression stands there, and the text is
    all that does). Prose or a comment closer behind an expression does not belong to it. `score`,
    from 0 to 1, grows with each different label found. Null texts count as empty: no words, no
    places, score 0. Repeated rows each get their row; an empty table gives an empty
    result; other columns are ignored.
    """
    id_type = rows.schema[id_column].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = pa.Table.from_pylist([scan_text(t or "", allowed) for t in part.column(1).to_pylist()],
                                             _FIELDS).combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(c.chunk(0) for c in found.columns)], names=[id_column, *_FIELDS.names])

    return rows.select(id_column, text_column).mapInArrow(work, (
        f"`{id_column}` {id_type}, n_words bigint, places array<struct<word: bigint, kind: string, label: string>>,"
        " expressions array<struct<text: string, labels: array<string>, allowed: boolean>>, score double"))
