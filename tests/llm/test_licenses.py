import re

import pytest

from acerto.llm.licenses import BASE, evaluate, postfix, scan, scan_text


def brute(text):
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower().decode())
    hits = [(i, label) for phrase, label in BASE.items() for i in range(len(words))
            if words[i:i + len(phrase.split())] == phrase.split()]
    return len(words), sorted(hits)


@pytest.mark.parametrize("text", [
    "Released under the MIT License.", "cc-by-nc cc by nc by nc", "Apache License, Version 2.0 under the mit license",
    "under the mit licenses", "", "underthe mit license", "É under the mit license É", "CC BY NC BY NC"])
def test_base_places(text):
    found = scan_text(text)
    assert (found["n_words"], sorted((p["word"], p["label"]) for p in found["places"] if p["kind"] == "base")) == brute(text)


def test_expressions():
    assert postfix("MIT OR Apache-2.0 AND ISC") == ["MIT", "Apache-2.0", "ISC", "and", "or"]
    assert postfix("(MIT OR X) AND GPL-2.0 WITH Classpath-exception-2.0") == [
        "MIT", "X", "or", "GPL-2.0", "Classpath-exception-2.0", "with", "and"]
    assert evaluate("MIT OR GPL-3.0") == (["gpl-3", "mit"], True)
    assert evaluate("MIT AND GPL-3.0") == (["gpl-3", "mit"], False)
    assert evaluate("(MIT OR GPL-3.0) AND Apache-2.0+") == (["apache-2", "gpl-3", "mit"], True)
    assert evaluate("GPL-2.0 WITH Classpath-exception-2.0") == (["gpl-2"], False)
    for broken in ("", "MIT OR", "(MIT", "MIT)", "MIT Apache-2.0", "AND MIT", "()"):
        assert evaluate(broken) is None


def test_tags_and_score():
    found = scan_text("x\n// SPDX-License-Identifier: MIT OR GPL-3.0-only\nrest")
    assert found["expressions"] == [{"text": "MIT OR GPL-3.0-only", "labels": ["gpl-3", "mit"], "allowed": True}]
    assert 0.9 < found["score"] < 1
    assert scan_text("SPDX-License-Identifier: (")["expressions"][0]["allowed"] is None
    assert scan_text("nothing")["score"] == 0


@pytest.mark.parametrize("text, labels, allowed", [
    ("<!-- SPDX-License-Identifier: MIT -->", ["mit"], True),
    ("/* SPDX-License-Identifier: MIT OR GPL-3.0-only */ int x;", ["gpl-3", "mit"], True),
    ("SPDX-License-Identifier: MIT. This file is free.", ["mit"], True),
    ("SPDX-License-Identifier: Apache-2.0.", ["apache-2"], True),
    ("SPDX-License-Identifier: (MIT AND GPL-2.0) see the file COPYING", ["gpl-2", "mit"], False),
    ("SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0 which is here", ["gpl-2"], False),
    ("SPDX-License-Identifier: MIT and the rest of the text", ["mit"], True),
    ("SPDX-License-Identifier: mit and gpl-2.0 for all of it", ["gpl-2", "mit"], False),
    ("(SPDX-License-Identifier: MIT) and more", ["mit"], True),
    ('<p id="SPDX-License-Identifier: BSD-3-Clause">or this</p>', ["bsd-3"], True),
    ("SPDX-License-Identifier: MIT OR\nnext line", ["mit"], True),
    ("SPDX-License-Identifier: -->", [], None)])
def test_expression_ends_before_what_follows(text, labels, allowed):
    (found,) = scan_text(text)["expressions"]
    assert (found["labels"], found["allowed"]) == (labels, allowed)


def test_two_tags_in_a_line():
    found = scan_text("SPDX-License-Identifier: MIT some words SPDX-License-Identifier: GPL-2.0 and more words")
    assert [(e["text"], e["labels"]) for e in found["expressions"]] == [("MIT", ["mit"]), ("GPL-2.0", ["gpl-2"])]


def test_table(frame, edge):
    found = scan(frame(edge)).collect()
    assert len(found) == len(edge)
    assert {r.doc_id: r.n_words for r in found}[1] == 0
    assert scan(frame([])).count() == 0
