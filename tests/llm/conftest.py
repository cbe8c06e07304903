from __future__ import annotations

import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long,"
          " id string, run int, class int, token string, language string, text_sha256 string, _row int")


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text[, source]); further columns have names that operators use themselves."""
    def build(rows):
        return spark.createDataFrame(
            [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 1, "x", 1, 2, "t", "l", "h", 3) for r in rows], SCHEMA)
    return build


@pytest.fixture(scope="session")
def words():
    """A text of so many invented words."""
    def build(count, seed=0):
        pick = random.Random(seed)
        return " ".join("".join(pick.choice("abcdeilmnorst") for _ in range(pick.randint(2, 8))) for _ in range(count))
    return build


@pytest.fixture(scope="session")
def edge(words):
    """Nulls, empty and very long texts, ties and repeated rows."""
    return [(1, None), (2, ""), (3, "  \n\t "), (4, "Hello World"), (5, "hELLO wORLD"), (None, "hello world"),
            (6, words(60_000, 3)), (7, words(80, 4)), (7, words(80, 4)), (8, None, None), (9, "É è hello"), (10, "x" * 70_000)]
