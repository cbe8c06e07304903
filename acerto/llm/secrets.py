"""Secret scan: fixed patterns, and two character Markov models compared by likelihood.

One model is trained on random strings, the other on ordinary words and identifiers; a
token whose log-likelihood ratio exceeds a threshold is a secret even where no pattern
knows it. The labelled samples: digests of words, written in hexadecimal, in base 64,
and in its capitals and digits alone, are random; the words themselves, in capitals, and joined in twos are ordinary.
Everything is SQL expressions: places come from the lengths of matches and of the text between.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sampled

_CHARACTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/=_-"
_START = len(_CHARACTERS)  # row of the table for the first character of a token
_SIDE = _START + 1
_BACKING = 5.0
_BLOCK = 64
_NOWHERE = 2**31 - 1
_TOKEN = "[A-Za-z0-9+/=_-]+"
_WORD = "[A-Za-z][A-Za-z0-9_-]*"

#: Kind, pattern, group whose length counts, its least length; in the order of the kinds.
PATTERNS = (
    ("assign", r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
#: A text without a match of this has none of the pattern itself; cheaper to look for.
_HINTS = {"assign": r"(?i:passw|secret|token|api_?key)", "access": "AKIA", "hex": "[0-9a-f]{16}"}


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often it is mentioned."""
    return F.transform(F.array(value), use)[0]


def _running(values: Column, join: Callable[[Column, Column], Column], zero: Column, levels: int = 3) -> Column:
    """Of each place in an array, all values before it joined, beginning with `zero`.

    By blocks of `_BLOCK`, whose own totals run alike: a value is looked at half a block's times on each level, while an
    array that grows value by value would be copied each time.
    """
    def direct(found: Column) -> Column:
        return F.transform(found, lambda _, i: F.aggregate(F.slice(found, F.lit(1), i), zero, join))

    def by_block(found: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / _BLOCK).cast("int"))
        cut = F.transform(starts, lambda i: F.slice(found, i * _BLOCK + 1, F.lit(_BLOCK)))

        def joined(blocks: Column) -> Column:
            totals = F.transform(blocks, lambda b: F.aggregate(b, zero, join))
            inside = F.transform(blocks, direct)
            return F.flatten(F.zip_with(inside, _running(totals, join, zero, levels - 1),
                                        lambda block, before: F.transform(block, lambda x: join(before, x))))

        return _let(cut, joined)

    return _let(values, lambda found: F.when(F.size(found) <= _BLOCK, direct(found)).otherwise(by_block(found))
                if levels else direct(found))


def _matches(text: Column, pattern: str, group: int) -> Column:
    """Places of all matches: array of start, end (code points, exclusive), value of the group."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    # The text behind the last match is one piece more.
    steps = F.zip_with(
        F.zip_with(found, values, lambda m, v: F.struct(F.length(m).alias("size"), v.alias("value"))),
        F.split(text, pattern, -1), lambda m, gap: F.struct(m.alias("m"), F.length(gap).alias("gap")))
    inner = F.filter(steps, lambda step: step.m.isNotNull())

    def placed(step: Column, at: Column) -> Column:
        start = at + step.gap
        return F.struct(start.alias("start"), (start + step.m.size).alias("end"), step.m.value.alias("value"))

    return _let(inner, lambda steps: F.zip_with(
        steps, _running(F.transform(steps, lambda s: s.gap + s.m.size), lambda a, b: a + b, F.lit(0)), placed))


def _outside(spans: Column, known: Column) -> Column:
    """Those of `spans` that overlap none of `known` (arrays of the form of `_spans`).

    In one list by start, a span is overlapped by a known one before it that ends behind its start, or by the next known one
    if that starts before its end.
    """
    def told(both: Column) -> Column:
        def is_known(s: Column) -> Column:
            return s.place < len(PATTERNS)

        ends = F.transform(both, lambda s: F.when(is_known(s), s.end).otherwise(0))
        starts = F.reverse(F.transform(both, lambda s: F.when(is_known(s), s.start).otherwise(_NOWHERE)))
        last_end = _running(ends, lambda a, b: F.greatest(a, b), F.lit(0))
        next_start = F.reverse(_running(starts, lambda a, b: F.least(a, b), F.lit(_NOWHERE)))
        near = F.zip_with(last_end, next_start, lambda e, s: F.struct(e.alias("end"), s.alias("start")))
        marked = F.zip_with(both, near, lambda s, n: F.struct(
            s.alias("span"), (~is_known(s) & (n.end <= s.start) & (n.start >= s.end)).alias("free")))
        return F.transform(F.filter(marked, lambda m: m.free), lambda m: m.span)

    return F.when(F.size(known) == 0, spans).otherwise(_let(F.array_sort(F.concat(spans, known)), told))


def _long(matches: Column, least: int) -> Column:
    return F.filter(matches, lambda m: F.length(m.value) >= least)


def _spans(kind: str, place: int) -> Column:
    """The matches of a pattern in the form that all spans share."""
    return F.transform(kind, lambda m: F.struct(
        m.start.alias("start"), F.lit(place).alias("place"), m.end.alias("end"), F.lit(kind).alias("kind"),
        F.lit(None).cast("double").alias("score")))


def _cells(token: Column) -> Column:
    """Cells of the model that `token` passes, one for each character: row before, column itself."""
    letters = F.split(token, "")
    before = F.concat(F.array(F.lit("")), F.slice(letters, F.lit(1), F.size(letters) - 1))

    def number(c: Column) -> Column:
        return F.position(c, F.lit(_CHARACTERS)) - 1

    return F.zip_with(before, letters,
                      lambda b, c: F.when(b == "", _START).otherwise(number(b)) * _SIDE + number(c))


def labelled_samples(rows: DataFrame, text_column: str = "text", sample_rows: int = 40) -> DataFrame:
    """Labelled tokens (token, is_random) from about `sample_rows` rows, never over twice as many."""
    words = F.regexp_extract_all(F.col(text_column), F.lit(_WORD), F.lit(0))
    ordinary = (sampled(rows.select(text_column), text_column, sample_rows).select(words.alias("words"))
                .withColumn("next", F.slice("words", F.lit(2), F.greatest(F.size("words"), F.lit(1))))
                .select(F.explode(F.arrays_zip("words", "next")).alias("w")).select("w.words", "w.next").distinct())
    digest = F.sha2("words", 256)
    coded = F.base64(F.unhex(digest))
    return ordinary.select(F.explode(F.array(*(
        F.struct(token.alias("token"), F.lit(is_random).alias("is_random")) for token, is_random in (
            (F.col("words"), False), (F.upper("words"), False),
            (F.concat_ws("_", "words", "next"), False), (F.concat("words", F.initcap("next")), False),
            (digest, True), (coded, True),
            (F.translate(coded, "abcdefghijklmnopqrstuvwxyz+/=", ""), True)))))).select("col.*")


def train(samples: DataFrame) -> list[float]:
    """For each cell, the log-likelihood ratio of random over ordinary.

    A character's probability behind another is smoothed by its overall one, which counts as
    `_BACKING` observations.
    """
    counts = {False: [0] * _SIDE * _SIDE, True: [0] * _SIDE * _SIDE}
    for row in (samples.where(F.length("token") > 0)
                .select("is_random", F.explode(_cells(F.col("token"))).alias("cell"))
                .groupBy("is_random", "cell").count().collect()):  # two models' cells at most
        counts[row.is_random][row.cell] += row["count"]
    logs = {}
    for label, cells in counts.items():
        overall = [0.1 + sum(cells[c::_SIDE]) for c in range(_SIDE)]
        total = sum(overall)
        logs[label] = [math.log((cells[i] + _BACKING * overall[i % _SIDE] / total)
                                / (sum(cells[i - i % _SIDE:i - i % _SIDE + _SIDE]) + _BACKING))
                       for i in range(_SIDE * _SIDE)]
    return [a - b for a, b in zip(logs[True], logs[False])]


def scan(rows: DataFrame, id_column: str = "doc_id", text_column: str = "text", *,
         model: Sequence[float] | None = None, shortest: int = 20, threshold: float = 20.0,
         mean_threshold: float = 0.5) -> DataFrame:
    """One row for each row of `rows`: its id and spans, an array of kind, start, end, score.

    Places are code points, the end exclusive; spans are sorted by start, then kind in the order of
    PATTERNS and "random" last. "random" spans are tokens of at least `shortest` characters
    outside all other spans whose log-likelihood ratio is at least `threshold` in all and
    `mean_threshold` for each character; `score` has it (null for the patterns). Without a `model`
    one is trained on `labelled_samples` of the rows. Null texts count as empty and have no spans.
    Repeated rows each get their row; an empty table gives an empty result; other columns are ignored.
    """
    if model is None:
        model = train(labelled_samples(rows, text_column))
    ratios = F.split(F.lit(",".join(map(repr, model))), ",").cast("array<double>")
    text = F.col("text")
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def found(pattern: str, group: int, hint: str) -> Column:
        return F.when(F.rlike(text, F.lit(hint)), _matches(text, pattern, group)).otherwise(none)

    out = rows.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    for kind, pattern, group, least in PATTERNS:
        out = out.withColumn(kind, _long(found(pattern, group, _HINTS[kind]), least))
    out = out.withColumn("random", found(f"{_TOKEN[:-1]}{{{shortest},}}", 0, f"{_TOKEN[:-1]}{{{shortest}}}"))

    def scored(m: Column) -> Column:
        score = F.aggregate(_cells(m.value), F.lit(0.0), lambda total, cell: total + F.get(ratios, cell))
        return F.struct(m.start.alias("start"), F.lit(len(PATTERNS)).alias("place"), m.end.alias("end"),
                        F.lit("random").alias("kind"), score.alias("score"))

    known = F.concat(*(_spans(kind, i) for i, (kind, *_) in enumerate(PATTERNS)))
    out = out.withColumn("known", known).withColumn("scored", F.filter(
        F.transform("random", scored),
        lambda m: (m.score >= threshold) & (m.score >= mean_threshold * (m.end - m.start))))
    fresh = _outside(F.col("scored"), F.col("known"))
    return out.select(F.col("id").alias(id_column), F.transform(
        F.array_sort(F.concat("known", fresh)),
        lambda m: F.struct(m.kind.alias("kind"), m.start.alias("start"), m.end.alias("end"), m.score.alias("score")))
        .alias("spans"))
