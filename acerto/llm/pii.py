"""Personal data: fixed patterns, and spans that a semi-Markov conditional random field adds.

Stretches of text with digits or "@" are cut into atoms. The field scores whole candidate spans of up
to `LONGEST` atoms for each kind (e.g. whether its digits pass the Luhn sum), and dynamic programming
over the atoms chooses boundaries and kinds together. It finds what the patterns lose because they
try only one boundary, such as a card number behind another number. The field is trained by conditional
likelihood on stretches in which the patterns are the labels.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sampled, slices

KINDS = ("email", "ip", "card", "phone")
LONGEST = 8
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HIT = re.compile(r"[0-9@]")
_SPACE = re.compile(r"\s")
_DIGITS = re.compile(r"[0-9]")
_EDGE = "\"'.,;:!?)]}>|#$%&*[{<=~/\\`^"
#: The feature without which a span cannot be of a kind.
_NEEDED = {"email": "address", "ip": "four parts", "card": "card sum", "phone": "call number"}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d *= 1 + i % 2
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _is_card(text: str) -> bool:
    digits = "".join(_DIGITS.findall(text))
    return 13 <= len(digits) <= 19 and luhn(digits)


def _is_ip(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Kind, start, end of the fixed patterns, in the order of KINDS, then start.

    Each pattern's matches are leftmost and do not overlap; those that fail their condition are
    dropped. Searched so that no long run of characters is read again from each of its places.
    """
    found: list[tuple[str, int, int]] = []
    free = 0  # where the next address may start
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            found.append(("email", start, match.end()))
            free = match.end()
        at = text.find("@", max(at + 1, free))
    if not _DIGITS.search(text):
        return found
    for run in _DOTTED.finditer(text):
        parts = list(_DIGIT_RUNS.finditer(text, run.start(), run.end()))
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            if _is_ip([p[0] for p in four]):
                found.append(("ip", four[0].start(), four[3].end()))
    found += [("card", m.start(), m.end()) for m in _CARD.finditer(text) if m.end() - m.start() >= 13 and _is_card(m[0])]
    found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_DIGITS.findall(m[0])) <= 15]
    return found


_DIGIT_RUNS = re.compile(r"[0-9]+")


def stretches(text: str) -> list[list[tuple[int, int]]]:
    """Atoms (start, end) of each stretch: words with a digit or "@" that one space separates."""
    found: list[list[tuple[int, int]]] = []
    before = 0
    hit = _HIT.search(text)
    while hit:
        start = hit.start()
        while start > before and not text[start - 1].isspace():
            start -= 1
        space = _SPACE.search(text, hit.end())
        end = space.start() if space else len(text)
        word = text[start:end]
        left = len(word) - len(word.lstrip(_EDGE))
        right = len(word.rstrip(_EDGE))
        if found and start == before + 1 and left == 0 and text[before] in " -" and text[found[-1][-1][1]:before] in ("", ")"):
            found[-1].append((start, start + right))
        else:
            found.append([(start + left, start + right)])
        before = end
        hit = _HIT.search(text, end)
    return found


def span_features(text: str, start: int, end: int, atoms: int) -> list[str]:
    """Features of the whole span, whatever its kind."""
    part = text[start:end]
    digits = _DIGITS.findall(part)
    count = len(digits)
    found = ["any", f"atoms{min(atoms, 6)}", f"digits{min(count, 20)}"]
    if "@" in part:
        found.append("address" if ("email", 0, len(part)) in base_spans(part) else "at")
    if part.count(".") == 3 and re.fullmatch(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", part):
        found.append("four parts" if _is_ip(part.split(".")) else "four large parts")
    if re.fullmatch(_CARD, part):
        found.append("plain number")
        if 13 <= count <= 19:
            found.append("card sum" if luhn("".join(digits)) else "no card sum")
    if part[:1] == "+" and re.fullmatch(_PHONE, part):
        found.append("call number" if 9 <= count <= 15 else "call number of odd length")
    if any(c.isalpha() for c in part):
        found.append("letters")
    return found


def _candidates(text: str, atoms: list[tuple[int, int]]) -> list[list[tuple[int, list[str]]]]:
    """For each atom where a span may end: number of atoms and features of each span."""
    return [[(size, span_features(text, atoms[last - size + 1][0], atoms[last][1], size))
             for size in range(1, min(LONGEST, last + 1) + 1)] for last in range(len(atoms))]


class Field:
    """Weights of (kind, feature); kind "" is outside, with one atom and no weight."""

    def __init__(self, weights: dict[tuple[str, str], float] | None = None):
        self.weights = weights or {}

    def scores(self, features: list[str]) -> list[float]:
        get = self.weights.get
        return [sum(get((kind, f), 0.0) for f in features) if _NEEDED[kind] in features else -math.inf
                for kind in KINDS]

    def best(self, text: str, atoms: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
        """The best segmentation's spans."""
        best, steps = [0.0], []
        for last, spans in enumerate(_candidates(text, atoms)):
            top, step = best[last], ("", 1)
            for size, features in spans:
                for kind, score in zip(KINDS, self.scores(features)):
                    if best[last + 1 - size] + score > top:
                        top, step = best[last + 1 - size] + score, (kind, size)
            best.append(top)
            steps.append(step)
        found, end = [], len(atoms)
        while end:
            kind, size = steps[end - 1]
            if kind:
                found.append((kind, atoms[end - size][0], atoms[end - 1][1]))
            end -= size
        return found[::-1]

    def learn(self, text: str, atoms: list[tuple[int, int]], gold: set[tuple[str, int, int]], rate: float,
              squares: dict) -> None:
        """One step along the gradient of the log-likelihood of `gold`."""
        spans = _candidates(text, atoms)
        scored = [[(size, f, self.scores(f)) for size, f in row] for row in spans]
        count = len(atoms)
        forward = [0.0] + [-math.inf] * count
        for end in range(1, count + 1):
            terms = [forward[end - 1]]
            terms += [forward[end - size] + s for size, _, scores in scored[end - 1] for s in scores]
            forward[end] = _log_sum(terms)
        backward = [-math.inf] * count + [0.0]
        for start in range(count - 1, -1, -1):
            terms = [backward[start + 1]]
            for size in range(1, min(LONGEST, count - start) + 1):
                terms += [backward[start + size] + s for s in scored[start + size - 1][size - 1][2]]
            backward[start] = _log_sum(terms)
        change: dict[tuple[str, str], float] = defaultdict(float)
        for end in range(1, count + 1):
            for size, features, scores in scored[end - 1]:
                for kind, s in zip(KINDS, scores):
                    p = math.exp(forward[end - size] + s + backward[end] - forward[count])
                    known = (kind, atoms[end - size][0], atoms[end - 1][1]) in gold
                    if p > 1e-4 or known:
                        for f in features:
                            change[kind, f] += known - p
        for key, g in change.items():
            g -= 0.002 * self.weights.get(key, 0.0)
            squares[key] += g * g
            self.weights[key] = self.weights.get(key, 0.0) + rate * g / math.sqrt(squares[key] + 1e-6)


def _log_sum(terms: list[float]) -> float:
    top = max(terms)
    return top + math.log(sum(math.exp(t - top) for t in terms)) if top > -math.inf else top


def _training(text: str) -> list[tuple[str, list[tuple[int, int]], set[tuple[str, int, int]]]]:
    """Stretches of up to 30 atoms and 300 characters with their labels, as texts of their own."""
    found, spans = [], base_spans(text)
    for atoms in stretches(text):
        start, end = atoms[0][0], atoms[-1][1]
        if len(atoms) > 30 or end - start > 300:
            continue
        starts, ends = {a for a, _ in atoms}, {b for _, b in atoms}
        gold = {s for s in spans if s[1] < end and s[2] > start}
        if all(a in starts and b in ends for _, a, b in gold):
            found.append((text[start:end], [(a - start, b - start) for a, b in atoms],
                          {(k, a - start, b - start) for k, a, b in gold}))
    return found


def fit(examples: list[tuple[str, list[tuple[int, int]], set[tuple[str, int, int]]]], rounds: int = 5) -> Field:
    field, squares = Field({(k, "any"): -4.0 for k in KINDS}), defaultdict(float)
    for turn in range(rounds):
        for text, atoms, gold in examples:
            field.learn(text, atoms, gold, 0.5 / (1 + turn), squares)
    return field


def train(rows: DataFrame, text_column: str = "text", *, sample_rows: int = 4000, most: int = 1500) -> Field:
    """A field from a bounded sample: about `sample_rows` rows, never over twice as many; of their
    stretches, which are at most 300 characters long, the first `most` with and without labels each."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text in batch.column(0).to_pylist():
                texts += {(t, bool(gold)) for t, _, gold in _training(text or "")}
            yield pa.RecordBatch.from_pydict({"text": pa.array([t for t, _ in texts], pa.string()),
                                              "labelled": pa.array([g for _, g in texts], pa.bool_())})

    found = sampled(rows.select(text_column), text_column, sample_rows).mapInArrow(
        cut, "text string, labelled boolean").distinct()
    texts = [row.text for labelled in (True, False) for row in
             found.where(F.col("labelled") == labelled).orderBy(F.xxhash64("text"), "text").limit(most).collect()]
    examples = sorted((e for t in texts for e in _training(t)), key=lambda e: e[0][::-1])
    return fit(examples)


def scan(rows: DataFrame, id_column: str = "doc_id", text_column: str = "text", field: Field | None = None) -> DataFrame:
    """One row for each row of `rows`: its id, base and added, arrays of kind, start, end.

    Places are code points, the end exclusive. `base` are the spans of the patterns, sorted by kind in the
    order of KINDS, then start; `added` those of the field that overlap none of them, sorted alike. Without a
    `field` one is trained on the rows. Null texts count as empty and have no spans. Repeated rows each get
    their row; an empty table gives an empty result; other columns are ignored.
    """
    field = train(rows, text_column) if field is None else field
    id_type = rows.schema[id_column].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def one(text: str) -> tuple[list, list]:
        if not _HIT.search(text):
            return [], []
        base = base_spans(text)
        added, known = [], sorted((a, b) for _, a, b in base)
        at, reach = 0, -1  # spans before `at` end at `reach` or earlier
        for atoms in stretches(text):
            for kind, start, end in field.best(text, atoms):
                while at < len(known) and known[at][0] < end:
                    reach = max(reach, known[at][1])
                    at += 1
                if reach <= start:
                    added.append((kind, start, end))
        added.sort(key=lambda s: (KINDS.index(s[0]), s[1]))
        return base, added

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [[[dict(zip(("kind", "start", "end"), s)) for s in spans] for spans in one(t or "")]
                         for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([b for b, _ in found], span), pa.array([a for _, a in found], span)],
                    names=[id_column, "base", "added"])

    spans = "array<struct<kind: string, start: bigint, end: bigint>>"
    return rows.select(id_column, text_column).mapInArrow(work, f"`{id_column}` {id_type}, base {spans}, added {spans}")
