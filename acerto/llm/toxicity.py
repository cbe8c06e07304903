"""Toxic spans by a linear-chain conditional random field, and a score for each document.

Training takes a bounded sample of labelled documents. Words and word beginnings that
toxic documents have and clean ones lack label the single tokens; the field with two states
(clean, toxic) is then fitted to windows of labelled tokens by its conditional likelihood. Evidence of
a token is never negative, so a token without evidence always has the same potential, and a
run of such tokens is one power of a two by two matrix. Forward-backward marginals
are thus exact at the cost of the few tokens with evidence, whatever a text's length.

A document's score is a logistic function of its marginals, fitted on the sampled documents.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sampled, slices

_WORDS = re.compile(r"\w+")
_WINDOW = 24  # tokens of a training window
_FEATURES = 7  # of a word, at most


def held_out(id_column: Column) -> Column:
    """Whether crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % 5 == 0


def features(word: str) -> list[str]:
    """What evidence may hang on: the word, its beginnings of 4 to 8 letters, its ending."""
    word = word.lower()
    found = [f"={word}"]
    found += [f"^{word[:n]}" for n in range(4, 9) if len(word) >= n]
    if len(word) >= 4:
        found.append(f"{word[-3:]}$")
    return found


@dataclass
class Model:
    """Weights of features (above 0), bias of the toxic state, log transitions, score."""

    weights: dict[str, float]
    bias: float
    transitions: np.ndarray
    calibration: tuple[float, float, float]

    def __post_init__(self) -> None:
        quiet = np.exp(self.transitions) * np.exp([0.0, self.bias])  # from row to column
        values, vectors = np.linalg.eig(quiet)
        top = np.argmax(values.real)
        self._ratio = float((values[1 - top] / values[top]).real)
        inverse = np.linalg.inv(vectors)
        part = [np.outer(vectors[:, k], inverse[k]).real for k in (top, 1 - top)]
        self._limit, self._rest = ([[float(x) for x in row] for row in p] for p in part)
        self._step = [[float(x) for x in row] for row in np.exp(self.transitions)]

    def __getstate__(self):
        return self.weights, self.bias, self.transitions, self.calibration

    def __setstate__(self, state):
        self.__init__(*state)

    def evidence(self, word: str) -> float:
        return sum(self.weights.get(f, 0.0) for f in features(word))

    def _across(self, vector: tuple[float, float], count: int, back: bool) -> tuple[float, float]:
        """`vector` moved over `count` tokens without evidence."""
        if not count:
            return vector
        a, b = vector
        share = self._ratio ** count
        (l00, l01), (l10, l11) = self._limit
        (r00, r01), (r10, r11) = self._rest
        m00, m01, m10, m11 = l00 + share * r00, l01 + share * r01, l10 + share * r10, l11 + share * r11
        out = (a * m00 + b * m01, a * m10 + b * m11) if back else (a * m00 + b * m10, a * m01 + b * m11)
        total = out[0] + out[1]
        return out[0] / total, out[1] / total

    def marginals(self, places: list[int], evidence: list[float], count: int) -> list[float]:
        """Probability of the toxic state at `places`, of `count` tokens in all."""
        (s00, s01), (s10, s11) = self._step
        forward, before, vector = [], -1, (1.0, 0.0)  # starts behind a clean token
        for place, e in zip(places, evidence):
            a, b = self._across(vector, place - before - 1, False)
            a, b = a * s00 + b * s10, (a * s01 + b * s11) * math.exp(min(self.bias + e, 50.0))
            vector = a / (a + b), b / (a + b)
            forward.append(vector)
            before = place
        found, after, vector = [], count, (1.0, 1.0)
        for k in range(len(places) - 1, -1, -1):
            a, b = self._across(vector, after - places[k] - 1, True)
            clean, toxic = forward[k][0] * a, forward[k][1] * b
            found.append(toxic / (clean + toxic))
            b *= math.exp(min(self.bias + evidence[k], 50.0))
            a, b = a * s00 + b * s01, a * s10 + b * s11
            vector = a / (a + b), b / (a + b)
            after = places[k]
        return found[::-1]

    def score(self, marginals: list[float]) -> float:
        most, total, base = self.calibration
        x = base + most * max(marginals, default=0.0) + total * math.log1p(sum(marginals))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


class _Evidence(dict):
    """Evidence of words as they are met."""

    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, word: str) -> float:
        found = self.model.evidence(word)
        if len(self) < 500_000:
            self[word] = found
        return found


def _labelled(documents: list[tuple[list[str], int]], least: float = 0.008, odds: float = 3.0
              ) -> list[tuple[list[bool], list[bool]]]:
    """Labels of tokens, and which are like toxic ones in a clean document: toxic where a feature is typical of toxic documents, that is, in a
    share of at least `least` of them (so that a text with copies does not count) and rare in others."""
    counts: tuple[Counter, Counter] = Counter(), Counter()
    sizes = [1, 1]
    for words, toxic in documents:
        sizes[toxic] += 1
        counts[toxic].update({f for w in set(words) for f in features(w) if f[-1] != "$"})
    typical = {f for f, n in counts[1].items() if n >= max(4, least * sizes[1])
               and math.log((n + 0.5) / sizes[1]) - math.log((counts[0][f] + 0.5) / sizes[0]) >= odds}
    known: dict[str, bool] = {}

    def label(word: str) -> bool:
        if word not in known:
            known[word] = not typical.isdisjoint(features(word))
        return known[word]

    alike = [[label(w) for w in words] for words, _ in documents]
    return [(row, [False] * len(row)) if toxic else ([False] * len(row), row)
            for row, (_, toxic) in zip(alike, documents)]


def fit(documents: list[tuple[str, int]], rounds: int = 60, windows: int = 4000) -> Model:
    """The model for labelled texts (text, 0 or 1).

    Texts are cut into windows of 24 tokens, the last one as short as it comes. The field is fitted to at most
    half of `windows` with toxic tokens, `windows` with tokens like them in clean documents and half of
    `windows` without either, picked by hash over all texts.
    """
    texts = [(_WORDS.findall(text), toxic) for text, toxic in documents]
    labels = _labelled(texts)
    bounds = {"toxic": windows // 2, "alike": windows, "clean": windows // 2}
    kinds: dict[str, list[tuple[int, int, int]]] = {kind: [] for kind in bounds}  # heaps of -hash, text, place
    for i, ((words, _), (toxic, alike)) in enumerate(zip(texts, labels)):
        for at in range(0, len(words), _WINDOW):
            kind = "toxic" if any(toxic[at:at + _WINDOW]) else "alike" if any(alike[at:at + _WINDOW]) else "clean"
            heap, entry = kinds[kind], (-zlib.crc32(f"{i}:{at}".encode()), i, at)
            if len(heap) < bounds[kind]:
                heapq.heappush(heap, entry)
            elif heap and entry > heap[0]:
                heapq.heapreplace(heap, entry)
    chosen = [(texts[i][0][at:at + _WINDOW], labels[i][0][at:at + _WINDOW])
              for i, at in sorted(entry[1:] for heap in kinds.values() for entry in heap)]
    start = np.log([[0.98, 0.02], [0.5, 0.5]])
    if not any(any(part) for _, part in chosen):
        toxic = sum(t for _, t in documents)
        prior = math.log((toxic + 1) / (len(documents) - toxic + 1)) if documents else -2.0
        return Model({}, -3.0, start, (0.0, 0.0, prior))
    names: dict[str, int] = {}
    ids = np.full((len(chosen), _WINDOW, _FEATURES), -1)
    for i, (words, _) in enumerate(chosen):
        for j, word in enumerate(words):
            for k, f in enumerate(features(word)):
                ids[i, j, k] = names.setdefault(f, len(names))
    gold = np.array([part + [False] * (_WINDOW - len(part)) for _, part in chosen])
    inside = np.arange(_WINDOW) < np.array([len(part) for _, part in chosen])[:, None]  # the rest of a window is masked
    weights, bias, transitions = np.zeros(len(names) + 1), -3.0, start.copy()
    momentum, speed = np.zeros(len(names) + 6), np.full(len(names) + 6, 1e-8)
    before = np.concatenate([np.zeros((len(gold), 1), bool), gold[:, :-1]], axis=1)
    moves = np.array([[np.sum((before == a) & (gold == b) & inside) for b in (0, 1)] for a in (0, 1)], float)
    for turn in range(rounds):
        toxic = weights[ids].sum(axis=2) + bias
        step, emission = np.exp(transitions), np.exp(np.stack([np.zeros_like(toxic), np.minimum(toxic, 50)], axis=2))
        alpha, beta = np.empty_like(emission), np.empty_like(emission)
        vector = np.tile([1.0, 0.0], (len(chosen), 1))
        for t in range(_WINDOW):
            vector = (vector @ step) * emission[:, t]
            vector /= vector.sum(axis=1, keepdims=True)
            alpha[:, t] = vector
        vector, pairs = np.ones((len(chosen), 2)), np.zeros((2, 2))
        for t in range(_WINDOW - 1, -1, -1):
            beta[:, t] = vector
            out = vector * emission[:, t]
            source = alpha[:, t - 1] if t else np.tile([1.0, 0.0], (len(chosen), 1))
            joint = source[:, :, None] * step * out[:, None, :]
            pairs += (joint / joint.sum(axis=(1, 2), keepdims=True))[inside[:, t]].sum(axis=0)
            moved = out @ step.T
            vector = np.where(inside[:, t, None], moved / moved.sum(axis=1, keepdims=True), vector)
        both = alpha * beta
        error = (gold - both[:, :, 1] / both.sum(axis=2)) * inside
        slope = np.bincount((ids % (len(names) + 1)).ravel(), np.repeat(error.ravel(), _FEATURES), len(names) + 1)
        slope[:-1] -= 0.5 * weights[:-1]
        slope[-1] = error.sum()
        gradient = np.concatenate([slope, (moves - pairs).ravel() - 0.5 * (transitions - start).ravel(), [0.0]])
        momentum = 0.8 * momentum + 0.2 * gradient
        speed = 0.95 * speed + 0.05 * gradient ** 2
        change = 0.3 * momentum / np.sqrt(speed)
        weights[:-1] = np.maximum(0.0, weights[:-1] + change[:len(names)])  # evidence only adds
        bias += 0.3 * change[len(names)]
        transitions = transitions + 0.3 * change[len(names) + 1:len(names) + 5].reshape(2, 2)
        transitions -= np.log(np.exp(transitions).sum(axis=1, keepdims=True))
    kept = {name: float(weights[i]) for name, i in names.items() if weights[i] > 0.05}
    model = Model(kept, float(bias), transitions, (0.0, 0.0, 0.0))
    model.calibration = _calibrated(model, texts)
    return model


def _calibrated(model: Model, texts: list[tuple[list[str], int]]) -> tuple[float, float, float]:
    """Logistic weights of the largest marginal and of log(1 + their sum), and the base."""
    known = _Evidence(model)
    rows = []
    for words, toxic in texts:
        evidence = [known[w] for w in words]
        places = [i for i, e in enumerate(evidence) if e]
        found = model.marginals(places, [evidence[i] for i in places], len(words))
        rows.append((max(found, default=0.0), math.log1p(sum(found)), 1.0, toxic))
    data = np.array(rows)
    x, y, weights = data[:, :3], data[:, 3], np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
        weights += np.linalg.solve(hessian, x.T @ (y - p) - 0.1 * weights)
    return tuple(float(w) for w in weights)


def train(rows: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          label_column: str = "toxic", *, toxic_rows: int = 1500, clean_rows: int = 3000,
          longest: int = 200_000, windows: int = 4000) -> Model:
    """A model from labelled rows that are not held out.

    The sample is bounded: about `toxic_rows` and `clean_rows` labelled rows, never over
    twice as many, of texts with at most `longest` characters; of its windows of tokens, the field
    is fitted to those that `fit` picks under `windows`. A repeated label counts as toxic if one of its rows is.
    """
    known = (labels.where(~held_out(F.col(id_column))).where(F.col(label_column).isNotNull())
             .groupBy(id_column).agg(F.max(F.col(label_column).cast("int")).alias("is_toxic")))
    picked = (sampled(known.where("is_toxic = 1"), id_column, toxic_rows)
              .unionByName(sampled(known.where("is_toxic = 0"), id_column, clean_rows)))
    texts = (rows.select(id_column, text_column).join(F.broadcast(picked), id_column)
             .where(F.length(text_column) <= longest)
             .dropDuplicates([id_column]).limit(2 * (toxic_rows + clean_rows))
             .select(F.col(id_column), F.col(text_column).alias("text"), "is_toxic").toArrow().to_pydict())
    order = sorted(range(len(texts["text"])), key=lambda i: str(texts[id_column][i]))
    return fit([(texts["text"][i], texts["is_toxic"][i]) for i in order], windows=windows)


def score(rows: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of `rows`: its id, score, spans (start, end, probability).

    Spans are runs of tokens that are toxic with probability 0.5 or more, in code points, the end
    exclusive. Null and empty texts have no spans and the score of a text without
    evidence. Repeated rows each get their row; an empty table gives an empty result; other columns
    are ignored.
    """
    id_type = rows.schema[id_column].dataType.simpleString()
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())])

    def one(text: str, known: _Evidence) -> tuple[float, list[dict]]:
        words = _WORDS.findall(text)
        evidence = list(map(known.__getitem__, words))
        if not any(evidence):
            return model.score([]), []
        places = [i for i, e in enumerate(evidence) if e]
        found = model.marginals(places, [evidence[i] for i in places], len(words))
        spans: list[dict] = []
        toxic = {i: p for i, p in zip(places, found) if p >= 0.5}
        last = -2
        for i, match in enumerate(_WORDS.finditer(text) if toxic else ()):
            if i in toxic:
                if last == i - 1:
                    spans[-1]["end"] = match.end()
                    spans[-1]["probability"] = max(spans[-1]["probability"], toxic[i])
                else:
                    spans.append({"start": match.start(), "end": match.end(), "probability": toxic[i]})
                last = i
        return model.score(found), spans

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Evidence(model)
        for batch in batches:
            for part in slices(batch):
                found = [one(t or "", known) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([s for s, _ in found], pa.float64()),
                     pa.array([s for _, s in found], pa.list_(span))], names=[id_column, "score", "spans"])

    return rows.select(id_column, text_column).mapInArrow(
        work, f"`{id_column}` {id_type}, score double,"
              " spans array<struct<start: bigint, end: bigint, probability: double>>")
