"""Encoding and decoding with merge-type SentencePiece vocabularies.

A text becomes symbols, one per character. An agenda holds the adjacent pairs whose joint
piece is in the vocabulary, best score first and leftmost first among equals; the head of the
agenda is merged and the new symbol's pairs enter it, until none is left. Characters
outside the vocabulary become byte pieces.

Where no piece has the space mark after another character, no merge crosses the start of a
run of space marks. The text is then cut there, and equal parts are encoded once per worker, as long as they keep coming
(a cache of two generations of bounded size, which lives as long as the worker). The agendas of all new parts of a batch advance together, one merge
each at a time, as array operations; a long part has a heap of its own. Each Arrow batch
checks all parts it meets for the first time, and its first whole text, against the
sentencepiece library, and fails where they differ.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from .common import held_by_worker, settle, slices, small_batches

MARK = "▁"
_LONGEST_CACHED = 64
_CACHED = 100_000  # parts in a generation of the cache; about 25 MB


class Agenda:
    """Encoder and decoder for one model file."""

    def __init__(self, model_file: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        library, size = self.library, len(self.library)
        plain = [i for i in range(size) if not (library.is_unknown(i) or library.is_control(i)
                                                or library.is_byte(i) or library.is_unused(i))]
        self.ids = {library.id_to_piece(i): i for i in plain}
        self.rank = {piece: -library.get_score(i) for piece, i in self.ids.items()}
        self.byte_ids = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes = [b""] * size
        for piece, i in self.ids.items():
            self.bytes[i] = piece.replace(MARK, " ").encode()
        for b, i in enumerate(self.byte_ids):
            self.bytes[i] = bytes([b])
        self.begin, self.end = library.bos_id(), library.eos_id()
        separable = not any(MARK in piece.lstrip(MARK) for piece in self.ids)
        self.separable = separable
        self.runs = re.compile(f"{MARK}+[^{MARK}]*").findall
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self._pairs()

    def _pairs(self) -> None:
        """All mergeable pairs: left id * size + right id, sorted; the joint piece's rank and id."""
        ids, size = self.ids, len(self.bytes)
        order = sorted(ids, key=self.rank.__getitem__)
        found = sorted((ids[piece[:cut]] * size + ids[piece[cut:]], place)
                       for place, piece in enumerate(order) for cut in range(1, len(piece))
                       if piece[:cut] in ids and piece[cut:] in ids)
        self.pair_keys = np.array([key for key, _ in found] + [2**62], np.int64)
        self.pair_places = np.array([place for _, place in found] + [0], np.int64)
        self.place_ids = np.array([ids[piece] for piece in order] + [0], np.int64)

    def parts(self, text: str) -> list[str]:
        """The parts of `text` that merge on their own, each without its first space mark."""
        if not text:
            return []
        if self.separable and MARK not in text and "  " not in text and text[0] != " ":
            return text.split(" ")
        text = MARK + text.replace(" ", MARK)
        return [part[1:] for part in self.runs(text)] if self.separable else [text[1:]]

    def merge(self, part: str) -> list[int]:
        """The ids of `part`, which has space marks for spaces."""
        rank = self.rank
        symbols: list[str | None] = list(part)
        count = len(symbols)
        before, after = list(range(-1, count - 1)), list(range(1, count + 1))
        agenda = []
        for left in range(count - 1):
            pair = symbols[left] + symbols[left + 1]
            if (found := rank.get(pair)) is not None:
                agenda.append((found, left, left + 1, pair))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, pair = heapq.heappop(agenda)
            if symbols[left] is None or after[left] != right or symbols[right] is None \
                    or len(symbols[left]) + len(symbols[right]) != len(pair):
                continue  # one of the two has been merged since
            symbols[left], symbols[right] = pair, None
            follower = after[left] = after[right]
            if follower < count:
                before[follower] = left
                pair = symbols[left] + symbols[follower]
                if (found := rank.get(pair)) is not None:
                    heapq.heappush(agenda, (found, left, follower, pair))
            if (leader := before[left]) >= 0:
                pair = symbols[leader] + symbols[left]
                if (found := rank.get(pair)) is not None:
                    heapq.heappush(agenda, (found, leader, left, pair))
        found = []
        for symbol in symbols:
            if symbol is not None:
                known = self.ids.get(symbol)
                found.extend([known] if known is not None else [self.byte_ids[b] for b in symbol.encode()])
        return found

    def merge_all(self, parts: list[str]) -> list[list[int]]:
        """As `merge` for each of `parts`, which are short."""
        ids, ends = self.merged(parts)
        return [ids[a:b].tolist() for a, b in zip([0, *ends], ends)]

    def merged(self, parts: list[str]) -> tuple[np.ndarray, list[int]]:
        """The ids of all `parts`, which are short, end to end, and where each one's end: one merge of each per round."""
        size, never = len(self.bytes), np.int64(2**62)
        text = "".join(parts)
        known = {c: self.ids.get(c, -1 - k) for k, c in enumerate(set(text))}  # below 0: not in the vocabulary
        strange = {i: [self.byte_ids[b] for b in c.encode()] for c, i in known.items() if i < 0}
        symbols = np.fromiter(map(known.__getitem__, text), np.int64, len(text))
        owner = np.repeat(np.arange(len(parts)), np.fromiter(map(len, parts), np.int64, len(parts)))
        done_symbols, done_owners = [], []

        def place(left: np.ndarray, right: np.ndarray) -> np.ndarray:
            key = np.where((left < 0) | (right < 0), -1, left * size + right)
            at = np.searchsorted(self.pair_keys, key)
            return np.where(self.pair_keys[at] == key, self.pair_places[at], never >> 20)

        places = np.append(place(symbols[:-1], symbols[1:]), never >> 20)
        places[:-1][owner[:-1] != owner[1:]] = never >> 20
        while len(symbols):
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best = np.minimum.reduceat((places << 20) | np.arange(len(places)), starts)
            merging = best < (never >> 1)
            if not merging.all():
                lengths = np.diff(np.append(starts, len(symbols)))
                ended = np.repeat(~merging, lengths)
                done_symbols.append(symbols[ended])
                done_owners.append(owner[ended])
                shift = np.cumsum(ended) - ended
                best = best[merging]
                left = best & ((1 << 20) - 1)
                left = left - shift[left]
                symbols, owner, places = symbols[~ended], owner[~ended], places[~ended]
            else:
                left = best & ((1 << 20) - 1)
            symbols[left] = self.place_ids[best >> 20]
            rest = np.ones(len(symbols), bool)
            rest[left + 1] = False
            symbols, owner, places = symbols[rest], owner[rest], places[rest]
            left = left - np.arange(len(left))  # one symbol less for each merge before it
            for first in (left, left - 1):
                first = first[(first >= 0) & (first + 1 < len(symbols))]
                same = owner[first] == owner[first + 1]
                places[first] = np.where(same, place(symbols[first], symbols[first + 1]), never >> 20)
            if len(left):
                places[-1] = never >> 20
        symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owners)
        order = np.argsort(owner, kind="stable")
        symbols, owner = symbols[order], owner[order]
        if strange:  # a character outside the vocabulary becomes the ids of its bytes
            sizes = np.ones(len(symbols), np.int64)
            unknown = np.flatnonzero(symbols < 0)
            spelled = [strange[i] for i in symbols[unknown].tolist()]
            sizes[unknown] = [len(x) for x in spelled]
            starts = np.cumsum(sizes) - sizes
            symbols, owner = np.repeat(symbols, sizes), np.repeat(owner, sizes)
            for at, found in zip(starts[unknown].tolist(), spelled):
                symbols[at:at + len(found)] = found
        return symbols, np.searchsorted(owner, np.arange(1, len(parts) + 1)).tolist()

    def _checked(self, parts: list[str]) -> int:
        """Encodes and caches `parts`; how many the library encodes differently."""
        differ = 0
        short = [p for p in parts if len(p) <= _LONGEST_CACHED]
        for start in range(0, len(short), 10_000):  # 20 bits hold a symbol's number
            some = short[start:start + 10_000]
            ids, ends = self.merged([MARK + p for p in some])
            differ += self._differing(some, ids, ends)
            flat = ids.astype("<u4").tobytes()
            self.cache.update((part, flat[4 * a:4 * b]) for part, a, b in zip(some, [0, *ends], ends))
        for part in parts:
            if len(part) > _LONGEST_CACHED:
                ids = self.merge(MARK + part)
                differ += self._differing([part], np.array(ids, np.int64), [len(ids)])
                self.cache[part] = array("I", ids).tobytes()
        return differ

    def _differing(self, parts: list[str], ids: np.ndarray, ends: list[int]) -> int:
        """How many of `parts`, whose ids stand end to end, the library encodes differently."""
        wanted = self.library.encode([p.replace(MARK, " ") for p in parts], num_threads=1)
        if "" in parts:  # the library encodes the empty text as nothing
            i = parts.index("")
            wanted[i] = ids[ends[i - 1] if i else 0:ends[i]].tolist()
        sizes = np.fromiter(map(len, wanted), np.int64, len(wanted))
        if (np.cumsum(sizes) == ends).all() and (np.fromiter(chain.from_iterable(wanted), np.int64, len(ids)) == ids).all():
            return 0
        return sum(w != ids[a:b].tolist() for w, a, b in zip(wanted, [0, *ends], ends))

    def _renew(self, parts: set[str]) -> None:
        """Makes a full generation the older one; parts of it that are met again live on in the new one."""
        if len(self.cache) > _CACHED:
            self.cache, self.older = {}, self.cache
        older = self.older
        if older:
            for part in parts:
                if part not in self.cache and (known := older.get(part)) is not None:
                    self.cache[part] = known

    def encode(self, texts: list[str]) -> tuple[list[bytes], int]:
        """Ids of each text as little-endian unsigned 32-bit integers, begin and end ids
        included; in how many places the library differs."""
        split = [self.parts(text) for text in texts]
        wanted = set(chain.from_iterable(split))
        self._renew(wanted)
        cache = self.cache
        fresh = [part for part in wanted if part not in cache]
        differ = self._checked(fresh)
        begin, end = array("I", [self.begin]).tobytes(), array("I", [self.end]).tobytes()
        encoded = [begin + b"".join(map(cache.__getitem__, parts)) + end for parts in split]
        for part in fresh:
            if len(part) > _LONGEST_CACHED:
                del cache[part]
        if texts:
            differ += self.library_ids(texts[0]) != encoded[0]
        return encoded, differ

    def forget(self) -> None:
        """Frees the cache."""
        self.cache, self.older = {}, {}

    def library_ids(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_bos=True, add_eos=True)).tobytes()

    def decode(self, ids: bytes) -> str:
        """The text of `ids`; control ids have none, the leading space mark's space goes."""
        text = b"".join(map(self.bytes.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def agenda(model_file: str) -> Agenda:
    """One encoder for each Python worker, with its cache, which goes when another operator starts in the worker."""
    found = Agenda(model_file)
    held_by_worker(found.forget)
    return found


def encode(rows: DataFrame, model_file: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of `rows`: its id, ids (binary, little-endian unsigned 32-bit
    integers with begin and end ids), decoded (the text of these ids), differ.

    A text that the library encodes otherwise fails the job with its id, so `differ` is 0. Null texts
    count as empty and give the begin and end ids. Repeated rows each get their row; an empty
    table gives an empty result; other columns are ignored. `model_file` lies at the same
    place on every executor, as the library does.
    """
    id_type = rows.schema[id_column].dataType.simpleString()
    small_batches(rows.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = agenda(model_file)
        for batch in batches:
            for part in slices(batch, 2 << 20):
                texts = [t or "" for t in part.column(1).to_pylist()]
                encoded, differ = coder.encode(texts)
                if differ:
                    wrong = [i for i, text in enumerate(texts) if coder.library_ids(text) != encoded[i]]
                    ids = [part.column(0)[i].as_py() for i in wrong[:10]]
                    raise ValueError(f"the library encodes the texts of {id_column} {ids} otherwise")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(encoded, pa.binary()),
                     pa.array([coder.decode(ids) for ids in encoded], pa.string()),
                     pa.array([0] * len(texts), pa.int64())],
                    names=[id_column, "ids", "decoded", "differ"])
                settle()

    return rows.select(id_column, text_column).mapInArrow(
        work, f"`{id_column}` {id_type}, ids binary, decoded string, differ bigint")
