import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from acerto.llm import piece_tokens
from acerto.llm.piece_tokens import Agenda, encode

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def coder():
    return Agenda(MODEL)


def check(coder, text):
    (ids,), differ = coder.encode([text])
    wanted = coder.library.encode(text, add_bos=True, add_eos=True)
    assert list(memoryview(ids).cast("I")) == wanted
    assert differ == 0
    assert coder.decode(ids) == coder.library.decode(wanted)


@pytest.mark.parametrize("text", [
    "", " ", "   ", "a  b", " a ", "\n x\ty ", "a\xa0b", "ﬁ ①①", "</s> <s> a", "a\x00b", "▁a ▁", "<0x41>", "a" * 100,
    "ab" * 200, "😀 é̂ ​", "word " * 50, "12345678901234567890"])
def test_same_as_library(coder, text):
    check(coder, text)


@settings(max_examples=150, deadline=None)
@given(text=st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text(coder, text):
    check(coder, text)


@given(parts=st.lists(st.text("aeinst▁é①", min_size=1, max_size=12), min_size=1, max_size=8))
@settings(max_examples=100, deadline=None)
def test_array_merges_are_the_heaps(coder, parts):
    assert coder.merge_all(parts) == [coder.merge(p) for p in parts]


def test_table(frame, edge, coder):
    found = encode(frame(edge), MODEL).collect()
    assert len(found) == len(edge) and all(r.differ == 0 for r in found)
    texts = dict((i, t) for i, t, *_ in edge)
    for row in found:
        text = texts[row.doc_id] or ""
        assert list(memoryview(bytes(row.ids)).cast("I")) == coder.library.encode(text, add_bos=True, add_eos=True)
        assert row.decoded == coder.library.decode(coder.library.encode(text))
    assert encode(frame([]), MODEL).count() == 0


def test_a_text_that_differs_fails_with_its_id(frame, monkeypatch):
    coder = Agenda(MODEL)
    right = coder.merged

    def wrong(parts):
        ids, ends = right(parts)
        ids = ids.copy()
        for part, end in zip(parts, ends):
            if "odd" in part:
                ids[end - 1] = 5
        return ids, ends

    monkeypatch.setattr(coder, "merged", wrong)
    monkeypatch.setattr(piece_tokens, "agenda", lambda model: coder)
    rows = pa.record_batch([pa.array([7, 8, 9]), pa.array(["all right", "this is odd", "right"])], names=["doc_id", "text"])

    class Rows:
        sparkSession = frame([]).sparkSession
        schema = {"doc_id": type("Field", (), {"dataType": type("Long", (), {"simpleString": lambda self: "bigint"})()})()}

        def select(self, *names):
            return self

        def mapInArrow(self, work, schema):
            return list(work(iter([rows])))

    with pytest.raises(ValueError, match=r"doc_id \[8\]"):
        encode(Rows(), MODEL)


def test_cache_is_bounded_and_keeps_what_comes_again(monkeypatch):
    monkeypatch.setattr(piece_tokens, "_CACHED", 50)
    coder = Agenda(MODEL)
    for n in range(40):
        check(coder, "always here " + " ".join(f"w{n}x{i}" for i in range(20)))
        assert len(coder.cache) <= 75 and len(coder.older) <= 75
    calls = []
    monkeypatch.setattr(coder, "merged", lambda parts: calls.append(parts))
    check(coder, "always here")
    assert calls == []
    coder.forget()
    assert not coder.cache and not coder.older
