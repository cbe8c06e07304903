import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from acerto.llm import language

WORDS = {"en": "the and with house water that this from have been", "fr": "le la des avec maison eau que dans été une",
         "de": "der die das und mit haus wasser nicht ein für"}


def corpus():
    rows = []
    for k, (lang, text) in enumerate(WORDS.items()):
        vocabulary = text.split()
        rows += [(k * 100 + i, " ".join(vocabulary[(i * j + j) % 10] for j in range(1, 15)), lang, f"{lang}{i % 3}.site")
                 for i in range(60)]
    return rows


def build(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_fusion(spark):
    table = build(spark, corpus())
    model = language.train(table)
    probes = [(1000, "wasser", None, None), (1001, "e", None, "fr0.site"), (1002, "", "en", "en0.site"), (1003, None, None, None),
              (1004, "the water and the house", "xx", "de0.site"), (1005, "Ω≈ç√∫˜µ≤≥÷ ДЖЗ ЩЪЫ ЭЮЯ жзи", None, None), (1006, "?!", "de-AT", None)]
    rows = build(spark, corpus() + probes)
    none = F.lit(None).cast("string")
    found = {r.doc_id: r for r in language.identify(
        rows, model, F.col("text"), F.col("lang"), F.col("source"), F.col("source"), none).collect()}
    truth = {r[0]: r[2] for r in corpus()}
    assert all(found[i].language == lang and found[i].accepted for i, lang in truth.items())
    assert found[1000].language == "de" and found[1004].language == "en"
    assert found[1001].language == "fr"  # the text says nothing, the host does
    assert not found[1002].accepted and found[1002].language == "en" and not found[1003].accepted
    assert found[1005].language == "und" and not found[1005].accepted
    assert found[1006].language == "de"


def test_columns_and_empty(spark, frame, edge):
    assert language.of_documents(frame(edge), only_accepted=True).columns == frame(edge).columns
    assert language.of_documents(frame(edge)).count() == len(edge)
    assert language.of_documents(frame([])).count() == 0


def test_pages(spark):
    html = "<html lang='fr-FR'><head><style>p{}</style><script>var t=\"</p>\";</script></head><body><p>Bonjour</p></body></html>"
    pages = spark.createDataFrame([(1, "https://u@a.b.Example.co:80/x?y#z", html), (2, None, None)],
                                  "page_id long, url string, html string")
    first, second = language.page_columns(pages).orderBy("page_id").collect()
    assert (first.text.split(), first.declared, first.host, first.domain, first.suffix) == (
        ["Bonjour"], "fr", "a.b.example.co", "example.co", "co")
    assert (second.text, second.declared, second.host) == ("", "", "")


def test_rare_and_many_languages(spark):
    pick = random.Random(5)
    rows, truth = [(i, " ".join(pick.choices(WORDS["en"].split(), k=14)), "en", None) for i in range(2000)], {}
    for k in range(80):  # 80 rare languages of 4 rows, one of them with a region
        vocabulary = ["".join(pick.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(12)]
        name = chr(97 + k // 26) + chr(97 + k % 26) + "x"
        for j in range(4):
            truth[10_000 + 10 * k + j] = name
            rows.append((10_000 + 10 * k + j, " ".join(pick.sample(vocabulary, 10)), name + "-AT" * (k == 7), None))
    rows += [(20_000 + i, "kopia kopia jednego tekstu", "pl", None) for i in range(300)]
    rows += [(30_000, "pitkä teksti yksin " * 50, "fi", None), (30_001, "12345 67890", "qq", None), (30_002, "dummy", "und", None)]
    table = build(spark, rows)
    model = language.train(table, sample_rows=60, longest=500)
    assert model.languages == (*sorted({"en", "pl", "fi", "qq", *truth.values()}), "und")
    none = F.lit(None).cast("string")
    found = {r.doc_id: r for r in language.identify(table, model, F.col("text"), F.col("lang"), none, none, none).collect()}
    assert len(found) == len(rows)
    assert all(found[i].language == name and found[i].accepted for i, name in truth.items())
    assert found[0].language == "en" and found[20_000].language == "pl" and found[30_000].language == "fi"


def test_junk_declarations_leave_the_table_alone(spark):
    junk = [(50_000 + i, f"junk text {i} the water", f"wild{i} guess", None) for i in range(5_000)]
    junk += [(60_000 + i, f"junk text {i} das wasser", f"name{i}", None) for i in range(5_000)]
    plain = language.train(build(spark, corpus()))
    found = language.train(build(spark, corpus() + junk))
    assert found.languages == plain.languages and found.table.shape == plain.table.shape
    named = [(70_000 + i, f"kotona on vesi {i}", "suomi", None) for i in range(120)]
    assert "suomi" in language.train(build(spark, corpus() + junk + named)).languages
    assert "suomi" not in language.train(build(spark, corpus() + named[:90])).languages


def test_columns_called_like_the_result(spark):
    rows = build(spark, corpus()).withColumn("Language", F.lit("x")).withColumn("accepted", F.lit(7)).withColumn("_text", F.lit("y"))
    found = language.of_documents(rows)
    assert found.columns == ["doc_id", "text", "lang", "source", "_text", "language", "probability", "accepted"]
    assert language.of_documents(rows, only_accepted=True).columns == rows.columns
    assert found.where("language = lang and accepted and _text = 'y'").count() == len(corpus())


@pytest.mark.parametrize("html, text", [
    ("a < b and c > d", "a   d"), ("<p>one</p><!-- two --><br", "one <br"), ("<style>p{}</STYLE >x<script>y", "x"), ("<script>a</script foo>b", "b"),
    ("<scripted>a</scripted>", "a"), ("", ""), (None, "")])
def test_broken_pages(spark, html, text):
    pages = spark.createDataFrame([(1, None, html)], "page_id long, url string, html string")
    assert language.page_columns(pages).first().text.split() == text.split()


@pytest.mark.parametrize("piece", ["<", "<script>", "<script ", "</script ", "<html ", "<html lang", "< >", "<style></style"])
def test_long_broken_pages_take_linear_time(spark, piece):
    pages = spark.createDataFrame([(1, None, piece * (1_000_000 // len(piece)))], "page_id long, url string, html string")
    began = time.time()
    language.page_columns(pages).collect()
    assert time.time() - began < 10


def posterior(rows, model, most_trigrams=60, host_weight=20.0):
    """Languages and probabilities of (id, text, declared, source), the source being host and domain, by hand."""
    names = model.languages

    def text_score(text):
        cells, _ = language._trigrams(pa.array([text or ""]))
        if not len(cells):
            return None
        sums = np.array([model.table[cells, k].astype(float).sum() for k in range(len(names))])
        sums *= min(len(cells), most_trigrams) / len(cells)
        return sums - sums.max()

    scores = [text_score(r[1]) for r in rows]
    said = [None if not r[2] else r[2] if r[2] in names else "other" for r in rows]
    guesses = [(int(np.argmax(s)), d, r[3] or "") for s, d, r in zip(scores, said, rows) if s is not None]
    overall = np.array([Counter(g[0] for g in guesses)[k] for k in range(len(names))], float)
    shares = (overall + 1) / (overall.sum() + len(names))
    values = [*names, "other"]

    def counts(host):
        return np.array([sum(g[0] == k and g[2] == host for g in guesses) for k in range(len(names))], float)

    out = {}
    for (ident, _, _, host), score, declared in zip(rows, scores, said):
        seen = counts(host or "")
        domain = (seen + host_weight * shares) / (seen.sum() + host_weight)
        prior = (seen + host_weight * domain) / (seen.sum() + host_weight)
        total = np.log(prior if seen.sum() else shares)
        if score is not None:
            total = total + score
        if declared is not None:
            for k, name in enumerate(names):
                weights = {v: sum(g[0] == k and g[1] == v for g in guesses) + (2.0 if v == name else 0.1) for v in values}
                total[k] += np.log(weights[declared] / sum(weights.values()))
        share = np.exp(total - total.max())
        out[ident] = (names[int(np.argmax(total))], 1 / share.sum())
    return out


def test_posterior_recomputed(spark):
    pick = random.Random(8)
    rows = [(i, " ".join(pick.choices(WORDS[lang].split() + WORDS["en"].split()[:3], k=pick.randint(1, 4))), pick.choice([lang, lang, None, "en", "xx"]),
             pick.choice([f"{lang}0.site", "mixed", None])) for i in range(150) for lang in [pick.choice(list(WORDS))]]
    rows += [(500, None, "fr", "mixed"), (501, "", None, None), (502, "e", None, "never seen"), (503, "??", "zz", "mixed")]
    table = build(spark, rows)
    model = language.train(build(spark, corpus()))
    none = F.lit(None).cast("string")
    found = {r.doc_id: (r.language, r.probability) for r in language.identify(
        table, model, F.col("text"), F.col("lang"), F.col("source"), F.col("source"), none).collect()}
    for ident, (name, probability) in posterior(rows, model).items():
        assert found[ident] == (name, pytest.approx(probability, rel=1e-6)), ident
