import hashlib
from array import array

import public_tokenizers
import sentencepiece

import corpus_pipeline
from check_oracle import difference, open_tables
from acerto.llm.queries import text_oracles
from tests.llm.test_near_ngrams import brute

import pytest


@pytest.mark.parametrize("name", sorted(text_oracles()))
def test_same_as_sql(spark, sf_dir, name):
    assert difference(spark, open_tables(sf_dir), sf_dir, name) is None


def test_stages_keep_the_columns(spark, frame, edge):
    docs = frame(edge)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, "")
        assert found.columns == docs.columns, name
        assert stage(spark, docs.limit(0), "").count() == 0
        docs = spark.createDataFrame(found.collect(), docs.schema)
    assert {r.doc_id for r in docs.collect()} <= {None, 4, 5, 6, 7, 9, 10}


def test_run_is_brute_force(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(120)
    extra = docs.limit(3).selectExpr("doc_id + 5000 as doc_id", "upper(text) as text", "lang", "source", "n_chars") \
        .where("text rlike '^[\\\\x00-\\\\x7F]*$'")
    rows = docs.unionByName(extra)
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for r in rows.collect():  # the last of equal texts
        key = r.text.encode().lower()
        kept[key] = max(kept.get(key, -1), r.doc_id)
    texts = {r.doc_id: r.text for r in rows.collect() if r.doc_id in set(kept.values())}
    linked = brute(list(texts.items()))
    texts = {i: t for i, t in texts.items() if linked[i][1] == i}
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in found} <= set(texts)
    coder = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    words = {i: len(t.split()) for i, t in texts.items()}
    assert sum(words[r.doc_id] for r in found) == pytest.approx(1.5 * sum(words.values()), rel=0.1)
    for r in found:
        ids = array("I", coder.encode(texts[r.doc_id], add_bos=True, add_eos=True))
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
