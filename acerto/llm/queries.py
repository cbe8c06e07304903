"""The queries of this package and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (conversations, exact_dedup, filter_audit, language, licenses, line_dedup, mixing, near_ngrams, near_vectors, pii, piece_tokens,
               secrets, toxicity)
from .common import documents


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(documents(spark, sf_dir))
    base = F.filter("places", lambda p: p.kind == "base")
    starts = F.transform(base, lambda p: p.word)

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    every = F.concat(F.transform("places", lambda p: p.label),
                     F.flatten(F.transform("expressions", lambda e: e.labels)))
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(F.transform(base, lambda p: p.label)).alias("base_labels"), joined(every).alias("labels"),
        "score", F.exists("expressions", lambda e: ~e.allowed).alias("forbidden"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def of(kind):
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    every = F.flatten(F.array(*(F.array_sort(F.filter(F.concat("base", "added"), _is(kind))) for kind in pii.KINDS)))
    return pii.scan(documents(spark, sf_dir)).select(
        "doc_id", *map(of, pii.KINDS), F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(every).alias("spans"))


def _is(kind: str):
    return lambda span: span.kind == kind


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(documents(spark, sf_dir), keep="largest")


def op5_piece_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = piece_tokens.encode(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "differ")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = documents(spark, sf_dir)
    model = toxicity.train(texts, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(texts, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("spans").cast("long").alias("n_spans"))


def op7_near_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_ngrams.jaccard_join(documents(spark, sf_dir))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = [kind for kind, *_ in secrets.PATTERNS]

    def listed(spans):
        return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", m.kind, m.start, m.end)), ",")

    def of(*wanted):
        return F.filter("spans", lambda m: m.kind.isin(*wanted))

    return secrets.scan(documents(spark, sf_dir)).select(
        "doc_id", *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds),
        F.sha2(listed(of(*kinds)), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and pages, whose rows share the model and the counts."""
    none = F.lit(None).cast("string")
    docs = documents(spark, sf_dir).select(
        "doc_id", F.lit(None).cast("long").alias("page_id"), "text", F.col("lang").alias("declared"),
        F.col("source").alias("host"), F.col("source").alias("domain"), none.alias("suffix"))
    pages = language.page_columns(spark.read.parquet(f"{sf_dir}/pages.parquet")).withColumn(
        "doc_id", F.lit(None).cast("long"))
    rows = docs.unionByName(pages)
    found = language.identify(rows, language.train(rows, "text", "declared"),
                              *(F.col(c) for c in ("text", "declared", "host", "domain", "suffix")))
    return found.select("doc_id", "page_id", "language", "probability", F.col("accepted").alias("kept"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversations.damage(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return conversations.digests(damaged, conversations.audits(damaged))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def text_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_near_vectors, op2_licenses, op3_pii, op4_exact_dedup, op5_piece_tokens, op6_toxicity, op7_near_ngrams, op8_mixing, op9_secrets, op10_language,
             op11_conversation_repair, op12_line_dedup, op13_filter_audit]
    return {query.__name__: query for query in found}


def text_oracles() -> dict[str, str]:
    return {"op4_exact_dedup": exact_dedup.ORACLE, "op8_mixing": mixing.ORACLE, "op11_conversation_repair": conversations.ORACLE,
            "op12_line_dedup": line_dedup.ORACLE, "op13_filter_audit": filter_audit.ORACLE}
