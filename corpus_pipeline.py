"""The corpus pipeline: STAGES, applied to the documents one after the other.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns the columns of
documents, the last one its tokens. `run` writes each stage's result as Parquet and reads it again.
ORACLE_SQL is None: languages, similarity and tokens are beyond SQL; tests compare `run` with a
brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acerto.llm import exact_dedup, language, mixing, near_ngrams, piece_tokens
from acerto.llm.common import documents, lower_ascii, written

ORACLE_SQL = None
#: Up to so many dropped documents are sent to all tasks; beyond, documents are shuffled.
MOST_BROADCAST = 1_000_000


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """`docs` (with the row itself in _row) without those that agree with one of `dropped` in all its
    columns, nulls too."""
    dropped = written(dropped.distinct(), "pipeline-dropped")
    if dropped.count() <= MOST_BROADCAST:
        dropped = F.broadcast(dropped)
    same = F.lit(True)
    for column in dropped.columns:
        same = same & docs[column].eqNullSafe(dropped[column])
    return docs.join(dropped, same, "left_anti").select("_row.*")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; those without text or in no known language go."""
    return language.of_documents(docs, only_accepted=True)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id; rows without a text are equal to empty ones."""
    found = exact_dedup.deduplicate(docs, keep="largest")
    digest = F.sha2(lower_ascii(F.coalesce("text", F.lit(""))), 256)
    return _without(docs.select(F.struct("*").alias("_row"), "doc_id", digest.alias("text_sha256")),
                    found.where("not kept").select("doc_id", "text_sha256"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked texts, the document with the smallest id. Rows that share an id go together."""
    found = near_ngrams.jaccard_join(docs)
    return _without(docs.select(F.struct("*").alias("_row"), "doc_id"),
                    found.where("doc_id <> component_id").select("doc_id"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents of which it takes words, as many times as it takes them, at least once.

    Rows that share an id are taken alike.
    """
    taken = (mixing.mix(docs).groupBy("doc_id").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
             .where("taken > 0")
             .select(F.col("doc_id").alias("mixed_id"),
                     F.greatest(F.lit(1), F.round(F.col("taken") / F.col("size"))).cast("int").alias("times")))
    rows = docs.select(F.struct("*").alias("_row"), "doc_id")
    return (rows.join(taken, rows["doc_id"].eqNullSafe(taken["mixed_id"]))
            .select("_row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("_row.*"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each document: its id, their number and digest, and the digest of the decoded text."""
    encoded = piece_tokens.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("exact_dedup", drop_copies),
    ("near_ngrams", drop_near_copies),
    ("mixing", mix_sources),
    ("tokens", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in `sf_dir`."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


def pipeline_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def pipeline_oracles() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
