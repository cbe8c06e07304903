"""Exact deduplication by a tree merge of sorted digest runs.

Every row becomes an entry (digest, proof, id): a 64-bit digest that places it, and SHA-256
and byte length as the proof of equality. Entries are dealt to 16 ** `rounds` runs by the
hash of their id, so that a text with very many copies starts in every run, and each run is sorted by digest, proof and id. In each
round, 16 runs that differ in one hexadecimal digit of their number exchange entries:
an entry goes to the run that has its digest's digit in that place. The receiving run merges
the 16 parts into one sorted run, where equal entries are neighbours: the first of each digest and proof stays, which has
the smallest (or largest) identifier, with the number of all. A round is four binomial rounds in one, as 16 parts are merged instead
of two; Spark's sort is what merges them. After the last round all entries of a digest have met.
The way back passes each result down the same tree, level by level.

No key is hot on any way: a level has at most 16 entries of a digest in a run, and
the rows of one text are spread over all runs. Texts are read and hashed once, into a narrow table, and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_ascii, written

_DIGIT_BITS = 4


def _next_run(level: int) -> Column:
    """The run number with its digit `level` replaced by that digit of the digest."""
    shift = _DIGIT_BITS * level
    mask = ((1 << _DIGIT_BITS) - 1) << shift
    return F.col("run").bitwiseAND(F.lit(~mask).cast("long")).bitwiseOR(
        F.col("digest").bitwiseAND(F.lit(mask).cast("long")))


def _merged(entries: DataFrame, proof: list[str], first: Column) -> DataFrame:
    """Runs in order, with the first entry of each digest and proof and the number of all."""
    same = Window.partitionBy("run", *proof).orderBy(first)
    every = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (entries.withColumn("place", F.row_number().over(same)).withColumn("n", F.sum("n").over(every))
            .where("place = 1").drop("place"))


def deduplicate(rows: DataFrame, id_column: str = "doc_id", text_column: str = "text", *,
                keep: str = "smallest", rounds: int = 3, normalise=lower_ascii) -> DataFrame:
    """One row for each row of `rows`: its id, keep_id, group_size, kept, text_sha256.

    Texts are equal when `normalise` gives the same text; null counts as empty. `keep` is
    "smallest" or "largest", the identifier of a group that stays. Rows with the same id
    and equal texts are one document: they count in group_size and are kept or dropped together.
    A null id never stays where the group has another; a group of null ids has keep_id null
    and keeps all its rows. An empty table gives an empty result; other columns are ignored.
    """
    first = {"smallest": F.asc_nulls_last, "largest": F.desc_nulls_last}[keep]("best")
    text = normalise(F.coalesce(F.col(text_column), F.lit("")))
    runs = 1 << (_DIGIT_BITS * rounds)
    # No join key can be null: else the joins would filter their inputs, each in its own way,
    # and the one shuffle of the entries could not serve them all.
    read = (rows.select(F.col(id_column).alias("id"), text.alias("text"))
            .select("id", F.xxhash64("text").alias("digest"),
                    F.coalesce(F.unhex(F.sha2("text", 256)), F.lit(b"")).alias("sha"),
                    F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")))
    entries = (written(read, "text-digests").withColumn("run", F.xxhash64("id").bitwiseAND(F.lit(runs - 1).cast("long")))
               .select("id", "digest", F.coalesce("sha", F.lit(b"")).alias("sha"), F.coalesce("size", F.lit(0)).alias("size"), "run")
               .repartition("run", "digest"))
    proof = ["digest", "sha", "size"]
    levels = [_merged(entries.select("run", *proof, F.col("id").alias("best"), F.lit(1).cast("long").alias("n")), proof, first)]
    for level in range(rounds):
        levels.append(_merged(levels[-1].withColumn("run", _next_run(level)), proof, first))
    found = levels.pop()
    for level in reversed(range(rounds)):
        below = levels.pop().select("run", _next_run(level).alias("above"), *proof)
        found = (below.join(found.withColumnRenamed("run", "above"), ["above", *proof])
                 .select("run", *proof, "best", "n"))
    return (entries.join(found, ["run", *proof])
            .select(F.col("id").alias(id_column), F.col("best").alias("keep_id"),
                    F.col("n").alias("group_size"), F.col("id").eqNullSafe(F.col("best")).alias("kept"),
                    F.lower(F.hex("sha")).alias("text_sha256")))


ORACLE = """
with entries as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm
  from documents)
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(norm) as text_sha256
from entries window same as (partition by norm)
"""
