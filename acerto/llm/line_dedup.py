"""Line deduplication: lines are exploded, hashed and counted, repeated ones go, the rest is joined again.

1. Every text is split at line breaks once. A line's key is the line stripped of white space at both ends, A-Z
   lower-cased; keys that are long enough become 128 bits of their SHA-256. The digests of a row, in the order
   of its lines, are written to a narrow table; texts are not.
2. The exploded digests are counted per document and per key, combined in the map tasks on both ways. Keys in
   at least so many documents are repeated; each names the smallest id, which keeps its lines.
3. Repeated keys meet the exploded digests again, which gives the positions that a row loses. A key that holds
   more than 1/10,000 of all lines would be a hot join key; there are fewer than 10,000 of these, whatever the
   size of the table, so they are broadcast. All others are joined by a shuffle.
4. The positions meet the texts, which are shuffled once, and the lines that stay are joined by position.

Only SQL functions, no Python code touches rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, written

_SPACE = " \t\n\x0b\f\r"
#: Keys with more than this share of all lines are hot; there are fewer of them than its reciprocal.
_HOT_SHARE = 1e-4


def _digests(text: Column, least_length: int) -> Column:
    """Of each line in order: 16 bytes that stand for its key, null where the key is too short."""
    def digest(line: Column) -> Column:
        key = F.btrim(line, F.lit(_SPACE))
        return F.when(F.length(key) >= least_length, F.unhex(F.substring(F.sha2(key, 256), 1, 32)))

    return F.transform(F.split(lower_ascii(text), "\n"), digest)


def line_digests(rows: DataFrame, id_column: str, text_column: str, least_length: int) -> DataFrame:
    """`rows` as (id, row, keys); `row` tells texts of one id apart."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return rows.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("row"),
                       _digests(text, least_length).alias("keys"))


def repeated_lines(lines: DataFrame, least_documents: int) -> DataFrame:
    """Keys of (id, key) `lines` found in at least so many documents: key, documents, lines, first_id."""
    without_id = F.max(F.col("id").isNull().cast("int"))
    return (lines.groupBy("key").agg((F.count_distinct("id") + without_id).alias("documents"),
                                     F.count("*").alias("lines"), F.min("id").alias("first_id"))
            .where(F.col("documents") >= least_documents))


def _positions(lines: DataFrame, repeated: DataFrame, total: int) -> DataFrame:
    """Positions that each (id, row) loses, in order."""
    is_hot = F.col("lines") > total * _HOT_SHARE
    found = repeated.select("key", "first_id", "lines")
    hot = F.broadcast(found.where(is_hot).drop("lines"))
    others = lines.join(hot.select("key"), "key", "left_anti").join(found.where(~is_hot).drop("lines"), "key")
    lost = lines.join(hot, "key").unionByName(others).where(~F.col("id").eqNullSafe(F.col("first_id")))
    return lost.groupBy("id", "row").agg(F.sort_array(F.collect_set("pos")).alias("lost"))


def _stays(lost: Column, n_lines: Column) -> Column:
    """Whether each line stays, from the sorted positions `lost`: the gaps between them, written out."""
    def run(i: Column) -> Column:
        start = F.coalesce(F.get(lost, i - 1) + 1, F.lit(0))
        gap = F.coalesce(F.get(lost, i), n_lines) - start
        return F.concat(F.array_repeat(F.lit(True), gap), F.array(F.lit(False)))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(lost)), run))


def drop_repeated_lines(rows: DataFrame, id_column: str = "doc_id", text_column: str = "text", *,
                        least_length: int = 10, least_documents: int = 2) -> DataFrame:
    """One row for each row of `rows`: its id, n_lines (before dropping), n_dropped, text (lines that stay).

    A key of at least `least_length` code points that is found in at least `least_documents` documents loses all
    its lines but those in the document with the smallest id, which keeps them all. Null texts count as empty,
    an empty text is one empty line; a text that loses all its lines is empty. Rows with one id are one document,
    and rows without an id are one as well, which is never the smallest. Repeated rows are treated alike. An empty table gives an
    empty result; other columns are ignored. Time and memory of a row grow with its length.
    """
    entries = written(line_digests(rows, id_column, text_column, least_length), "line-digests")
    total = entries.agg(F.sum(F.size("keys"))).first()[0] or 0
    lines = entries.select("id", "row", F.posexplode("keys").alias("pos", "key")).where("key is not null")
    repeated = written(repeated_lines(lines, least_documents), "line-repeated")
    lost = _positions(lines, repeated, total)
    text = F.coalesce(F.col(text_column), F.lit(""))
    texts = rows.select(F.col(id_column).alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_row"))
    split = F.split("_text", "\n")
    n_lines = F.size(split)
    kept = F.zip_with(split, _stays(F.col("lost"), n_lines), lambda line, stays: F.when(stays, line))
    return (texts.join(lost, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_row") == F.col("row")), "left")
            .select(F.col("_id").alias(id_column), n_lines.cast("long").alias("n_lines"),
                    F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"),
                    F.when(F.col("lost").isNull(), F.col("_text")).otherwise(F.array_join(kept, "\n")).alias("text")))


ORACLE = """
with split as (
  select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents),
lines as (
  select doc_id, unnest(parts) as line, generate_subscripts(parts, 1) as pos from split),
keyed as (
  select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as line_key
  from lines),
repeated as (
  select line_key, min(doc_id) as first_id from keyed where length(line_key) >= 10
  group by line_key having count(distinct doc_id) >= 2),
marked as (
  select k.*, r.line_key is not null and k.doc_id <> r.first_id as lost
  from keyed k left join repeated r on k.line_key = r.line_key)
select doc_id, count(*) as n_lines, count(*) filter (lost) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not lost), '')) as kept_sha256
from marked group by doc_id
"""
