"""How filters interact: what each removes, for every order they can be applied in.

1. One pass over the texts gives each document its failures, one bit for each filter. Whether a text is a copy of
   one with a smaller id is found by counting: rows are aggregated by digest, part and labels, and the smallest id
   of a digest tells how many of these rows are no copies. No join, and copies combine before every shuffle.
2. Documents are counted per part and mask of failures: at most 32 cells a part.
3. A Gray-code walk visits all 32 subsets of filters, toggling one filter at a time. Each mask keeps a counter of
   the active filters that it fails; a cell leaves the running survivors when its counter rises from 0 and
   comes back when it falls to 0. The survivors of each subset are stored; a step of an order is the
   difference of two of these states.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILTERS = "ABCDE"
_SPACE = " \t\n\x0b\f\r"
_COPY = 1 << FILTERS.index("E")
_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
#: Join keys of rows without an id, spread over so many groups that have no partner.
_NO_ID_GROUPS = 4096


def _text_failures(text: Column) -> Column:
    """Bits of the filters A to D that `text` fails."""
    trimmed = F.btrim(text, F.lit(_SPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    # The array of one gives the words a name, so that they are split once.
    counted = F.transform(F.array(words), lambda w: F.struct(
        F.size(w).cast("long").alias("all"), F.size(F.array_distinct(w)).cast("long").alias("different")))[0]
    capitals = F.regexp_count(text, F.lit("[A-Z]")).cast("long")
    fails = (counted["all"] < 200, counted["different"] * 100 < counted["all"] * 50,
             capitals * 100 > F.length(text).cast("long") * 3, text.rlike("[#$%&*|]"))
    return sum((F.when(test, F.lit(1 << i)).otherwise(F.lit(0)) for i, test in enumerate(fails)), F.lit(0))


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` (id, digest, part, mask) with good and toxic, false where no label says so."""
    found = (labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id"))
             .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
             .withColumn("_group", F.lit(0)))
    none = F.lit(0).cast(docs.schema["id"].dataType)
    group = F.when(F.col("id").isNull(), F.pmod(F.hash("digest"), F.lit(_NO_ID_GROUPS)) + 1).otherwise(F.lit(0))
    keyed = docs.select("*", F.coalesce("id", none).alias("_id"), group.alias("_group"))
    return keyed.join(found, ["_id", "_group"], "left").select(
        *docs.columns, *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents per part and mask of failures: part, mask, n, good, toxic."""
    text = F.coalesce(F.col("text"), F.lit(""))
    read = docs.select(F.col("doc_id").alias("id"), F.unhex(F.sha2(text, 256)).alias("digest"),
                       F.coalesce(F.col("lang"), F.lit("")).alias("part"), _text_failures(text).alias("mask"))
    same = ["digest", "part", "mask", "good", "toxic"]
    per_id = _labelled(read, labels).groupBy(*same, "id").agg(F.count("*").alias("n"))
    known = F.when(F.col("id").isNotNull(), F.struct("id", "n"))
    grouped = per_id.groupBy(*same).agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("no_id"),
        F.min(known).alias("lowest"))
    smallest = F.expr("min(lowest.id) over (partition by digest)")
    first = F.when(F.col("lowest.id") == smallest, F.col("lowest.n")).otherwise(F.lit(0))
    split = grouped.select("part", "mask", "good", "toxic", "n", (F.col("no_id") + first).alias("first"))
    both = F.array(F.struct("mask", F.col("first").alias("n")),
                   F.struct((F.col("mask") + _COPY).alias("mask"), (F.col("n") - F.col("first")).alias("n")))
    return (split.select("part", "good", "toxic", F.explode(both).alias("c"))
            .groupBy("part", "c.mask")
            .agg(F.sum("c.n").alias("n"), F.sum(F.when(F.col("good"), F.col("c.n")).otherwise(F.lit(0))).alias("good"),
                 F.sum(F.when(F.col("toxic"), F.col("c.n")).otherwise(F.lit(0))).alias("toxic")))


def survivors(counts: np.ndarray) -> np.ndarray:
    """counts[..., mask] to survivors[..., subset]: documents that fail no filter of the subset."""
    size = counts.shape[-1]
    failures = [0] * size  # of each mask: active filters that it fails
    running = counts.sum(axis=-1)
    states = np.empty_like(counts)
    subset = 0
    states[..., 0] = running
    for step in range(1, size):
        toggled = step & -step  # the bit in which two neighbours of the Gray code differ
        subset ^= toggled
        for mask in range(size):
            if mask & toggled:
                if subset & toggled:
                    failures[mask] += 1
                    if failures[mask] == 1:
                        running = running - counts[..., mask]
                else:
                    failures[mask] -= 1
                    if failures[mask] == 0:
                        running = running + counts[..., mask]
        states[..., subset] = running
    return states


def _orders() -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Of every step of every order: the order, the step, the subset applied before it, the filter's bit."""
    names, steps, before, bits = [], [], [], []
    for order in permutations(range(len(FILTERS))):
        done = 0
        for step, i in enumerate(order):
            names.append("".join(FILTERS[j] for j in order))
            steps.append(step + 1)
            before.append(done)
            bits.append(1 << i)
            done |= 1 << i
    return names, *(np.array(x, dtype=np.int64) for x in (steps, before, bits))


def _shapley(n: np.ndarray) -> np.ndarray:
    """[..., subset] survivors to [..., filter] documents removed, summed over all orders."""
    k, size = len(FILTERS), n.shape[-1]
    total = np.zeros((*n.shape[:-1], k), dtype=np.int64)
    for i in range(k):
        for subset in range(size):
            if not subset >> i & 1:
                before = subset.bit_count()
                orders = factorial(before) * factorial(k - 1 - before)
                total[..., i] += orders * (n[..., subset] - n[..., subset | 1 << i])
    return total


def _steps_of(parts: list, counts: np.ndarray) -> pa.RecordBatch:
    """`counts`[part, (n, good, toxic), mask] to one row for each part, order and step."""
    names, steps, before, bits = _orders()
    states = survivors(counts)
    n, after, everything = states[:, 0], before | bits, counts.shape[-1] - 1
    letter = np.array([b.bit_length() - 1 for b in bits.tolist()])
    removed, good, toxic = (states[:, k][:, before] - states[:, k][:, after] for k in range(3))
    alone = n[:, everything ^ bits] - n[:, [everything]]
    failing = n[:, [0]] - n[:, bits]
    values = {"kept": n[:, after], "removed": removed, "redundant": failing - removed, "unique_fails": alone,
              "good_lost": good, "toxic_lost": toxic, "shapley": _shapley(n)[:, letter]}
    rows = len(parts)
    columns = [pa.array(np.repeat(np.array(parts, dtype=object), len(names)), pa.string()),
               pa.array(names * rows, pa.string()), pa.array(np.tile(steps, rows), pa.int32())]
    columns += [pa.array(np.ascontiguousarray(values[c]).ravel(), pa.int64()) for c in _COUNTS]
    return pa.RecordBatch.from_arrays(columns, names=["part", "filter_order", "step", *_COUNTS])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = 1 << len(FILTERS)
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            rows = batch.slice(start, 64).to_pylist()
            counts = np.zeros((len(rows), 3, size), dtype=np.int64)
            for i, row in enumerate(rows):
                for cell in row["cells"]:
                    counts[i, :, cell["mask"]] = cell["n"], cell["good"], cell["toxic"]
            yield _steps_of([row["part"] for row in rows], counts)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, with the documents counted within the part.

    `docs` has doc_id, text and lang, which is the part (null: the empty string); `labels` has doc_id, quality and toxic.
    Null texts count as empty; an empty text has no words and no characters, so of A to D it fails A only.
    A row without an id is no copy and makes none; rows with the same id and text are no copies of each other.
    Of several labels of an id one that says so is enough, a label without an id means nothing. An empty table
    has no parts, so the result is empty. Other columns are ignored.
    """
    per_part = cells(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    schema = T.StructType([T.StructField("part", T.StringType()), T.StructField("filter_order", T.StringType()),
                           T.StructField("step", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in _COUNTS)])
    return per_part.mapInArrow(_walk, schema)


ORACLE = r"""
with read as (
  select doc_id, coalesce(text, '') as body, coalesce(lang, '') as part,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents),
tested as (
  select part, doc_id,
         len(words) < 200 as fa, 100 * len(list_distinct(words)) < 50 * len(words) as fb,
         100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 3 * length(body) as fc,
         regexp_matches(body, '[#$%&*|]') as fd,
         coalesce(doc_id > min(doc_id) over (partition by body), false) as fe,
         coalesce((select bool_or(quality = 1) from labels l where l.doc_id = r.doc_id), false) as good,
         coalesce((select bool_or(toxic = 1) from labels l where l.doc_id = r.doc_id), false) as toxic
  from read r),
cells as (
  select part, fa::int + 2 * fb::int + 4 * fc::int + 8 * fd::int + 16 * fe::int as mask,
         count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
  from tested group by all),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as f),
orders as (
  select a.f || b.f || c.f || d.f || e.f as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
bits as (select f, cast(pow(2, ascii(f) - 65) as integer) as bit from letters),
steps as (
  select o.filter_order, s.step, b.bit,
         (select coalesce(sum(x.bit), 0) from bits x where strpos(o.filter_order, x.f) < s.step)::integer as before
  from orders o, (select unnest([1, 2, 3, 4, 5]) as step) s, bits b
  where b.f = substr(o.filter_order, s.step, 1)),
found as (
  select p.part, s.filter_order, s.step, s.bit,
         coalesce(sum(n) filter (mask & (s.before | s.bit) = 0), 0) as kept,
         coalesce(sum(n) filter (mask & s.before = 0 and mask & s.bit > 0), 0) as removed,
         coalesce(sum(n) filter (mask & s.before > 0 and mask & s.bit > 0), 0) as redundant,
         coalesce(sum(n) filter (mask = s.bit), 0) as unique_fails,
         coalesce(sum(good) filter (mask & s.before = 0 and mask & s.bit > 0), 0) as good_lost,
         coalesce(sum(toxic) filter (mask & s.before = 0 and mask & s.bit > 0), 0) as toxic_lost
  from (select distinct part from cells) p cross join steps s join cells c on c.part = p.part
  group by all)
select part, filter_order, cast(step as integer) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
       cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
       cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
       cast(sum(removed) over (partition by part, bit) as bigint) as shapley
from found
"""
