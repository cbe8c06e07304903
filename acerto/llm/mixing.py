"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are shuffled by a hash of their id and laid end to end; the words are
cut into blocks of equal length. A schedule of slots decides what the mix reads: slot i has
the golden-ratio point i * phi mod 1 (in whole numbers, modulo 2 ** 31), and the point
falls into the interval of one source on the line of cumulative targets. The r-th slot of a
source reads its block r, beginning again after the last. As the points are spread
evenly, every stretch of the schedule has the sources in proportion, and a source's slots
differ from its target by a few blocks.

Running sums over a source are taken in two steps (sums of hash ranges, then inside a range),
so that a source with a third of all rows is spread over tasks. The only step in one task
has one row for each source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE, written

_RESOLUTION = 31  # bits of a point
_STEP = 1327217885  # golden ratio times 2 ** 31, made odd: steps through all points
_CELLS = 10  # bits of a point by which slots meet intervals
_CHUNK = 16  # bits: slots ranked together
_SHORTEST = 256  # a source has about so many blocks at least


def _targets(sizes: DataFrame, weights: tuple[int, ...], percent: int, cap: int) -> DataFrame:
    """For each source of `sizes` (key, source, source_size): number, target, block, points.

    Weights go round over the sources in order of code points, null last. A source whose
    share is above `cap` times its size gets that much; the rest is shared by weight again.
    That is the level at which the sources, filled in order of their limit by weight, hold the total.
    """
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("limit", "number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("source_size").over(every) * F.lit(percent / 100)
    full = F.sum("most").over(by_limit)
    open_weight = F.sum("weight").over(every) - F.sum("weight").over(by_limit)
    filled = (sizes.withColumn("number", F.row_number().over(order) - 1)
              .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)),
                                                 (F.col("number") % len(weights) + 1).cast("int")))
              .withColumn("most", F.col("source_size") * cap)
              .withColumn("limit", F.col("most") / F.col("weight"))
              .withColumn("total", total)
              .withColumn("full", full + F.col("limit") * open_weight <= F.col("total")))
    rest = F.col("total") - F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(every), F.lit(0))
    rest_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(every)
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise(
        F.least(F.col("most").cast("double"), F.try_divide(rest, rest_weight) * F.col("weight")))
    return filled.withColumn("target", target)


def _schedule(spark: SparkSession, sources: DataFrame, slots: int, cap: int) -> DataFrame:
    """How often the slots read each block: number, block_number, times."""
    shift = _RESOLUTION - _CELLS
    intervals = (sources.where("low < high")
                 .select("number", "low", "high", "blocks",
                         F.explode(F.sequence(F.shiftright("low", shift), F.shiftright(F.col("high") - 1, shift)))
                         .alias("cell")))
    points = (spark.range(slots)
              .withColumn("point", F.col("id") % (1 << _RESOLUTION) * _STEP % (1 << _RESOLUTION))
              .withColumn("cell", F.shiftright("point", shift)))
    dealt = (points.join(intervals, "cell").where("point >= low and point < high")
             .select("number", "blocks", "id", F.shiftright("id", _CHUNK).alias("chunk")))
    before = (dealt.groupBy("number", "chunk").count()
              .withColumn("before", F.sum("count").over(Window.partitionBy("number").orderBy("chunk")) - F.col("count"))
              .select("number", "chunk", "before"))
    rank = F.col("before") + F.row_number().over(Window.partitionBy("number", "chunk").orderBy("id")) - 1
    return (dealt.join(before, ["number", "chunk"]).withColumn("rank", rank)
            .where(F.col("rank") < F.col("blocks") * cap)
            .groupBy("number", (F.col("rank") % F.col("blocks")).alias("block_number"))
            .agg(F.count("*").alias("times")))


def mix(rows: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", *,
        weights: tuple[int, ...] = (3, 1, 2), percent: int = 150, cap: int = 2, block: int = 1024,
        seed: int = 0) -> DataFrame:
    """One row for each row of `rows`: its id, size, source_size, target, taken.

    `size` is the number of words, `target` what the mix should take of the row's source, `taken`
    what it takes of the row, repeats counted: at most `cap` times its size. The targets
    add up to `percent` % of all words. Null and empty texts have size 0 and taken 0. A null source is
    a source of its own and the last. Repeated rows are taken on their own. An empty
    table gives an empty result. Other columns are ignored, and `seed` gives another shuffle.
    """
    spark = rows.sparkSession
    shuffled = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))))
    sized = written(rows.select(
        F.col(id_column).alias("id"), F.col(source_column).cast("string").alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(source_column).cast("string")), F.lit("")).alias("key"),
        F.regexp_count(F.coalesce(F.col(text_column), F.lit("")), F.lit(f"[^{SPACE}]+")).cast("long").alias("size"),
        shuffled.alias("shuffled"), F.substring(shuffled, 1, 3).alias("range")), "mix-sizes")
    ranges = sized.groupBy("key", "range").agg(F.sum("size").alias("words"), F.first("source").alias("source"))
    sizes = ranges.groupBy("key").agg(F.first("source").alias("source"), F.sum("words").alias("source_size"))
    length = F.greatest(F.lit(1), F.least(F.lit(block), F.expr(f"source_size div {_SHORTEST}"))).cast("long")
    line = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    end = F.try_divide(F.sum("wanted").over(line), F.sum("wanted").over(every)) * (1 << _RESOLUTION)
    sources = written(
        _targets(sizes, weights, percent, cap).withColumn("length", length)
        .withColumn("blocks", F.expr("(source_size + length - 1) div length"))
        .withColumn("wanted", F.col("target") / F.col("length"))
        .withColumn("high", F.coalesce(F.floor(end), F.lit(0)))
        .withColumn("low", F.coalesce(F.lag("high").over(Window.orderBy("number")), F.lit(0)))
        .select("key", "number", "source_size", "target", "length", "blocks", "wanted", "low", "high"), "mix-sources")
    slots = sources.agg(F.ceil(F.sum("wanted"))).first()[0] or 0
    times = _schedule(spark, sources, slots, cap)

    running = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = (ranges.withColumn("offset", F.sum("words").over(running) - F.col("words"))
               .select("key", "range", "offset")
               .join(sources.select("key", "number", "source_size", "target", "length"), "key"))
    inside = Window.partitionBy("key", "range").orderBy("shuffled", "id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = (sized.drop("source").join(offsets, ["key", "range"])
              .withColumn("start", F.col("offset") + F.sum("size").over(inside) - F.col("size"))
              .select("id", "size", "number", "source_size", "target", "length", "start"))
    stop = F.col("start") + F.col("size")
    last = F.expr("greatest(start, start + size - 1) div length")
    pieces = placed.withColumn("block_number", F.explode(F.sequence(F.expr("start div length"), last)))
    share = (F.least(stop, (F.col("block_number") + 1) * F.col("length"))
             - F.greatest(F.col("start"), F.col("block_number") * F.col("length")))
    return _taken(pieces, times, share, id_column)


def _taken(pieces: DataFrame, times: DataFrame, share: Column, id_column: str) -> DataFrame:
    """Rows of size 0 share a start, so equal ones are counted and repeated."""
    summed = (pieces.join(times, ["number", "block_number"], "left")
              .withColumn("share", share * F.coalesce("times", F.lit(0)))
              .groupBy("id", "number", "start", "size", "source_size", "target")
              .agg(F.sum("share").alias("taken"),
                   F.when(F.col("size") == 0, F.count("*")).otherwise(1).alias("copies")))
    return summed.select(F.col("id").alias(id_column), "size", "source_size", "target", "taken",
                         F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies").cast("long"))).alias("copy")).drop("copy")


ORACLE = r"""
with sized as (
  select doc_id, source, md5('0:' || coalesce(cast(doc_id as varchar), '')) as shuffled,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size
  from documents),
ranked as (
  select source, cast(sum(size) as bigint) as source_size,
         row_number() over (order by source nulls last) - 1 as number
  from sized group by source),
weighed as (
  select *, [3, 1, 2][number % 3 + 1] as weight, 2 * source_size as most, sum(source_size) over () * 1.5::double as total
  from ranked),
filled as (
  select *, sum(most) over upto + most / weight * (sum(weight) over () - sum(weight) over upto) <= total as is_full
  from weighed window upto as (order by most / weight, number rows between unbounded preceding and current row)),
targets as (
  select *, case when is_full then most::double else least(most::double,
           (total - coalesce(sum(most) filter (is_full) over (), 0)) / sum(weight) filter (not is_full) over () * weight) end as target,
         greatest(1, least(1024, source_size // 256)) as length
  from filled),
line as (
  select *, (source_size + length - 1) // length as blocks,
         cast(floor(sum(target / length) over upto / sum(target / length) over every_row * 2147483648) as bigint) as high,
         ceil(sum(target / length) over every_row) as slots
  from targets window upto as (order by number rows between unbounded preceding and current row),
       every_row as (order by number rows between unbounded preceding and unbounded following)),
sources as (select *, coalesce(lag(high) over (order by number), 0) as low from line),
ranks as (
  select number, blocks, row_number() over (partition by number order by i) - 1 as rank
  from (select i, i % 2147483648 * 1327217885 % 2147483648 as point
        from range(cast((select max(slots) from sources) as bigint)) t(i)) p
  join sources on point >= low and point < high),
times as (
  select number, rank % blocks as block_number, count(*) as times from ranks
  where rank < 2 * blocks group by all),
placed as (
  select doc_id, size, source_size, target, number, length,
         cast(sum(size) over (partition by number order by shuffled, doc_id, size rows between unbounded preceding and current row)
              - size as bigint) as start
  from sized join sources on sized.source is not distinct from sources.source),
pieces as (
  select *, unnest(range(start // length, greatest(start, start + size - 1) // length + 1)) as block_number from placed)
select doc_id, cast(size as bigint) as size, source_size, target,
       cast(sum(coalesce(times, 0) * (least(start + size, (block_number + 1) * length)
                                      - greatest(start, block_number * length))) as bigint) as taken
from pieces left join times using (number, block_number)
group by doc_id, start, size, source_size, target, number
"""
