"""Matching of both sides by key and day.

Two text keys ``pix_key,day`` are equal exactly when key and day are, since the
day part contains no comma; so everything here matches on (pix_key, day), with
a NULL key read as empty text, and builds the long text only for output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from acerto.config import CORRECTION, INTERNAL_TRANSFER, MISMATCH, REVIEW, SOURCE_JD, SOURCE_LEDGER
from acerto.operators.counted import COPIES, collapse, replicate

_SIDE_COLUMNS = ("date_day", "end_to_end_id", "operation", "amount", "pix_key", "source")
UNMATCHED_COLUMNS = ("tx_key", "pix_key", "end_to_end_id", "date_day", "amount", "operation",
                     "source", "mismatch_classification")


def classify(ledger_day: Column, jd_day: Column, ledger_key: Column, jd_key: Column) -> Column:
    """Mismatch if a side is missing, correction if only the day differs, else review."""
    return (F.when(ledger_day.isNull() | jd_day.isNull(), F.lit(MISMATCH))
            .when((ledger_key == jd_key) & (ledger_day != jd_day), F.lit(CORRECTION))
            .otherwise(F.lit(REVIEW)))


def _one_side(counted: DataFrame) -> DataFrame:
    return counted.select(F.coalesce("pix_key", F.lit("")).alias("_key"), F.col("date_day").alias("_day"),
                          *counted.columns)


def _without_partner(side: DataFrame, other: DataFrame) -> DataFrame:
    """Rows of ``side`` whose key and day ``other`` does not have.

    The other side comes as one row per key, so a hot key only makes the probing side large,
    which adaptive execution splits. The sum keeps the counts in use on both
    ways, so that both share the shuffles below.
    """
    keys = (other.groupBy("_key", "_day").agg(F.sum(COPIES).alias("n")).filter("n > 0")
            .select("_key", "_day"))
    return side.join(keys, ["_key", "_day"], "left_anti").select(
        *[name for name in UNMATCHED_COLUMNS if name != "mismatch_classification"], "_key", COPIES)


def unmatched_counted(ledger_net: DataFrame, jd: DataFrame) -> DataFrame:
    """Rows of either side whose key does not occur on the other, with ``copies``.

    ``ledger_net`` comes counted from ``ledger.net_refunds_counted``. An internal
    transfer of the ledger is no mismatch.
    """
    ledger = _one_side(ledger_net.select(*_SIDE_COLUMNS, "tx_key", COPIES))
    other = _one_side(collapse(jd.select(*_SIDE_COLUMNS, "tx_key")))
    internal = F.col("operation") == INTERNAL_TRANSFER
    missing_day, missing_key = F.lit(None).cast("date"), F.lit(None).cast("string")
    of_ledger = (_without_partner(ledger, other).filter(~internal | F.col("operation").isNull())
                 .withColumn("mismatch_classification", classify(
                     F.col("date_day"), missing_day, F.col("pix_key"), missing_key)))
    of_other = _without_partner(other, ledger).withColumn("mismatch_classification", classify(
        missing_day, F.col("date_day"), missing_key, F.col("pix_key")))
    return of_ledger.unionByName(of_other).select(*UNMATCHED_COLUMNS, COPIES)


def unmatched_transactions(ledger_net: DataFrame, jd: DataFrame) -> DataFrame:
    """As ``unmatched_counted``, one row per transaction."""
    return replicate(unmatched_counted(ledger_net, jd))


def match_status_counts(ledger_net: DataFrame, jd: DataFrame) -> DataFrame:
    """Rows of the full outer join by status, without producing its pairs."""
    sides = (ledger_net.select("pix_key", "date_day", F.col(COPIES).alias("n_ledger"),
                               F.lit(0).cast("bigint").alias("n_jd"))
             .unionByName(jd.select("pix_key", "date_day",
                                    F.lit(0).cast("bigint").alias("n_ledger"),
                                    F.lit(1).cast("bigint").alias("n_jd"))))
    keys = (sides.groupBy(F.coalesce("pix_key", F.lit("")).alias("pix_key"), "date_day")
            .agg(F.sum("n_ledger").alias("n_ledger"), F.sum("n_jd").alias("n_jd")))
    status = (F.when(F.col("n_jd") == 0, F.lit("ledger_only"))
              .when(F.col("n_ledger") == 0, F.lit("jd_only")).otherwise(F.lit("matched")))
    rows = F.when(F.col("n_jd") == 0, F.col("n_ledger")).when(
        F.col("n_ledger") == 0, F.col("n_jd")).otherwise(F.col("n_ledger") * F.col("n_jd"))
    return keys.groupBy(status.alias("status")).agg(F.sum(rows).alias("nb_rows"))


def corrections_intended(unmatched: DataFrame) -> DataFrame:
    """Unmatched rows of both sides with the same key on different days, paired.

    The i-th ledger row of a key meets its i-th provider row, in day order. Own
    design: the original classification never reaches its correction branch.

    ``unmatched`` is counted, so a key has one run of rows per day, side and
    operation. Runs take up consecutive positions; where a ledger run and a
    provider run overlap there are that many pairs. A sweep over the positions
    at which runs begin finds the overlaps without pairing runs with each other,
    and all steps share one shuffle on the key. A key has at most one run per day,
    operation and amount and side there, whatever its number of rows.
    """
    runs = (unmatched.filter(F.col("pix_key").isNotNull() & F.col("date_day").isNotNull())
            .repartition("pix_key")
            .groupBy("pix_key", "source", "date_day", "operation", "amount")
            .agg(F.sum(COPIES).alias(COPIES)))
    in_order = (W.partitionBy("pix_key", "source")
                .orderBy("date_day", "operation", "amount")
                .rowsBetween(W.unboundedPreceding, W.currentRow))
    last = F.sum(COPIES).over(in_order)
    placed = runs.select("pix_key", "source", (last - F.col(COPIES)).alias("start"),
                         F.struct(last.alias("stop"), "date_day", "operation", "amount")
                         .alias("run"))

    def starting(source: str) -> Column:
        return F.max(F.when(F.col("source") == source, F.col("run"))).alias(source)

    points = placed.groupBy("pix_key", "start").agg(starting(SOURCE_LEDGER), starting(SOURCE_JD))
    forward = W.partitionBy("pix_key").orderBy("start")
    current = points.select(
        "pix_key", "start", F.lead("start").over(forward).alias("next"),
        F.last(SOURCE_LEDGER, ignorenulls=True).over(forward).alias(SOURCE_LEDGER),
        F.last(SOURCE_JD, ignorenulls=True).over(forward).alias(SOURCE_JD))
    overlap = F.least("next", f"{SOURCE_LEDGER}.stop", f"{SOURCE_JD}.stop") - F.col("start")
    pairs = (current.filter(F.col(SOURCE_LEDGER).isNotNull() & F.col(SOURCE_JD).isNotNull())
             .select("pix_key",
                     F.col(f"{SOURCE_LEDGER}.date_day").alias("ledger_date_day"),
                     F.col(f"{SOURCE_JD}.date_day").alias("jd_date_day"),
                     F.col(f"{SOURCE_LEDGER}.operation").alias("operation"),
                     F.col(f"{SOURCE_LEDGER}.amount").alias("amount"),
                     F.lit(CORRECTION).alias("mismatch_classification"),
                     overlap.alias(COPIES))
             .filter((F.col(COPIES) > 0)
                     & (F.col("ledger_date_day") != F.col("jd_date_day"))))
    return replicate(pairs)
