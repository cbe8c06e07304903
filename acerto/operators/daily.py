"""Daily consolidation over a gap-free calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acerto.config import CORRECTION, CREDIT, DEBIT, MISMATCH, PIX_IN, PIX_OUT, ReconConfig
from acerto.operators.counted import COPIES

FLOWS = (PIX_IN, PIX_OUT)
JD_OPERATION = {PIX_IN: CREDIT, PIX_OUT: DEBIT}

# One (count, amount) pair per class and flow.
UNMATCHED_MEASURES = tuple(
    f"{kind}_{label}_tx_{flow}" for flow in FLOWS
    for kind, label in (("nb", MISMATCH), ("nb", CORRECTION),
                        ("amount", MISMATCH), ("amount", CORRECTION)))

DAILY_COLUMNS = ("date_day",) + tuple(
    name for flow in FLOWS for name in (
        f"amount_ledger_{flow}", f"amount_jd_{flow}", f"mismatch_amount_{flow}",
        f"mismatch_{flow}",
        *[measure for measure in UNMATCHED_MEASURES if measure.endswith(flow)]))


def calendar_days(bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    """One row per day between two dates of a one-row DataFrame, both included."""
    return bounds.select(
        F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date_day"))


def calendar(spark: SparkSession, config: ReconConfig) -> DataFrame:
    return calendar_days(spark.range(1), F.lit(config.calendar_start), config.yesterday())


def in_calendar(config: ReconConfig) -> Column:
    return F.col("date_day").between(F.lit(config.calendar_start), config.yesterday())


def _sum_where(test: Column, amount: Column) -> Column:
    """Sum with 0 for the rows outside the test; a NULL amount inside adds nothing."""
    return F.sum(F.when(test, amount).otherwise(F.lit(0)))


def consolidated_jd(jd: DataFrame) -> DataFrame:
    return jd.groupBy("date_day").agg(*[
        _sum_where(F.col("operation") == JD_OPERATION[flow], F.col("amount"))
        .alias(f"amount_{flow}") for flow in FLOWS])


def consolidated_ledger(transactions: DataFrame) -> DataFrame:
    """Takes the ledger with its refunds."""
    return transactions.groupBy("date_day").agg(*[
        _sum_where(F.col("operation") == flow, F.col("amount")).alias(f"amount_{flow}")
        for flow in FLOWS])


def flow_is(flow: str, operation: Column) -> Column:
    """Either side's name of the flow."""
    return operation.isin(flow, JD_OPERATION[flow])


def unmatched_daily(days: DataFrame, unmatched: DataFrame) -> DataFrame:
    """Counts and amounts of unmatched rows per calendar day, 0 on days without any.

    Takes plain or counted rows. The calendar joins in as rows that add nothing,
    so one aggregation both fills the gaps and sums up, combining before its
    shuffle.
    """
    copies = F.col(COPIES) if COPIES in unmatched.columns else F.lit(1).cast("bigint")

    def value(name: str) -> Column:
        kind, label, _, flow = name.split("_", 3)
        test = (F.col("mismatch_classification") == label) & flow_is(flow, F.col("operation"))
        return F.when(test, copies if kind == "nb" else F.col("amount") * copies)

    measured = unmatched.select("date_day", *[value(n).alias(n) for n in UNMATCHED_MEASURES])
    return fill_days(days, measured, defaults=UNMATCHED_MEASURES)


def fill_days(days: DataFrame, measured: DataFrame, defaults: tuple = ()) -> DataFrame:
    """Sum every measure per calendar day: a left join from the calendar and its group-by in one.

    Days outside the calendar drop out. ``defaults`` names the measures that
    read 0 rather than NULL on a day without rows.
    """
    names = [name for name in measured.columns if name != "date_day"]
    marked = days.select("date_day", F.expr("true as _calendar"))
    sums = [f"coalesce(sum({n}), 0) as {n}" if n in defaults else f"sum({n}) as {n}"
            for n in names]
    return (marked.unionByName(measured, allowMissingColumns=True)
            .groupBy("date_day")
            .agg(*[F.expr(text) for text in ["max(_calendar) as _calendar", *sums]])
            .filter("_calendar").drop("_calendar"))


def with_differences(daily: DataFrame) -> DataFrame:
    """Difference and ratio to the ledger total per flow; the 17 result columns, newest day first.

    The ratio is NULL where the ledger total is 0.
    """
    computed = {}
    for flow in FLOWS:
        difference = f"amount_ledger_{flow} - amount_jd_{flow}"
        computed[f"mismatch_amount_{flow}"] = difference
        computed[f"mismatch_{flow}"] = (
            f"round(try_divide({difference}, amount_ledger_{flow}), 6)")
    return daily.selectExpr(
        *[f"{computed.get(name, name)} as {name}" for name in DAILY_COLUMNS]
    ).orderBy(F.col("date_day").desc())


def recon_daily(days: DataFrame, ledger: DataFrame, jd: DataFrame,
                unmatched: DataFrame) -> DataFrame:
    """Calendar with the three daily results beside each other.

    Each is cut to one row per calendar day before it is attached, so the size
    of what is broadcast is the number of days.
    """
    wide = days
    for totals, side in ((ledger, "ledger"), (jd, "jd")):
        named = totals.withColumnsRenamed(
            {f"amount_{flow}": f"amount_{side}_{flow}" for flow in FLOWS})
        bounded = days.join(named, "date_day", "left")
        wide = wide.join(F.broadcast(bounded), "date_day", "left")
    return with_differences(wide.join(F.broadcast(unmatched), "date_day", "left"))
