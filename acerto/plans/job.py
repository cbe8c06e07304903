"""The whole job: new reports in, curated table, daily mart and report out."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acerto import schemas
from acerto.config import ReconConfig
from acerto.operators import jd as jd_side, ledger as ledger_side, match, report, staging
from acerto.operators.counted import replicate
from acerto.plans.reconcile import reconcile_daily
from acerto.sources import tables
from acerto.streaming.ingest import ingest_new


#: Up to so many touched days are named in the filter of the raw table; more are joined.
MOST_NAMED_DAYS = 5_000


def curate(spark: SparkSession, raw: str, curated: str, progress: str | None = None) -> None:
    """Bring the curated provider table up to date with the raw one; without a raw table there is nothing to do.

    A stream over the raw table's files tells what is new, whatever its load time; its checkpoint
    ``progress`` (beside ``curated`` by default) is written after the data. Only the report days that
    received rows are computed again, from all their rows, and replaced; doing so twice gives the same,
    so a run that dies halfway is made good by the next. Of the raw table, which has a partition for each report day, only those days are read.
    """
    def replace(batch: DataFrame, _: int) -> None:
        touched = touched_days(batch)
        if touched is None or touched:
            # Files are made up per day; a large day gets several.
            (curated_days(batch, raw, touched).hint("rebalance", "report_day").write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("report_day").parquet(curated))

    if not tables.has_files(spark, raw):
        return
    schema = spark.read.parquet(raw).schema
    query = (spark.readStream.schema(schema).parquet(raw).writeStream.foreachBatch(replace)
             .option("checkpointLocation", progress or f"{curated.rstrip('/')}_progress")
             .trigger(availableNow=True).start())
    query.awaitTermination()


def touched_days(batch: DataFrame) -> list[date | None] | None:
    """The report days of new raw rows, None if there are more than can be named."""
    found = (batch.filter("not cast(rejected as boolean)").select(F.to_date("date_day").alias("day"))
             .distinct().limit(MOST_NAMED_DAYS + 1).collect())
    return [r.day for r in found] if len(found) <= MOST_NAMED_DAYS else None


def curated_days(batch: DataFrame, raw: str, touched: list[date | None] | None) -> DataFrame:
    """The curated rows of the touched days with their ``report_day``, from all raw rows of these days."""
    session = batch.sparkSession
    staged = tables.read_staged(session, raw, touched).withColumn("report_day", F.to_date("date_day"))
    if touched is None:
        days = (batch.filter("not cast(rejected as boolean)")
                .select(F.to_date("date_day").alias("touched_day")).distinct())
        staged = staged.join(days, F.col("report_day").eqNullSafe(F.col("touched_day")), "left_semi")
    return staging.curate_jd(staged)


def unmatched_detail(ledger: DataFrame, gateway: DataFrame, jd: DataFrame,
                     config: ReconConfig) -> DataFrame:
    """The unmatched rows behind the daily figures, one per transaction."""
    transactions = ledger_side.ledger_transactions(
        ledger_side.ledger_transactions_aux(ledger, gateway, config))
    return replicate(match.unmatched_counted(
        ledger_side.net_refunds_counted(transactions), jd_side.jd_transactions(jd, config)))


def run(spark: SparkSession, config: ReconConfig, folder: str, raw: str, checkpoint: str,
        curated: str, ledger: str, gateway: str, daily: str, reports: str,
        done_folder: str | None = None) -> None:
    """One run. ``ledger`` and ``gateway`` are paths or table names, all others paths.

    ``daily`` is exchanged for the new result when that is complete. ``reports`` has a partition for each report date, which another run for
    the date replaces. The daily result is read back from its table for the report, so it is computed once.
    Before the first report has come the provider's side is empty.
    """
    ingest_new(spark, folder, raw, checkpoint, done_folder).awaitTermination()
    curate(spark, raw, curated)
    reported = (tables.scan_jd(spark, curated) if tables.has_files(spark, curated)
                else spark.createDataFrame([], schemas.STAGED_SCHEMA).select(*schemas.JD_COLUMNS))
    result = reconcile_daily(
        tables.scan_ledger(spark, ledger), tables.scan_gateway(spark, gateway), reported, config)
    tables.replace_table(result, daily)
    due = report.report_days(spark.read.parquet(daily), config)
    (report.report_text(due, config).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(reports))
