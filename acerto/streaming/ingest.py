"""Read each report archive once.

The stream's checkpoint knows which archives were read; together with the file
sink's commit log that makes every row appear exactly once, also after a
failure. Moving archives away is housekeeping on top and lags one batch behind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from acerto.config import REPORT_MEMBER_PREFIX
from acerto.operators import staging
from acerto.sources import tables
from acerto.sources.archives import BINARY_FILE_SCHEMA, expand_archives, expand_members, list_archives, tasks_can_open

#: The name of the row counts in a stream's progress.
ROW_COUNTS = "report_rows"


def stage_archives(archives: DataFrame, prefix: str = REPORT_MEMBER_PREFIX, by_member: bool = False,
                   tasks: int | None = None, inserted_at: Column | None = None) -> DataFrame:
    """Archives to staged and rejected rows with their origin, in one pass. Works on batches and streams.

    ``by_member`` deals the members of an archive to ``tasks``, which then open it themselves. The rows are counted on the
    way, under ``ROW_COUNTS`` (see ``row_counts``).
    """
    expanded = (expand_members(archives, prefix=prefix, tasks=tasks) if by_member
                else expand_archives(archives, prefix=prefix))
    report = staging.rename_columns(expanded)
    counted = _counted(staging.staged_and_pending(report, inserted_at))
    return counted.filter("outcome <> 'pending'").drop("outcome")


def _counted(rows: DataFrame) -> DataFrame:
    """``rows``, observed: how many there are and how many of each outcome."""
    def of(outcome: str) -> Column:
        return F.count_if(F.col("outcome") == outcome).alias(outcome)

    return rows.observe(ROW_COUNTS, F.count(F.lit(1)).alias("read"), of("staged"), of("rejected"), of("pending"))


def row_counts(query: StreamingQuery) -> list[dict[str, int]]:
    """Of each batch of a stream that wrote ``stage_archives``: its number, rows read, staged, rejected and pending.

    Rows read are the others' sum. The progress of the last 100 batches is at hand.
    """
    found = []
    for progress in query.recentProgress:
        counts = progress.observedMetrics.get(ROW_COUNTS)
        if counts is not None:
            found.append({"batch": progress.batchId, **counts.asDict()})
    return found


def ingest_batch(spark: SparkSession, folder: str, target: str) -> None:
    """Append everything that lies in the folder now.

    Use this or ``ingest_new`` for a table, not both: a table written by a stream
    is read through the stream's commit log, which knows no other files.
    """
    tables.append_staged(stage_archives(list_archives(spark, folder), by_member=tasks_can_open(folder)), target)


def ingest_unread(spark: SparkSession, folder: str, target: str) -> None:
    """Append the archives of the folder that the table has no rows of, so a repeated call adds nothing.

    An archive goes by its path. One without a single row to keep is read again by each call, which adds nothing either.
    """
    found = list_archives(spark, folder)
    if tables.has_files(spark, target):
        known = spark.read.parquet(target).select(F.col("archive").alias("path")).distinct()
        found = found.join(known, "path", "left_anti")
    tables.append_staged(stage_archives(found, by_member=tasks_can_open(folder)), target)


def archive_stream(spark: SparkSession, folder: str, done_folder: str | None = None,
                   files_per_batch: int = 1000) -> DataFrame:
    """Archives as they arrive; read ones are moved to ``done_folder`` if one is given.

    ``done_folder`` must lie outside ``folder``.
    """
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("pathGlobFilter", "*.zip")
              .option("maxFilesPerTrigger", files_per_batch))
    if done_folder is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", done_folder)
    return reader.load(folder)


def ingest_new(spark: SparkSession, folder: str, target: str, checkpoint: str,
               done_folder: str | None = None, files_per_batch: int = 1000,
               inserted_at: Column | None = None) -> StreamingQuery:
    """Append what is new in the folder since the last run with this checkpoint, then stop."""
    outcomes = stage_archives(archive_stream(spark, folder, done_folder, files_per_batch),
                              by_member=tasks_can_open(folder), inserted_at=inserted_at)
    return (tables.with_report_day(outcomes).writeStream.format("parquet").outputMode("append")
            .partitionBy(*tables.RAW_PARTITIONS)
            .option("path", target).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
