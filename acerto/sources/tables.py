"""Tables: scans of the reconciliation inputs, appends, SQL text."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acerto import schemas
from acerto.sources.scratch import file_system


def read_table(spark: SparkSession, name: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """A catalog table, or parquet files if ``name`` is a path."""
    found = spark.read.parquet(name) if "/" in name else spark.table(name)
    return found.select(*columns) if columns else found


def scan_jd(spark: SparkSession, name: str) -> DataFrame:
    return read_table(spark, name, schemas.JD_COLUMNS)


def scan_ledger(spark: SparkSession, name: str) -> DataFrame:
    return read_table(spark, name, schemas.LEDGER_COLUMNS)


def scan_gateway(spark: SparkSession, name: str) -> DataFrame:
    return read_table(spark, name, schemas.GATEWAY_COLUMNS)


def append_table(df: DataFrame, target: str, partition_by: tuple[str, ...] = (),
                 source_format: str = "parquet", **options: str) -> None:
    """Append rows to a path or, with the options of another format, to that."""
    writer = df.write.mode("append").format(source_format).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(target) if source_format != "jdbc" else writer.save()


def append_batch(df: DataFrame, target: str, batch: str, partition_by: tuple[str, ...] = ()) -> None:
    """Append the rows of one batch to the Parquet table ``target``, once however often it is called.

    The table has a partition for each ``batch``. The rows are written aside and take the partitions' place when all are there,
    so a run that dies leaves what was there, and a repeated one replaces its own rows by the same. A run that gives other
    partitions than the last one for the batch did leaves none of the old ones, as the batch's folder is exchanged as a whole.
    """
    if not re.fullmatch(r"[\w.-]+", batch):
        raise ValueError(f"no name for a partition: {batch!r}")
    replace_table(df, f"{target.rstrip('/')}/batch={batch}", partition_by)


def replace_table(df: DataFrame, target: str, partition_by: tuple[str, ...] = ()) -> None:
    """Put ``df`` in the place of the Parquet files in ``target``, which stay readable until the new ones are complete.

    The new files are written beside the old ones, in folders that readers of a table skip, and the two folders change
    names. A run that dies while it writes leaves the old files. One that dies between the two renames leaves them under
    the other name, where ``recover_table`` and the next run find them. Two runs at a time are not meant.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    fresh, former = _beside(target, "new"), _beside(target, "old")
    recover_table(df.sparkSession, target)
    writer.parquet(fresh)
    system, path = file_system(df.sparkSession, target)
    if system.exists(path(target)) and not system.rename(path(target), path(former)):
        raise OSError(f"cannot rename {target}")
    system.mkdirs(path(target).getParent())
    if not system.rename(path(fresh), path(target)):
        raise OSError(f"cannot rename {fresh}")
    system.delete(path(former), True)


def recover_table(spark: SparkSession, target: str) -> None:
    """Finish an exchange of ``target`` that died between its renames: the former files come back."""
    system, path = file_system(spark, target)
    former = path(_beside(target, "old"))
    if not system.exists(former):
        return
    if system.exists(path(target)):
        system.delete(former, True)
    elif not system.rename(former, path(target)):
        raise OSError(f"cannot rename {former}")


def _beside(target: str, kind: str) -> str:
    folder, _, name = target.rstrip("/").rpartition("/")
    return f"{folder}/.{kind}_{name}" if folder else f".{kind}_{name}"


def has_files(spark: SparkSession, target: str) -> bool:
    """Whether there is a table of files at a path: a file, or a folder with a partition or a file that readers see."""
    system, path = file_system(spark, target)
    if not system.exists(path(target)):
        return False
    names = [found.getPath().getName() for found in system.listStatus(path(target))]
    return any("=" in name or not name.startswith("_") for name in names if not name.startswith("."))


def append_staged(outcomes: DataFrame, target: str) -> None:
    """Append ``staging.staged_or_rejected`` rows; both outcomes share the table, which has a partition for each report day."""
    append_table(with_report_day(outcomes), target, partition_by=RAW_PARTITIONS)


RAW_PARTITIONS = ("rejected", "report_day")


def with_report_day(outcomes: DataFrame) -> DataFrame:
    """Staged rows with the day to store them by; NULL for rejected rows and rows without a time."""
    return outcomes.withColumn("report_day", F.to_date("date_day"))


def read_staged(spark: SparkSession, target: str, days: list[date | None] | None = None) -> DataFrame:
    """The 21 staged columns of the accepted rows, of some report days only if they are listed (None: rows without a time).

    Listed days reach the file scan as a filter on its partitions.
    """
    raw = spark.read.parquet(target)
    kept = raw.filter("not cast(rejected as boolean)")
    if days is not None:
        day = F.col("report_day") if "report_day" in raw.columns else F.to_date("date_day")
        known = day.isin([d for d in days if d is not None])
        kept = kept.filter((known | day.isNull()) if None in days else known)
    return kept.select(*schemas.STAGED_COLUMNS)


def read_rejects(spark: SparkSession, target: str) -> DataFrame:
    """The rejected rows as they came, with the reason and, where the table has it, the origin."""
    raw = spark.read.parquet(target)
    return (raw.filter("cast(rejected as boolean)")
            .select("report_row.*", "reject_reason", *[c for c in schemas.ORIGIN_COLUMNS if c in raw.columns]))


def run_sql(spark: SparkSession, text: str, **views: DataFrame) -> DataFrame:
    """Result of a query text over named DataFrames, written ``{name}`` in the text."""
    return spark.sql(text, **views)
