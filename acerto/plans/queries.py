"""Every operator as a query over the test tables. The matching SQL is in ``oracle``."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import replace
from datetime import date

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acerto import functions as fn
from acerto.config import REPORT_MEMBER_PREFIX
from acerto.functions import numbers
from acerto.operators import daily, jd as jd_side, ledger as ledger_side, match, report, staging
from acerto.plans import job, mapping
from acerto.plans.mapping import CONFIG
from acerto.plans.reconcile import reconcile_daily, reconcile_daily_stepwise
from acerto.plans.sql import reconcile_daily_sql
from acerto.schemas import GATEWAY_COLUMNS, JD_COLUMNS, LEDGER_COLUMNS, REPORT_COLUMNS
from acerto.sources import archives, delimited, scratch, tables
from acerto.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

# A run on a Saturday, which reports one day only; the configured day is a Monday.
OTHER_DAY = replace(CONFIG, as_of=date(1998, 5, 30))


def _loaded(day: int = 1) -> Column:
    return F.lit(f"2024-06-{day:02} 00:00:00").cast("timestamp")


def _unzoned(staged: DataFrame) -> DataFrame:
    """The load time as the session's clock shows it, which is how ``_loaded`` is written."""
    return staged.withColumn("inserted_at", F.col("inserted_at").cast("timestamp_ntz"))


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return mapping.ledger(spark, sf), mapping.gateway(spark, sf), mapping.jd_curated(spark, sf)


def _aux(spark: SparkSession, sf: str) -> DataFrame:
    return ledger_side.ledger_transactions_aux(
        mapping.ledger(spark, sf), mapping.gateway(spark, sf), CONFIG)


def _transactions(spark: SparkSession, sf: str) -> DataFrame:
    return ledger_side.ledger_transactions(_aux(spark, sf))


def _jd(spark: SparkSession, sf: str) -> DataFrame:
    return jd_side.jd_transactions(mapping.jd_curated(spark, sf), CONFIG)


def _net(spark: SparkSession, sf: str) -> DataFrame:
    return ledger_side.net_refunds_counted(_transactions(spark, sf))


def _unmatched(spark: SparkSession, sf: str) -> DataFrame:
    return match.unmatched_counted(_net(spark, sf), _jd(spark, sf))


# Scans

@query
def scan_jd(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.jd_curated(spark, sf).select(*JD_COLUMNS)


@query
def scan_ledger(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.ledger(spark, sf).select(*LEDGER_COLUMNS)


@query
def scan_gateway(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.gateway(spark, sf).select(*GATEWAY_COLUMNS)


@query
def calendar_days(spark: SparkSession, sf: str) -> DataFrame:
    day = fn.local_day(F.col("utc_datetime"), CONFIG.zone)
    bounds = mapping.ledger(spark, sf).agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return daily.calendar_days(bounds, F.col("first"), F.col("last"))


@query
def member_prefix_filter(spark: SparkSession, sf: str) -> DataFrame:
    return (mapping.report_members(spark, sf)
            .filter(F.col("member").startswith(REPORT_MEMBER_PREFIX))
            .select("member", F.col("IdFimAFim").alias("end_to_end_id")))


@query
def csv_line_parse(spark: SparkSession, sf: str) -> DataFrame:
    lines = delimited.render_lines(mapping.report_raw(spark, sf))
    return staging.rename_columns(delimited.parse_lines(lines))


@query
def archive_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Report lines zipped, a batch per archive, and unpacked again."""
    header = ";".join(REPORT_COLUMNS)

    def zip_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io
        import zipfile

        import pyarrow as pa

        for batch in batches:
            texts: dict[str, list[str]] = {}
            for name, line in zip(batch.column("member").to_pylist(),
                                  batch.column("line").to_pylist()):
                texts.setdefault(name, [header]).append(line)
            content = io.BytesIO()
            with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED) as zipped:
                for name, lines in texts.items():
                    zipped.writestr(name, "\n".join(lines) + "\n")
            yield pa.RecordBatch.from_arrays(
                [pa.array(["batch.zip"]), pa.array([content.getvalue()], pa.binary())],
                names=["path", "content"])

    members = mapping.report_members(spark, sf)
    row = F.struct(*[F.col(f"`{name}`") for name in REPORT_COLUMNS])
    zipped = (members.select("member", F.to_csv(row, {"sep": ";", "escape": '"'}).alias("line"))
              .mapInArrow(zip_batches, "path string, content binary"))
    return (archives.expand_archives(zipped).transform(staging.rename_columns)
            .select("member", *REPORT_COLUMNS.values()))


def _loose_files(spark: SparkSession, sf: str) -> str:
    """A folder with the report's lines in files, each with its header."""
    header = ";".join(REPORT_COLUMNS)

    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        yield pa.RecordBatch.from_arrays([pa.array([header])], names=["line"])
        yield from batches

    folder = scratch.new_folder(spark, "loose-files")
    mapping.report_lines(spark, sf).select("line").mapInArrow(headed, "line string").write.text(folder)
    return scratch.until_end(spark, folder)


def _zip_files(spark: SparkSession, sf: str) -> str:
    """A folder with the report's lines in archives, one for each remainder of the event's number, with a broken one."""
    header, folder = ";".join(REPORT_COLUMNS), scratch.new_folder(spark, "archives")
    base = folder.removeprefix("file:")
    base = "/" + base.lstrip("/") if base != folder else base

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import itertools
        import os
        import zipfile

        import pyarrow as pa

        def texts():
            """Number, member and lines of a stretch of rows with the same member; a batch is held, not a member."""
            for batch in batches:
                rows = zip(*(batch.column(c).to_pylist() for c in ("number", "member", "line")))
                for (number, name), found in itertools.groupby(rows, key=lambda r: r[:2]):
                    yield number, name, "".join(f"{line}\n" for _, _, line in found)

        for number, stretches in itertools.groupby(texts(), key=lambda t: t[0]):
            os.makedirs(base, exist_ok=True)
            partial = f"{base}/.{number}.{os.getpid()}"
            with zipfile.ZipFile(partial, "w", zipfile.ZIP_DEFLATED) as zipped:
                for name, parts in itertools.groupby(stretches, key=lambda t: t[1]):
                    with zipped.open(name, "w", force_zip64=True) as member:
                        member.write(f"{header}\n".encode())
                        for _, _, text in parts:
                            member.write(text.encode())
            if number == 0:  # what a transfer that broke off leaves
                with open(partial, "r+b") as file:
                    file.truncate(os.path.getsize(partial) // 2)
            os.replace(partial, f"{base}/{number}.zip")
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64())], names=["number"])

    lines = mapping.report_lines(spark, sf).select((F.col("event_id") % 8).alias("number"), "member", "line")
    dealt = lines.repartitionById(8, F.pmod("number", F.lit(8)).cast("int")).sortWithinPartitions("number", "member")
    dealt.mapInArrow(write, "number long").write.format("noop").mode("overwrite").save()
    return scratch.until_end(spark, folder)


def _with_problem(rows: DataFrame) -> DataFrame:
    """``parse_error`` cut to what a row's problem is and, where a row has too many fields, the number it holds."""
    return rows.withColumns({
        "problem": F.regexp_extract("parse_error", "^[^:]*", 0),
        "lost_number": F.nullif(F.regexp_extract("parse_error", ";(STR[0-9]+);", 1), F.lit(""))}).drop("parse_error")


@query
def loose_file_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Report lines in loose files, read in small splits: quoted line breaks, surplus and short rows."""
    found = delimited.scan_delimited(spark, _loose_files(spark, sf), split_bytes=64 << 10)
    return _with_problem(staging.rename_columns(found.drop("archive", "member", "row_no")))


@query
def archive_member_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Report lines in archives, members dealt to tasks; one archive is cut off."""
    found = archives.expand_members(archives.list_archives(spark, _zip_files(spark, sf)))
    return _with_problem(staging.rename_columns(found.drop("row_no")).withColumn("archive", F.regexp_extract("archive", "[0-9]+[.]zip$", 0)))


def _ingested(spark: SparkSession, sf: str) -> tuple[str, list[dict[str, int]]]:
    """A raw table written by the stream in batches of three archives, and the stream's own row counts."""
    folder, raw, progress = _zip_files(spark, sf), *(scratch.new_folder(spark, name) for name in ("raw", "progress"))
    running = ingest.ingest_new(spark, folder, raw, progress, files_per_batch=3, inserted_at=_loaded())
    running.awaitTermination()
    scratch.until_end(spark, progress)
    return scratch.until_end(spark, raw), ingest.row_counts(running)


@query
def ingest_staged(spark: SparkSession, sf: str) -> DataFrame:
    """What the stream loaded."""
    return _unzoned(tables.read_staged(spark, _ingested(spark, sf)[0]))


@query
def ingest_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """What the stream set aside, with its origin."""
    found = tables.read_rejects(spark, _ingested(spark, sf)[0])
    return found.select(F.regexp_extract("archive", "[0-9]+[.]zip$", 0).alias("archive"), "member", "str_pix_control_number",
                        F.regexp_extract("reject_reason", "^[^:]*", 0).alias("reason"))


@query
def ingest_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The stream's own account of its rows, over all batches, beside what the table holds."""
    raw, counts = _ingested(spark, sf)
    said = spark.createDataFrame([(c["read"], c["staged"], c["rejected"], c["pending"]) for c in counts],
                                 "read long, staged long, rejected long, pending long")
    rejected = F.col("rejected").cast("boolean")
    held = spark.read.parquet(raw).select((~rejected).cast("long").alias("held_staged"), rejected.cast("long").alias("held_rejected"))
    both = said.unionByName(held, allowMissingColumns=True)
    return both.agg(*[F.sum(c).alias(c) for c in both.columns])


@query
def job_curate(spark: SparkSession, sf: str) -> DataFrame:
    """The curated table after the stream and a second run of the curation, which finds nothing new."""
    raw, curated = _ingested(spark, sf)[0], scratch.new_folder(spark, "curated")
    for _ in range(2):
        job.curate(spark, raw, curated)
    return _unzoned(spark.read.parquet(scratch.until_end(spark, curated)).drop("report_day"))


@query
def append_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Staged rows appended in two batches, one of them twice."""
    staged, target = staging.stage_report(mapping.report(spark, sf), _loaded()), scratch.new_folder(spark, "batches")
    for batch, test in (("geral", "operation = 'Geral'"), ("other", "operation <> 'Geral'"), ("geral", "operation = 'Geral'")):
        tables.append_batch(staged.filter(test), target, batch)
    return _unzoned(spark.read.parquet(scratch.until_end(spark, target)).drop("batch"))


@query
def union_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Members of which one has no initiation column and one a column nobody asked for."""
    rows = mapping.report_members(spark, sf)
    narrow = rows.filter(F.col("member").endswith("_0")).drop("Tipo Iniciação")
    wide = rows.filter(F.col("member").endswith("_1")).withColumn("Nova Coluna", F.lit("x"))
    rest = rows.filter(~F.col("member").endswith("_0") & ~F.col("member").endswith("_1"))
    return (delimited.union_reports(rest, narrow, wide)
            .transform(delimited.require_report_columns)
            .transform(staging.rename_columns)
            .select("member", "end_to_end_id", "sender_document_kind",
                    F.col("Nova Coluna").alias("new_column")))


# Report staging

@query
def rename_columns(spark: SparkSession, sf: str) -> DataFrame:
    return staging.rename_columns(mapping.report_raw(spark, sf))


@query
def parse_report_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.report(spark, sf).select(
        "end_to_end_id", fn.parse_report_timestamp(F.col("date_day")).alias("date_day"))


@query
def amount_to_cents(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.report(spark, sf).select(
        "end_to_end_id", fn.to_cents(fn.parse_number(F.col("amount"))).alias("amount"))


@query
def sided_amount(spark: SparkSession, sf: str) -> DataFrame:
    cents = fn.to_cents(fn.parse_number(F.col("amount")))
    return mapping.report(spark, sf).select(
        "end_to_end_id", "direction", fn.sided_amount(F.col("direction"), cents).alias("amount"))


@query
def numeric_id_default0(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.report(spark, sf).select("end_to_end_id", *[
        fn.as_id_number(F.col(name)).alias(name)
        for name in ("receiver_psp", "receiver_branch_number", "sender_psp",
                     "sender_branch_number")])


@query
def coerce_account_number(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.report(spark, sf).select("end_to_end_id", *[
        fn.as_account_number(F.col(name)).alias(name)
        for name in ("receiver_account_number", "sender_account_number")])


@query
def format_document_id(spark: SparkSession, sf: str) -> DataFrame:
    return (mapping.report(spark, sf)
            .select("end_to_end_id", "receiver_national_document_id",
                    "sender_national_document_id")
            .transform(numbers.format_document_id, "receiver_national_document_id")
            .transform(numbers.format_document_id, "sender_national_document_id"))


@query
def null_amount_rows(spark: SparkSession, sf: str) -> DataFrame:
    return staging.null_amount_rows(mapping.report(spark, sf))


@query
def drop_pending(spark: SparkSession, sf: str) -> DataFrame:
    return (staging.drop_pending(mapping.report(spark, sf))
            .select("end_to_end_id", "operation", "status"))


@query
def ingest_pix_key(spark: SparkSession, sf: str) -> DataFrame:
    return (staging.stage_report(mapping.report(spark, sf), _loaded())
            .select("end_to_end_id", "str_pix_control_number", "operation", "pix_key"))


@query
def stage_project(spark: SparkSession, sf: str) -> DataFrame:
    """Every text of the report in the fixed order; the columns around it are dropped."""
    loaded = (mapping.report_members(spark, sf).transform(staging.rename_columns)
              .withColumn("pix_key", fn.join_text("end_to_end_id", F.lit(","), "amount"))
              .withColumn("inserted_at", _loaded()))
    return staging.stage_project(loaded).drop("inserted_at")


@query
def stage_report(spark: SparkSession, sf: str) -> DataFrame:
    return _unzoned(staging.stage_report(mapping.report(spark, sf), _loaded()))


@query
def stage_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Every reason for which a row is not loaded."""
    return staging.stage_rejects(mapping.report_faulty(spark, sf))


@query
def stage_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each outcome and reason, from the one pass that gives staged and rejected rows."""
    return (staging.staged_and_pending(mapping.report_faulty(spark, sf), _loaded())
            .groupBy("outcome", "reject_reason").agg(F.count("*").alias("nb_rows"), F.count("inserted_at").alias("nb_loaded")))


@query
def preview_top5(spark: SparkSession, sf: str) -> DataFrame:
    return (staging.stage_report(mapping.report(spark, sf), _loaded())
            .orderBy("date_day", "end_to_end_id").limit(5).drop("inserted_at"))


def _loaded_twice(spark: SparkSession, sf: str) -> DataFrame:
    """The staged report as a folder holds it that was loaded a second time."""
    return (staging.stage_report(mapping.report(spark, sf), _loaded())
            .unionByName(staging.stage_report(mapping.report(spark, sf), _loaded(2))))


@query
def dedupe_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _unzoned(staging.dedupe_rows(_loaded_twice(spark, sf)))


@query
def curate_jd(spark: SparkSession, sf: str) -> DataFrame:
    return _unzoned(staging.curate_jd(_loaded_twice(spark, sf)))


# Both sides

@query
def utc_to_local_day(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.ledger(spark, sf).select(
        "transfer_id", "utc_datetime",
        fn.local_day(F.col("utc_datetime"), CONFIG.zone).alias("date_day"))


@query
def weekday_number(spark: SparkSession, sf: str) -> DataFrame:
    day = fn.local_day(F.col("utc_datetime"), CONFIG.zone)
    return mapping.ledger(spark, sf).select(
        "transfer_id", day.alias("date_day"), F.weekday(day).alias("weekday"))


@query
def null_skipping_concat(spark: SparkSession, sf: str) -> DataFrame:
    return _aux(spark, sf).select(
        "date_day", "end_to_end_id",
        fn.pix_key(F.col("end_to_end_id"), F.col("sided_amount")).alias("pix_key"))


@query
def jd_rejected_filter(spark: SparkSession, sf: str) -> DataFrame:
    return jd_side.jd_rejected_filter(mapping.jd_curated(spark, sf)).select(*JD_COLUMNS)


@query
def jd_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return _jd(spark, sf)


@query
def ledger_day_range(spark: SparkSession, sf: str) -> DataFrame:
    return (ledger_side.ledger_day_range(mapping.ledger(spark, sf), CONFIG)
            .select(*LEDGER_COLUMNS))


@query
def exclude_accounts(spark: SparkSession, sf: str) -> DataFrame:
    return (ledger_side.exclude_accounts(mapping.ledger(spark, sf), CONFIG.excluded_accounts)
            .select(*LEDGER_COLUMNS))


@query
def internal_transfer_filter(spark: SparkSession, sf: str) -> DataFrame:
    return ledger_side.internal_transfer_filter(
        mapping.ledger(spark, sf).withColumnRenamed("type", "operation")
    ).select("transfer_id", "operation", "amount")


@query
def ledger_gateway_join(spark: SparkSession, sf: str) -> DataFrame:
    return (ledger_side.ledger_gateway_join(mapping.ledger(spark, sf), mapping.gateway(spark, sf))
            .select("transfer_id", "utc_datetime", "type", "end_to_end_id"))


@query
def ledger_transactions_aux(spark: SparkSession, sf: str) -> DataFrame:
    return _aux(spark, sf)


@query
def ledger_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return _transactions(spark, sf)


@query
def same_day_refunds(spark: SparkSession, sf: str) -> DataFrame:
    return ledger_side.same_day_refunds(_transactions(spark, sf))


@query
def ledger_net_refunds(spark: SparkSession, sf: str) -> DataFrame:
    return ledger_side.ledger_net_refunds(_transactions(spark, sf))


@query
def unmatched_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return match.unmatched_transactions(_net(spark, sf), _jd(spark, sf))


@query
def match_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return match.match_status_counts(_net(spark, sf), _jd(spark, sf))


@query
def corrections_intended(spark: SparkSession, sf: str) -> DataFrame:
    return match.corrections_intended(_unmatched(spark, sf))


# Daily results and report

@query
def consolidated_jd(spark: SparkSession, sf: str) -> DataFrame:
    return daily.consolidated_jd(_jd(spark, sf))


@query
def consolidated_ledger(spark: SparkSession, sf: str) -> DataFrame:
    return daily.consolidated_ledger(_aux(spark, sf).withColumnRenamed("sided_amount", "amount"))


@query
def unmatched_daily(spark: SparkSession, sf: str) -> DataFrame:
    return daily.unmatched_daily(daily.calendar(spark, CONFIG), _unmatched(spark, sf))


@query
def recon_daily(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile_daily(*_inputs(spark, sf), CONFIG)


@query
def recon_daily_heavy(spark: SparkSession, sf: str) -> DataFrame:
    """Transfers with many rows and many links, whose pairs are counted but not formed."""
    return reconcile_daily(mapping.heavy_ledger(spark, sf), mapping.heavy_gateway(spark, sf), mapping.jd_curated(spark, sf),
                           CONFIG, heavy=4)


@query
def recon_daily_account_table(spark: SparkSession, sf: str) -> DataFrame:
    """The SQL form with the excluded accounts in a table, which also has a NULL."""
    accounts = mapping.ledger(spark, sf).select("account_id").distinct().filter("account_id between 1 and 15 or account_id is null")
    return reconcile_daily_sql(*_inputs(spark, sf), replace(CONFIG, excluded_accounts=accounts))


@query
def recon_daily_stepwise(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile_daily_stepwise(*_inputs(spark, sf), CONFIG)


@query
def recon_daily_sql(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile_daily_sql(*_inputs(spark, sf), CONFIG)


@query
def report_days_monday(spark: SparkSession, sf: str) -> DataFrame:
    return report.report_days(recon_daily(spark, sf), CONFIG)


@query
def report_days_other(spark: SparkSession, sf: str) -> DataFrame:
    return report.report_days(recon_daily(spark, sf), OTHER_DAY)


@query
def daily_report_values(spark: SparkSession, sf: str) -> DataFrame:
    return report.report_values(recon_daily(spark, sf), CONFIG)


@query
def daily_report_text(spark: SparkSession, sf: str) -> DataFrame:
    return report.report_text(recon_daily(spark, sf), CONFIG)
