"""Report rows: rename, type, sign, filter, key, project.

Every text is converted once, by an expression that gives NULL where it fails.
``stage_report`` takes the rows where all went well and ``stage_rejects`` the
others, with the reason. Only ``dedupe_rows`` and ``curate_jd`` shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acerto import schemas
from acerto.config import (
    OPERATIONS_BY_CONTROL_NUMBER,
    OPERATIONS_BY_TRANSACTION_ID,
    PENDING,
)
from acerto.functions import numbers, pix_key, report_key, sided_amount
from acerto.functions.time import parse_report_timestamp


def rename_columns(report: DataFrame) -> DataFrame:
    """Report headers to staged names; headers that are absent or unknown are left alone."""
    return report.withColumnsRenamed(schemas.REPORT_COLUMNS)


def blank_to_null(report: DataFrame) -> DataFrame:
    """Read the usual "no value" texts as NULL, in every text column."""
    text = [name for name, kind in report.dtypes if kind == "string"]
    return report.withColumns({
        name: F.when(~F.col(name).isin(*schemas.NULL_TOKENS), F.col(name)) for name in text})


def null_amount_rows(report: DataFrame) -> DataFrame:
    return report.filter(F.col("amount").isNull())


def drop_pending(report: DataFrame) -> DataFrame:
    """Rows that are not pending; a row without a status stays."""
    return report.filter(~F.col("status").eqNullSafe(PENDING))


def stage_project(report: DataFrame) -> DataFrame:
    """The fixed column list in its order: a missing column is an error, others are dropped."""
    return report.select(*schemas.STAGED_COLUMNS)


def _converted(report: DataFrame) -> DataFrame:
    """The report's texts and, in ``_value``, the converted values; NULL where that failed.

    The one-element explode keeps the filters that follow from being pushed
    below the conversion, where they would repeat it for every mention of a
    value. The transform gives the parsed document numbers a name, as they are
    needed twice; it also takes the conversion out of the surrounding generated
    method, which would become too large for the JVM to compile.
    """
    def each(columns: tuple[str, ...], convert) -> Column:
        return F.array(*[convert(F.col(name)) for name in columns])

    documents = each(schemas.DOCUMENT_COLUMNS, numbers.parse_document_number)
    value = F.struct(
        parse_report_timestamp(F.col("date_day")).alias("date_day"),
        numbers.to_cents(numbers.parse_number(F.col("amount"))).alias("amount"),
        each(schemas.ID_COLUMNS, numbers.as_id_number).alias("ids"),
        each(schemas.ACCOUNT_COLUMNS, numbers.as_account_number).alias("accounts"),
        F.transform(documents, numbers.exact).alias("documents"))
    return report.select("*", F.explode(F.array(value)).alias("_value"))


def _values() -> dict[str, Column]:
    """Staged name to converted value."""
    value = F.col("_value")
    values = {"date_day": value["date_day"], "amount": value["amount"]}
    for group, columns in (("ids", schemas.ID_COLUMNS), ("accounts", schemas.ACCOUNT_COLUMNS),
                           ("documents", schemas.DOCUMENT_COLUMNS)):
        values |= {name: value[group][i] for i, name in enumerate(columns)}
    return values


def _problems() -> list[tuple[str, Column]]:
    """(reason, test) for rows that cannot be loaded. Pending rows never get a key."""
    values = _values()
    problems = [
        ("malformed date_day", F.col("date_day").isNotNull() & values["date_day"].isNull()),
        ("missing amount", F.col("amount").isNull())]
    problems += [(f"malformed {name}", value.isNull())
                 for name, value in values.items() if name != "date_day"]
    kept = ~F.col("status").eqNullSafe(PENDING)
    by_id = F.col("operation").isin(*OPERATIONS_BY_TRANSACTION_ID)
    by_number = F.col("operation").isin(*OPERATIONS_BY_CONTROL_NUMBER)
    lead = F.when(by_id, F.col("end_to_end_id")).otherwise(F.col("str_pix_control_number"))
    return [*problems,
            ("unknown operation", kept & ~F.coalesce(by_id | by_number, F.lit(False))),
            ("missing key id", kept & lead.isNull())]


def _is_bad(report: DataFrame) -> Column:
    """Whether a row has any problem; never NULL."""
    unread = [F.col("parse_error").isNotNull()] if "parse_error" in report.columns else []
    return reduce(Column.__or__, unread + [test for _, test in _problems()])


def _reason(report: DataFrame) -> Column:
    """The first problem of a row, NULL if it has none."""
    unread = [F.col("parse_error")] if "parse_error" in report.columns else []
    return F.coalesce(*unread, *[F.when(test, F.lit(name)) for name, test in _problems()])


def _staged_values(inserted_at: Column | None) -> list[Column]:
    values: dict[str, Column] = {name: F.col(name) for name in schemas.REPORT_COLUMNS.values()}
    values |= _values()
    values["amount"] = sided_amount(F.col("direction"), values["amount"])
    values["inserted_at"] = F.current_timestamp() if inserted_at is None else inserted_at
    values["pix_key"] = report_key(
        F.col("operation"), F.col("end_to_end_id"), F.col("str_pix_control_number"),
        values["amount"], F.col("status"))
    return [values[name].alias(name) for name in schemas.STAGED_COLUMNS]


def stage_report(report: DataFrame, inserted_at: Column | None = None,
                 strict: bool = False) -> DataFrame:
    """Renamed report rows to the 21-column staged table, pending rows dropped.

    Rows that cannot be loaded are left to ``stage_rejects``, or fail the job if
    ``strict``. A ``parse_error`` column, as archives have one, counts as a problem.
    """
    kept = ~F.col("status").eqNullSafe(PENDING)
    if strict:
        # One expression: as a filter of its own, the status test could run first.
        problem = F.concat(F.lit("report row: "), _reason(report))
        test = F.when(~_is_bad(report), kept).otherwise(F.raise_error(problem).cast("boolean"))
    else:
        test = ~_is_bad(report) & kept
    return _converted(report).filter(test).select(*_staged_values(inserted_at))


def stage_rejects(report: DataFrame) -> DataFrame:
    """Rows that cannot be loaded, as they came, with the first reason."""
    return (_converted(report).filter(_is_bad(report))
            .select(*report.columns, _reason(report).alias("reject_reason")))


def staged_and_pending(report: DataFrame, inserted_at: Column | None = None) -> DataFrame:
    """Every row of the report with its ``outcome``: staged, rejected or pending. The other columns are as in ``staged_or_rejected``."""
    origin = [name for name in schemas.ORIGIN_COLUMNS if name in report.columns]
    texts = F.struct(*schemas.REPORT_COLUMNS.values())
    rejected = F.col("outcome") == "rejected"
    judged = _converted(report).withColumn(
        "outcome", F.when(_is_bad(report), "rejected").when(F.col("status").eqNullSafe(PENDING), "pending")
        .otherwise("staged"))
    staged = F.struct(*_staged_values(inserted_at))
    chosen = judged.select(
        F.when(~rejected, staged).alias("staged"),
        F.when(rejected, _reason(report)).alias("reject_reason"),
        F.when(rejected, texts).alias("report_row"), rejected.alias("rejected"), *origin, "outcome")
    return chosen.select("staged.*", *origin, "reject_reason", "report_row", "rejected", "outcome")


def staged_or_rejected(report: DataFrame, inserted_at: Column | None = None) -> DataFrame:
    """Both outcomes in one pass: staged columns, ``reject_reason``, ``report_row``, ``rejected``.

    A rejected row keeps its texts in ``report_row`` and has NULL staged columns. Where the report tells the rows'
    origin (``archive``, ``member``, ``row_no``), both kinds keep it.
    """
    return staged_and_pending(report, inserted_at).filter("outcome <> 'pending'").drop("outcome")


def dedupe_rows(staged: DataFrame) -> DataFrame:
    """One row per distinct content, with the time it was first loaded.

    Grouping on every column combines copies before the shuffle.
    """
    content = [name for name in staged.columns if name != "inserted_at"]
    if len(content) == len(staged.columns):
        return staged.distinct()
    return (staged.groupBy(*content).agg(F.min("inserted_at").alias("inserted_at"))
            .select(*staged.columns))


def curate_jd(staged: DataFrame) -> DataFrame:
    """Staged report rows to the table the reconciliation reads.

    Drops repeated rows and replaces the three-part key with the two-part one
    the ledger side uses. Own design: the step is not part of the original job.
    """
    once = dedupe_rows(staged.drop("pix_key"))
    return once.withColumn("pix_key", pix_key(F.col("end_to_end_id"), F.col("amount")))
