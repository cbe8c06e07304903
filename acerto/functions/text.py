"""Text keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from acerto.config import OPERATIONS_BY_CONTROL_NUMBER, OPERATIONS_BY_TRANSACTION_ID


def join_text(*parts: Column | str) -> Column:
    """Concatenate, reading NULL as nothing; the separators are ordinary parts.

    ``concat`` would turn the whole key NULL, and ``concat_ws(',')`` would drop
    the comma next to a NULL.
    """
    return F.concat_ws("", *[F.col(p) if isinstance(p, str) else p for p in parts])


def pix_key(transaction_id: Column, amount: Column) -> Column:
    return join_text(transaction_id, F.lit(","), amount.cast("string"))


def tx_key(key: Column, day: Column) -> Column:
    return join_text(key, F.lit(","), day.cast("string"))


def report_key(operation: Column, transaction_id: Column, control_number: Column,
               amount: Column, status: Column) -> Column:
    """Three-part key of a report row; the operation decides which id leads.

    NULL for an unknown operation or a missing id. A missing status reads ``nan``.
    """
    tail = F.concat(F.lit(","), amount.cast("string"), F.lit(","),
                    F.coalesce(status, F.lit("nan")))
    return (F.when(operation.isin(*OPERATIONS_BY_TRANSACTION_ID), F.concat(transaction_id, tail))
            .when(operation.isin(*OPERATIONS_BY_CONTROL_NUMBER), F.concat(control_number, tail)))
