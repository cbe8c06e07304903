"""Provider side of the reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acerto.config import (
    OPERATIONS_BY_TRANSACTION_ID,
    REJECTED_STATUSES,
    SOURCE_JD,
    ReconConfig,
)
from acerto.functions import local_day, tx_key


def jd_rejected_filter(jd: DataFrame) -> DataFrame:
    """Rows that were not rejected; a row without a status goes as well."""
    return jd.filter(~F.col("status").isin(*REJECTED_STATUSES))


def jd_transactions(jd: DataFrame, config: ReconConfig) -> DataFrame:
    """Local day, id, direction as ``operation``, amount and keys of settled payments.

    The filter is on the report's operation, the output column is the direction.
    """
    settled = (jd.filter(F.col("operation").isin(*OPERATIONS_BY_TRANSACTION_ID))
               .transform(jd_rejected_filter))
    day = local_day(F.col("date_day"), config.zone)
    return settled.select(
        day.alias("date_day"), "end_to_end_id", F.col("direction").alias("operation"), "amount",
        "pix_key", tx_key(F.col("pix_key"), day).alias("tx_key"), F.lit(SOURCE_JD).alias("source"))
