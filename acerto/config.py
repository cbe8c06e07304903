"""Run parameters and the fixed values shared with the two source systems."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Codes that appear in the provider report.
OPERATIONS_BY_TRANSACTION_ID = ("Geral", "Devolucao")
OPERATIONS_BY_CONTROL_NUMBER = ("Aporte", "Retirada")
CREDIT = "Credito"
DEBIT = "Debito"
PENDING = "Pendente"
REJECTED_STATUSES = ("RejeitadoSpiPsp", "Rejeitado SPI Psp")
UNKNOWN_DIRECTION_AMOUNT = 9999999999999
REPORT_MEMBER_PREFIX = "JDPI_RELATORIO_FINANCEIRO"

# Codes that appear in the ledger and in the results.
PIX_IN = "pix_in"
PIX_OUT = "pix_out"
INTERNAL_TRANSFER = "pix_internal_transfer"
SOURCE_JD = "jd"
SOURCE_LEDGER = "ledger"
MISMATCH = "mismatch"
CORRECTION = "correction"
REVIEW = "review mismatch classification"


@dataclass(frozen=True)
class ReconConfig:
    """What a deployment sets: dates, zone, ledger codes, accounts and links.

    ``as_of`` is the day of the run; everything reported ends the day before.
    Left at None it is the current date in ``zone``. Excluded accounts are a tuple or, if they are many,
    a DataFrame of one column.
    """

    as_of: date | None = None
    calendar_start: date = date(2021, 6, 1)
    ledger_start: date = date(2021, 1, 1)
    zone: str = "America/Sao_Paulo"
    direction_in: str = "TransferIn"
    direction_out: str = "TransferOut"
    excluded_accounts: tuple | DataFrame = ()
    pix_in_link: str = ""
    pix_out_link: str = ""

    def as_of_day(self) -> Column:
        if self.as_of is not None:
            return F.lit(self.as_of)
        return F.to_date(F.convert_timezone(None, F.lit(self.zone), F.localtimestamp()))

    def yesterday(self) -> Column:
        return F.date_sub(self.as_of_day(), 1)
