"""Table layouts. Reports arrive as text and are typed by ``operators.staging``."""

from __future__ import annotations

from pyspark.sql import types as T

# Report headers and the staged names they map to.
REPORT_COLUMNS = {
    "Data Hora": "date_day",
    "Tipo Operação": "operation",
    "IdFimAFim": "end_to_end_id",
    "IdFimAFimOriginal": "end_to_end_id_original",
    "NumCtrlSTR": "str_pix_control_number",
    "D/C": "direction",
    "Valor": "amount",
    "PSP Recebedor": "receiver_psp",
    "Agência Recebedora": "receiver_branch_number",
    "Conta Recebedora": "receiver_account_number",
    "CPF/CNPJ Recebedora": "receiver_national_document_id",
    "Nome Cliente Recebedor": "receiver_name",
    "PSP Pagador": "sender_psp",
    "Agência Pagadora": "sender_branch_number",
    "Conta Pagadora": "sender_account_number",
    "CPF/CNPJ Pagador": "sender_national_document_id",
    "Nome Cliente Pagador": "sender_name",
    "Situação": "status",
    "Tipo Iniciação": "sender_document_kind",
}

# Texts that mean "no value" in a report cell (the usual dataframe reader defaults).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

ID_COLUMNS = ("receiver_psp", "receiver_branch_number", "sender_psp", "sender_branch_number")
ACCOUNT_COLUMNS = ("receiver_account_number", "sender_account_number")
DOCUMENT_COLUMNS = ("receiver_national_document_id", "sender_national_document_id")

#: Where a report row came from.
ORIGIN_COLUMNS = ("archive", "member", "row_no")

STAGED_COLUMNS = [*REPORT_COLUMNS.values(), "inserted_at", "pix_key"]

REPORT_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in REPORT_COLUMNS])


def _staged_type(name: str) -> T.DataType:
    if name == "date_day":
        return T.TimestampNTZType()
    if name == "inserted_at":
        return T.TimestampType()
    if name == "amount" or name in ID_COLUMNS + ACCOUNT_COLUMNS + DOCUMENT_COLUMNS:
        return T.LongType()
    return T.StringType()


STAGED_SCHEMA = T.StructType([T.StructField(name, _staged_type(name)) for name in STAGED_COLUMNS])

# Columns the reconciliation reads from each table; further columns are ignored.
JD_COLUMNS = ("date_day", "end_to_end_id", "direction", "amount", "operation", "status", "pix_key")
LEDGER_COLUMNS = ("transfer_id", "utc_datetime", "type", "direction", "amount", "account_id")
GATEWAY_COLUMNS = ("ledger_transfer_id", "end_to_end_id")
