"""Column expressions: text keys, local time and report numbers."""

from acerto.functions.numbers import (
    as_account_number,
    as_document_id,
    as_id_number,
    format_document_id,
    parse_number,
    sided_amount,
    to_cents,
)
from acerto.functions.text import join_text, pix_key, report_key, tx_key
from acerto.functions.time import local_day, parse_report_timestamp

__all__ = [
    "as_account_number", "as_document_id", "as_id_number", "format_document_id", "join_text", "local_day",
    "parse_number", "parse_report_timestamp", "pix_key", "report_key", "sided_amount",
    "to_cents", "tx_key",
]
