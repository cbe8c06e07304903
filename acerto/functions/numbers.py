"""Numbers as the report writes them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acerto.config import CREDIT, DEBIT, UNKNOWN_DIRECTION_AMOUNT

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_INFINITE = ("inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")


def parse_number(text: Column) -> Column:
    """Text to DOUBLE; NULL where it is not a finite number.

    The pattern keeps out Java literals such as 12d or 0x1p3, which Spark's cast
    takes, and keeps malformed text from the cast, where each costs an exception.
    """
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def parse_account_number(text: Column) -> Column:
    """As ``parse_number``, but 0 for NULL and malformed text; infinities stay what they are."""
    infinite = F.when(F.lower(F.trim(text)).isin(*_INFINITE), F.lit(float("inf")))
    return F.coalesce(parse_number(text), infinite, F.lit(0.0))


def parse_id_number(text: Column) -> Column:
    """As ``parse_number``, but 0 for NULL."""
    return parse_number(F.coalesce(text, F.lit("0")))


def parse_document_number(text: Column) -> Column:
    """As ``parse_id_number`` with a comma for the decimal point."""
    return parse_id_number(F.replace(text, F.lit(","), F.lit(".")))


def rounded(number: Column) -> Column:
    """Nearest BIGINT, ties to even; NULL if there is none."""
    return F.rint(number).try_cast("bigint")


def exact(number: Column) -> Column:
    """The number as BIGINT; NULL if it has a fraction or does not fit."""
    return F.when(number == F.rint(number), number.try_cast("bigint"))


def to_cents(reais: Column) -> Column:
    """Reais to whole cents, ties to even; NULL if that is no BIGINT."""
    return rounded(reais.cast("double") * F.lit(100.0))


def sided_amount(direction: Column, amount: Column) -> Column:
    """Credit positive, debit negative; any other direction gives the sentinel."""
    return (F.when(direction == CREDIT, amount)
            .when(direction == DEBIT, -amount)
            .otherwise(F.lit(UNKNOWN_DIRECTION_AMOUNT).cast("bigint")))


def as_id_number(text: Column) -> Column:
    """Rounded id, 0 for NULL; NULL if the text is malformed or no BIGINT."""
    return rounded(parse_id_number(text))


def as_account_number(text: Column) -> Column:
    """Rounded number, 0 for NULL and for malformed text; NULL only if it is no BIGINT."""
    return rounded(parse_account_number(text))


def as_document_id(text: Column) -> Column:
    """Document id, a comma read as decimal point, 0 for NULL; NULL if it is no whole number."""
    return exact(parse_document_number(text))


def format_document_id(df: DataFrame, column: str) -> DataFrame:
    """``df.transform(format_document_id, column)``: replace the text column by its number.

    Raises on a text that is no whole number.
    """
    problem = F.concat(F.lit("not a document id: "), F.col(column))
    return df.withColumn(column, F.coalesce(
        as_document_id(F.col(column)), F.raise_error(problem).cast("bigint")))
