"""Daily report: which days, which values, which text."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acerto.config import ReconConfig
from acerto.operators.daily import FLOWS

# The layout of the message, spaces at line ends included.
MESSAGE = """Date: {date}
PIX In:
    - Daily mismatch: {pix_in_daily_mismatch}% 
    - Daily mismatch amount: R${pix_in_daily_mismatch_amount}
    - # mismatch transactions: {pix_in_nb_mismatch_tx}
    - Amount of mismatch transactions: R${pix_in_amount_mismatch_tx}
    - # corrected transactions: {pix_in_nb_correction_tx}
    - Amount of corrected transactions: {pix_in_amount_correction_tx}
    - Dashboard: {pix_in_dashboard_link} 
    
PIX Out:
    - Daily mismatch: {pix_out_daily_mismatch}% 
    - Daily mismatch amount: R${pix_out_daily_mismatch_amount}
    - # mismatch transactions: {pix_out_nb_mismatch_tx}
    - Amount of mismatch transactions: R${pix_out_amount_mismatch_tx}
    - # corrected transactions: {pix_out_nb_correction_tx}
    - Amount of corrected transactions: {pix_out_amount_correction_tx}
    - Dashboard: {pix_out_dashboard_link}
            
            """

_MONEY = ("daily_mismatch_amount", "amount_mismatch_tx", "amount_correction_tx")


def report_days(daily: DataFrame, config: ReconConfig) -> DataFrame:
    """Days a run reports, oldest first: on a Monday the three before it, else yesterday."""
    as_of = config.as_of_day()
    back = F.when(F.weekday(as_of) == 0, F.lit(3)).otherwise(F.lit(1))
    first = F.date_sub(as_of, back)
    return (daily.filter(F.col("date_day").between(first, config.yesterday()))
            .orderBy("date_day"))


def _source_columns(flow: str) -> dict[str, str]:
    return {
        "daily_mismatch": f"mismatch_{flow}",
        "daily_mismatch_amount": f"mismatch_amount_{flow}",
        "nb_mismatch_tx": f"nb_mismatch_tx_{flow}",
        "amount_mismatch_tx": f"amount_mismatch_tx_{flow}",
        "nb_correction_tx": f"nb_correction_tx_{flow}",
        "amount_correction_tx": f"amount_correction_tx_{flow}",
    }


def report_values(daily: DataFrame, config: ReconConfig) -> DataFrame:
    """Per day the ratio in percent, counts, amounts in reais, and the links."""
    links = {"pix_in": config.pix_in_link, "pix_out": config.pix_out_link}
    columns: list[Column] = [F.to_date("date_day").alias("date")]
    for flow in FLOWS:
        for name, source in _source_columns(flow).items():
            value = F.col(source)
            if name in _MONEY:
                value = value / 100
            elif name == "daily_mismatch":
                value = F.round(value * 100, 6)
            columns.append(value.alias(f"{flow}_{name}"))
        columns.append(F.lit(links[flow]).alias(f"{flow}_dashboard_link"))
    return daily.select(*columns)


def _plain_number(value: Column) -> Column:
    """Decimal as text: no trailing zeros but one digit after the point; ``nan`` for NULL."""
    return F.coalesce(F.regexp_replace(value.cast("string"), r"(\.\d+?)0+$", "$1"), F.lit("nan"))


def _as_text(name: str, source: str) -> Column:
    value = F.col(source)
    if name in _MONEY:
        # Exact: a DOUBLE prints 1.0E7 from ten million on.
        return _plain_number((value.cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)"))
                             .cast("decimal(20,2)"))
    if name == "daily_mismatch":
        return _plain_number((value * 100).cast("decimal(20,6)"))
    return value.cast("string")


def _message_fields(config: ReconConfig) -> dict[str, Column]:
    fields = {"date": F.col("date_day").cast("string"),
              "pix_in_dashboard_link": F.lit(config.pix_in_link),
              "pix_out_dashboard_link": F.lit(config.pix_out_link)}
    for flow in FLOWS:
        for name, source in _source_columns(flow).items():
            fields[f"{flow}_{name}"] = _as_text(name, source)
    return fields


def report_text(daily: DataFrame, config: ReconConfig) -> DataFrame:
    """Date and message text per day: ``MESSAGE`` with its fields filled in."""
    fields = _message_fields(config)
    parts: list[Column] = []
    for before, name, _, _ in Formatter().parse(MESSAGE):
        parts.append(F.lit(before))
        if name is not None:
            parts.append(fields[name])
    return daily.select(F.to_date("date_day").alias("date"), F.concat(*parts).alias("text"))
