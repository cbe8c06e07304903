"""Reconciliation inputs derived from the generic test tables.

``orders`` and ``lineitem`` become ledger, gateway links and provider payments,
``events`` becomes a provider report. Divisors of the order or event key plant
the cases to tell apart: missing rows, other amounts, other days, rejected and
missing statuses, refunds, missing ids and accounts, unreadable numbers.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acerto.config import REPORT_MEMBER_PREFIX, ReconConfig
from acerto.functions import pix_key
from acerto.operators.staging import rename_columns

CONFIG = ReconConfig(
    as_of=date(1998, 6, 1),
    calendar_start=date(1997, 6, 1),
    ledger_start=date(1997, 1, 1),
    excluded_accounts=tuple(range(1, 16)),
    pix_in_link="https://dashboards.example/pix-in",
    pix_out_link="https://dashboards.example/pix-out",
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as k", "o_custkey as acct",
        "o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 as int), 0, 0) as ts",
        "cast(round(o_totalprice * 100) as bigint) as cents",
        "o_orderstatus = 'F' or (o_orderstatus = 'P' and o_orderkey % 2 = 0) as incoming")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every payment, plus a same-day reversal of some and a next-day repeat of some of those.

    The variants of a payment are built side by side and unnested, so the
    table is read once.
    """
    kind = "if(incoming, 'pix_in', 'pix_out')"
    direction = "if(incoming, 'TransferIn', 'TransferOut')"

    def row(ts: str, kind: str, direction: str, account: str) -> str:
        return (f"named_struct('utc_datetime', {ts}, 'type', {kind},"
                f" 'direction', {direction}, 'account_id', {account})")

    first = row("ts", f"if(k % 73 = 0, 'pix_internal_transfer', {kind})",
                f"if(not incoming and k % 79 = 0, 'Other', {direction})",
                "if(k % 89 = 0, null, acct)")
    reversal = row("ts", "if(incoming, 'pix_out', 'pix_in')",
                   "if(incoming, 'TransferOut', 'TransferIn')", "acct")
    repeat = row("ts + interval 1 day", kind, direction, "acct")
    variants = (f"case when k % 58 = 0 then array({first}, {reversal}, {repeat})"
                f" when k % 29 = 0 then array({first}, {reversal}) else array({first}) end")
    return (_payments(spark, sf_dir)
            .selectExpr("k as transfer_id", "cents as amount", f"inline({variants})"))


def gateway(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_table(spark, sf_dir, "lineitem").select("l_orderkey").distinct()
            .selectExpr("l_orderkey as ledger_transfer_id",
                        "if(l_orderkey % 83 = 0, null, concat('E', l_orderkey))"
                        " as end_to_end_id"))


def _gathered(column: str) -> Column:
    """Some transfers, many together under one number."""
    return F.expr(f"if({column} % 7 = 0, {column} - {column} % 700, {column})")


def heavy_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger with transfers of many rows."""
    return ledger(spark, sf_dir).withColumn("transfer_id", _gathered("transfer_id"))


def heavy_gateway(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links with transfers of many links."""
    return gateway(spark, sf_dir).withColumn("ledger_transfer_id", _gathered("ledger_transfer_id"))


def jd_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _payments(spark, sf_dir).filter("k % 41 <> 0").selectExpr(
        "if(k % 47 = 0, ts + interval 1 day, ts) as date_day",
        "concat('E', k) as end_to_end_id",
        "if(incoming, 'Credito', 'Debito') as direction",
        "if(incoming, 1, -1) * (cents + if(k % 43 = 0, 1, 0)) as amount",
        "case when k % 67 = 0 then 'Aporte' when k % 71 = 0 then 'Retirada'"
        " when k % 13 = 0 then 'Devolucao' else 'Geral' end as operation",
        "case when k % 59 = 0 then 'RejeitadoSpiPsp' when k % 101 = 0 then 'Rejeitado SPI Psp'"
        " when k % 61 = 0 then null else 'Efetivado' end as status")
    return rows.withColumn("pix_key", pix_key(F.col("end_to_end_id"), F.col("amount")))


_REPORT_TEXT = {
    "Data Hora": "date_format(ts, 'dd/MM/yyyy HH:mm:ss.SSSSSS')",
    "Tipo Operação": "case event_type when 'purchase' then 'Geral' when 'view' then 'Devolucao'"
                     " when 'click' then 'Aporte' else 'Retirada' end",
    "IdFimAFim": "concat('E', event_id)",
    "IdFimAFimOriginal": "if(event_type = 'view', concat('E', event_id - 1), null)",
    "NumCtrlSTR": "concat('STR', event_id)",
    "D/C": "case when event_id % 3 = 0 then 'Debito' when event_id % 97 = 0 then null"
           " else 'Credito' end",
    "Valor": "if(event_id % 103 = 0, null, cast(value as string))",
    "PSP Recebedor": "if(event_id % 23 = 0, null, cast(user_id as string))",
    "Agência Recebedora": "cast(user_id % 10 as string)",
    "Conta Recebedora": "case when event_id % 11 = 0 then concat(user_id, 'X')"
                        " when event_id % 7 = 0 then null else cast(user_id as string) end",
    "CPF/CNPJ Recebedora": "case when event_id % 5 = 0 then null"
                           " when event_id % 2 = 0 then concat(user_id, ',0')"
                           " else cast(user_id as string) end",
    "Nome Cliente Recebedor": "concat('name ', user_id)",
    "PSP Pagador": "cast(user_id + 1 as string)",
    "Agência Pagadora": "cast(user_id % 7 as string)",
    "Conta Pagadora": "if(event_id % 13 = 0, 'n/d', cast(user_id + 2 as string))",
    "CPF/CNPJ Pagador": "cast(user_id + 3 as string)",
    "Nome Cliente Pagador": "concat('payer ', user_id)",
    "Situação": "case when event_id % 17 = 0 then 'Pendente' when event_id % 19 = 0 then null"
                " else 'Efetivado' end",
    "Tipo Iniciação": "if(event_id % 2 = 0, 'MANUAL', 'QRCODE')",
}
_MEMBER = (f"concat(if(event_id % 4 <> 0, '{REPORT_MEMBER_PREFIX}', 'OUTRO'), '_', event_id % 5)"
           " as member")


#: Texts that cannot be loaded, by the remainder of the event's number.
_FAULTS = {
    "Data Hora": {1: "'31/02/2024 10:00:00.0'", 2: "'yesterday'"},
    "Valor": {3: "'12,50'", 4: "'1e400'"},
    "PSP Recebedor": {5: "'abc'"}, "Agência Recebedora": {6: "'1d'"}, "PSP Pagador": {7: "'0x1F'"}, "Agência Pagadora": {8: "'9e30'"},
    "Conta Recebedora": {9: "'Infinity'"}, "Conta Pagadora": {10: "'1e30'"},
    "CPF/CNPJ Recebedora": {11: "'1,5'"}, "CPF/CNPJ Pagador": {12: "'x'"},
    "Tipo Operação": {13: "'Outra'", 14: "null", 15: "'Geral'", 16: "'Aporte'"},
    "IdFimAFim": {15: "null"}, "NumCtrlSTR": {16: "null"},
}
_FAULT_PERIOD = 211


def report_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report under its staged names, with every kind of text that cannot be loaded."""
    def text(name: str) -> str:
        cases = " ".join(f"when {k} then {fault}" for k, fault in _FAULTS.get(name, {}).items())
        base = _REPORT_TEXT[name]
        return f"case event_id % {_FAULT_PERIOD} {cases} else {base} end" if cases else base

    found = _table(spark, sf_dir, "events").selectExpr(*[f"{text(name)} as `{name}`" for name in _REPORT_TEXT])
    return rename_columns(found)


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as delimited lines, by member: names over two lines with quotes, rows with a field too many and with two too few."""
    names = [name for name in _REPORT_TEXT]
    events = _table(spark, sf_dir, "events").selectExpr("event_id", _MEMBER, *[f"{t} as `{n}`" for n, t in _REPORT_TEXT.items()])
    spread = F.when(F.col("event_id") % 31 == 0, F.concat(
        F.col("Nome Cliente Pagador"), F.lit('\nsecond "line"; of '), F.col("event_id"))).otherwise(F.col("Nome Cliente Pagador"))
    texts = events.withColumn("Nome Cliente Pagador", spread)
    cells = [F.col(f"`{name}`") for name in names]

    def line(columns: list) -> Column:
        return F.to_csv(F.struct(*columns), {"sep": ";", "escape": '"'})

    return texts.select("event_id", "member", F.when(F.col("event_id") % 37 == 0, F.concat(line(cells), F.lit(";more")))
                        .when(F.col("event_id") % 41 == 0, line(cells[:-2])).otherwise(line(cells)).alias("line"))


def report_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report with its own headers, all text."""
    return report_members(spark, sf_dir).drop("member")


def report_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report rows and the archive member they lie in."""
    return _table(spark, sf_dir, "events").selectExpr(
        _MEMBER, *[f"{text} as `{name}`" for name, text in _REPORT_TEXT.items()])


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report under its staged names."""
    return rename_columns(report_raw(spark, sf_dir))
