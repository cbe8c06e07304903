"""The daily reconciliation as one SQL text.

Same plan as ``reconcile.reconcile_daily``: one aggregation where both sides
meet, one per (id, day) carrying both outcomes of the refund test, one per day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from acerto.config import ReconConfig
from acerto.sources.tables import run_sql

_TEXT = """
with ledger_rows as (
  select {ledger_day} as date_day, link.end_to_end_id, l.type as operation,
         case l.direction when {direction_out} then -1 when {direction_in} then 1 end
           * l.amount as amount
  from {{ledger}} l
  join {{gateway}} link on l.transfer_id = link.ledger_transfer_id
  where l.type in ('pix_in', 'pix_out')
    and l.utc_datetime >= cast(date_sub({ledger_start}, 1) as timestamp_ntz)
    and l.utc_datetime < cast(date_add({as_of}, 1) as timestamp_ntz)
    and {ledger_day} between {ledger_start} and date_sub({as_of}, 1)
    and l.account_id is not null {account_test}
),
jd_rows as (
  select {jd_day} as date_day, direction as operation, amount, coalesce(pix_key, '') as pix_key
  from {{jd}} j
  where operation in ('Geral', 'Devolucao')
    and status not in ('RejeitadoSpiPsp', 'Rejeitado SPI Psp')
    and date_day >= cast(date_sub({calendar_start}, 1) as timestamp_ntz)
    and date_day < cast(date_add({as_of}, 1) as timestamp_ntz)
    and {jd_day} between {calendar_start} and date_sub({as_of}, 1)
),
both_sides as (
  select concat_ws('', end_to_end_id, ',', cast(amount as string)) as pix_key, date_day,
         end_to_end_id as ledger_id, amount as ledger_amount,
         cast(operation = 'pix_in' as bigint) as ledger_in,
         cast(operation = 'pix_out' as bigint) as ledger_out,
         cast(operation = 'pix_in' and end_to_end_id is null as bigint) as no_id_in,
         cast(operation = 'pix_out' and end_to_end_id is null as bigint) as no_id_out,
         0L as jd_rows, 0L as jd_in, 0L as jd_out, 0L as jd_amount_in, 0L as jd_amount_out,
         cast(null as bigint) as jd_total_in, cast(null as bigint) as jd_total_out
  from ledger_rows
  union all
  select pix_key, date_day, null, null, 0L, 0L, 0L, 0L, 1L,
         cast(operation in ('pix_in', 'Credito') as bigint),
         cast(operation in ('pix_out', 'Debito') as bigint),
         if(operation in ('pix_in', 'Credito'), amount, 0L),
         if(operation in ('pix_out', 'Debito'), amount, 0L),
         if(operation = 'Credito', amount, 0L),
         if(operation = 'Debito', amount, 0L)
  from jd_rows
),
key_days as (
  select pix_key, date_day, max(ledger_id) as ledger_id, max(ledger_amount) as amount,
         sum(ledger_in) as ledger_in, sum(ledger_out) as ledger_out,
         sum(ledger_in + ledger_out) as n_ledger,
         sum(no_id_in) as no_id_in, sum(no_id_out) as no_id_out,
         sum(no_id_in + no_id_out) as n_no_id,
         sum(jd_rows) as n_jd, sum(jd_in) as jd_in, sum(jd_out) as jd_out,
         coalesce(sum(jd_amount_in), 0) as jd_amount_in,
         coalesce(sum(jd_amount_out), 0) as jd_amount_out,
         sum(jd_total_in) as jd_total_in, sum(jd_total_out) as jd_total_out
  from both_sides
  group by pix_key, date_day
),
id_days as (
  select ledger_id, date_day,
         sum(if(n_ledger > n_no_id, amount * (n_ledger - n_no_id), null)) as net_amount,
         sum(case when amount is not null then amount * ledger_in
                  when ledger_out > 0 then 0L end) as ledger_total_in,
         sum(case when amount is not null then amount * ledger_out
                  when ledger_in > 0 then 0L end) as ledger_total_out,
         sum(jd_total_in) as jd_total_in, sum(jd_total_out) as jd_total_out,
         sum(if(n_ledger = 0 or n_jd = 0, ledger_in + jd_in, 0L)) as kept_nb_in,
         sum(if(n_ledger = 0 or n_jd = 0, ledger_out + jd_out, 0L)) as kept_nb_out,
         sum(if(n_ledger = 0 or n_jd = 0,
                coalesce(amount * ledger_in, 0L) + jd_amount_in, 0L)) as kept_amount_in,
         sum(if(n_ledger = 0 or n_jd = 0,
                coalesce(amount * ledger_out, 0L) + jd_amount_out, 0L)) as kept_amount_out,
         sum(if(n_no_id = 0 or n_jd = 0, no_id_in + jd_in, 0L)) as removed_nb_in,
         sum(if(n_no_id = 0 or n_jd = 0, no_id_out + jd_out, 0L)) as removed_nb_out,
         sum(if(n_no_id = 0 or n_jd = 0,
                coalesce(amount * no_id_in, 0L) + jd_amount_in, 0L)) as removed_amount_in,
         sum(if(n_no_id = 0 or n_jd = 0,
                coalesce(amount * no_id_out, 0L) + jd_amount_out, 0L)) as removed_amount_out
  from key_days
  group by ledger_id, date_day
),
flagged as (
  select *, coalesce(max(net_amount = 0) over (partition by ledger_id), false) as removed
  from id_days
),
contributions as (
  select date_day, ledger_total_in, ledger_total_out, jd_total_in, jd_total_out,
         if(removed, removed_nb_in, kept_nb_in) as nb_in,
         if(removed, removed_nb_out, kept_nb_out) as nb_out,
         if(removed, removed_amount_in, kept_amount_in) as amount_in,
         if(removed, removed_amount_out, kept_amount_out) as amount_out,
         false as in_calendar
  from flagged
  where date_day between {calendar_start} and date_sub({as_of}, 1)
  union all
  select day, null, null, null, null, 0L, 0L, 0L, 0L, true
  from (select explode(sequence({calendar_start}, date_sub({as_of}, 1), interval 1 day)) as day)
),
days as (
  select date_day, sum(ledger_total_in) as ledger_total_in,
         sum(ledger_total_out) as ledger_total_out,
         sum(jd_total_in) as jd_total_in, sum(jd_total_out) as jd_total_out,
         sum(nb_in) as nb_in, sum(nb_out) as nb_out,
         sum(amount_in) as amount_in, sum(amount_out) as amount_out
  from contributions
  group by date_day
  having max(in_calendar)
)
select date_day,
       ledger_total_in as amount_ledger_pix_in, jd_total_in as amount_jd_pix_in,
       ledger_total_in - jd_total_in as mismatch_amount_pix_in,
       round(try_divide(ledger_total_in - jd_total_in, ledger_total_in), 6) as mismatch_pix_in,
       nb_in as nb_mismatch_tx_pix_in, 0L as nb_correction_tx_pix_in,
       amount_in as amount_mismatch_tx_pix_in, 0L as amount_correction_tx_pix_in,
       ledger_total_out as amount_ledger_pix_out, jd_total_out as amount_jd_pix_out,
       ledger_total_out - jd_total_out as mismatch_amount_pix_out,
       round(try_divide(ledger_total_out - jd_total_out, ledger_total_out), 6)
         as mismatch_pix_out,
       nb_out as nb_mismatch_tx_pix_out, 0L as nb_correction_tx_pix_out,
       amount_out as amount_mismatch_tx_pix_out, 0L as amount_correction_tx_pix_out
from days
order by date_day desc
"""


def _literal(value) -> str:
    """A value in the text; braces are doubled, as single ones name inputs."""
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'").replace("{", "{{").replace("}", "}}")
        return f"'{escaped}'"
    return str(value)


def _local_day(column: str, zone: str) -> str:
    return ("date_from_unix_date(cast(floor(unix_seconds(from_utc_timestamp(timestamp_seconds("
            f"unix_timestamp({column})), {_literal(zone)})) / 86400) as int))")


def _account_test(accounts: tuple | DataFrame) -> str:
    """Rows outside the listed accounts; a table of them is an anti join, where a NULL account lists nothing."""
    if isinstance(accounts, DataFrame):
        return "and not exists (select 1 from {accounts} listed where listed.account_id = l.account_id)"
    listed = ", ".join(_literal(a) for a in accounts)
    return f"and l.account_id not in ({listed})" if listed else ""


def recon_daily_text(config: ReconConfig) -> str:
    """The query for one run; ``{ledger}``, ``{gateway}`` and ``{jd}`` name its inputs, and ``{accounts}`` a table of excluded accounts."""
    as_of = (f"to_date(convert_timezone({_literal(config.zone)}, localtimestamp()))" if config.as_of is None
             else f"date'{config.as_of}'")
    return _TEXT.format(
        ledger_day=_local_day("l.utc_datetime", config.zone),
        jd_day=_local_day("j.date_day", config.zone),
        direction_in=_literal(config.direction_in), direction_out=_literal(config.direction_out),
        calendar_start=f"date'{config.calendar_start}'",
        ledger_start=f"date'{config.ledger_start}'", as_of=as_of,
        account_test=_account_test(config.excluded_accounts))


def reconcile_daily_sql(ledger: DataFrame, gateway: DataFrame, jd: DataFrame,
                        config: ReconConfig) -> DataFrame:
    inputs = {"ledger": ledger, "gateway": gateway, "jd": jd}
    if isinstance(config.excluded_accounts, DataFrame):
        inputs["accounts"] = config.excluded_accounts.toDF("account_id")
    return run_sql(ledger.sparkSession, recon_daily_text(config), **inputs)
