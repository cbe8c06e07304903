"""DuckDB SQL for every query in ``queries``, step by step and without shortcuts."""

from __future__ import annotations

from acerto.plans.mapping import CONFIG
from acerto.schemas import REPORT_COLUMNS

_ACCOUNTS = ", ".join(str(a) for a in CONFIG.excluded_accounts)
_FIRST, _AS_OF = f"date '{CONFIG.calendar_start}'", f"date '{CONFIG.as_of}'"
_STAGED = ", ".join(REPORT_COLUMNS.values())


def _day(column: str) -> str:
    return f"cast(({column} at time zone 'UTC') at time zone '{CONFIG.zone}' as date)"


_TYPED = """
               strptime(date_day, '%d/%m/%Y %H:%M:%S.%f') as date_day, operation, end_to_end_id,
               end_to_end_id_original, str_pix_control_number, direction,
               cast(case direction
                 when 'Credito' then cast(round_even(cast(amount as double) * 100, 0) as bigint)
                 when 'Debito' then -cast(round_even(cast(amount as double) * 100, 0) as bigint)
                 else 9999999999999 end as bigint) as amount,
               coalesce(cast(receiver_psp as bigint), 0) as receiver_psp,
               coalesce(cast(receiver_branch_number as bigint), 0) as receiver_branch_number,
               coalesce(try_cast(receiver_account_number as bigint), 0)
                 as receiver_account_number,
               cast(cast(coalesce(replace(receiver_national_document_id, ',', '.'), '0')
                 as double) as bigint) as receiver_national_document_id,
               receiver_name,
               coalesce(cast(sender_psp as bigint), 0) as sender_psp,
               coalesce(cast(sender_branch_number as bigint), 0) as sender_branch_number,
               coalesce(try_cast(sender_account_number as bigint), 0) as sender_account_number,
               cast(cast(coalesce(replace(sender_national_document_id, ',', '.'), '0')
                 as double) as bigint) as sender_national_document_id,
               sender_name, status, sender_document_kind, amount is null as no_amount"""
_KEYED = """
               * exclude (no_amount),
               concat(case when operation in ('Geral', 'Devolucao') then end_to_end_id
                           else str_pix_control_number end,
                      ',', amount, ',', coalesce(status, 'nan')) as pix_key"""


def _is_number(text: str) -> str:
    return f"coalesce(regexp_full_match({text}, '\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*'), false)"


def _finite(text: str, most: float = 9.2e18) -> str:
    return f"({_is_number(text)} and coalesce(abs(try_cast({text} as double)) < {most!r}, false))"


# Named relations in dependency order; each may use the ones before it.
_RELATIONS: dict[str, str] = {
    "base": """
        select o_orderkey as k, o_custkey as acct,
               o_orderdate + to_hours(cast(o_orderkey % 24 as int)) as ts,
               cast(round(o_totalprice * 100) as bigint) as cents,
               case when o_orderstatus = 'F' or (o_orderstatus = 'P' and o_orderkey % 2 = 0)
                    then 'pix_in' else 'pix_out' end as typ
        from orders""",
    "ledger": """
        select k as transfer_id, ts as utc_datetime,
               case when k % 73 = 0 then 'pix_internal_transfer' else typ end as type,
               case when typ = 'pix_in' then 'TransferIn' when k % 79 = 0 then 'Other'
                    else 'TransferOut' end as direction,
               cents as amount, case when k % 89 = 0 then null else acct end as account_id
        from base
        union all
        select k, ts, case when typ = 'pix_in' then 'pix_out' else 'pix_in' end,
               case when typ = 'pix_in' then 'TransferOut' else 'TransferIn' end, cents, acct
        from base where k % 29 = 0
        union all
        select k, ts + interval 1 day, typ,
               case when typ = 'pix_in' then 'TransferIn' else 'TransferOut' end, cents, acct
        from base where k % 58 = 0""",
    "gateway": """
        select distinct l_orderkey as ledger_transfer_id,
               case when l_orderkey % 83 = 0 then null
                    else concat('E', cast(l_orderkey as varchar)) end as end_to_end_id
        from lineitem""",
    "jd_source": """
        select case when k % 47 = 0 then ts + interval 1 day else ts end as date_day,
               concat('E', cast(k as varchar)) as end_to_end_id,
               case when typ = 'pix_in' then 'Credito' else 'Debito' end as direction,
               case when typ = 'pix_in' then 1 else -1 end
                 * (cents + case when k % 43 = 0 then 1 else 0 end) as amount,
               case when k % 67 = 0 then 'Aporte' when k % 71 = 0 then 'Retirada'
                    when k % 13 = 0 then 'Devolucao' else 'Geral' end as operation,
               case when k % 59 = 0 then 'RejeitadoSpiPsp'
                    when k % 101 = 0 then 'Rejeitado SPI Psp'
                    when k % 61 = 0 then null else 'Efetivado' end as status
        from base where k % 41 <> 0""",
    "jd_curated": """
        select *, concat(end_to_end_id, ',', amount) as pix_key from jd_source""",
    "report_raw": """
        select concat(case when event_id % 4 <> 0 then 'JDPI_RELATORIO_FINANCEIRO'
                           else 'OUTRO' end, '_', event_id % 5) as member,
               strftime(ts, '%d/%m/%Y %H:%M:%S.%f') as date_day,
               case event_type when 'purchase' then 'Geral' when 'view' then 'Devolucao'
                    when 'click' then 'Aporte' else 'Retirada' end as operation,
               concat('E', event_id) as end_to_end_id,
               case when event_type = 'view' then concat('E', event_id - 1) end
                 as end_to_end_id_original,
               concat('STR', event_id) as str_pix_control_number,
               case when event_id % 3 = 0 then 'Debito' when event_id % 97 = 0 then null
                    else 'Credito' end as direction,
               case when event_id % 103 = 0 then null else cast(value as varchar) end as amount,
               case when event_id % 23 = 0 then null else cast(user_id as varchar) end
                 as receiver_psp,
               cast(user_id % 10 as varchar) as receiver_branch_number,
               case when event_id % 11 = 0 then concat(user_id, 'X')
                    when event_id % 7 = 0 then null
                    else cast(user_id as varchar) end as receiver_account_number,
               case when event_id % 5 = 0 then null when event_id % 2 = 0
                    then concat(user_id, ',0') else cast(user_id as varchar) end
                 as receiver_national_document_id,
               concat('name ', user_id) as receiver_name,
               cast(user_id + 1 as varchar) as sender_psp,
               cast(user_id % 7 as varchar) as sender_branch_number,
               case when event_id % 13 = 0 then 'n/d' else cast(user_id + 2 as varchar) end
                 as sender_account_number,
               cast(user_id + 3 as varchar) as sender_national_document_id,
               concat('payer ', user_id) as sender_name,
               case when event_id % 17 = 0 then 'Pendente' when event_id % 19 = 0 then null
                    else 'Efetivado' end as status,
               case when event_id % 2 = 0 then 'MANUAL' else 'QRCODE' end
                 as sender_document_kind
        from events""",
    "faulty": """
        select * exclude (k) replace (
          case k when 1 then '31/02/2024 10:00:00.0' when 2 then 'yesterday' else date_day end as date_day,
          case k when 3 then '12,50' when 4 then '1e400' else amount end as amount,
          case k when 5 then 'abc' else receiver_psp end as receiver_psp,
          case k when 6 then '1d' else receiver_branch_number end as receiver_branch_number,
          case k when 7 then '0x1F' else sender_psp end as sender_psp,
          case k when 8 then '9e30' else sender_branch_number end as sender_branch_number,
          case k when 9 then 'Infinity' else receiver_account_number end as receiver_account_number,
          case k when 10 then '1e30' else sender_account_number end as sender_account_number,
          case k when 11 then '1,5' else receiver_national_document_id end as receiver_national_document_id,
          case k when 12 then 'x' else sender_national_document_id end as sender_national_document_id,
          case k when 13 then 'Outra' when 14 then null when 15 then 'Geral' when 16 then 'Aporte' else operation end as operation,
          case k when 15 then null else end_to_end_id end as end_to_end_id,
          case k when 16 then null else str_pix_control_number end as str_pix_control_number)
        from (select *, cast(substr(str_pix_control_number, 4) as bigint) % 211 as k from report_raw)""",
    "judged": f"""
        select {_STAGED}, case
          when date_day is not null and try_strptime(date_day, '%d/%m/%Y %H:%M:%S.%f') is null then 'malformed date_day'
          when amount is null then 'missing amount'
          when not {_finite('amount', 9.2e16)} then 'malformed amount'
          {' '.join(f"when {name} is not null and not {_finite(name)} then 'malformed {name}'"
                    for name in ('receiver_psp', 'receiver_branch_number', 'sender_psp', 'sender_branch_number'))}
          {' '.join(f"when lower({name}) = 'infinity' or ({_is_number(name)} and not {_finite(name)}) then 'malformed {name}'"
                    for name in ('receiver_account_number', 'sender_account_number'))}
          {' '.join(f"when {name} is not null and not ({_finite(f"replace({name}, ',', '.')")} and coalesce("
                    f"try_cast(replace({name}, ',', '.') as double) % 1 = 0, false)) then 'malformed {name}'"
                    for name in ('receiver_national_document_id', 'sender_national_document_id'))}
          when status = 'Pendente' then null
          when operation is null or operation not in ('Geral', 'Devolucao', 'Aporte', 'Retirada') then 'unknown operation'
          when operation in ('Geral', 'Devolucao') and end_to_end_id is null then 'missing key id'
          when operation in ('Aporte', 'Retirada') and str_pix_control_number is null then 'missing key id' end as reject_reason
        from faulty""",
    "in_files": f"""
        select event_id, event_id % 37 = 0 as surplus, r.* replace (
          case when event_id % 31 = 0 then concat(sender_name, chr(10), 'second "line"; of ', event_id) else sender_name end as sender_name,
          case when event_id % 41 = 0 then null else status end as status,
          case when event_id % 41 = 0 then null else sender_document_kind end as sender_document_kind)
        from (select *, cast(substr(str_pix_control_number, 4) as bigint) as event_id from report_raw) r""",
    "in_archives": """
        select * from in_files where event_id % 8 <> 0 and starts_with(member, 'JDPI_RELATORIO_FINANCEIRO')""",
    "typed": f"select {_TYPED} from report_raw",
    "staged": f"select {_KEYED} from typed where not no_amount and status is distinct from 'Pendente'",
    "stored": f"""
        select {_KEYED.replace('exclude (no_amount)', 'exclude (no_amount, surplus)')}, not surplus as stored
        from (select {_TYPED}, surplus from in_archives)
        where not no_amount and status is distinct from 'Pendente'""",
    "jd": f"""
        select {_day('date_day')} as date_day, end_to_end_id, direction as operation, amount,
               pix_key, concat(pix_key, ',', {_day('date_day')}) as tx_key, 'jd' as source
        from jd_curated c
        where c.operation in ('Geral', 'Devolucao')
          and c.status not in ('RejeitadoSpiPsp', 'Rejeitado SPI Psp')""",
    "aux": f"""
        select {_day('l.utc_datetime')} as date_day, g.end_to_end_id, l.type as operation,
               case l.direction when 'TransferOut' then -1 when 'TransferIn' then 1 end * l.amount
                 as sided_amount,
               'ledger' as source
        from ledger l join gateway g on g.ledger_transfer_id = l.transfer_id
        where l.type in ('pix_in', 'pix_out')
          and {_day('l.utc_datetime')}
              between date '{CONFIG.ledger_start}' and {_AS_OF} - 1
          and l.account_id not in ({_ACCOUNTS})""",
    "tx": """
        select date_day, end_to_end_id, operation, sided_amount as amount, source,
               concat(end_to_end_id, ',', sided_amount) as pix_key,
               concat(end_to_end_id, ',', sided_amount, ',', date_day) as tx_key,
               concat(end_to_end_id, ',', date_day) as same_day_refund_ledger_key
        from aux""",
    "refunds": """
        select end_to_end_id, same_day_refund_ledger_key, cast(sum(amount) as bigint) as amount
        from tx group by all having sum(amount) = 0""",
    "net": """
        select t.* from tx t left join refunds r on r.end_to_end_id = t.end_to_end_id
        where r.end_to_end_id is null""",
    "joined": """
        select l.tx_key as l_tx_key, j.tx_key as j_tx_key,
               coalesce(l.tx_key, j.tx_key) as tx_key, coalesce(l.pix_key, j.pix_key) as pix_key,
               coalesce(l.end_to_end_id, j.end_to_end_id) as end_to_end_id,
               coalesce(l.date_day, j.date_day) as date_day,
               coalesce(l.amount, j.amount) as amount,
               coalesce(l.operation, j.operation) as operation,
               coalesce(l.source, j.source) as source,
               case when l.date_day is null or j.date_day is null then 'mismatch'
                    when l.pix_key = j.pix_key and l.date_day <> j.date_day then 'correction'
                    else 'review mismatch classification' end as mismatch_classification
        from net l full outer join jd j on l.tx_key = j.tx_key""",
    "unmatched": """
        select * exclude (l_tx_key, j_tx_key) from joined
        where l_tx_key is null or j_tx_key is null""",
    "cal": f"""
        select cast(d as date) as date_day
        from generate_series({_FIRST}, {_AS_OF} - 1, interval 1 day) s(d)""",
    "jd_daily": """
        select date_day,
               cast(sum(case when operation = 'Credito' then amount else 0 end) as bigint)
                 as amount_pix_in,
               cast(sum(case when operation = 'Debito' then amount else 0 end) as bigint)
                 as amount_pix_out
        from jd group by date_day""",
    "ledger_daily": """
        select date_day,
               cast(sum(case when operation = 'pix_in' then amount else 0 end) as bigint)
                 as amount_pix_in,
               cast(sum(case when operation = 'pix_out' then amount else 0 end) as bigint)
                 as amount_pix_out
        from tx group by date_day""",
    "unmatched_daily": "select cal.date_day, " + ", ".join(
        f"cast(coalesce(sum(case when mismatch_classification = '{label}' and operation in"
        f" ('{flow}', '{name}') then {value} else 0 end), 0) as bigint)"
        f" as {kind}_{label}_tx_{flow}"
        for flow, name in (("pix_in", "Credito"), ("pix_out", "Debito"))
        for kind, value in (("nb", "1"), ("amount", "amount"))
        for label in ("mismatch", "correction")
    ) + " from cal left join unmatched u on u.date_day = cal.date_day group by cal.date_day",
    "recon": "select cal.date_day, " + ", ".join(
        f"l.amount_{flow} as amount_ledger_{flow}, j.amount_{flow} as amount_jd_{flow}, "
        f"l.amount_{flow} - j.amount_{flow} as mismatch_amount_{flow}, "
        f"round(cast(l.amount_{flow} - j.amount_{flow} as double)"
        f" / nullif(l.amount_{flow}, 0), 6) as mismatch_{flow}, "
        f"u.nb_mismatch_tx_{flow}, u.nb_correction_tx_{flow}, "
        f"u.amount_mismatch_tx_{flow}, u.amount_correction_tx_{flow}"
        for flow in ("pix_in", "pix_out")
    ) + """ from cal
        left join ledger_daily l on l.date_day = cal.date_day
        left join jd_daily j on j.date_day = cal.date_day
        left join unmatched_daily u on u.date_day = cal.date_day""",
    "one_sided": """
        select source, pix_key, date_day, operation, amount,
               row_number() over (partition by source, pix_key
                                  order by date_day, operation, amount) as n
        from unmatched""",
}


def _gathered(relation: str, column: str) -> str:
    return (f"select * replace (case when {column} % 7 = 0 then {column} - {column} % 700 else {column} end as {column})"
            f" from ({_RELATIONS[relation]})")


def _sql(final: str, **changed: str) -> str:
    relations = ",\n".join(f"{name} as ({changed.get(name, text)})" for name, text in _RELATIONS.items())
    return f"with {relations}\n{final}"


def _plain_number(value: str) -> str:
    return (f"coalesce(regexp_replace(cast({value} as varchar), '(\\.\\d+?)0+$', '\\1'), 'nan')")


def _report_fields() -> dict[str, str]:
    fields = {"date": "cast(date_day as varchar)",
              "pix_in_dashboard_link": f"'{CONFIG.pix_in_link}'",
              "pix_out_dashboard_link": f"'{CONFIG.pix_out_link}'"}
    for flow in ("pix_in", "pix_out"):
        def reais(column: str) -> str:
            return _plain_number(
                f"cast(cast({column} // 100 as decimal(20,2)) "
                f"+ cast({column} % 100 as decimal(20,2)) * 0.01 as decimal(20,2))")

        fields[f"{flow}_daily_mismatch"] = _plain_number(
            f"cast(mismatch_{flow} * 100 as decimal(20,6))")
        fields[f"{flow}_daily_mismatch_amount"] = reais(f"mismatch_amount_{flow}")
        for label, word in (("mismatch", "mismatch"), ("correction", "correction")):
            fields[f"{flow}_nb_{word}_tx"] = f"cast(nb_{label}_tx_{flow} as varchar)"
            fields[f"{flow}_amount_{word}_tx"] = reais(f"amount_{label}_tx_{flow}")
    return fields


# The lines of the message for one flow, without its links; {} is the flow.
_FLOW_LINES = (
    "    - Daily mismatch: {{{}_daily_mismatch}}% ",
    "    - Daily mismatch amount: R${{{}_daily_mismatch_amount}}",
    "    - # mismatch transactions: {{{}_nb_mismatch_tx}}",
    "    - Amount of mismatch transactions: R${{{}_amount_mismatch_tx}}",
    "    - # corrected transactions: {{{}_nb_correction_tx}}",
    "    - Amount of corrected transactions: {{{}_amount_correction_tx}}",
)


def _message() -> str:
    """The expected text, written out here so that a changed template shows."""
    lines = ["Date: {date}"]
    for title, flow, end in (("PIX In:", "pix_in", [" ", "\n    "]), ("PIX Out:", "pix_out", ["", "\n" + " " * 12 + "\n" + " " * 12])):
        lines += [title, *(line.format(flow) for line in _FLOW_LINES),
                  f"    - Dashboard: {{{flow}_dashboard_link}}" + "".join(end)]
    return "\n".join(lines)


def _report_text() -> str:
    text = "'" + _message().replace("'", "''") + "'"
    for name, value in _report_fields().items():
        text = f"replace({text}, '{{{name}}}', {value})"
    return f"select date_day as date, {text} as text from recon"


def _report_values() -> str:
    links = {"pix_in": CONFIG.pix_in_link, "pix_out": CONFIG.pix_out_link}
    columns = ", ".join(
        f"round(mismatch_{flow} * 100, 6) as {flow}_daily_mismatch, "
        f"mismatch_amount_{flow} / 100 as {flow}_daily_mismatch_amount, "
        f"nb_mismatch_tx_{flow} as {flow}_nb_mismatch_tx, "
        f"amount_mismatch_tx_{flow} / 100 as {flow}_amount_mismatch_tx, "
        f"nb_correction_tx_{flow} as {flow}_nb_correction_tx, "
        f"amount_correction_tx_{flow} / 100 as {flow}_amount_correction_tx, "
        f"'{links[flow]}' as {flow}_dashboard_link"
        for flow in ("pix_in", "pix_out"))
    return f"select date_day as date, {columns} from recon"


_LOADED = "timestamp '2024-06-01 00:00:00' as inserted_at"
# A row with too many fields has none of its columns.
_READ = ", ".join(f"case when not surplus then {name} end as {name}" for name in REPORT_COLUMNS.values()) + """,
        case when surplus then 'expected 19 fields, saw 20' end as problem,
        case when surplus then str_pix_control_number end as lost_number"""
_CENTS = "cast(round_even(cast(amount as double) * 100, 0) as bigint)"
_UNMATCHED = ("select tx_key, pix_key, end_to_end_id, date_day, amount, operation, source,"
              " mismatch_classification from unmatched")
_LEDGER = "transfer_id, utc_datetime, type, direction, amount, account_id"

_FINAL: dict[str, str] = {
    "scan_jd": "select * from jd_curated",
    "scan_ledger": "select * from ledger",
    "scan_gateway": "select * from gateway",
    "calendar_days": f"""
        select cast(unnest(generate_series(min({_day('utc_datetime')}),
                                           max({_day('utc_datetime')}), interval 1 day)) as date)
                 as date_day
        from ledger""",
    "member_prefix_filter": """
        select member, end_to_end_id from report_raw
        where member like 'JDPI\\_RELATORIO\\_FINANCEIRO%' escape '\\'""",
    "csv_line_parse": f"select {_STAGED} from report_raw",
    "archive_rows": f"""
        select member, {_STAGED} from report_raw
        where starts_with(member, 'JDPI_RELATORIO_FINANCEIRO')""",
    "union_reports": """
        select member, end_to_end_id,
               case when member like '%0' then null else sender_document_kind end
                 as sender_document_kind,
               case when member like '%1' then 'x' end as new_column
        from report_raw""",
    "rename_columns": f"select {_STAGED} from report_raw",
    "parse_report_timestamp": "select end_to_end_id, date_day from typed",
    "amount_to_cents": f"select end_to_end_id, {_CENTS} as amount from report_raw",
    "sided_amount": f"""
        select end_to_end_id, direction,
               case when direction = 'Credito' then {_CENTS}
                    when direction = 'Debito' then -{_CENTS}
                    else cast(9999999999999 as bigint) end as amount
        from report_raw""",
    "numeric_id_default0": """
        select end_to_end_id, receiver_psp, receiver_branch_number, sender_psp,
               sender_branch_number
        from typed""",
    "coerce_account_number": """
        select end_to_end_id, receiver_account_number, sender_account_number from typed""",
    "format_document_id": """
        select end_to_end_id, receiver_national_document_id, sender_national_document_id
        from typed""",
    "null_amount_rows": f"select {_STAGED} from report_raw where amount is null",
    "drop_pending": """
        select end_to_end_id, operation, status from report_raw
        where status is null or status <> 'Pendente'""",
    "ingest_pix_key": """
        select end_to_end_id, str_pix_control_number, operation, pix_key from staged""",
    "stage_project": f"""
        select {_STAGED}, concat(end_to_end_id, ',', amount) as pix_key from report_raw""",
    "stage_report": f"select *, {_LOADED} from staged",
    "stage_rejects": f"select {_STAGED}, reject_reason from judged where reject_reason is not null",
    "stage_outcomes": """
        select case when reject_reason is not null then 'rejected' when status = 'Pendente' then 'pending' else 'staged' end as outcome,
               reject_reason, count(*) as nb_rows, count(*) filter (reject_reason is null) as nb_loaded
        from judged group by all""",
    "loose_file_rows": f"select {_READ} from in_files",
    "archive_member_rows": f"""
        select concat(event_id % 8, '.zip') as archive, member, {_READ} from in_archives
        union all by name
        select '0.zip' as archive, 'unreadable' as problem""",
    "ingest_staged": f"select * exclude (stored), {_LOADED} from stored where stored",
    "ingest_rejects": """
        select concat(event_id % 8, '.zip') as archive, member,
               case when not surplus then str_pix_control_number end as str_pix_control_number,
               case when surplus then 'expected 19 fields, saw 20' else 'missing amount' end as reason
        from in_archives where surplus or amount is null
        union all select '0.zip', null, null, 'unreadable'""",
    "ingest_counts": """
        select count(*) + 1 as read, count(*) filter (not bad and not pending) as staged, count(*) filter (bad) + 1 as rejected,
               count(*) filter (not bad and pending) as pending, count(*) filter (not bad and not pending) as held_staged,
               count(*) filter (bad) + 1 as held_rejected
        from (select surplus or amount is null as bad, coalesce(status = 'Pendente', false) as pending from in_archives)""",
    "job_curate": f"""
        select distinct * exclude (stored) replace (concat(end_to_end_id, ',', amount) as pix_key), {_LOADED} from stored where stored""",
    "append_batches": f"select *, {_LOADED} from staged",
    "preview_top5": "select * from staged order by date_day, end_to_end_id limit 5",
    "dedupe_rows": f"""
        select distinct *, {_LOADED} from (select * from staged union all select * from staged)""",
    "curate_jd": f"""
        select distinct * replace (concat(end_to_end_id, ',', amount) as pix_key), {_LOADED}
        from (select * from staged union all select * from staged)""",
    "utc_to_local_day": f"""
        select transfer_id, utc_datetime, {_day('utc_datetime')} as date_day from ledger""",
    "weekday_number": f"""
        select transfer_id, {_day('utc_datetime')} as date_day,
               cast(isodow({_day('utc_datetime')}) - 1 as integer) as weekday
        from ledger""",
    "null_skipping_concat": "select date_day, end_to_end_id, pix_key from tx",
    "jd_rejected_filter": """
        select * from jd_curated where status not in ('RejeitadoSpiPsp', 'Rejeitado SPI Psp')""",
    "jd_transactions": "select * from jd",
    "ledger_day_range": f"""
        select {_LEDGER} from ledger
        where {_day('utc_datetime')} between date '{CONFIG.ledger_start}' and {_AS_OF} - 1""",
    "exclude_accounts": f"""
        select {_LEDGER} from ledger where account_id not in ({_ACCOUNTS})""",
    "internal_transfer_filter": """
        select transfer_id, type as operation, amount from ledger
        where type <> 'pix_internal_transfer' or type is null""",
    "ledger_gateway_join": """
        select transfer_id, utc_datetime, type, end_to_end_id
        from ledger join gateway on transfer_id = ledger_transfer_id""",
    "ledger_transactions_aux": "select * from aux",
    "ledger_transactions": "select * from tx",
    "same_day_refunds": "select * from refunds",
    "ledger_net_refunds": "select * from net",
    "unmatched_transactions": _UNMATCHED,
    "match_status_counts": """
        select case when j_tx_key is null then 'ledger_only' when l_tx_key is null then 'jd_only'
                    else 'matched' end as status, count(*) as nb_rows
        from joined group by 1""",
    "corrections_intended": """
        select l.pix_key, l.date_day as ledger_date_day, j.date_day as jd_date_day, l.operation,
               l.amount, 'correction' as mismatch_classification
        from one_sided l join one_sided j on l.pix_key = j.pix_key and l.n = j.n
        where l.source = 'ledger' and j.source = 'jd' and l.date_day <> j.date_day""",
    "consolidated_jd": "select * from jd_daily",
    "consolidated_ledger": "select * from ledger_daily",
    "unmatched_daily": "select * from unmatched_daily",
    "recon_daily": "select * from recon order by date_day desc",
    "recon_daily_account_table": "select * from recon order by date_day desc",
    "recon_daily_stepwise": "select * from recon order by date_day desc",
    "recon_daily_sql": "select * from recon order by date_day desc",
    "report_days_monday": """
        select * from recon where date_day between date '1998-05-29' and date '1998-05-31'
        order by date_day""",
    "report_days_other": "select * from recon where date_day = date '1998-05-29'",
    "daily_report_values": _report_values(),
    "daily_report_text": _report_text(),
}


def all_oracles() -> dict[str, str]:
    heavy = _sql(_FINAL["recon_daily"], ledger=_gathered("ledger", "transfer_id"), gateway=_gathered("gateway", "ledger_transfer_id"))
    return {name: _sql(final) for name, final in _FINAL.items()} | {"recon_daily_heavy": heavy}
