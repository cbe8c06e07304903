"""The daily reconciliation, from the three tables to the 17-column result.

``reconcile_daily`` is the plan to run at scale. ``reconcile_daily_stepwise``
chains the operators one by one; both give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acerto.config import ReconConfig
from acerto.functions import pix_key
from acerto.operators import daily, jd as jd_side, ledger as ledger_side, match
from acerto.operators.daily import FLOWS, JD_OPERATION, UNMATCHED_MEASURES
from acerto.sources.scratch import new_folder, until_end


def reconcile_daily_stepwise(ledger: DataFrame, gateway: DataFrame, jd: DataFrame,
                             config: ReconConfig) -> DataFrame:
    transactions = ledger_side.ledger_transactions(
        ledger_side.ledger_transactions_aux(ledger, gateway, config))
    reported = jd_side.jd_transactions(jd, config)
    unmatched = match.unmatched_counted(
        ledger_side.net_refunds_counted(transactions), reported)
    days = daily.calendar(ledger.sparkSession, config)
    return daily.recon_daily(
        days,
        daily.consolidated_ledger(transactions),
        daily.consolidated_jd(reported),
        daily.unmatched_daily(days, unmatched))


def reconcile_daily(ledger: DataFrame, gateway: DataFrame, jd: DataFrame,
                    config: ReconConfig, heavy: int | None = 100) -> DataFrame:
    """Daily result from one read of each table and, but for the gateway link, no join.

    1. Both sides meet in one aggregation on (pix_key, day): a key is unmatched
       when one side's count is 0. Copies combine before the shuffle and no
       pairs are formed.
    2. Whether a ledger id is removed by a same-day refund is not known there
       yet, so each key contributes its measures for both cases. These are sums,
       so they add up per (id, day).
    3. An id is removed if any of its days nets to zero. The window that spreads
       this over the id's days sees one row per day, however many transactions
       the id has.
    4. The fitting case is picked and summed per calendar day.

    The gateway link pairs the rows and the links of a transfer. Of transfers with more than ``heavy`` of both, the pairs
    are not formed but counted (``transfer_sums``, ``heavy_sums``); whether there are any is looked up by a job when this is called, unless
    ``heavy`` is None. If there are, their links are then written to a table.
    """
    signed = ledger_side.signed_rows(ledger, config)
    reported = jd_side.jd_transactions(
        jd_side_window(jd, config), config).filter(daily.in_calendar(config))
    found = None if heavy is None else ledger_side.heavy_transfers(ledger, gateway, heavy)
    if found is None:
        per_day = pick_case(per_id_day(per_key(ledger_side.linked_rows(signed, gateway), reported)))
    else:
        light = ledger_side.linked_rows(signed.join(found, "transfer_id", "left_anti"), gateway)
        groups, links = heavy_groups(signed, found), heavy_links(gateway, found)
        keys = per_key(light, reported, heavy_matches(groups, links, reported))
        by_day, alone, shared = heavy_days(groups), links.filter("alone"), links.filter("not alone")
        own = heavy_sums(by_day, shared).unionByName(removed_ids(by_day, alone), allowMissingColumns=True)
        per_day = pick_case(per_id_day(keys, own)).unionByName(transfer_sums(by_day, alone))
    days = daily.calendar(ledger.sparkSession, config)
    filled = daily.fill_days(days, per_day.filter(daily.in_calendar(config)),
                             defaults=UNMATCHED_MEASURES)
    return daily.with_differences(filled)


def heavy_groups(signed: DataFrame, heavy: DataFrame) -> DataFrame:
    """Equal ledger rows of heavy transfers, counted in ``n``."""
    return signed.join(heavy, "transfer_id", "left_semi").groupBy(*signed.columns).agg(F.count("*").alias("n"))


def heavy_links(gateway: DataFrame, heavy: DataFrame) -> DataFrame:
    """Equal links of heavy transfers, counted in ``m``, as a written table. ``alone`` if their id is missing or has no link to another transfer."""
    links = gateway.select(F.col("ledger_transfer_id").alias("transfer_id"), "end_to_end_id")
    several = (links.groupBy("end_to_end_id").agg((F.min("transfer_id") != F.max("transfer_id")).alias("several"))
               .filter("several and end_to_end_id is not null"))
    counted = links.join(heavy, "transfer_id", "left_semi").groupBy(*links.columns).agg(F.count("*").alias("m"))
    spark = gateway.sparkSession
    path = new_folder(spark, "heavy-links")
    counted.join(several, "end_to_end_id", "left").select(*counted.columns, F.isnull("several").alias("alone")).write.parquet(path)
    return spark.read.parquet(until_end(spark, path))


def heavy_days(groups: DataFrame) -> DataFrame:
    """The rows of heavy transfers summed per day, and whether the transfer nets to zero on any day (``removed``)."""
    per_day = groups.groupBy("transfer_id", "date_day").agg(
        F.expr("sum(sided_amount * n)").alias("amount"),
        *_per_flow("sum(if(operation = '{flow}', n, 0L)) as rows_{flow}",
                   "sum(if(operation = '{flow}', sided_amount * n, 0L)) as total_{flow}"))
    return per_day.select("*", F.expr("coalesce(max(amount = 0) over (partition by transfer_id), false) as removed"))


def heavy_sums(per_day: DataFrame, links: DataFrame) -> DataFrame:
    """The (id, day) sums of heavy transfers as if no pair had a partner on the provider's side.

    A link meets a row for each day, not each row. What ``heavy_matches`` finds is taken off by its key. Meant for ids
    that need their days by themselves, as other transfers add to them.
    """
    return links.join(per_day, "transfer_id").select(
        F.col("end_to_end_id").alias("ledger_id"), "date_day",
        *_exprs("if(end_to_end_id is not null, amount * m, null) as net_amount"),
        *_per_flow("total_{flow} * m as amount_ledger_{flow}", "cast(null as bigint) as amount_jd_{flow}",
                   "rows_{flow} * m as kept_nb_{flow}", "coalesce(total_{flow} * m, 0L) as kept_amount_{flow}",
                   "if(end_to_end_id is null, rows_{flow} * m, 0L) as removed_nb_{flow}",
                   "if(end_to_end_id is null, coalesce(total_{flow} * m, 0L), 0L) as removed_amount_{flow}"))


def transfer_sums(per_day: DataFrame, alone: DataFrame) -> DataFrame:
    """The daily measures of heavy transfers' ids without another transfer, in the columns of ``pick_case``.

    All of a transfer's ids net to zero on the same days, so they are removed or kept together, and links are
    counted per transfer before they meet its days. Rows without an id are always kept.
    """
    links = alone.groupBy("transfer_id").agg(*_exprs(
        "sum(m) as m", "sum(if(end_to_end_id is null, m, 0L)) as no_id_m"))
    return links.join(per_day, "transfer_id").select("date_day", *_per_flow(
        "total_{flow} * m as amount_ledger_{flow}", "cast(null as bigint) as amount_jd_{flow}",
        "rows_{flow} * if(removed, no_id_m, m) as nb_mismatch_tx_{flow}", "0L as nb_correction_tx_{flow}",
        "coalesce(total_{flow} * if(removed, no_id_m, m), 0L) as amount_mismatch_tx_{flow}", "0L as amount_correction_tx_{flow}"))


def removed_ids(per_day: DataFrame, alone: DataFrame) -> DataFrame:
    """The ids of ``transfer_sums`` that are removed, as a net amount of zero on no day: it reaches their keys, and no day of the result."""
    removed = per_day.filter("removed").select("transfer_id").distinct()
    return alone.filter("end_to_end_id is not null").join(removed, "transfer_id", "left_semi").select(
        F.col("end_to_end_id").alias("ledger_id"), *_exprs("cast(null as date) as date_day", "0L as net_amount"))


def heavy_matches(groups: DataFrame, links: DataFrame, reported: DataFrame) -> DataFrame:
    """The pairs of heavy transfers whose key the provider has on their day, as ledger rows for ``per_key`` that stand for ``n * m`` each.

    The provider's keys are taken apart at their last comma, as an amount has none: their id finds the links, and their
    amount and day the ledger rows. So pairs come from keys, and there are no more than keys and transfers of an id.
    """
    key = F.coalesce("pix_key", F.lit(""))
    parts = reported.select(key.alias("pix_key"), "date_day").distinct().filter("contains(pix_key, ',')").select(
        "pix_key", "date_day", F.regexp_extract("pix_key", "(?s)^(.*),[^,]*$", 1).alias("_id"),
        F.regexp_extract("pix_key", "[^,]*$", 0).alias("_amount"))
    by_id = parts.join(links.withColumn("_id", F.coalesce("end_to_end_id", F.lit(""))), "_id")
    rows = groups.withColumn("_amount", F.coalesce(F.col("sided_amount").cast("string"), F.lit("")))
    pairs = by_id.join(rows, ["transfer_id", "date_day", "_amount"]).select(
        "pix_key", "date_day", "end_to_end_id", "operation", "sided_amount", F.expr("n * m as pairs"))
    return pairs.select(
        "pix_key", "date_day", *_exprs("end_to_end_id as ledger_id", "sided_amount as amount"),
        *_per_flow("if(operation = '{flow}', pairs, 0L) as ledger_{flow}",
                   "if(operation = '{flow}' and end_to_end_id is null, pairs, 0L) as no_id_{flow}",
                   "if(operation = '{flow}', pairs, 0L) as heavy_{flow}",
                   "if(operation = '{flow}' and end_to_end_id is null, pairs, 0L) as heavy_no_id_{flow}"))


def jd_side_window(jd: DataFrame, config: ReconConfig) -> DataFrame:
    """Raw time range around the calendar, a day wider than needed, for the file scan.

    Reports outside the calendar reach no day of the result.
    """
    raw = F.col("date_day")
    earliest = F.date_sub(F.lit(config.calendar_start), 1).cast("timestamp_ntz")
    latest = F.date_add(config.as_of_day(), 1).cast("timestamp_ntz")
    return jd.filter((raw >= earliest) & (raw < latest))


def per_key(transactions: DataFrame, reported: DataFrame, matches: DataFrame | None = None) -> DataFrame:
    """One row per (pix_key, day): what each side holds there.

    Ledger rows of a key share one amount, as the key spells it out, so counts
    and that amount say it all. ``no_id_*`` counts those without an id, which no
    refund removes. Provider keys are taken as given, so their amounts are summed. ``heavy_*`` counts the ledger rows
    among these that stand for pairs of heavy transfers (``matches``).
    """
    key = pix_key(F.col("end_to_end_id"), F.col("sided_amount"))
    ledger_rows = transactions.select(
        key.alias("pix_key"), "date_day",
        *_exprs("end_to_end_id as ledger_id", "sided_amount as amount"),
        *_per_flow("cast(operation = '{flow}' as bigint) as ledger_{flow}",
                   "cast(operation = '{flow}' and end_to_end_id is null as bigint)"
                   " as no_id_{flow}"))
    jd_rows = reported.select(
        *_exprs("coalesce(pix_key, '') as pix_key", "date_day", "1L as jd_rows"),
        *_per_flow(
            "cast(operation in ('{flow}', '{jd}') as bigint) as jd_{flow}",
            "if(operation in ('{flow}', '{jd}'), amount, null) as jd_amount_{flow}",
            "if(operation = '{jd}', amount, 0L) as jd_total_{flow}"))
    both = ledger_rows.unionByName(jd_rows, allowMissingColumns=True)
    counts = ["ledger", "no_id", "jd", "jd_amount"]
    if matches is not None:
        both = both.unionByName(matches, allowMissingColumns=True)
        counts += ["heavy", "heavy_no_id"]
    # Provider totals stay NULL without rows; counts read 0.
    return both.groupBy("pix_key", "date_day").agg(
        *_exprs("max(ledger_id) as ledger_id", "max(amount) as amount",
                "coalesce(sum(jd_rows), 0) as jd_rows"),
        *_per_flow(*[f"coalesce(sum({n}_{{flow}}), 0) as {n}_{{flow}}"
                     for n in counts],
                   "sum(jd_total_{flow}) as jd_total_{flow}"))


_ID_DAY_SUMS = ("net_amount",) + tuple(
    f"{name}_{flow}" for flow in FLOWS
    for name in ("amount_ledger", "amount_jd", "kept_nb", "kept_amount",
                 "removed_nb", "removed_amount"))


def per_id_day(keys: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    """One row per (ledger id, day): net amount, totals, and the unmatched measures of each case.

    "Kept" counts all ledger rows of the key, "removed" only those without an id. ``heavy`` has the sums of heavy
    transfers with every pair unmatched; the pairs among the keys are then taken off and not counted again.
    """
    if heavy is not None:
        # Every key of such a pair is matched, so it adds nothing itself.
        keys = keys.select("*", *_per_flow("ledger_{flow} - heavy_{flow} as own_{flow}", "no_id_{flow} - heavy_no_id_{flow} as own_no_id_{flow}"))
        own, own_no_id = "own_{flow}", "own_no_id_{flow}"
        off = {"kept_nb": " - heavy_{flow}", "kept_amount": " - coalesce(heavy_{flow} * amount, 0L)",
               "removed_nb": " - heavy_no_id_{flow}", "removed_amount": " - coalesce(heavy_no_id_{flow} * amount, 0L)"}
    else:
        own, own_no_id, off = "ledger_{flow}", "no_id_{flow}", {}

    def measure(name: str, test: str, value: str) -> str:
        text = f"if({test} = 0 or jd_rows = 0, {value}, null)"
        return f"coalesce({text}, 0L){off[name]} as {name}_{{flow}}" if off else f"{text} as {name}_{{flow}}"

    def both(template: str) -> str:
        return " + ".join(template.format(flow=flow) for flow in FLOWS)

    sided = keys.select(
        "*", *_exprs("ledger_pix_in + ledger_pix_out as ledger_rows",
                     "no_id_pix_in + no_id_pix_out as no_id_rows",
                     f"{both(own)} as own_rows", f"{both(own_no_id)} as own_no_id_rows"))
    measured = sided.select(
        "ledger_id", "date_day",
        *_exprs("if(own_rows > own_no_id_rows, amount * (own_rows - own_no_id_rows), null)"
                " as net_amount"),
        *_per_flow(
            f"case when amount is not null then amount * {own}"
            f" when own_rows > {own} then 0L end as amount_ledger_{{flow}}",
            "jd_total_{flow} as amount_jd_{flow}",
            measure("kept_nb", "ledger_rows", "ledger_{flow} + jd_{flow}"),
            measure("kept_amount", "ledger_rows", "coalesce(ledger_{flow} * amount, 0L) + jd_amount_{flow}"),
            measure("removed_nb", "no_id_rows", "no_id_{flow} + jd_{flow}"),
            measure("removed_amount", "no_id_rows", "coalesce(no_id_{flow} * amount, 0L) + jd_amount_{flow}")))
    if heavy is not None:
        measured = measured.unionByName(heavy)
    return measured.groupBy("ledger_id", "date_day").agg(
        *_exprs(*[f"sum({name}) as {name}" for name in _ID_DAY_SUMS]))


def pick_case(id_days: DataFrame) -> DataFrame:
    """The daily measures with refunded ids removed from the ledger side.

    Every unmatched row has a side missing and is therefore a mismatch; the
    correction measures are 0.
    """
    flagged = id_days.select(
        "*", F.expr("coalesce(max(net_amount = 0) over (partition by ledger_id), false)"
                    " as removed"))
    return flagged.select(
        "date_day",
        *_per_flow(
            "amount_ledger_{flow}", "amount_jd_{flow}",
            "if(removed, removed_nb_{flow}, kept_nb_{flow}) as nb_mismatch_tx_{flow}",
            "0L as nb_correction_tx_{flow}",
            "if(removed, removed_amount_{flow}, kept_amount_{flow})"
            " as amount_mismatch_tx_{flow}",
            "0L as amount_correction_tx_{flow}"))


def _exprs(*texts: str) -> list[Column]:
    return [F.expr(text) for text in texts]


def _per_flow(*templates: str) -> list[Column]:
    """Each expression once per flow, with ``{flow}`` and the provider's name ``{jd}`` filled in."""
    return _exprs(*[t.format(flow=flow, jd=JD_OPERATION[flow])
                    for flow in FLOWS for t in templates])
