"""Ledger, matching and daily results on hand-made rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from acerto.config import ReconConfig
from acerto.operators import daily, jd as jd_side, ledger as ledger_side, match, report
from acerto.operators.counted import collapse, replicate
from acerto.plans.reconcile import reconcile_daily, reconcile_daily_stepwise
from acerto.plans.sql import reconcile_daily_sql

CONFIG = ReconConfig(as_of=date(2021, 6, 6), excluded_accounts=(99,))
NOON = datetime(2021, 6, 1, 15)


def at(day, hour=15, month=6):
    return datetime(2021, month, day, hour)


def ledger_rows(spark, *rows):
    """(transfer, id, signed amount, day time[, account[, type[, direction]]])"""
    out, links = [], []
    for n, row in enumerate(rows):
        ident, amount, when, *rest = row
        account = rest[0] if rest else 1
        kind = rest[1] if len(rest) > 1 else ("pix_in" if amount >= 0 else "pix_out")
        direction = rest[2] if len(rest) > 2 else (
            "TransferIn" if amount >= 0 else "TransferOut")
        out.append((n, when, kind, direction, abs(amount), account))
        links.append((n, ident))
    ledger = spark.createDataFrame(
        out, "transfer_id long, utc_datetime timestamp_ntz, type string, direction string,"
             " amount long, account_id long")
    return ledger, spark.createDataFrame(links, "ledger_transfer_id long, end_to_end_id string")


def jd_rows(spark, *rows):
    """(id, signed amount, day time[, operation[, status[, direction]]])"""
    out = []
    for ident, amount, when, *rest in rows:
        direction = rest[2] if len(rest) > 2 else ("Credito" if amount >= 0 else "Debito")
        out.append((when, ident, direction, amount, rest[0] if rest else "Geral",
                    rest[1] if len(rest) > 1 else "Efetivado", f"{ident or ''},{amount}"))
    return spark.createDataFrame(
        out, "date_day timestamp_ntz, end_to_end_id string, direction string, amount long,"
             " operation string, status string, pix_key string")


def transactions(spark, *rows):
    return ledger_side.ledger_transactions(
        ledger_side.ledger_transactions_aux(*ledger_rows(spark, *rows), CONFIG))


def unmatched(spark, ledger, jd):
    return match.unmatched_counted(
        ledger_side.net_refunds_counted(transactions(spark, *ledger)),
        jd_side.jd_transactions(jd_rows(spark, *jd), CONFIG))


def recon(spark, ledger, jd):
    """Result by day, the same from all three plans."""
    inputs = (*ledger_rows(spark, *ledger), jd_rows(spark, *jd), CONFIG)
    rows = reconcile_daily(*inputs).collect()
    assert rows == reconcile_daily_stepwise(*inputs).collect()
    assert rows == reconcile_daily_sql(*inputs).collect()
    days = [r.date_day for r in rows]
    assert days == [date(2021, 6, d) for d in (5, 4, 3, 2, 1)]
    return {r.date_day.day: r for r in rows}


def test_equal_key_and_day_match(spark):
    assert unmatched(spark, [("E1", 100, NOON)], [("E1", 100, NOON)]).count() == 0
    row = recon(spark, [("E1", 100, NOON)], [("E1", 100, NOON)])[1]
    assert (row.amount_ledger_pix_in, row.amount_jd_pix_in) == (100, 100)
    assert (row.nb_mismatch_tx_pix_in, row.mismatch_pix_in) == (0, 0.0)


def test_other_day_is_two_mismatches_and_one_intended_correction(spark):
    rows = unmatched(spark, [("E1", 100, at(1))], [("E1", 100, at(2))])
    assert sorted((r.source, r.mismatch_classification) for r in rows.collect()) == [
        ("jd", "mismatch"), ("ledger", "mismatch")]
    pair = match.corrections_intended(rows).collect()
    assert [(p.pix_key, p.ledger_date_day, p.jd_date_day, p.operation) for p in pair] == [
        ("E1,100", date(2021, 6, 1), date(2021, 6, 2), "pix_in")]
    days = recon(spark, [("E1", 100, at(1))], [("E1", 100, at(2))])
    assert days[1].nb_mismatch_tx_pix_in == days[2].nb_mismatch_tx_pix_in == 1
    assert sum(r.nb_correction_tx_pix_in for r in days.values()) == 0


def test_classification_branches(spark):
    df = spark.createDataFrame(
        [(date(2021, 1, 1), None, "a", None), (date(2021, 1, 1), date(2021, 1, 2), "a", "a"),
         (date(2021, 1, 1), date(2021, 1, 1), "a", "a")],
        "l date, j date, lk string, jk string")
    found = df.select(match.classify(*[F.col(c) for c in ("l", "j", "lk", "jk")]).alias("c"))
    assert [r.c for r in found.collect()] == [
        "mismatch", "correction", "review mismatch classification"]


def test_a_refund_removes_the_id_on_all_days(spark):
    rows = [("E1", 5, at(1)), ("E1", -5, at(1)), ("E1", 7, at(2)), ("E2", 3, at(1))]
    net = ledger_side.ledger_net_refunds(transactions(spark, *rows))
    assert [r.end_to_end_id for r in net.collect()] == ["E2"]
    days = recon(spark, rows, [("E1", 7, at(2))])
    assert (days[1].amount_ledger_pix_in, days[1].amount_ledger_pix_out) == (8, -5)
    assert (days[1].nb_mismatch_tx_pix_in, days[1].nb_mismatch_tx_pix_out) == (1, 0)
    assert (days[2].nb_mismatch_tx_pix_in, days[2].amount_mismatch_tx_pix_in) == (1, 7)


def test_a_single_zero_amount_is_a_refund(spark):
    assert ledger_side.ledger_net_refunds(transactions(spark, ("E1", 0, NOON))).count() == 0
    assert recon(spark, [("E1", 0, NOON)], [])[1].nb_mismatch_tx_pix_in == 0


def test_refund_before_the_calendar_removes_later_rows(spark):
    rows = [("E1", 5, at(1, month=3)), ("E1", -5, at(1, month=3)), ("E1", 7, at(2))]
    assert recon(spark, rows, [])[2].nb_mismatch_tx_pix_in == 0


def test_missing_id_is_never_removed(spark):
    rows = [(None, 5, at(1)), (None, -5, at(1))]
    tx = transactions(spark, *rows)
    assert ledger_side.same_day_refunds(tx).count() == 1
    net = ledger_side.ledger_net_refunds(tx).collect()
    assert sorted(r.pix_key for r in net) == [",-5", ",5"]
    day = recon(spark, rows, [])[1]
    assert (day.nb_mismatch_tx_pix_in, day.nb_mismatch_tx_pix_out) == (1, 1)


def test_empty_and_missing_id_share_a_key_but_not_the_refund(spark):
    rows = [("", 5, at(1)), ("", -5, at(1)), (None, 5, at(1))]
    net = ledger_side.ledger_net_refunds(transactions(spark, *rows)).collect()
    assert [(r.end_to_end_id, r.pix_key) for r in net] == [(None, ",5")]
    day = recon(spark, rows, [])[1]
    assert (day.nb_mismatch_tx_pix_in, day.nb_mismatch_tx_pix_out) == (1, 0)
    assert recon(spark, rows, [("", 5, at(1))])[1].nb_mismatch_tx_pix_in == 0


def test_unknown_direction_counts_without_an_amount(spark):
    rows = [("E1", 5, NOON, 1, "pix_in", "Other")]
    assert transactions(spark, *rows).first().pix_key == "E1,"
    day = recon(spark, rows, [])[1]
    assert (day.nb_mismatch_tx_pix_in, day.amount_mismatch_tx_pix_in) == (1, 0)
    assert day.amount_ledger_pix_in is None and day.amount_ledger_pix_out == 0


def test_filters(spark):
    rows = [("E1", 1, at(1), 99), ("E2", 1, at(1), None), ("E3", 1, at(1), 1, "pix_internal_transfer"),
            ("E4", 1, at(6)), ("E5", 1, datetime(2020, 12, 31, 15)), ("E6", 1, at(1))]
    assert [r.end_to_end_id for r in transactions(spark, *rows).collect()] == ["E6"]
    jd = jd_rows(spark, ("E1", 1, NOON, "Aporte"), ("E2", 1, NOON, "Geral", None),
                 ("E3", 1, NOON, "Geral", "RejeitadoSpiPsp"),
                 ("E4", 1, NOON, "Geral", "Rejeitado SPI Psp"), ("E5", -1, NOON, "Devolucao"))
    found = jd_side.jd_transactions(jd, CONFIG).collect()
    assert [(r.end_to_end_id, r.operation) for r in found] == [("E5", "Debito")]


def test_account_list_as_table(spark):
    ledger, _ = ledger_rows(spark, ("E1", 1, NOON, 99), ("E2", 1, NOON, None), ("E3", 1, NOON, 1))
    listed = spark.createDataFrame([(99,), (99,)], "id long")
    assert [r.transfer_id for r in ledger_side.exclude_accounts(ledger, listed).collect()] == [2]


def test_several_links_give_several_rows(spark):
    ledger, gateway = ledger_rows(spark, ("E1", 1, NOON))
    both = gateway.unionByName(spark.createDataFrame([(0, "E2")], gateway.schema))
    assert ledger_side.ledger_transactions_aux(ledger, both, CONFIG).count() == 2


def test_local_day(spark):
    day = transactions(spark, ("E1", 1, datetime(2021, 6, 1, 2))).first()
    assert day.date_day == date(2021, 5, 31)
    assert day.tx_key == "E1,1,2021-05-31"


def test_unmatched_outside_the_calendar_vanishes(spark):
    days = recon(spark, [("E1", 1, at(31, month=5))], [("E2", 1, at(31, month=5)), ("E3", 1, at(20))])
    assert sum(r.nb_mismatch_tx_pix_in for r in days.values()) == 0


def test_days_without_rows(spark):
    day = recon(spark, [("E1", 1, at(1))], [])[3]
    assert day.amount_ledger_pix_in is None and day.amount_jd_pix_in is None
    assert day.nb_mismatch_tx_pix_in == 0 and day.amount_mismatch_tx_pix_out == 0


def test_ratio_without_ledger_total(spark):
    day = recon(spark, [("E1", -4, at(1))], [("E1", -4, at(1)), ("E2", 5, at(1))])[1]
    assert day.mismatch_pix_in is None and day.mismatch_amount_pix_in == -5
    assert day.mismatch_pix_out == 0.0


def test_unknown_provider_direction(spark):
    day = recon(spark, [], [("E1", 5, NOON, "Geral", "Efetivado", "?"),
                            ("E2", 6, NOON, "Geral", "Efetivado", "pix_in")])[1]
    assert (day.amount_jd_pix_in, day.nb_mismatch_tx_pix_in, day.amount_mismatch_tx_pix_in) == (
        0, 1, 6)


def test_status_counts_and_repeated_keys(spark):
    ledger = [("E1", 1, NOON)] * 3 + [("E2", 1, NOON)] * 2
    jd = [("E1", 1, NOON)] * 4 + [("E3", 1, NOON)]
    net = ledger_side.net_refunds_counted(transactions(spark, *ledger))
    other = jd_side.jd_transactions(jd_rows(spark, *jd), CONFIG)
    counts = {r.status: r.nb_rows for r in match.match_status_counts(net, other).collect()}
    assert counts == {"matched": 12, "ledger_only": 2, "jd_only": 1}
    rows = match.unmatched_transactions(net, other).collect()
    assert sorted(r.end_to_end_id for r in rows) == ["E2", "E2", "E3"]


def test_corrections_pair_in_order(spark):
    ledger = [("E1", 1, at(1))] * 2 + [("E1", 1, at(3))] * 3
    jd = [("E1", 1, at(2))] * 4 + [("E1", 1, at(4))] * 3 + [("E9", 1, at(2))]
    pairs = match.corrections_intended(unmatched(spark, ledger, jd)).collect()
    assert sorted((p.ledger_date_day.day, p.jd_date_day.day) for p in pairs) == [
        (1, 2), (1, 2), (3, 2), (3, 2), (3, 4)]


@pytest.mark.parametrize("chunk", [1, 2, 3, 100])
def test_replicate_undoes_collapse(spark, chunk):
    df = spark.createDataFrame([("a", None)] * 7 + [("b", 1)], "x string, y int")
    back = replicate(collapse(df), chunk)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_hot_keys(spark):
    """A third of all rows under one id, and a third under none, against plain counting."""
    ledger = ([("HOT", 1 + n % 40, at(1 + n % 5)) for n in range(400)]
              + [(None, 1 + n % 40, at(1 + n % 5)) for n in range(400)]
              + [(f"E{n}", n + 1, at(1 + n % 5)) for n in range(400)])
    jd = ([("HOT", 1 + n % 30, at(1 + n % 5)) for n in range(400)]
          + [(f"E{n}", n + 1, at(1 + n % 5)) for n in range(0, 400, 2)])
    left = {(i, a, d.day) for i, a, d in ledger if i}
    right = {(i, a, d.day) for i, a, d in jd}
    expected = {day: sum(1 for i, a, d in ledger if d.day == day and (i, a, d.day) not in right)
                + sum(1 for i, a, d in jd if d.day == day and (i, a, d.day) not in left)
                for day in range(1, 6)}
    days = recon(spark, ledger, jd)
    assert {d: r.nb_mismatch_tx_pix_in for d, r in days.items()} == expected
    assert unmatched(spark, ledger, jd).agg(F.sum("copies")).first()[0] == sum(expected.values())


def test_rows_balance(spark):
    """Net ledger and removed rows make the ledger; matched and unmatched make each side."""
    rows = [(f"E{n % 50}", (n % 7) - 3, at(1 + n % 5)) for n in range(200)]
    tx = transactions(spark, *rows)
    refunded = ledger_side.same_day_refunds(tx).select("end_to_end_id")
    removed = tx.join(refunded, "end_to_end_id", "left_semi").count()
    assert ledger_side.ledger_net_refunds(tx).count() + removed == tx.count() == 200


def test_calendar_defaults_to_today(spark):
    last = daily.calendar(spark, ReconConfig()).agg(F.max("date_day")).first()[0]
    assert last == spark.sql("select date_sub(current_date(), 1)").first()[0]


@pytest.mark.parametrize("as_of, days", [
    (date(2021, 6, 7), [4, 5, 6]), (date(2021, 6, 5), [4]), (date(2021, 6, 8), [7])])
def test_report_days(spark, as_of, days):
    table = spark.sql("select explode(sequence(date'2021-06-01', date'2021-06-20')) as date_day")
    found = report.report_days(table, ReconConfig(as_of=as_of)).collect()
    assert [r.date_day.day for r in found] == days


def test_report_text(spark):
    row = spark.sql("""
        select date'2021-06-01' as date_day, 0.012345D as mismatch_pix_in,
               1000000000L as mismatch_amount_pix_in, 2L as nb_mismatch_tx_pix_in,
               -1205L as amount_mismatch_tx_pix_in, 0L as nb_correction_tx_pix_in,
               0L as amount_correction_tx_pix_in, cast(null as double) as mismatch_pix_out,
               cast(null as bigint) as mismatch_amount_pix_out, 0L as nb_mismatch_tx_pix_out,
               -7L as amount_mismatch_tx_pix_out, 0L as nb_correction_tx_pix_out,
               10L as amount_correction_tx_pix_out""")
    config = ReconConfig(pix_in_link="http://in", pix_out_link="http://out")
    text = report.report_text(row, config).first().text
    assert text.splitlines()[:9] == [
        "Date: 2021-06-01", "PIX In:", "    - Daily mismatch: 1.2345% ",
        "    - Daily mismatch amount: R$10000000.0", "    - # mismatch transactions: 2",
        "    - Amount of mismatch transactions: R$-12.05", "    - # corrected transactions: 0",
        "    - Amount of corrected transactions: 0.0", "    - Dashboard: http://in "]
    assert "    - Daily mismatch: nan% \n    - Daily mismatch amount: R$nan\n" in text
    assert "R$-0.07" in text and text.endswith("http://out\n            \n            ")
    values = report.report_values(row, config).first()
    assert (values.pix_in_daily_mismatch, values.pix_in_amount_mismatch_tx) == (1.2345, -12.05)


def test_many_hot_rows_are_spread(spark):
    counted = spark.range(300).selectExpr("id", "50L as copies")
    found = replicate(counted, chunk=10).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in found) == 15_000 and len(found) > 1
