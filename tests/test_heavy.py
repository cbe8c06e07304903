"""Transfers with many rows and links, excluded accounts as a table, values in the SQL text."""

import random
import time
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest

from acerto.config import ReconConfig
from acerto.operators.ledger import heavy_transfers, signed_rows
from acerto.plans.reconcile import (
    heavy_days,
    heavy_groups,
    heavy_links,
    reconcile_daily,
    reconcile_daily_stepwise,
    removed_ids,
    transfer_sums,
)
from acerto.plans.sql import recon_daily_text, reconcile_daily_sql

CONFIG = ReconConfig(as_of=date(2021, 6, 12), calendar_start=date(2021, 6, 1), ledger_start=date(2021, 5, 28), zone="UTC")
LEDGER = "transfer_id long, utc_datetime timestamp_ntz, type string, direction string, amount long, account_id long"
GATEWAY = "ledger_transfer_id long, end_to_end_id string"
JD = "date_day timestamp_ntz, end_to_end_id string, direction string, amount long, operation string, status string, pix_key string"


def tables(spark, seed):
    pick = random.Random(seed)
    ids = ["a", "b", "c,1", "d", "", None]

    def moment():
        return datetime(2021, 5, 27) + timedelta(hours=pick.randint(0, 24 * 17))

    ledger = [(pick.choice([1, 1, 2, 3, 4, None]), moment(), pick.choice(["pix_in", "pix_out", "other"]),
               pick.choice(["TransferIn", "TransferOut", "TransferIn", "?"]), pick.choice([1, 2, 5, 5, 0, None]), pick.choice([7, 7, 8, None]))
              for _ in range(120)]
    gateway = [(pick.choice([1, 1, 2, 3, 5, None]), pick.choice(ids)) for _ in range(25)]
    jd = []
    for _ in range(80):
        ident, amount = pick.choice(ids), pick.choice([1, -1, 2, 5, -5, 0, None])
        key = pick.choice([f"{ident or ''},{'' if amount is None else amount}", None, "", "no comma", ","])
        jd.append((moment(), ident, pick.choice(["Credito", "Debito", "?"]), amount, pick.choice(["Geral", "Devolucao", "Aporte"]),
                   pick.choice(["Efetivado", "Efetivado", None]), key))
    return [spark.createDataFrame(rows, schema) for rows, schema in ((ledger, LEDGER), (gateway, GATEWAY), (jd, JD))]


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("seed", range(6))
def test_counting_pairs_equals_forming_them(spark, seed):
    inputs = tables(spark, seed)
    formed = rows(reconcile_daily(*inputs, CONFIG, heavy=None))
    assert formed == rows(reconcile_daily_stepwise(*inputs, CONFIG))
    for least in (0, 1, 4, 1000):
        assert rows(reconcile_daily(*inputs, CONFIG, heavy=least)) == formed


def test_only_transfers_with_many_of_both_are_heavy(spark):
    ledger = spark.sql("select explode(flatten(array(repeat_1, array(2L, 3L, 3L, 3L)))) as transfer_id from (select array(1L, 1L, 1L, null, null, null) as repeat_1)")
    gateway = spark.sql("select explode(array(1L, 1L, 1L, 2L, 2L, 2L, 3L, null, null, null)) as ledger_transfer_id, 'x' as end_to_end_id")
    assert rows(heavy_transfers(ledger, gateway, 2)) == [(1,)]
    assert heavy_transfers(ledger, gateway, 3) is None


def test_ten_thousand_rows_and_links_make_no_pairs(spark):
    ledger = spark.range(10_000).selectExpr(
        "1L as transfer_id", "timestamp_ntz'2021-06-01' + make_dt_interval(cast(id % 10 as int)) as utc_datetime", "'pix_in' as type",
        "'TransferIn' as direction", "id + 1 as amount", "7L as account_id")
    gateway = spark.range(10_000).selectExpr("1L as ledger_transfer_id", "concat('E', id) as end_to_end_id")
    # The provider has one pair of each id on the right day, and one on another day.
    jd = spark.range(10_000).selectExpr(
        "timestamp_ntz'2021-06-01' + make_dt_interval(cast((id + if(id % 2 = 0, 0, 1)) % 10 as int)) as date_day", "concat('E', id) as end_to_end_id",
        "'Credito' as direction", "id + 1 as amount", "'Geral' as operation", "'Efetivado' as status", "concat('E', id, ',', id + 1) as pix_key")
    began = time.time()
    found = reconcile_daily(ledger, gateway, jd, CONFIG)
    days = {r.date_day.day: r for r in found.collect() if r.date_day.day <= 10}
    assert time.time() - began < 60
    for day, r in days.items():
        own = [i for i in range(10_000) if i % 10 == day - 1]
        matched = [i for i in own if i % 2 == 0]
        moved = [i for i in range(10_000) if i % 2 == 1 and (i + 1) % 10 == day - 1]
        assert r.amount_ledger_pix_in == 10_000 * sum(i + 1 for i in own)
        assert r.nb_mismatch_tx_pix_in == 10_000 * len(own) - len(matched) + len(moved)
        assert r.amount_mismatch_tx_pix_in == (10_000 * sum(i + 1 for i in own) - sum(i + 1 for i in matched)
                                               + sum(i + 1 for i in moved))


@pytest.mark.parametrize("seed", range(4))
def test_ids_of_one_heavy_transfer_share_their_sums(spark, seed):
    pick = random.Random(seed)
    moment = lambda: datetime(2021, 5, 30) + timedelta(days=pick.randint(0, 6))
    ledger = [(pick.choice([1, 2, 3]), moment(), pick.choice(["pix_in", "pix_out"]), pick.choice(["TransferIn", "TransferOut"]), pick.choice([1, 2, 5, None]), 7)
              for _ in range(60)]
    gateway = ([(t, f"{t}-{i}") for t in (1, 2, 3) for i in range(6) for _ in range(pick.randint(1, 2))]
               + [(t, None) for t in (1, 1, 3)] + [(1, "both"), (2, "both"), (4, "1-0"), (None, "2-0"), (3, "")])
    jd = [(moment(), None, "Credito", amount, "Geral", "Efetivado", f"{ident or ''},{amount}")
          for ident in ("1-0", "1-1", "2-0", "3-2", "both", None, "x") for amount in (1, -2, 5) for _ in range(2)]
    inputs = [spark.createDataFrame(found, schema) for found, schema in ((ledger, LEDGER), (gateway, GATEWAY), (jd, JD))]
    formed = rows(reconcile_daily(*inputs, CONFIG, heavy=None))
    assert formed == rows(reconcile_daily_stepwise(*inputs, CONFIG))
    for least in (0, 4):
        assert rows(reconcile_daily(*inputs, CONFIG, heavy=least)) == formed


def test_links_of_a_heavy_transfer_do_not_meet_its_days(spark):
    """Ids without another transfer are one row at most each, however many days their transfer has."""
    day = "timestamp_ntz'2021-06-01' + make_dt_interval(cast(id % 10 as int))"
    ledger = spark.range(200).selectExpr("1L as transfer_id", f"{day} as utc_datetime", "'pix_in' as type",
                                         "if(id % 20 < 10, 'TransferIn', 'TransferOut') as direction", "5L as amount", "7L as account_id")
    signed = signed_rows(ledger, CONFIG)
    gateway = spark.range(300).selectExpr("if(id < 299, 1L, 2L) as ledger_transfer_id", "concat('E', id % 298) as end_to_end_id")
    heavy = spark.range(1, 2).toDF("transfer_id")
    links, days = heavy_links(gateway, heavy), heavy_days(heavy_groups(signed, heavy))
    alone = links.filter("alone")
    assert sorted(r.end_to_end_id for r in links.filter("not alone").collect()) == ["E1"]
    assert (alone.count(), days.count(), transfer_sums(days, alone).count()) == (297, 10, 10)
    assert removed_ids(days, alone).count() == 297


def test_excluded_accounts_in_all_forms(spark):
    inputs = tables(spark, 11)
    listed = replace(CONFIG, excluded_accounts=(8, 9))
    table = replace(CONFIG, excluded_accounts=spark.createDataFrame([(8,), (9,), (None,), (8,)], "acct long"))
    expected = rows(reconcile_daily(*inputs, listed))
    assert expected != rows(reconcile_daily(*inputs, CONFIG))
    for config in (listed, table):
        for form in (reconcile_daily, reconcile_daily_stepwise, reconcile_daily_sql):
            assert rows(form(*inputs, config)) == expected
    nothing = replace(CONFIG, excluded_accounts=spark.createDataFrame([(None,)], "acct long"))
    assert rows(reconcile_daily_sql(*inputs, nothing)) == rows(reconcile_daily(*inputs, CONFIG))


def test_values_are_quoted_in_the_text(spark):
    ledger, gateway, jd = tables(spark, 12)
    odd = "it's {in}\\"
    changed = ledger.replace("TransferIn", odd, "direction")
    config = replace(CONFIG, direction_in=odd, excluded_accounts=("8", "{x}"))
    as_text = changed.withColumn("account_id", changed.account_id.cast("string"))
    assert rows(reconcile_daily_sql(as_text, gateway, jd, config)) == rows(reconcile_daily(as_text, gateway, jd, config))
    with pytest.raises(Exception, match="(?i)zone|quoted|region"):
        reconcile_daily_sql(ledger, gateway, jd, replace(CONFIG, zone="x') or ('1' = '1")).collect()


def test_text_and_plan_take_the_day_of_the_zone(spark):
    config = ReconConfig(zone="Pacific/Kiritimati")
    assert "to_date(convert_timezone('Pacific/Kiritimati', localtimestamp()))" in recon_daily_text(config)
    text = "select to_date(convert_timezone('Pacific/Kiritimati', localtimestamp())) as day"
    assert spark.sql(text).first().day == spark.range(1).select(config.as_of_day().alias("day")).first().day
