"""Shape of the physical plans."""

from datetime import date

import pytest

import __spark_entry__ as driver
from acerto.config import ReconConfig
from acerto.operators import ledger as ledger_side, staging
from acerto.plans import mapping
from acerto.plans.queries import all_queries
from acerto.plans.reconcile import reconcile_daily


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_cross_joins_and_no_row_udfs(spark, sf_dir, name):
    text = plan_text(driver.queries()[name](spark, sf_dir))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                 "ArrowEvalPython"):
        assert word not in text
    assert ("MapInArrow" in text) == (name in ("archive_rows", "archive_member_rows", "loose_file_rows"))


def test_daily_reads_each_table_once_and_joins_once(spark, sf_dir):
    text = plan_text(driver.queries()["recon_daily"](spark, sf_dir)).split("Initial Plan")[0]
    assert text.count("FileScan") == 3  # orders for both sides, lineitem for the links
    assert text.count("Join") == 1


def test_refund_removal_reuses_the_ledger_shuffle(spark, sf_dir):
    df = ledger_side.net_refunds_counted(
        driver.queries()["ledger_transactions"](spark, sf_dir))
    assert "ReusedExchange" in final_plan(df)


def test_ledger_dates_reach_the_scan(spark, tmp_path, sf_dir):
    for name in ("ledger", "gateway", "jd_curated"):
        getattr(mapping, name)(spark, sf_dir).write.parquet(str(tmp_path / name))
    tables = [spark.read.parquet(str(tmp_path / n)) for n in ("ledger", "gateway", "jd_curated")]
    text = reconcile_daily(*tables, mapping.CONFIG)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(utc_datetime,1996-12-31T00:00)" in text
    assert "LessThan(utc_datetime,1998-06-02T00:00)" in text
    assert "In(type, [pix_in,pix_out])" in text
    assert "GreaterThanOrEqual(date_day,1997-05-31T00:00)" in text
    assert "In(operation, [Devolucao,Geral])" in text or "In(operation, [Geral,Devolucao])" in text


def test_default_day_also_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "ledger")
    spark.sql("select 1L as transfer_id, timestamp_ntz'2021-06-01 15:00:00' as utc_datetime"
              ).write.parquet(path)
    found = ledger_side.ledger_day_range(
        spark.read.parquet(path), ReconConfig(ledger_start=date(2021, 1, 1)))
    assert "LessThan(utc_datetime," in plan_text(found) and found.count() == 1


def test_staging_does_not_shuffle(spark, sf_dir):
    report = mapping.report(spark, sf_dir)
    for df in (staging.stage_report(report), staging.stage_rejects(report),
               staging.staged_or_rejected(report)):
        assert "Exchange" not in plan_text(df)
