"""Report values at their edges."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from acerto import functions as fn
from acerto.functions import numbers
from acerto.operators import staging
from acerto.schemas import REPORT_COLUMNS, STAGED_COLUMNS, STAGED_SCHEMA

NAMES = list(REPORT_COLUMNS.values())
ROW = {
    "date_day": "01/06/2021 09:11:12.123456", "operation": "Geral", "end_to_end_id": "E1",
    "end_to_end_id_original": None, "str_pix_control_number": "S1", "direction": "Credito",
    "amount": "1.00", "receiver_psp": "1", "receiver_branch_number": "2",
    "receiver_account_number": "3", "receiver_national_document_id": "4", "receiver_name": "a",
    "sender_psp": "5", "sender_branch_number": "6", "sender_account_number": "7",
    "sender_national_document_id": "8", "sender_name": "b", "status": "Efetivado",
    "sender_document_kind": "MANUAL",
}


def report(spark, *changes):
    rows = [tuple((ROW | change)[n] for n in NAMES) for change in changes]
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in NAMES))


def one(spark, text, convert):
    df = spark.createDataFrame([(text,)], "x string")
    return df.select(convert(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("text, expected", [
    ("1/6/2021 9:11:12.1", datetime(2021, 6, 1, 9, 11, 12, 100000)),
    ("01/06/2021 09:11:12.123456", datetime(2021, 6, 1, 9, 11, 12, 123456)),
    ("31/02/2021 00:00:00.0", None), ("2021-06-01 00:00:00.0", None),
    ("01/06/2021 09:11:12", None), ("01/06/2021", None), ("x", None), (None, None)])
def test_timestamp(spark, text, expected):
    assert one(spark, text, fn.parse_report_timestamp) == expected


def test_timestamp_does_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:  # this time does not exist there
        assert one(spark, "28/03/2021 02:30:00.0", fn.parse_report_timestamp) == datetime(
            2021, 3, 28, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("text, cents", [("0.025", 2), ("0.035", 4), ("-0.5", -50), ("1e2", 10000)])
def test_cents_round_half_to_even(spark, text, cents):
    assert one(spark, text, lambda c: fn.to_cents(fn.parse_number(c))) == cents


@pytest.mark.parametrize("text, expected", [
    ("12", 12), ("12.5", 12), (" 7 ", 7), (None, 0), ("x", None), ("12d", None), ("0x1p3", None),
    ("inf", None), ("1e30", None)])
def test_id(spark, text, expected):
    assert one(spark, text, fn.as_id_number) == expected


@pytest.mark.parametrize("text, expected", [
    ("12X", 0), ("12f", 0), ("n/d", 0), (None, 0), ("12.6", 13), ("inf", None), ("-Infinity", None)])
def test_account(spark, text, expected):
    assert one(spark, text, fn.as_account_number) == expected


@pytest.mark.parametrize("text, expected", [
    ("123,0", 123), ("123,45", None), (None, 0), ("1,2,3", None), ("x", None)])
def test_document(spark, text, expected):
    assert one(spark, text, fn.as_document_id) == expected


def test_format_document_id_raises(spark):
    df = spark.createDataFrame([("123,45",)], "d string")
    with pytest.raises(Exception, match="not a document id"):
        df.transform(numbers.format_document_id, "d").collect()


@pytest.mark.parametrize("direction, expected", [
    ("Credito", 100), ("Debito", -100), ("?", 9999999999999), (None, 9999999999999)])
def test_sided_amount(spark, direction, expected):
    assert staging.stage_report(report(spark, {"direction": direction})).first().amount == expected


@pytest.mark.parametrize("change, key", [
    ({}, "E1,100,Efetivado"), ({"status": None}, "E1,100,nan"),
    ({"operation": "Devolucao", "direction": "Debito"}, "E1,-100,Efetivado"),
    ({"operation": "Aporte"}, "S1,100,Efetivado"), ({"operation": "Retirada"}, "S1,100,Efetivado"),
    ({"operation": "Aporte", "end_to_end_id": None}, "S1,100,Efetivado")])
def test_key(spark, change, key):
    assert staging.stage_report(report(spark, change)).first().pix_key == key


def test_pending_goes_and_missing_status_stays(spark):
    df = report(spark, {"status": "Pendente"}, {"status": None}, {"status": "Efetivado"})
    assert [r.status for r in staging.stage_report(df).collect()] == [None, "Efetivado"]


@pytest.mark.parametrize("change, reason", [
    ({"amount": None}, "missing amount"), ({"amount": "1.234,56"}, "malformed amount"),
    ({"amount": "inf"}, "malformed amount"), ({"date_day": "x"}, "malformed date_day"),
    ({"receiver_psp": "x"}, "malformed receiver_psp"),
    ({"sender_account_number": "inf"}, "malformed sender_account_number"),
    ({"sender_national_document_id": "1,5"}, "malformed sender_national_document_id"),
    ({"operation": "Outro"}, "unknown operation"), ({"operation": None}, "unknown operation"),
    ({"end_to_end_id": None}, "missing key id"),
    ({"amount": None, "status": "Pendente"}, "missing amount")])
def test_rejects(spark, change, reason):
    df = report(spark, change, {})
    rejects = staging.stage_rejects(df).collect()
    assert [r.reject_reason for r in rejects] == [reason]
    assert staging.stage_report(df).count() == 1
    both = staging.staged_or_rejected(df).collect()
    assert sorted(r.rejected for r in both) == [False, True]
    bad = next(r for r in both if r.rejected)
    assert bad.reject_reason == reason and bad.amount is None
    assert bad.report_row["end_to_end_id"] == (ROW | change)["end_to_end_id"]
    with pytest.raises(Exception, match=reason):
        staging.stage_report(df, strict=True).collect()


def test_pending_rows_need_no_key(spark):
    df = report(spark, {"status": "Pendente", "operation": "Outro"})
    assert staging.stage_report(df, strict=True).count() == 0
    assert staging.staged_or_rejected(df).count() == 0


def test_missing_date_is_kept(spark):
    assert staging.stage_report(report(spark, {"date_day": None})).first().date_day is None


def test_staged_schema(spark):
    staged = staging.stage_report(report(spark, {}))
    assert [(f.name, f.dataType) for f in staged.schema] == [
        (f.name, f.dataType) for f in STAGED_SCHEMA]


def test_project_needs_every_column(spark):
    staged = staging.stage_report(report(spark, {}))
    assert staging.stage_project(staged.withColumn("more", F.lit(1))).columns == STAGED_COLUMNS
    with pytest.raises(Exception, match="status"):
        staging.stage_project(staged.drop("status"))


def test_rename_ignores_absent_and_unknown(spark):
    df = spark.createDataFrame([("1", "2")], "`D/C` string, other string")
    assert staging.rename_columns(df).columns == ["direction", "other"]


def test_dedupe_keeps_the_first_load(spark):
    early, late = (staging.stage_report(report(spark, {}, {"amount": "2"}),
                                        F.lit(datetime(2024, 1, d)).cast("timestamp"))
                   for d in (1, 2))
    rows = staging.dedupe_rows(late.unionByName(early)).collect()
    assert len(rows) == 2 and {r.inserted_at.day for r in rows} == {1}


def test_curated_key_has_two_parts(spark):
    assert staging.curate_jd(staging.stage_report(report(spark, {}))).first().pix_key == "E1,100"
