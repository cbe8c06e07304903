"""Archives, delimited files, tables and incremental ingest on temporary folders."""

import os
import zipfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from acerto.config import ReconConfig
from acerto.operators import staging
from acerto.plans import job, mapping, queries
from acerto.schemas import REPORT_COLUMNS, STAGED_COLUMNS
from acerto.sources import archives, delimited, tables
from acerto.streaming import ingest

HEADER = list(REPORT_COLUMNS)
PREFIX = "JDPI_RELATORIO_FINANCEIRO"


def line(ident, amount="1.00", header=HEADER, **changes):
    values = dict.fromkeys(HEADER, "") | {
        "Data Hora": "01/06/2021 15:00:00.0", "Tipo Operação": "Geral", "IdFimAFim": ident,
        "D/C": "Credito", "Valor": amount, "Situação": "Efetivado", "Nova": "x"} | changes
    return ";".join(values[name] for name in header)


def member(*lines, header=HEADER):
    return "\n".join([";".join(header), *lines]) + "\n"


def write_zip(folder, name, **members):
    # Written beside the folder and moved in, so a stream never sees half a file.
    os.makedirs(folder, exist_ok=True)
    partial = f"{folder}.{name}.partial"
    with zipfile.ZipFile(partial, "w", zipfile.ZIP_DEFLATED) as zipped:
        for title, text in members.items():
            zipped.writestr(title, text)
    os.replace(partial, os.path.join(folder, name))


def expanded(spark, folder, **options):
    return archives.expand_archives(archives.list_archives(spark, str(folder)), **options)


def test_list_takes_zip_files_only(spark, tmp_path):
    write_zip(tmp_path / "in", "a.zip", x="1")
    (tmp_path / "in" / "b.txt").write_text("1")
    found = archives.list_archives(spark, str(tmp_path / "in")).select("path").collect()
    assert [os.path.basename(r.path) for r in found] == ["a.zip"]


def test_members_are_chosen_by_prefix(spark, tmp_path):
    write_zip(tmp_path / "in", "a.zip", **{
        f"{PREFIX}_1.csv": member(line("E1"), line("E2")), "OUTRO.csv": member(line("E3")),
        f"sub/{PREFIX}_2.csv": member(line("E4")), f"{PREFIX}_empty.csv": "",
        f"{PREFIX}_header.csv": member()})
    rows = expanded(spark, tmp_path / "in").collect()
    assert sorted((r.member, r.row_no, r.IdFimAFim) for r in rows) == [
        (f"{PREFIX}_1.csv", 0, "E1"), (f"{PREFIX}_1.csv", 1, "E2"), (f"{PREFIX}_2.csv", 0, "E4")]
    assert all(r.archive.endswith("a.zip") for r in rows)


def test_columns_are_found_by_name(spark, tmp_path):
    other = ["Nova", *HEADER[::-1]]
    other.remove("Tipo Iniciação")
    write_zip(tmp_path / "in", "a.zip", **{
        f"{PREFIX}_1": member(line("E1", **{"Tipo Iniciação": "QRCODE"})),
        f"{PREFIX}_2": member(line("E2", header=other), header=other)})
    rows = {r.IdFimAFim: r for r in expanded(spark, tmp_path / "in").collect()}
    assert rows["E1"]["Tipo Iniciação"] == "QRCODE" and rows["E2"]["Tipo Iniciação"] is None
    assert rows["E2"]["Valor"] == "1.00" and "Nova" not in rows["E2"].asDict()


def test_cells(spark, tmp_path):
    text = member(
        line('"E;1"', amount="NaN"),
        line('"E ""2"""', **{"Nome Cliente Recebedor": '"two\nlines"', "Situação": "null"}),
        "", line("E3", **{"Situação": "n/d"}))
    write_zip(tmp_path / "in", "a.zip", **{PREFIX: "﻿" + text})
    rows = sorted(expanded(spark, tmp_path / "in").collect(), key=lambda r: r.row_no)
    assert [r.IdFimAFim for r in rows] == ["E;1", 'E "2"', "E3"]
    assert rows[0].Valor is None and rows[1]["Situação"] is None
    assert rows[1]["Nome Cliente Recebedor"] == "two\nlines" and rows[2]["Situação"] == "n/d"
    assert rows[0]["Data Hora"] == "01/06/2021 15:00:00.0"


def test_short_and_long_rows(spark, tmp_path):
    short = ";".join(line("E2").split(";")[:7])
    write_zip(tmp_path / "in", "a.zip",
              **{PREFIX: member(line("E1"), short, line("E3") + ";more", line("E4"))})
    rows = expanded(spark, tmp_path / "in").collect()
    assert len({r.row_no for r in rows}) == 4
    by_id = {r.IdFimAFim: r for r in rows}
    assert by_id["E2"].Valor == "1.00" and by_id["E2"]["Situação"] is None
    assert by_id[None].parse_error.startswith("expected 19 fields, saw 20: ")
    assert line("E3") + ";more" in by_id[None].parse_error
    outcome = ingest.stage_archives(archives.list_archives(spark, str(tmp_path / "in")))
    assert outcome.filter("rejected").first().reject_reason == by_id[None].parse_error
    assert outcome.filter("not rejected").count() == 3


def test_large_member_comes_in_blocks(spark, tmp_path):
    lines = [line(f"E{n}") for n in range(5000)]
    lines[1234] = lines[1234].rsplit(";", 3)[0]
    write_zip(tmp_path / "in", "a.zip", **{PREFIX: member(*lines)})
    rows = expanded(spark, tmp_path / "in", block_bytes=10_000)
    found = rows.agg(F.count("*"), F.countDistinct("row_no"), F.countDistinct("IdFimAFim")).first()
    assert tuple(found) == (5000, 5000, 5000)


def test_loose_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text(member(line("E1", amount="NA"), line('"E;2"')))
    df = delimited.read_delimited(spark, str(tmp_path / "a.csv"))
    assert df.columns == HEADER
    assert sorted((r.IdFimAFim, r.Valor) for r in df.collect()) == [("E1", None), ("E;2", "1.00")]
    moved = HEADER[::-1]
    with pytest.raises(Exception, match="(?i)header"):
        delimited.read_delimited(spark, str(tmp_path / "a.csv"), moved).collect()


def test_lines_round_trip(spark):
    df = spark.createDataFrame([("a;b", 'say "x"', None), ("", "2", "3")], "p string, q string, r string")
    back = delimited.parse_lines(delimited.render_lines(df), schema=df.schema)
    assert [tuple(r) for r in back.collect()] == [("a;b", 'say "x"', None), (None, "2", "3")]


def test_union_by_name(spark):
    a = spark.createDataFrame([("1", "2")], "x string, y string")
    b = spark.createDataFrame([("3",)], "y string")
    assert [tuple(r) for r in delimited.union_reports(a, b).collect()] == [("1", "2"), (None, "3")]
    with pytest.raises(ValueError, match="Situação"):
        delimited.require_report_columns(a)


def test_append_and_reread(spark, tmp_path):
    write_zip(tmp_path / "in", "a.zip", **{PREFIX: member(line("E1"), line("E2", amount=""))})
    target = str(tmp_path / "raw")
    for times in (1, 2):
        ingest.ingest_batch(spark, str(tmp_path / "in"), target)
        staged = tables.read_staged(spark, target)
        assert staged.columns == STAGED_COLUMNS
        assert [r.end_to_end_id for r in staged.collect()] == ["E1"] * times
        rejects = tables.read_rejects(spark, target).collect()
        assert [r.reject_reason for r in rejects] == ["missing amount"] * times
    assert staging.curate_jd(tables.read_staged(spark, target)).count() == 1


def test_scans_prune_to_their_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("select 1L as ledger_transfer_id, 'E1' as end_to_end_id, 2 as more").write.parquet(path)
    assert tables.scan_gateway(spark, path).columns == ["ledger_transfer_id", "end_to_end_id"]


def test_run_sql(spark):
    df = spark.range(3)
    assert tables.run_sql(spark, "select sum(id) as s from {rows}", rows=df).first().s == 3


def test_each_archive_is_read_once(spark, tmp_path):
    folder, target, state = (str(tmp_path / n) for n in ("in", "raw", "state"))

    def run():
        ingest.ingest_new(spark, folder, target, state, str(tmp_path / "done")).awaitTermination()
        return sorted(r.end_to_end_id for r in tables.read_staged(spark, target).collect())

    write_zip(folder, "a.zip", **{PREFIX: member(line("E1"), line("E2", amount="x"))})
    assert run() == ["E1"]
    assert run() == ["E1"]
    write_zip(folder, "b.zip", **{PREFIX: member(line("E3"))})
    assert run() == ["E1", "E3"]
    assert [r.reject_reason for r in tables.read_rejects(spark, target).collect()] == [
        "malformed amount"]
    # What was read is moved away when the next batch runs.
    assert sorted(os.listdir(folder)) == ["b.zip"]
    assert any("a.zip" in names for _, _, names in os.walk(tmp_path / "done"))


def test_stream_equals_batch(spark, tmp_path):
    for n in range(4):
        write_zip(str(tmp_path / "in"), f"{n}.zip",
                  **{PREFIX: member(*[line(f"E{n}-{i}") for i in range(10)])})
    ingest.ingest_batch(spark, str(tmp_path / "in"), str(tmp_path / "batch"))
    ingest.ingest_new(spark, str(tmp_path / "in"), str(tmp_path / "stream"),
                      str(tmp_path / "state"), files_per_batch=1).awaitTermination()
    batch, stream = (tables.read_staged(spark, str(tmp_path / n)).drop("inserted_at")
                     for n in ("batch", "stream"))
    assert batch.count() == 40
    assert batch.exceptAll(stream).count() == stream.exceptAll(batch).count() == 0


def test_whole_job(spark, tmp_path):
    path = {n: str(tmp_path / n) for n in
            ("in", "raw", "state", "curated", "ledger", "gateway", "daily", "reports")}
    write_zip(path["in"], "a.zip", **{PREFIX: member(line("E1"), line("E2", amount="2.00"))})
    spark.sql("""select 1L as transfer_id, timestamp_ntz'2021-06-01 15:00:00' as utc_datetime,
                        'pix_in' as type, 'TransferIn' as direction, 100L as amount,
                        7L as account_id""").write.parquet(path["ledger"])
    spark.sql("select 1L as ledger_transfer_id, 'E1' as end_to_end_id").write.parquet(path["gateway"])
    config = ReconConfig(as_of=date(2021, 6, 2))
    job.run(spark, config, path["in"], path["raw"], path["state"], path["curated"],
            path["ledger"], path["gateway"], path["daily"], path["reports"])
    day = spark.read.parquet(path["daily"]).first()
    assert (day.date_day, day.nb_mismatch_tx_pix_in, day.amount_jd_pix_in) == (
        date(2021, 6, 1), 1, 300)
    text = spark.read.parquet(path["reports"]).first().text
    assert "    - Amount of mismatch transactions: R$2.0\n" in text
    detail = job.unmatched_detail(
        *[spark.read.parquet(path[n]) for n in ("ledger", "gateway", "curated")], config)
    assert [(r.end_to_end_id, r.source) for r in detail.collect()] == [("E2", "jd")]


def test_curation_replaces_only_days_with_new_rows(spark, tmp_path):
    folder, raw, curated = (str(tmp_path / n) for n in ("in", "raw", "curated"))

    def load(name, *lines):
        write_zip(folder, name, **{PREFIX: member(*lines)})
        ingest.ingest_new(spark, folder, raw, str(tmp_path / "state")).awaitTermination()
        job.curate(spark, raw, curated)
        rows = sorted(r.end_to_end_id for r in spark.read.parquet(curated).collect())
        return rows, {d: sorted(os.listdir(os.path.join(curated, d)))
                      for d in os.listdir(curated) if d.startswith("report_day=")}

    second_day = {"Data Hora": "02/06/2021 15:00:00.0"}
    rows, before = load("a.zip", line("E1"), line("E2", **second_day),
                        line("E3", **{"Data Hora": ""}))
    assert rows == ["E1", "E2", "E3"] and len(before) == 3
    rows, after = load("b.zip", line("E2", **second_day), line("E4", **second_day))
    assert rows == ["E1", "E2", "E3", "E4"]
    assert {d for d in after if after[d] != before[d]} == {"report_day=2021-06-02"}
    rows, _ = load("c.zip", line("E5", **{"Data Hora": ""}))
    assert rows == ["E1", "E2", "E3", "E4", "E5"]


def odd_archive(folder, name, content, member_name=PREFIX):
    os.makedirs(folder, exist_ok=True)
    with zipfile.ZipFile(os.path.join(folder, name), "w") as zipped:
        zipped.writestr(member_name, content)


def odd_rows(spark, folder, **options):
    found = archives.expand_archives(archives.list_archives(spark, folder), ["a", "b"], **options)
    return [(r.a, r.b, r.parse_error) for r in found.orderBy("archive", "row_no").collect()]


@pytest.mark.parametrize("content, rows", [
    ('a;b\n1;"open\n2;x\n3;y\n', [(None, None, "quote is never closed")]),
    ("\n\na;b\n0012;x\n", [("0012", "x", None)]),
    ("a;b;a\n1;2;3\n", [("1", "2", None)]),
    ('a;b\n1;5" pipe\n2;y\n', [("1", '5" pipe', None), ("2", "y", None)]),
    ('a;b\n1;"two\nlines"\n', [("1", "two\nlines", None)]),
    ("a;b\n1\n1;2;3\n", [("1", None, None), (None, None, "expected 2 fields, saw 3: 1;2;3")]),
    ("a;b\n1;é\n".encode("latin-1"), [(None, None, "unreadable: ArrowInvalid")]),
])
def test_odd_members_lose_nothing(spark, tmp_path, content, rows):
    odd_archive(str(tmp_path / "in"), "a.zip", content)
    found = odd_rows(spark, str(tmp_path / "in"))
    if isinstance(content, bytes):
        assert len(found) == 1 and found[0][2].startswith("unreadable")
    else:
        assert found == rows


def test_members_in_folders(spark, tmp_path):
    odd_archive(str(tmp_path / "in"), "a.zip", "a;b\n1;2\n", f"deep/{PREFIX}")
    assert odd_rows(spark, str(tmp_path / "in"), nested=False) == []
    assert odd_rows(spark, str(tmp_path / "in")) == [("1", "2", None)]


def test_broken_archive_does_not_stop_the_stream(spark, tmp_path):
    folder = str(tmp_path / "in")
    os.makedirs(folder)
    with open(os.path.join(folder, "a.zip"), "wb") as broken:
        broken.write(b"PK no zip")
    write_zip(folder, "b.zip", **{PREFIX: member(line("E1"))})
    ingest.ingest_new(spark, folder, str(tmp_path / "raw"), str(tmp_path / "state")).awaitTermination()
    assert [r.end_to_end_id for r in tables.read_staged(spark, str(tmp_path / "raw")).collect()] == ["E1"]
    assert [r.reject_reason for r in tables.read_rejects(spark, str(tmp_path / "raw")).collect()] == [
        "unreadable: BadZipFile"]


def test_half_done_curation_and_late_clock(spark, tmp_path):
    """Progress does not hang on what the output shows: a day that was not written comes next time."""
    folder, raw, curated = (str(tmp_path / n) for n in ("in", "raw", "curated"))
    other = {"Data Hora": "02/06/2021 15:00:00.0"}
    write_zip(folder, "a.zip", **{PREFIX: member(line("E1"), line("E2", **other))})
    ingest.ingest_new(spark, folder, raw, str(tmp_path / "state")).awaitTermination()
    done = staging.curate_jd(tables.read_staged(spark, raw)).withColumn("report_day", F.to_date("date_day"))
    done.filter("end_to_end_id = 'E2'").write.partitionBy("report_day").parquet(curated)
    job.curate(spark, raw, curated)
    assert sorted(r.end_to_end_id for r in spark.read.parquet(curated).collect()) == ["E1", "E2"]
    job.curate(spark, raw, curated)
    assert spark.read.parquet(curated).count() == 2


def test_second_run_of_a_day_leaves_one_text(spark, tmp_path):
    path = {n: str(tmp_path / n) for n in
            ("in", "raw", "state", "curated", "ledger", "gateway", "daily", "reports")}
    write_zip(path["in"], "a.zip", **{PREFIX: member(line("E1"))})
    spark.sql("""select 1L as transfer_id, timestamp_ntz'2021-06-01 15:00:00' as utc_datetime,
                        'pix_in' as type, 'TransferIn' as direction, 100L as amount,
                        7L as account_id""").write.parquet(path["ledger"])
    spark.sql("select 1L as ledger_transfer_id, 'E1' as end_to_end_id").write.parquet(path["gateway"])
    for _ in range(2):
        job.run(spark, ReconConfig(as_of=date(2021, 6, 2)), *path.values())
    assert spark.read.parquet(path["reports"]).groupBy("date").count().filter("count > 1").count() == 0


def test_test_archives_are_written_without_holding_a_group(spark, tmp_path, monkeypatch):
    def whole_group(*_):
        raise AssertionError("a group would be held by one task")

    monkeypatch.setattr(type(spark.range(1).groupBy("id")), "applyInArrow", whole_group)
    monkeypatch.setattr(type(spark.range(1).groupBy("id")), "applyInPandas", whole_group)
    spark.range(-40, 400).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-01' as ts", "id % 9 as user_id", "'purchase' as event_type", "cast(id as double) as value",
        "'' as props").write.parquet(str(tmp_path / "events.parquet"))
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows)
    spark.conf.set(rows, 7)
    try:
        folder = queries._zip_files(spark, str(tmp_path)).removeprefix("file:")
    finally:
        spark.conf.set(rows, before)
    expected = {}
    for r in mapping.report_lines(spark, str(tmp_path)).collect():
        sign, number = (-1 if r.event_id < 0 else 1), abs(r.event_id) % 8  # as in SQL
        expected.setdefault(sign * number, {}).setdefault(r.member, []).append(r.line)
    assert {n for n in os.listdir(folder) if n.endswith(".zip")} == {f"{n}.zip" for n in expected}
    with pytest.raises(zipfile.BadZipFile):
        zipfile.ZipFile(f"{folder}/0.zip")
    for number in set(expected) - {0}:
        with zipfile.ZipFile(f"{folder}/{number}.zip") as zipped:
            assert zipped.namelist() == sorted(expected[number])
            for name, lines in expected[number].items():
                text = zipped.read(name).decode()
                assert text.startswith(";".join(HEADER) + "\n") and len(text) == len(member(*lines))
                assert all(line + "\n" in text for line in lines)
