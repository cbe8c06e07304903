"""Archives by member, rows accounted for, tables exchanged and appended once, curation by day."""

import os
import subprocess
import sys
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from acerto import schemas
from acerto.config import ReconConfig
from acerto.plans import job
from acerto.sources import archives, scratch, tables
from acerto.streaming import ingest
from tests.test_sources import PREFIX, line, member, odd_archive, write_zip


def test_members_of_an_archive_are_different_tasks(spark, tmp_path):
    write_zip(tmp_path / "in", "a b.zip", **{f"{PREFIX}_{n}": member(line(f"E{n}"), line(f"F{n}")) for n in range(50)})
    found = archives.list_archives(spark, str(tmp_path / "in"))
    by_member, whole = archives.expand_members(found, tasks=50), archives.expand_archives(found)
    assert by_member.select(F.spark_partition_id().alias("task"), "member").distinct().groupBy("task").count().filter("count > 1").isEmpty()
    assert by_member.count() == 100
    assert by_member.exceptAll(whole).isEmpty() and whole.exceptAll(by_member).isEmpty()


def test_members_do_not_need_the_content(spark, tmp_path):
    write_zip(tmp_path / "in", "a.zip", **{PREFIX: member(line("E1"))})
    plan = archives.expand_members(archives.list_archives(spark, str(tmp_path / "in")))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string>" in plan


@pytest.mark.parametrize("content", ['a;b\n1;"open\n2;x\n', "\n\na;b\n1;x\n", "a;b\n1\n1;2;3\n2;4\n", "", "a;b\n1;é\n".encode("latin-1")])
def test_odd_members_are_the_same_both_ways(spark, tmp_path, content):
    odd_archive(str(tmp_path / "in"), "a.zip", content)
    odd_archive(str(tmp_path / "in"), "b.zip", "a;b\n5;6\n", f"deep/{PREFIX}")
    (tmp_path / "in" / "c.zip").write_bytes(b"PK no zip")
    found = archives.list_archives(spark, str(tmp_path / "in"))
    for nested in (True, False):
        ways = [sorted(map(tuple, way(found, ["a", "b"], nested=nested).collect()), key=str)
                for way in (archives.expand_members, archives.expand_archives)]
        assert ways[0] == ways[1]


def test_rejects_tell_where_they_come_from(spark, tmp_path):
    folder, target = str(tmp_path / "in"), str(tmp_path / "raw")
    write_zip(folder, "a.zip", **{PREFIX: member(line("E1"), line("E2", amount="x"))})
    (tmp_path / "in" / "b.zip").write_bytes(b"PK no zip")
    ingest.ingest_new(spark, folder, target, str(tmp_path / "state")).awaitTermination()
    found = {os.path.basename(r.archive): (r.member, r.row_no, r.reject_reason) for r in tables.read_rejects(spark, target).collect()}
    assert found == {"a.zip": (PREFIX, 1, "malformed amount"), "b.zip": (None, 0, "unreadable: BadZipFile")}
    assert spark.read.parquet(target).filter("end_to_end_id = 'E1'").select("member", "row_no").first() == (PREFIX, 0)


def test_every_batch_accounts_for_its_rows(spark, tmp_path):
    folder = str(tmp_path / "in")
    for n in range(4):
        write_zip(folder, f"{n}.zip", **{PREFIX: member(
            *[line(f"E{n}-{i}") for i in range(n + 1)], line("x", amount="no"), line("y", **{"Situação": "Pendente"}))})
    running = ingest.ingest_new(spark, folder, str(tmp_path / "raw"), str(tmp_path / "state"), files_per_batch=1)
    running.awaitTermination()
    counts = ingest.row_counts(running)
    assert len(counts) == 4
    assert all(c["read"] == c["staged"] + c["rejected"] + c["pending"] for c in counts)
    assert sorted(c["staged"] for c in counts) == [1, 2, 3, 4] and {(c["rejected"], c["pending"]) for c in counts} == {(1, 1)}
    assert tables.read_staged(spark, str(tmp_path / "raw")).count() == 10


def test_archives_are_appended_once(spark, tmp_path):
    folder, target = str(tmp_path / "in"), str(tmp_path / "raw")
    for name in ("a", "b"):
        write_zip(folder, f"{name}.zip", **{PREFIX: member(line(f"E{name}"))})
        for _ in range(2):
            ingest.ingest_unread(spark, folder, target)
    assert sorted(r.end_to_end_id for r in tables.read_staged(spark, target).collect()) == ["Ea", "Eb"]


def test_a_batch_is_appended_once(spark, tmp_path):
    target = str(tmp_path / "t")
    rows = spark.range(10).withColumn("kind", F.col("id") % 3)
    tables.append_batch(rows, target, "first", ("kind",))
    tables.append_batch(rows.filter("id > 4"), target, "second", ("kind",))
    tables.append_batch(rows, target, "first", ("kind",))
    assert spark.read.parquet(target).groupBy("batch").count().orderBy("batch").collect() == [("first", 10), ("second", 5)]
    with pytest.raises(ValueError, match="partition"):
        tables.append_batch(rows, target, "a/b")


def values(spark, target):
    return sorted(r.id for r in spark.read.parquet(target).collect())


def test_a_run_that_dies_leaves_the_old_table(spark, tmp_path):
    target = str(tmp_path / "daily")
    tables.replace_table(spark.range(3), target)
    broken = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("died"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="died"):
        tables.replace_table(broken, target)
    assert values(spark, target) == [0, 1, 2]
    tables.replace_table(spark.range(7), target)
    assert values(spark, target) == list(range(7)) and os.listdir(tmp_path) == ["daily"]


def test_a_run_that_dies_between_the_renames(spark, tmp_path):
    target = str(tmp_path / "daily")
    tables.replace_table(spark.range(3), target)
    os.rename(target, tmp_path / ".old_daily")
    tables.recover_table(spark, target)
    assert values(spark, target) == [0, 1, 2]
    os.rename(target, tmp_path / ".old_daily")
    tables.replace_table(spark.range(4), target)
    assert values(spark, target) == [0, 1, 2, 3] and os.listdir(tmp_path) == ["daily"]


def test_a_table_read_from_itself_can_be_replaced(spark, tmp_path):
    target = str(tmp_path / "daily")
    tables.replace_table(spark.range(3), target)
    tables.replace_table(spark.read.parquet(target).withColumn("id", F.col("id") + 1), target)
    spark.catalog.refreshByPath(target)
    assert values(spark, target) == [1, 2, 3]


def test_curation_reads_only_touched_partitions(spark, tmp_path):
    folder, raw = str(tmp_path / "in"), str(tmp_path / "raw")
    lines = [line(f"E{day}", **{"Data Hora": f"{day:02}/06/2021 15:00:00.0"}) for day in range(1, 11)]
    write_zip(folder, "a.zip", **{PREFIX: member(*lines, line("E0", **{"Data Hora": ""}), line("bad", amount="x"))})
    ingest.ingest_new(spark, folder, raw, str(tmp_path / "state")).awaitTermination()
    batch = spark.read.parquet(raw).filter("end_to_end_id in ('E3', 'E7')")
    touched = job.touched_days(batch)
    assert sorted(touched) == [date(2021, 6, 3), date(2021, 6, 7)]
    found = job.curated_days(batch, raw, touched)
    assert sorted(r.end_to_end_id for r in found.collect()) == ["E3", "E7"]
    plan = found._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [" in plan.toString() and "report_day" in plan.toString().split("PartitionFilters: [")[1].split("]")[0]
    assert len(found.inputFiles()) == 12  # the files of the table; of these the filter leaves two
    scans = [node for node in _nodes(plan) if node.getClass().getSimpleName() == "FileSourceScanExec"]
    assert {scan.metrics().apply("numPartitions").value() for scan in scans} == {2}
    assert sorted(r.end_to_end_id for r in job.curated_days(batch, raw, [None]).collect()) == ["E0"]
    assert sorted(r.end_to_end_id for r in job.curated_days(batch, raw, None).collect()) == ["E3", "E7"]


def _nodes(plan):
    """All nodes of a physical plan, through adaptive stages."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return _nodes(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return _nodes(plan.plan())
    children = plan.children()
    return [plan, *[node for i in range(children.size()) for node in _nodes(children.apply(i))]]


def test_first_run_without_reports(spark, tmp_path):
    path = {n: str(tmp_path / n) for n in ("in", "raw", "state", "curated", "ledger", "gateway", "daily", "reports")}
    os.makedirs(path["in"])
    spark.sql("""select 1L as transfer_id, timestamp_ntz'2021-06-01 15:00:00' as utc_datetime, 'pix_in' as type,
                        'TransferIn' as direction, 100L as amount, 7L as account_id""").write.parquet(path["ledger"])
    spark.sql("select 1L as ledger_transfer_id, 'E1' as end_to_end_id").write.parquet(path["gateway"])
    config = ReconConfig(as_of=date(2021, 6, 2))
    job.run(spark, config, *path.values())
    day = spark.read.parquet(path["daily"]).first()
    assert (day.nb_mismatch_tx_pix_in, day.amount_ledger_pix_in, day.amount_jd_pix_in) == (1, 100, None)
    write_zip(path["in"], "a.zip", **{PREFIX: member(line("E1", amount="1.00"))})
    job.run(spark, config, *path.values())
    assert spark.read.parquet(path["daily"]).first().nb_mismatch_tx_pix_in == 0


def test_scratch_tables_go_when_the_driver_ends(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {os.getcwd()!r})
from pyspark.sql import SparkSession
from acerto.sources import scratch
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate())
path = scratch.new_folder(spark, "kept")
spark.range(3).write.parquet(path)
assert spark.read.parquet(scratch.until_end(spark, path)).count() == 3
"""
    environment = {k: v for k, v in os.environ.items() if k not in ("PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120, env=environment, capture_output=True)
    deadline = time.time() + 20
    while any("kept" in name for name in os.listdir(tmp_path)) and time.time() < deadline:
        time.sleep(0.2)
    assert not any("kept" in name for name in os.listdir(tmp_path))


def test_folders_must_be_shared_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="checkpoint"):
        scratch.shared_folder(Session())
    assert scratch.new_folder(spark, "x") != scratch.new_folder(spark, "x")
    assert schemas.ORIGIN_COLUMNS == ("archive", "member", "row_no")
