"""Loose files in splits: quotes over line breaks, odd rows, many tasks."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from acerto.sources import archives, delimited
from tests.test_sources import odd_archive


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "wb") as file:
        file.write(text if isinstance(text, bytes) else text.encode())


def rows(found):
    return [(r.a, r.b, r.parse_error) for r in found.orderBy("archive", "row_no").collect()]


def cell(pick):
    return pick.choice(["1", "x;y", "two\nlines", "", 'say "hi"', "\n\n\n", "é" * 5, "long " * pick.randint(0, 40), "\n;\"\n", 'a"b', "null"])


def rendered(pick, count):
    out = io.StringIO()
    writer = csv.writer(out, delimiter=";", lineterminator=pick.choice(["\n", "\r\n"]))
    writer.writerow(["a", "b"])
    expected = []
    for _ in range(count):
        values = [cell(pick), cell(pick) + "."]
        writer.writerow(values)
        expected.append((None if values[0] in ("", "null") else values[0].replace("\r\n", "\n"), values[1], None))
    return out.getvalue(), expected


@pytest.mark.parametrize("size", [1, 11, 60, 301, 5000])
def test_any_split_gives_the_same_rows(spark, tmp_path, size):
    pick = random.Random(size)
    folder, expected = str(tmp_path / "in"), []
    for n in range(3):
        text, found = rendered(pick, 12)
        write(folder, f"{n}.csv", text)
        expected += found
    found = delimited.scan_delimited(spark, folder, ["a", "b"], split_bytes=size, block_bytes=30)
    assert rows(found) == expected
    assert found.select("archive", "row_no").distinct().count() == len(expected)


@pytest.mark.parametrize("size", [2, 6, 1000])
@pytest.mark.parametrize("content", [
    'a;b\n1;"open\n2;x\n3;y\n', "\n\na;b\n0012;x\n", "a;b;a\n1;2;3\n", 'a;b\n1;5" pipe\n2;y\n',
    'a;b\n1;"two\nlines"\n', "a;b\n1\n1;2;3\n2;4\n", "", "a;b\n", '﻿a;b\n"x";"";\n1;2', 'a;b\n"x"y;"z"\n"";1\n',
])
def test_same_as_members_of_archives(spark, tmp_path, size, content):
    odd_archive(str(tmp_path / "zip"), "a.zip", content)
    write(str(tmp_path / "in"), "a.csv", content)
    member = archives.expand_members(archives.list_archives(spark, str(tmp_path / "zip")), ["a", "b"])
    found = delimited.scan_delimited(spark, str(tmp_path / "in"), ["a", "b"], split_bytes=size)
    assert sorted(rows(found), key=str) == sorted(rows(member), key=str)


def test_bad_bytes_cost_one_row(spark, tmp_path):
    write(str(tmp_path), "a.csv", b"a;b\n" + b"".join(b"%d;x\n" % n for n in range(50)) + b"50;\xe9\n51;y\n")
    found = rows(delimited.scan_delimited(spark, str(tmp_path), ["a", "b"]))
    assert len(found) == 52 and found[50][2].startswith("unreadable: ") and found[51] == ("51", "y", None)
    latin = rows(delimited.scan_delimited(spark, str(tmp_path), ["a", "b"], encoding="latin-1"))
    assert latin[50] == ("50", "é", None)


def test_a_file_is_many_tasks(spark, tmp_path):
    write(str(tmp_path), "a.csv", "a;b\n" + "".join(f'{n};"x\n{n}"\n' for n in range(20_000)))
    found = delimited.scan_delimited(spark, str(tmp_path), ["a", "b"], split_bytes=10_000, tasks=32)
    assert found.select(F.spark_partition_id()).distinct().count() >= 30
    total = found.agg(F.count("*"), F.sum(F.col("a").cast("long")), F.count_distinct("row_no"), F.count("parse_error")).first()
    assert tuple(total) == (20_000, sum(range(20_000)), 20_000, 0)
    assert found.filter("b <> concat('x\n', a)").count() == 0


def test_strict_reading_fails_rather_than_loses(spark, tmp_path):
    write(str(tmp_path), "a.csv", "a;b\n1;2\n1;2;3\n")
    with pytest.raises(Exception, match="expected 2 fields, saw 3"):
        delimited.read_delimited(spark, str(tmp_path)).collect()


def test_lines_with_surplus_fields(spark):
    lines = spark.createDataFrame([("1;2",), ("1",), ("1;2;",), ('"x;y";null',), ("1;2;3;4",), ('1;"2',), (None,), ("",)], "line string")
    schema = spark.createDataFrame([], "a string, b string").schema
    found = delimited.parse_lines(lines, schema=schema, error="problem")
    problem = "more than 2 fields or an open quote: "
    assert [tuple(r) for r in found.collect()] == [
        ("1", "2", None), ("1", None, None), (None, None, problem + "1;2;"), ("x;y", None, None),
        (None, None, problem + "1;2;3;4"), (None, None, problem + '1;"2'), (None, None, None), (None, None, None)]
