"""Loose delimited files, and the union of reports with different columns.

A quoted cell may have line breaks, so where a split of a file starts does not tell whether a line break there ends a
record. ``scan_delimited`` still reads a large file in many tasks: each split tells what it makes of a quote that is open before
it and of none; put together in order, these tell for every split how it starts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acerto.operators.staging import blank_to_null
from acerto.schemas import REPORT_COLUMNS, REPORT_SCHEMA
from acerto.sources.archives import file_opener, member_schema, tasks_can_open
from acerto.sources.records import record_reader, row_builder

_SPLITS = "file string, start long, stop long, inside boolean, unclosed boolean"


def read_delimited(spark: SparkSession, path: str, columns: list[str] | None = None,
                   separator: str = ";") -> DataFrame:
    """Files that share one header, all text, without the rows' origin.

    Without ``columns`` the header of one file names them. Files whose header
    differs fail rather than shift, and so do rows that cannot be read; ``scan_delimited`` takes both.
    """
    if columns is None:
        columns = spark.read.option("sep", separator).option("header", True).csv(path).columns
    found = scan_delimited(spark, path, columns, separator, same_header=True)
    error = F.raise_error(F.concat("archive", F.lit(": "), "parse_error")).cast("boolean")
    return (found.filter(F.when(F.col("parse_error").isNull(), True).otherwise(error))
            .select(*[F.col(f"`{name}`") for name in columns]))


def scan_delimited(spark: SparkSession, path: str, columns: tuple[str, ...] | list[str] | None = None,
                   separator: str = ";", encoding: str = "utf8", split_bytes: int = 64 << 20,
                   block_bytes: int = 4 << 20, same_header: bool = False, tasks: int | None = None) -> DataFrame:
    """Rows of delimited files, with the columns and rules of ``archives.expand_archives``, a task for each split.

    ``archive`` is the file and ``member`` NULL. ``row_no`` orders and tells apart the rows of a file but has gaps. A file
    whose last quote is never closed gives one row with that error. A record that cannot be decoded gives one
    row with that error, its neighbours are read. Records end at a line feed, so UTF-16 is not read. With ``same_header`` a
    file fails whose header is not ``columns``.

    Files of more than ``split_bytes`` are read twice, the first time for their quotes. Splits are dealt to ``tasks``
    (the session's shuffle partitions by default); what is shuffled is a row for each split. A task holds a block and its longest
    record. Tasks open the files themselves (``archives.tasks_can_open``); files that only Spark can open are a task each.
    """
    wanted = list(REPORT_COLUMNS) if columns is None else list(columns)
    files = spark.read.format("binaryFile").load(path)
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    is_open, rows_of = _quote_scanner(separator), record_reader(wanted, separator, encoding, block_bytes)
    if not tasks_can_open(path):
        read = _read_splits(is_open, rows_of, wanted, separator, encoding, block_bytes, same_header, None)
        return files.select("path", "content").mapInArrow(read, member_schema(wanted))
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))
    splits = files.filter("length > 0").select(F.col("path").alias("file"), F.explode(starts).alias("start"), "length").select(
        "file", "start", F.least(F.col("start") + split_bytes, F.col("length")).alias("stop"), "length")

    def dealt(df: DataFrame) -> DataFrame:
        number = F.hash("file") + F.floor(F.col("start") / split_bytes)
        return df.repartitionById(tasks, F.pmod(number, F.lit(tasks)).cast("int"))

    none = F.lit(None).cast("boolean")
    small = splits.filter(F.col("length") <= split_bytes).select("file", "start", "stop", none.alias("inside"), none.alias("unclosed"))
    effects = (dealt(splits.filter(F.col("length") > split_bytes).drop("length"))
               .mapInArrow(_quote_effects(is_open), "file string, start long, stop long, from_outside boolean, from_inside boolean"))
    large = effects.groupBy("file").applyInArrow(_how_splits_start, _SPLITS)
    read = _read_splits(is_open, rows_of, wanted, separator, encoding, block_bytes, same_header, file_opener())
    return dealt(small.unionByName(large)).mapInArrow(read, member_schema(wanted))


def _quote_scanner(separator: str) -> Callable:
    """``is_open(line, inside)``: whether a quoted cell is open behind a line, if one is ``inside`` before it.

    A quote opens a cell only as its first character, and two inside a cell stand for one.
    """
    start = separator.encode() + b'"'

    def is_open(line, inside):
        at = 0
        if not inside:
            if line[:1] == b'"':
                at = 1
            else:
                found = line.find(start)
                if found < 0:
                    return False
                at = found + len(start)
        while True:
            found = line.find(b'"', at)
            if found < 0:
                return True
            if line[found + 1:found + 2] == b'"':
                at = found + 2
                continue
            # The cell is closed; the next one with a quote starts behind a separator.
            found = line.find(start, found + 1)
            if found < 0:
                return False
            at = found + len(start)

    return is_open


def _quote_effects(is_open: Callable) -> Callable:
    """Of each split: whether a quote is open behind its lines, if none and if one was open before them."""
    open_file = file_opener()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        for batch in batches:
            effects = []
            for file, start, stop in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "stop"))):
                states = [False, True]
                with open_file(file) as source:
                    at = start
                    if start:
                        source.seek(start - 1)
                        at += len(source.readline()) - 1
                    while at < stop and (line := source.readline()):
                        at += len(line)
                        if b'"' in line:
                            states = [is_open(line, state) for state in states]
                effects.append(states)
            kept = batch.select(["file", "start", "stop"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, *(pa.array([e[i] for e in effects], pa.bool_()) for i in (0, 1))],
                names=[*kept.schema.names, "from_outside", "from_inside"])

    return read


def _how_splits_start(table: pa.Table) -> pa.Table:
    """The splits of one file in order: whether each starts inside a quote, and whether the file ends in one."""
    import pyarrow as pa

    rows = sorted(table.to_pylist(), key=lambda r: r["start"])
    starts, inside = [], False
    for row in rows:
        starts.append(inside)
        inside = row["from_inside"] if inside else row["from_outside"]
    columns = [pa.array([r[name] for r in rows], kind) for name, kind in
               (("file", pa.string()), ("start", pa.int64()), ("stop", pa.int64()))]
    return pa.Table.from_arrays([*columns, pa.array(starts, pa.bool_()), pa.array([inside] * len(rows), pa.bool_())],
                                names=["file", "start", "stop", "inside", "unclosed"])


def _read_splits(is_open, rows_of, wanted, separator, encoding, block_bytes, same_header, open_file) -> Callable:
    """Rows of the records that begin in each split; without ``open_file`` each row has the content of a whole file."""
    emit = row_builder(wanted)

    def record(source):
        """The bytes of the next record, and whether its last quote is closed."""
        lines, inside = [], False
        while line := source.readline():
            if inside or b'"' in line:
                inside = is_open(line, inside)
            lines.append(line)
            if not inside:
                break
        return b"".join(lines), not inside

    def parse(file, header, first, records):
        """Rows of ``records``; where they cannot be read, the halves by themselves."""
        import csv
        import io

        import pyarrow as pa

        content = header + b"".join(records)
        try:
            found = list(rows_of(file, None, lambda: io.BytesIO(content), first, True, len(content)))
        except (UnicodeError, pa.ArrowInvalid, csv.Error) as problem:
            if len(records) == 1:
                yield emit(file, None, first, 1, {}, f"unreadable: {type(problem).__name__}")
                return
            middle = len(records) // 2
            yield from parse(file, header, first, records[:middle])
            yield from parse(file, header, first + middle, records[middle:])
            return
        yield from found

    def ends_inside(source):
        inside = False
        for line in source:
            if b'"' in line:
                inside = is_open(line, inside)
        return inside

    def check(file, header):
        import csv

        names = next(csv.reader([header.decode(encoding).rstrip("\r\n").removeprefix("\ufeff")], delimiter=separator), [])
        if names != wanted:
            raise ValueError(f"{file}: the header is {names}, not {wanted}")

    def split_rows(file, source, start, stop, inside, unclosed):
        if unclosed is None:
            unclosed = ends_inside(source)
            source.seek(0)
        if unclosed:
            if start == 0:
                yield emit(file, None, 0, 1, {}, "quote is never closed")
            return
        header = b"\n"
        while header and not header.strip(b"\r\n"):
            header, _ = record(source)
        if not header:
            return
        if same_header:
            check(file, header)
        header = header if header.endswith(b"\n") else header + b"\n"
        at = source.tell()
        if start > at:
            source.seek(start - 1)
            source.readline()
            while inside and (line := source.readline()):
                inside = is_open(line, inside) if b'"' in line else inside
            at = source.tell()
        first, held, size = at, [], 0
        while at + size < stop:
            found, _ = record(source)
            if not found:
                break
            held.append(found)
            size += len(found)
            if size > block_bytes:
                yield from parse(file, header, first, held)
                at += size
                first, held, size = at, [], 0
        if held:
            yield from parse(file, header, first, held)

    def read(batches):
        import io

        for batch in batches:
            if open_file is None:
                for file, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                    data = content.as_buffer().to_pybytes()
                    yield from split_rows(file, io.BytesIO(data), 0, len(data), False, None)
                continue
            for file, *split in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "stop", "inside", "unclosed"))):
                with open_file(file) as source:
                    yield from split_rows(file, source, *split)

    return read


def parse_lines(lines: DataFrame, column: str = "line", schema: T.StructType = REPORT_SCHEMA,
                separator: str = ";", error: str | None = None) -> DataFrame:
    """Delimited lines held in a column to one text column per field; a short line is filled up with NULL.

    ``error`` names a column for lines with too many fields or an open quote, whose other columns are then NULL; without it their surplus is dropped.
    All columns are text then.
    """
    names = [field.name for field in schema]
    ddl = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    if error is None:
        fields = F.from_csv(F.col(column), ddl, {"sep": separator, "escape": '"'})
        return blank_to_null(lines.select(fields.alias("fields")).select("fields.*"))
    # A last field of our own shows where the line ends: among the fields if there are too few, behind them if there are
    # all, and not at all if there are too many or a quote is open.
    fields = F.from_csv(F.concat(column, F.lit(separator + _END)), f"{ddl}, `{_END}` string", {"sep": separator, "escape": '"'})
    found = lines.select(fields.alias("fields"), F.col(column).alias("line"))
    cells = [F.col(f"fields.`{name}`") for name in [*names, _END]]
    complete = F.coalesce(F.array_contains(F.array(*cells), _END), F.col("line").isNull())
    kept = [F.when(complete & (cell != _END), cell).alias(name) for name, cell in zip(names, cells)]
    problem = F.when(~complete, F.concat(F.lit(f"more than {len(names)} fields or an open quote: "), "line"))
    return blank_to_null(found.select(*kept, problem.alias(error)))


#: A text that no line contains, as the last field.
_END = "\x01end of line\x01"


def render_lines(report: DataFrame, separator: str = ";") -> DataFrame:
    """Rows as delimited lines; the reverse of ``parse_lines``."""
    row = F.struct(*[F.col(f"`{name}`") for name in report.columns])
    return report.select(F.to_csv(row, {"sep": separator, "escape": '"'}).alias("line"))


def union_reports(*reports: DataFrame) -> DataFrame:
    """All rows, matched by column name; a column missing from a report is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), reports)


def require_report_columns(report: DataFrame) -> DataFrame:
    """Pass the report through if it has all its columns, else fail."""
    missing = [name for name in REPORT_COLUMNS if name not in report.columns]
    if missing:
        raise ValueError(f"report lacks columns: {', '.join(missing)}")
    return report
