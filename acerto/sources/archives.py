"""Report archives: list them, unpack them, turn their members into rows.

Archives are listed as binary rows, so listing and (in a stream) bookkeeping are Spark's. There are two ways on.
``expand_members`` reads no more than the directory of each archive, deals its members to tasks and opens each
where it lies, so one large archive is read by as many tasks as it has members. ``expand_archives`` gets the
content with the row, for folders that only Spark can open; there an archive is one task. Both hand back Arrow
batches as they read, and neither holds a member as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acerto.config import REPORT_MEMBER_PREFIX
from acerto.schemas import REPORT_COLUMNS
from acerto.sources.records import record_reader, row_builder

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
_MEMBERS_SCHEMA = "archive string, position long, error string"


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The zip files directly in a folder; ``content`` is only read if it is used."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.zip")
            .load(folder))


def member_schema(columns: tuple[str, ...] | list[str]) -> T.StructType:
    """Where a row comes from, the wanted columns as text, and what is wrong with it."""
    return T.StructType([
        T.StructField("archive", T.StringType()),
        T.StructField("member", T.StringType()),
        T.StructField("row_no", T.LongType()),
        *[T.StructField(name, T.StringType()) for name in columns],
        T.StructField("parse_error", T.StringType()),
    ])


def _unreadable() -> tuple[type[Exception], ...]:
    """What reading a broken archive or member raises; errors of the file system are not among them."""
    import csv
    import zipfile
    import zlib

    import pyarrow as pa

    return (zipfile.BadZipFile, zlib.error, EOFError, UnicodeError, pa.ArrowInvalid, csv.Error, NotImplementedError)


def expand_archives(archives: DataFrame, columns: tuple[str, ...] | list[str] | None = None,
                    prefix: str = REPORT_MEMBER_PREFIX, separator: str = ";",
                    encoding: str = "utf8", block_bytes: int = 4 << 20,
                    nested: bool = True) -> DataFrame:
    """Rows of all members whose name starts with ``prefix``, from the content of each archive.

    Columns are found by the header of each member: one that a member lacks is
    NULL there, one that is not asked for is dropped. Cells with a usual "no
    value" text are NULL. A row with too few fields is filled up with NULL; one
    with too many has NULL columns and stands in ``parse_error`` as it was.
    Empty lines before the header are skipped; of columns with the same header the first counts.
    A member with an open quote, which would swallow its rest, gives one row with that error, and
    so does an archive or member that cannot be read, after the rows read so far. Members inside folders
    of the archive are read as well, unless ``nested`` is false. ``row_no`` tells the rows of a member apart.
    ``archives`` needs ``path`` and ``content``.
    """
    wanted = list(REPORT_COLUMNS) if columns is None else list(columns)
    rows_of = record_reader(wanted, separator, encoding, block_bytes)
    emit = row_builder(wanted)
    unreadable = _unreadable()

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zipfile

        import pyarrow as pa

        def members_of(archive, content):
            member = None
            try:
                with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as zipped:
                    for info in zipped.infolist():
                        folder, _, name = info.filename.rpartition("/")
                        if (nested or not folder) and not info.is_dir() and name.startswith(prefix):
                            member = name
                            yield from rows_of(archive, member, lambda info=info: zipped.open(info))
                            member = None
            except unreadable as problem:
                yield emit(archive, member, 0, 1, {}, f"unreadable: {type(problem).__name__}")

        for batch in batches:
            for archive, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                yield from members_of(archive, content)

    return archives.select("path", "content").mapInArrow(unpack, member_schema(wanted))


def tasks_can_open(folder: str) -> bool:
    """Whether tasks open the files of ``folder`` by themselves: paths of a mounted file system."""
    return urlparse(str(folder)).scheme in ("", "file")


def file_opener():
    """``open_file(path)``: a seekable file for a path as Spark writes it; other schemes through pyarrow."""
    def open_file(path):
        scheme, found, rest = path.partition(":")
        if not found or "/" in scheme:
            return open(path, "rb")
        if scheme == "file":
            return open("/" + rest.lstrip("/"), "rb")
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(f"s3:{rest}" if scheme == "s3a" else path)
        return system.open_input_file(inner)

    return open_file


def list_members(archives: DataFrame, prefix: str = REPORT_MEMBER_PREFIX, nested: bool = True) -> DataFrame:
    """Members whose name starts with ``prefix``, from the directory at the end of each archive.

    One row each: ``archive``, ``position`` in the directory and no ``error``; for an archive without a
    readable directory one row with the error. ``archives`` needs ``path``.
    """
    open_file, unreadable = file_opener(), _unreadable()

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zipfile

        import pyarrow as pa

        for batch in batches:
            for archive in batch.column("path").to_pylist():
                positions, error = [], None
                with open_file(archive) as file:
                    try:
                        with zipfile.ZipFile(file) as zipped:
                            for i, info in enumerate(zipped.infolist()):
                                folder, _, name = info.filename.rpartition("/")
                                if (nested or not folder) and not info.is_dir() and name.startswith(prefix):
                                    positions.append(i)
                    except unreadable as problem:
                        positions, error = [None], f"unreadable: {type(problem).__name__}"
                count = len(positions)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([archive] * count, pa.string()), pa.array(positions, pa.int64()),
                     pa.array([error] * count, pa.string())], names=["archive", "position", "error"])

    return archives.select("path").mapInArrow(look_up, _MEMBERS_SCHEMA)


def expand_members(archives: DataFrame, columns: tuple[str, ...] | list[str] | None = None,
                   prefix: str = REPORT_MEMBER_PREFIX, separator: str = ";",
                   encoding: str = "utf8", block_bytes: int = 4 << 20,
                   nested: bool = True, tasks: int | None = None) -> DataFrame:
    """The rows of ``expand_archives``, with the members of an archive dealt to different tasks.

    Neighbours in an archive's directory go to neighbouring tasks, so an archive of 50 members is read by 50 of
    ``tasks`` (the session's shuffle partitions by default), and a task holds a block of one member. What is
    shuffled is a row for each member. Tasks open the archives themselves, so their paths
    must mean the same on every machine (``tasks_can_open``). ``archives`` needs ``path``; works on streams.
    """
    wanted = list(REPORT_COLUMNS) if columns is None else list(columns)
    tasks = tasks or int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows_of = record_reader(wanted, separator, encoding, block_bytes)
    emit = row_builder(wanted)
    open_file, unreadable = file_opener(), _unreadable()

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zipfile

        is_open, file, zipped = None, None, None
        try:
            for batch in batches:
                for archive, position, error in zip(*(batch.column(c).to_pylist() for c in ("archive", "position", "error"))):
                    if error is not None:
                        yield emit(archive, None, 0, 1, {}, error)
                        continue
                    if archive != is_open:
                        if file is not None:
                            file.close()
                        file = open_file(archive)
                        is_open, zipped = archive, zipfile.ZipFile(file)
                    info = zipped.infolist()[position]
                    member = info.filename.rpartition("/")[2]
                    try:
                        yield from rows_of(archive, member, lambda: zipped.open(info))
                    except unreadable as problem:
                        yield emit(archive, member, 0, 1, {}, f"unreadable: {type(problem).__name__}")
        finally:
            if file is not None:
                file.close()

    dealt = F.pmod(F.hash("archive") + F.coalesce("position", F.lit(0)), F.lit(tasks)).cast("int")
    return (list_members(archives, prefix, nested).repartitionById(tasks, dealt)
            .mapInArrow(unpack, member_schema(wanted)))
