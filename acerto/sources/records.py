"""Delimited records to rows, for members of archives and loose files.

Runs inside tasks. Everything is made by functions that return functions, so that it travels
with the task by value and workers need no more than pyarrow.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from acerto.schemas import NULL_TOKENS


def row_builder(wanted: Sequence[str]) -> Callable:
    """``emit(archive, member, first, count, cells, error)``: a batch of rows numbered from ``first``."""
    wanted = list(wanted)

    def emit(archive, member, first, count, cells, error=None):
        import pyarrow as pa

        arrays = [pa.repeat(pa.scalar(archive, pa.string()), count),
                  pa.repeat(pa.scalar(member, pa.string()), count),
                  pa.array(range(first, first + count), pa.int64())]
        for name in wanted:
            values = cells.get(name)
            arrays.append(pa.nulls(count, pa.string()) if values is None else values.cast(pa.string()))
        arrays.append(pa.repeat(pa.scalar(error, pa.string()), count))
        names = ["archive", "member", "row_no", *wanted, "parse_error"]
        types = [pa.string(), pa.string(), pa.int64(), *[pa.string()] * len(wanted), pa.string()]
        return pa.RecordBatch.from_arrays(arrays, schema=pa.schema(list(zip(names, types))))

    return emit


def record_reader(wanted: Sequence[str], separator: str, encoding: str, block_bytes: int) -> Callable:
    """``rows_of(archive, member, stream, first=0, closed=False, block=block_bytes)``: the rows of what ``stream()`` opens, header first.

    Columns are found by the header: one that is lacking is NULL, one that is not wanted is dropped, of
    columns with the same header the first counts. Cells with a usual "no value" text are NULL. A row with
    too few fields is filled up with NULL; one with too many has NULL columns and stands in ``parse_error`` as
    it was. An open quote, which would swallow the rest, gives one row with that error (not looked for if ``closed``). Empty lines before the header are skipped.
    """
    wanted = list(wanted)
    null_tokens = list(NULL_TOKENS)
    emit = row_builder(wanted)

    def ends_in_quote(stream):
        """An odd number of quotes is a hint; whether one stays open, a strict reader knows."""
        import csv
        import io

        quotes, source = 0, stream()
        while block := source.read(block_bytes):
            quotes += block.count(b'"')
        if quotes % 2 == 0:
            return False
        try:
            for _ in csv.reader(io.TextIOWrapper(stream(), encoding=encoding, newline=""),
                                delimiter=separator, strict=True):
                pass
        except csv.Error as problem:
            return "unexpected end of data" in str(problem)
        return False

    def rows_of(archive, member, stream, first=0, closed=False, block=block_bytes):
        import csv
        import io

        import pyarrow as pa
        from pyarrow import csv as arrow_csv

        lines = csv.reader(io.TextIOWrapper(stream(), encoding=encoding, newline=""), delimiter=separator)
        header = next((line for line in lines if line), None)
        if header is None:
            return
        if not closed and ends_in_quote(stream):
            yield emit(archive, member, first, 1, {}, "quote is never closed")
            return
        if header[0].startswith("\ufeff"):
            header[0] = header[0][1:]
        odd = []

        def set_aside(row):
            odd.append((row.expected_columns, row.actual_columns, row.text))
            return "skip"

        try:
            reader = arrow_csv.open_csv(
                stream(),
                arrow_csv.ReadOptions(use_threads=False, block_size=block, encoding=encoding),
                arrow_csv.ParseOptions(delimiter=separator, newlines_in_values=True, invalid_row_handler=set_aside),
                arrow_csv.ConvertOptions(
                    column_types={name: pa.string() for name in header},
                    null_values=null_tokens, strings_can_be_null=True, quoted_strings_can_be_null=True))
        except pa.ArrowInvalid as problem:
            if "Empty CSV" in str(problem):
                return
            raise
        row_no = first

        def odd_rows():
            nonlocal row_no
            for expected, actual, text in odd:
                cells, error = {}, f"expected {expected} fields, saw {actual}: {text}"
                if actual < expected:
                    fields = next(csv.reader([text], delimiter=separator), [])
                    fields += [""] * (expected - len(fields))
                    cells = {name: pa.array([None if value in null_tokens else value], pa.string())
                             for name, value in reversed(list(zip(header, fields)))}
                    error = None
                yield emit(archive, member, row_no, 1, cells, error)
                row_no += 1
            odd.clear()

        for batch in reader:
            cells = {}
            for i, name in enumerate(batch.schema.names):
                if name in wanted:
                    cells.setdefault(name, batch.column(i))
            if batch.num_rows:
                yield emit(archive, member, row_no, batch.num_rows, cells)
            row_no += batch.num_rows
            yield from odd_rows()
        yield from odd_rows()

    return rows_of
