"""Flight tables from delimited text or Parquet.

The columns are declared, not inferred, so the file is read once and the CSV reader itself
turns cells into numbers. Numeric cells are read as doubles first, because a whole number
may be written "1.0".
"""

from __future__ import annotations

import json
import uuid
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.text import VISIBLE, from_number, is_blank, number, stripped
from tarmac.model import FLIGHTS, FLIGHTS_RAW
from tarmac.sources import files

# Quotes inside quoted cells are doubled; the reader and the writer agree on it.
CSV_FORMAT = {"sep": ",", "quote": '"', "escape": '"'}

REQUIRED = ("month", "cancelled")

# Marks that no line holds, as nobody knows them before the process starts.
_OWN = "\u0001" + uuid.uuid4().hex
_HIDDEN_COMMA = _OWN + "c"
_QUOTED_BLANK = _OWN + "b"  # is an empty text, while a blank without quotes is none

# Anything but white space, and but the mark of an empty text.
_SOMETHING = f"(?s)^(?!{_QUOTED_BLANK}$).*{VISIBLE}"

# A whole line as one cell: nothing separates and nothing quotes.
LINE_FORMAT = {"sep": _OWN, "quote": ""}

MANIFEST = "_rungs.json"

_CELLS = "_cells"
_TYPED = "_typed"


def header_names(spark: SparkSession, path) -> list[str]:
    """Column names in the first line; reads no more than that."""
    return spark.read.options(**CSV_FORMAT, header=True).csv(path).columns


def scan_csv(spark: SparkSession, path, schema: T.StructType = FLIGHTS_RAW) -> DataFrame:
    """The columns of ``schema``, found by name in the header; other columns are not parsed.

    A cell that does not fit its type is NULL. Each file is read by its own header.
    """
    scans = []
    for names, found in _layouts(spark, path, schema):
        lines = (
            spark.read.schema(_file_schema(names, schema))
            .options(**CSV_FORMAT, header=True, enforceSchema=False)
            .csv(found)
        )
        scans.append(lines.select(*(_value(field, F.col(field.name)) for field in schema)))
    return reduce(DataFrame.unionAll, scans)


def scan_tolerant(
    spark: SparkSession, path, schema: T.StructType = FLIGHTS, lines: Observation | None = None
) -> DataFrame:
    """Like ``scan_csv``, but a line that does not parse is dropped as a whole.

    A line is dropped if it repeats the header, if it ends before one of the columns, if
    month or cancelled is blank or junk, or if another number is neither blank nor a number.
    Cells lose the white space around them. ``scan_report`` tells how many lines went; ``lines``
    counts all lines in the job that uses the rows, as "lines".

    Lines are split here and not by the CSV reader, in time that is linear in the line and only
    up to the last column wanted: no line, however long or badly quoted, fails the job.
    """
    layouts = _layouts(spark, path, schema)
    names = layouts[0][0]
    cells = [_lines(spark, found, layout, schema, header=True) for layout, found in layouts]
    if len(layouts) > 1:  # the wanted cells in the schema's order; none of a line that lacks one
        names = schema.names
        cells = [
            lines.select(
                F.when(
                    F.size(_CELLS) >= _needed(layout, schema), F.array(*(_cell(layout.index(name)) for name in names))
                ).otherwise(F.array().cast("array<string>")).alias(_CELLS)
            )
            for lines, (layout, _) in zip(cells, layouts)
        ]
    every = reduce(DataFrame.unionAll, cells)
    if lines is not None:
        every = every.observe(lines, F.count("*").alias("lines"))
    return _kept(every, names, schema)


def scan_positional(
    spark: SparkSession, path, schema: T.StructType = FLIGHTS, layout: T.StructType = FLIGHTS
) -> DataFrame:
    """Like ``scan_tolerant`` for files laid out as ``layout``, with or without a header."""
    names = layout.names
    return _kept(_lines(spark, path, names, schema, header=False), names, schema)


def scan_report(spark: SparkSession, path, schema: T.StructType = FLIGHTS) -> DataFrame:
    """How many lines ``scan_tolerant`` keeps and drops, and why, in one pass."""
    statuses = []
    for names, found in _layouts(spark, path, schema):
        lines = _typed(_lines(spark, found, names, schema, header=True), names, schema)
        is_header = F.coalesce(F.lower(F.trim(_cell(0))) == names[0].lower(), F.lit(False))
        status = F.when(is_header, "header").when(_is_kept(names, schema), "kept").otherwise("malformed")
        statuses.append(lines.select(status.alias("status")))
    return reduce(DataFrame.unionAll, statuses).groupBy("status").agg(F.count("*").alias("lines"))


def is_text(path, form: str | None = None) -> bool:
    """Whether ``read_flights`` takes the path for delimited text."""
    return form == "csv" if form else str(path).rstrip("/").endswith((".csv", ".csv.gz"))


def read_flights(
    spark: SparkSession,
    path,
    schema: T.StructType = FLIGHTS,
    form: str | None = None,
    lines: Observation | None = None,
) -> DataFrame:
    """Clean flights from a Parquet table or delimited text.

    ``form`` is "csv" or "parquet"; without it a path that ends in ``.csv`` or ``.csv.gz`` is text, of
    which ``lines`` counts the lines.
    """
    if is_text(path, form):
        return scan_tolerant(spark, path, schema, lines)
    return spark.read.parquet(path).select(*schema.names)


def rung_folders(spark: SparkSession, out_dir: str, name: str) -> list[str]:
    """The folders that make up a subset which ``write_rungs`` has written; [] of one without rows."""
    rungs = json.loads(files.read_text(spark, f"{out_dir}/{MANIFEST}"))
    if name not in rungs:
        raise ValueError(f"no subset {name!r} in {out_dir}, but {sorted(rungs)}")
    return [f"{str(out_dir).rstrip('/')}/{folder}" for folder in rungs[name]]


def read_rung(
    spark: SparkSession, out_dir: str, name: str, schema: T.StructType = FLIGHTS, lines: Observation | None = None
) -> DataFrame:
    """The flights of a subset as the union of its folders."""
    folders = rung_folders(spark, out_dir, name)
    return scan_tolerant(spark, folders, schema, lines) if folders else spark.createDataFrame([], schema)


def _layouts(spark: SparkSession, path, schema: T.StructType) -> list[tuple[list[str], list[str]]]:
    """The column names of the files that a path stands for, and the files that have them.

    The driver reads the first line of each file. Files with the same header are one scan, so there are as
    many scans as different headers; mostly that is one, of the path itself.
    """
    paths = [path] if isinstance(path, str) else list(path)
    by_header: dict[str, list[str]] = {}
    for file in (file for p in paths for file in files.listed(spark, p) if file.size):
        by_header.setdefault(files.first_line(spark, file.path), []).append(file.path)
    if len(by_header) <= 1:
        return [(_checked_header(header_names(spark, paths), schema), paths)]
    by_names: dict[tuple, list[str]] = {}
    for found in by_header.values():
        by_names.setdefault(tuple(_checked_header(header_names(spark, found[:1]), schema)), []).extend(found)
    return [(list(names), found) for names, found in by_names.items()]


def _checked_header(header: list[str], schema: T.StructType) -> list[str]:
    """The header's names, in the letters of ``schema`` where they differ only in case."""
    known = {name.lower(): name for name in schema.names}
    names = [known.get(name.strip().lower(), name) for name in header]
    missing = [name for name in schema.names if name not in names]
    if missing:
        raise ValueError(f"columns not in the header: {missing}")
    twice = [name for name in schema.names if names.count(name) > 1]
    if twice:
        raise ValueError(f"columns more than once in the header: {twice}")
    return names


def _is_text(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.StringType)


def _file_schema(names, schema: T.StructType) -> T.StructType:
    """All columns of the file: doubles where ``schema`` wants a number, text elsewhere."""
    numbers = {field.name for field in schema if not _is_text(field)}
    return T.StructType(
        [T.StructField(n, T.DoubleType() if n in numbers else T.StringType()) for n in names]
    )


def _lines(spark: SparkSession, path, names, schema: T.StructType, header: bool) -> DataFrame:
    """The cells of each line, up to the last one wanted; the rest of the line is one more."""
    whole = spark.read.options(**LINE_FORMAT, header=header)
    (text,) = whole.csv(path).columns if header else ("line",)
    lines = whole.options(enforceSchema=not header).schema(T.StructType([T.StructField(text, T.StringType())])).csv(path)
    line = F.col(f"`{text.replace('`', '``')}`")
    # as a generator, so that a line is split once and not again for each column
    return lines.select(F.explode(F.array(_split(line, _needed(names, schema)))).alias(_CELLS))


def _needed(names, schema: T.StructType) -> int:
    return 1 + max(names.index(name) for name in schema.names)


def _split(line: Column, needed: int) -> Column:
    """Cells without quotes and white space around them. Of the pieces between quotes every second one
    is inside; commas there do not separate."""

    def unquoted(cell: Column) -> Column:
        bare = stripped(F.replace(cell, F.lit(_HIDDEN_COMMA), F.lit(",")))
        inside = stripped(F.replace(F.substring(bare, F.lit(2), F.length(bare) - 2), F.lit('""'), F.lit('"')))
        quoted = bare.startswith('"') & bare.endswith('"') & (F.length(bare) > 1)
        return F.when(quoted & (inside == ""), F.lit(_QUOTED_BLANK)).when(quoted, inside).otherwise(bare)

    between = F.transform(
        F.split(line, '"', -1),
        lambda piece, i: F.when(i % 2 == 1, F.replace(piece, F.lit(","), F.lit(_HIDDEN_COMMA))).otherwise(piece),
    )
    quoted = F.transform(F.split(F.array_join(between, '"'), ",", needed + 1), unquoted)
    return F.when(line.contains('"'), quoted).otherwise(F.split(line, ",", needed + 1))


def _value(field: T.StructField, cell: Column) -> Column:
    return (cell if _is_text(field) else from_number(cell, field)).alias(field.name)


def _cell(place: int) -> Column:
    return F.get(F.col(_CELLS), F.lit(place))


def _typed(lines: DataFrame, names, schema: T.StructType) -> DataFrame:
    """The lines with their wanted numbers as ``_typed``. As a generator, so that a cell is read once and not again
    for what is then asked about it."""
    values = [
        from_number(number(_cell(names.index(field.name))), field).alias(field.name) for field in schema if not _is_text(field)
    ]
    typed = F.struct(*values) if values else F.struct(F.lit(None).alias("none"))
    return lines.select(_CELLS, F.explode(F.array(typed)).alias(_TYPED))


def _is_kept(names, schema: T.StructType) -> Column:
    """Whether the line has all wanted cells, no junk among them, and a month and a status.

    The test names every wanted number, so a query that needs fewer columns drops the same lines.
    """
    fine = [F.size(_CELLS) >= _needed(names, schema)]
    for field in schema:
        if _is_text(field):
            continue
        found = F.col(f"{_TYPED}.{field.name}").isNotNull()
        cell = _cell(names.index(field.name))
        if field.name not in REQUIRED:  # what is no number is looked at once more
            found = found | ~F.coalesce(cell.rlike(_SOMETHING), F.lit(False))
            if isinstance(field.dataType, T.IntegerType):  # one that is too large is a number
                found = found | number(cell).isNotNull()
        fine.append(found)
    return F.coalesce(reduce(and_, fine), F.lit(False))


def _kept(lines: DataFrame, names, schema: T.StructType) -> DataFrame:
    def value(field: T.StructField) -> Column:
        if not _is_text(field):
            return F.col(f"{_TYPED}.{field.name}").alias(field.name)
        cell = _cell(names.index(field.name))
        found = F.when(cell == _QUOTED_BLANK, F.lit("")).when(~is_blank(cell), stripped(cell))
        return found.alias(field.name)

    return _typed(lines, names, schema).filter(_is_kept(names, schema)).select(*map(value, schema))
