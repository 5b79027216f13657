"""Tables and reports to files, written in parallel as directories.

A directory can be made one file: its parts are written so that they only need to follow each other, and the file
system joins them (``files.join``), so that no task and no process holds the whole.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.sources import files
from tarmac.sources.reading import CSV_FORMAT, MANIFEST


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", by: str | None = None, header: bool = True) -> None:
    """Delimited text with a header in every part file. NULL and '' are both empty cells.

    ``by`` names a column whose values become folders.
    """
    writer = (
        df.write.mode(mode)
        .options(**CSV_FORMAT, header=header, emptyValue="")
        .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    )
    (writer.partitionBy(by) if by else writer).csv(path)


def write_csv_file(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Delimited text as one file with one header, rows in the order of the partitions."""
    parts = _parts_beside(df.sparkSession, path, mode)
    write_csv(df, parts, header=False)
    joined(df.sparkSession, parts, path, header_line(df.columns), "")


def header_line(columns: list[str]) -> str:
    def cell(name: str) -> str:
        return '"' + name.replace('"', '""') + '"' if any(c in name for c in ',"\r\n') else name

    return ",".join(map(cell, columns)) + "\n"


def write_report_file(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The documents as one JSON array in one file, in order of the first column; nulls are written out.

    What stands between two documents is written with the second one: a comma for all but the first, which is
    the one with the smallest key. Keys are unique, as in every report here.
    """
    spark = df.sparkSession
    parts = _parts_beside(spark, path, mode)
    key = df.columns[0]
    first = df.select(F.min(key)).first()[0]
    before = F.when(F.col(key).eqNullSafe(F.lit(first)), F.lit("")).otherwise(F.lit(","))
    in_order(df).select(F.concat(before, report_line(df)).alias("line")).write.text(parts)
    joined(spark, parts, path, "[\n", "]\n")


def _parts_beside(spark: SparkSession, path: str, mode: str) -> str:
    """Where the parts of a file go at first; a file that must not be replaced is an error here."""
    if mode == "errorifexists" and files.exists(spark, path):
        raise FileExistsError(path)
    parts = f"{path}._parts"
    files.delete(spark, parts)
    return parts


def joined(spark: SparkSession, parts: str, path: str, before: str, after: str) -> None:
    """One file of the parts that hold anything, with a text before and after them.

    The file appears under its name when it is complete.
    """
    ordered = [file.path for file in files.listed(spark, parts) if file.size]
    for name, text in (("before", before), ("after", after)):
        if text:
            files.write_text(spark, f"{parts}/{name}", text)
    ends = {name: [f"{parts}/{name}"] if text else [] for name, text in (("before", before), ("after", after))}
    files.join(spark, [*ends["before"], *ordered, *ends["after"]], f"{parts}/whole")
    files.rename(spark, f"{parts}/whole", path)
    files.delete(spark, parts)


def write_manifest(spark: SparkSession, out_dir: str, folders: dict[str, list[str]]) -> None:
    """Which folders of ``out_dir`` make up which subset."""
    files.write_text(spark, f"{out_dir}/{MANIFEST}", json.dumps(folders, indent=1))


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A Parquet table, for the reports to read only the columns they need."""
    df.write.mode(mode).parquet(path)


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON document per line, in order of the first column; nulls are written out.

    ``mode="errorifexists"`` refuses to replace a report.
    """
    in_order(df).write.mode(mode).option("ignoreNullFields", False).json(path)


def in_order(df: DataFrame) -> DataFrame:
    """Sorted by the first column; no exchange if the rows are dealt by its ranges already."""
    return df.orderBy(df.columns[0])


def report_line(df: DataFrame) -> Column:
    """A report row as the text that ``write_report`` writes."""
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("line")
