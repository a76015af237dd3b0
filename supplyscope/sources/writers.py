"""CSV report sinks.

A report is a directory of part files with a header each: nothing is pulled into one task to make a
single file, and a sorted report stays sorted across the parts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_report(df: DataFrame, path: str, columns: Sequence[str] | None = None, mode: str = "overwrite") -> None:
    """Header, declared column order, null and empty text both blank. An empty report has its header."""
    chosen = df if columns is None else df.select(*[F.col(f"`{c}`") for c in columns])
    (
        chosen.write.mode(mode)
        .option("header", True)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def export_table(df: DataFrame, path: str) -> None:
    """A whole table, unchanged."""
    write_report(df, path)


def write_reports(reports: Mapping[str, DataFrame], folder: str) -> None:
    """Several reports, each into a directory of its name."""
    for name, df in reports.items():
        write_report(df, f"{folder}/{name}")


def write_split(
    df: DataFrame, parts: Mapping[str, tuple[Column | None, Sequence[str] | None]]
) -> None:
    """Several reports from one result, each with its own row condition and columns.

    The result is computed once; blocks lost with an executor are recomputed.
    """
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for path, (condition, columns) in parts.items():
            write_report(df if condition is None else df.filter(condition), path, columns)
    finally:
        df.unpersist()
