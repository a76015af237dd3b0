"""Row filters and column layout."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import is_blank, parse_ts


def missing(df: DataFrame, col: str) -> Column:
    """True where the value is null or, for text, blank.

    Typed columns get a bare null test, which Parquet can evaluate from its statistics.
    """
    if isinstance(df.schema[col].dataType, T.StringType):
        return is_blank(F.col(col))
    return F.col(col).isNull()


def timestamp_of(df: DataFrame, col: str, strict: bool = False) -> Column:
    """The column as a wall-clock timestamp. Only text has to be parsed."""
    if isinstance(df.schema[col].dataType, T.StringType):
        return parse_ts(F.col(col), strict)
    return F.col(col).cast("timestamp_ntz")


def active(df: DataFrame, col: str = "end_date") -> DataFrame:
    """Rows that have not ended."""
    return df.filter(missing(df, col))


def ended(df: DataFrame, col: str = "end_date") -> DataFrame:
    return df.filter(~missing(df, col))


def isin(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    return df.filter(F.col(col).isin(list(values)))


def exclude(df: DataFrame, col: str, value) -> DataFrame:
    """Rows whose value is known and different: as in SQL, null is dropped too."""
    return df.filter(F.col(col) != F.lit(value))


def order_columns(df: DataFrame, front: Iterable[str], last: Iterable[str] = ()) -> DataFrame:
    """Some columns first, some last, the rest between in their present order."""
    front, last = list(front), list(last)
    middle = [c for c in df.columns if c not in front and c not in last]
    return df.select(*[F.col(f"`{c}`") for c in front + middle + last])


def with_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """Every column renamed, so that a table can be joined in a second role."""
    return df.toDF(*[prefix + c for c in df.columns])
