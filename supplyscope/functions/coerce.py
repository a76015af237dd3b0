"""Type coercion that never fails on bad text, whatever the session's ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal notation. Java's own number parser also takes suffixes such as "1d".
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_INTEGER = r"^\s*[+-]?\d+\s*$"
_WHOLE = r"^\s*[+-]?\d+(\.0*)?\s*$"

# The patterns are tested first, so that a cast seldom fails: a failing try_cast is many times slower.


def to_long(c: Column) -> Column:
    """Whole number or null: ``"12"`` and ``"12.0"`` give 12, ``"12.5"`` and ``"x"`` give null."""
    text = c.cast("string")
    as_double = text.try_cast("double")
    other = F.when(as_double == F.floor(as_double), as_double.try_cast("bigint"))
    return F.when(text.rlike(_WHOLE), F.substring_index(text, ".", 1).try_cast("bigint")).when(
        text.rlike(_NUMBER), other
    )


def to_number_or_zero(c: Column, kind: str = "double") -> Column:
    """A number, with 0 for blank or invalid text. As an integer, ``"1.0"`` is invalid too."""
    text = c.cast("string")
    if kind == "double":
        return F.coalesce(F.when(text.rlike(_NUMBER), text.try_cast("double")), F.lit(0.0))
    if kind == "bigint":
        return F.coalesce(F.when(text.rlike(_INTEGER), text.try_cast("bigint")), F.lit(0).cast("bigint"))
    raise ValueError(f"unsupported number type: {kind}")


def parse_ts(c: Column, strict: bool = False) -> Column:
    """Wall-clock timestamp. Bad text gives null, or stops the job when ``strict``."""
    parsed = F.when(c.cast("string").rlike(r"^\s*\d"), c.try_cast("timestamp_ntz"))
    if not strict:
        return parsed
    message = F.concat(F.lit("not a timestamp: "), c.cast("string"))
    return F.when(c.isNotNull() & parsed.isNull(), F.raise_error(message)).otherwise(parsed)


def to_day(c: Column) -> Column:
    return c.try_cast("date")
