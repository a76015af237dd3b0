"""Conditions, flags and small numeric rules with their null behaviour spelled out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(c: Column) -> Column:
    """Null, empty or only white space."""
    return c.isNull() | c.cast("string").rlike(r"(?U)^\s*$")


def true_only(p: Column) -> Column:
    """A condition in which unknown counts as false."""
    return F.coalesce(p, F.lit(False))


def same(a: Column, b: Column) -> Column:
    """Equality in which null equals nothing, not even null, and the answer is never null."""
    return true_only(a == b)


def flag(p: Column, yes="yes", no="no") -> Column:
    """Two-way label; an unknown condition takes the second."""
    return F.when(p, F.lit(yes)).otherwise(F.lit(no))


def yes_no(p: Column) -> Column:
    return flag(p)


def bool_text(c: Column, invert: bool = False) -> Column:
    """``TRUE`` / ``FALSE`` text for a report; null stays null."""
    return F.when(c, F.lit("FALSE" if invert else "TRUE")).when(~c, F.lit("TRUE" if invert else "FALSE"))


def cap(c: Column, n: int) -> Column:
    """At most ``n``. Null stays null, which ``least`` would not do."""
    return F.when(c > n, F.lit(n)).otherwise(c)


def minus_one_to_zero(c: Column) -> Column:
    """Only -1 becomes 0; other negative numbers stay."""
    return F.when(c == -1, F.lit(0)).otherwise(c)


def recode(c: Column, mapping: Mapping[str, str]) -> Column:
    """Replace whole values, leaving the rest as they are."""
    result = c
    for old, new in mapping.items():
        result = F.when(c == old, F.lit(new)).otherwise(result)
    return result


def guarded_ratio(n: Column, d: Column) -> Column:
    """``n / d`` only where both are known and ``d`` is positive."""
    return F.when(d > 0, n / d)


def fraction(n: Column, d: Column) -> Column:
    """``n / d``, null for a zero denominator."""
    return F.try_divide(n, d)
