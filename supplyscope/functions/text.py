"""Text expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_prefix(c: Column) -> Column:
    """Drop everything up to the first colon: ``a:b:c`` gives ``b:c``."""
    return F.regexp_replace(c, "^.*?:", "")


def remove_text(c: Column, text: str) -> Column:
    """Remove every literal occurrence."""
    return F.replace(c, F.lit(text), F.lit(""))


def ends_with_ci(c: Column, suffix: str) -> Column:
    return F.coalesce(F.lower(c).endswith(suffix.lower()), F.lit(False))


def like_ci(c: Column, pattern: str) -> Column:
    """LIKE without regard to case."""
    return c.ilike(pattern)


def join_code(a: Column, sep: str, b: Column) -> Column:
    """``a<sep>b``; null if either part is null."""
    return F.concat(a.cast("string"), F.lit(sep), b.cast("string"))


def first_match(c: Column, rules: Sequence[tuple[str, Column]], default: Column | None = None) -> Column:
    """The value of the first rule whose text occurs in ``c``, ignoring case."""
    lowered = F.lower(c)
    result = None
    for needle, value in rules:
        hit = lowered.contains(needle)
        result = F.when(hit, value) if result is None else result.when(hit, value)
    return result if default is None else result.otherwise(default)


def json_value(c: Column, path: str) -> Column:
    return F.get_json_object(c, path)


def parse_details(c: Column, schema: str) -> Column:
    """Parse JSON-shaped text, also with single quotes and Python's None / True / False.

    Text that cannot be parsed gives null fields.
    """
    text = c
    for word, replacement in (("None", "null"), ("True", "true"), ("False", "false")):
        text = F.regexp_replace(text, rf"([:\[,]\s*){word}(?=\s*[,}}\]])", f"$1{replacement}")
    return F.from_json(text, schema)


def n_of_total(n: Column, total: Column) -> Column:
    return join_code(n.cast("bigint"), "/", total.cast("bigint"))


def percent_label(x: Column) -> Column:
    """Whole percent, half to even: 0.125 gives ``12%``."""
    return F.concat(F.bround(x * 100).cast("bigint").cast("string"), F.lit("%"))


def decile_band(x: Column) -> Column:
    """``00-10`` ... ``90-100`` for a fraction, and ``100`` for a full one."""
    group = F.floor(x * 100 / 10)
    text = group.cast("string")
    following = (group + 1).cast("string")
    return F.when(group == 10, F.lit("100")).otherwise(F.concat(text, F.lit("0-"), following, F.lit("0")))


def pretty(name: str) -> str:
    """A column name as a heading."""
    if "_" in name:
        name = name.replace("_", " ").replace("pct", "%").replace("count", "")
    return name.title()


def pretty_text(c: Column) -> Column:
    """The cell counterpart of :func:`pretty`: only text holding an underscore is rewritten."""
    spaced = F.replace(c, F.lit("_"), F.lit(" "))
    percent = F.replace(spaced, F.lit("pct"), F.lit("%"))
    return F.when(c.contains("_"), F.replace(percent, F.lit("count"), F.lit(""))).otherwise(c)
