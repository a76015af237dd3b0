"""Nested data to rows, rows to columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parse_details

MAX_PIVOT_COLUMNS = 1000

_MATCH = "array<struct<entity_a:string,organisation_entity_a:string,entity_b:string,organisation_entity_b:string>>"


def explode_entities(df: DataFrame, col: str = "details") -> DataFrame:
    """One row per listed entity; an empty list leaves one row with a null entity."""
    listed = F.from_json(F.col(col), "entities array<string>")["entities"]
    return df.withColumn("entity", F.explode_outer(listed)).drop(col)


def explode_matches(df: DataFrame, col: str = "details") -> DataFrame:
    """One row per complete and per single match, labelled in ``message``."""
    details = parse_details(F.col(col), f"complete_matches {_MATCH}, single_matches {_MATCH}")

    def labelled(field: str, label: str) -> Column:
        matches = F.coalesce(details[field], F.array().cast(_MATCH))
        return F.transform(matches, lambda m: F.struct(F.lit(label).alias("message"), m.alias("match")))

    kept = [c for c in df.columns if c != col]
    both = F.concat(labelled("complete_matches", "complete_match"), labelled("single_matches", "single_match"))
    rows = df.withColumn("__m", F.explode(both))
    return rows.select(*kept, "__m.message", "__m.match.*")


def distinct_values(df: DataFrame, col: str, limit: int = MAX_PIVOT_COLUMNS) -> list:
    """The known distinct values of a column, sorted, for use as report columns.

    Runs a job. A column with more than ``limit`` values is refused, so the driver never receives more.
    """
    rows = df.select(col).dropna().distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{col} has more than {limit} values, too many for report columns")
    return sorted(r[0] for r in rows)


def pivot_labels(
    df: DataFrame, index: Sequence[str], col: str, val: str, values: Sequence[str]
) -> DataFrame:
    """Long to wide, one column per given value; null index values are kept.

    Two rows for one cell stop the job: the report would have to pick one.
    """
    key = ", ".join(index)
    cells = []
    for v in values:
        here = F.col(col) == F.lit(v)
        message = F.lit(f"pivot: more than one row for {v} and one ({key})")
        cell = F.when(F.count_if(here) > 1, F.raise_error(message)).otherwise(F.max(F.when(here, F.col(val))))
        cells.append(cell.alias(v))
    return df.groupBy(*index).agg(*cells)


def fill_pivot(df: DataFrame, cols: Sequence[str], default: str) -> DataFrame:
    """Fill gaps in the pivoted columns only."""
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(default)) for c in cols})


def spec_fields(listed: Column, allowed: Column, sep: str = ";") -> Column:
    """Members of a delimited list that are in ``allowed``, in their order and with repeats."""
    parts = F.coalesce(F.split(listed, sep), F.array().cast("array<string>"))
    known = F.coalesce(allowed, F.array().cast("array<string>"))
    return F.filter(parts, lambda x: F.array_contains(known, x))


def array_len(c: Column) -> Column:
    """Number of elements, 0 for null."""
    return F.when(c.isNull(), F.lit(0)).otherwise(F.size(c))


def criteria_flags(criteria_col: str, counted_col: str, criteria: Mapping[str, str] | Sequence[str]) -> list[Column]:
    """Aggregates, one per criterion: true when the group has no issue against it."""
    return [
        F.coalesce(
            ~F.bool_or((F.col(criteria_col) == F.lit(c)) & F.col(counted_col).isNotNull()), F.lit(True)
        ).alias(c)
        for c in criteria
    ]
