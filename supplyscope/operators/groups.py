"""Grouped aggregates. All combine before the shuffle, so one large group stays cheap."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fraction


def known_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any grouping key, for groupings that ignore unknown keys."""
    return df.dropna(subset=list(keys))


def grouped(df: DataFrame, keys: Sequence[str], *aggs: Column, dropna: bool = True) -> DataFrame:
    """Group and aggregate; null keys are dropped, or kept as a group of their own."""
    rows = known_keys(df, keys) if dropna else df
    return rows.groupBy(*keys).agg(*aggs)


def group_count(
    df: DataFrame, keys: Sequence[str], col: str | None = None, name: str = "count", dropna: bool = True
) -> DataFrame:
    """Rows per group, or non-null values of ``col`` per group."""
    counted = F.count(F.lit(1) if col is None else F.col(col))
    return grouped(df, keys, counted.alias(name), dropna=dropna)


def group_distinct(
    df: DataFrame, keys: Sequence[str], cols: Mapping[str, str], dropna: bool = False
) -> DataFrame:
    """Exact distinct counts in which null is a value; ``cols`` maps a column to the name of its count.

    Two levels: rows are first reduced to the distinct values of a group, which the shuffle deals out by key and value,
    so a group with most of the rows is spread over all tasks; then what is left, a row for
    each value, is counted with partial aggregation. Columns are counted as rows of (column, value) and not by one
    expansion for each. Values are compared by their text, which tells all values of simple types apart.
    """
    rows = known_keys(df, keys) if dropna else df
    values = [F.struct(F.lit(k).alias("__of"), F.col(c).cast("string").alias("__value")) for k, c in enumerate(cols)]
    tall = rows.select(*keys, F.explode(F.array(*values)).alias("__x")).select(*keys, "__x.*")
    counts = [F.count_if(F.col("__of") == k).alias(name) for k, name in enumerate(cols.values())]
    return tall.distinct().groupBy(*keys).agg(*counts)


def group_min_max(df: DataFrame, keys: Sequence[str], col: str, dropna: bool = True) -> DataFrame:
    return grouped(df, keys, F.min(col).alias(f"min_{col}"), F.max(col).alias(f"max_{col}"), dropna=dropna)


def group_any(df: DataFrame, keys: Sequence[str], p: Column, name: str, dropna: bool = True) -> DataFrame:
    """Whether any row of the group satisfies ``p``."""
    return grouped(df, keys, F.bool_or(p).alias(name), dropna=dropna)


def first_non_null(col: str, order: str) -> Column:
    """Aggregate: the value of the earliest row that has one."""
    return F.min_by(F.col(col), F.when(F.col(col).isNotNull(), F.col(order)))


def representative(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One whole row per group: the least by ``order``, then by the remaining columns."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    own = [c for c in order if c not in keys]
    chosen = F.min(F.struct(*own, *rest)).alias("__row")
    return df.groupBy(*keys).agg(chosen).select(*keys, "__row.*").select(*df.columns)


def covers_days(day: Column, as_of: Column, n: int) -> Column:
    """Aggregate: whether every one of the ``n`` days before ``as_of`` occurs.

    Each day sets one bit, so the state is a single number rather than a set of dates.
    """
    ago = F.date_diff(as_of, day)
    bits = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.when(ago.between(1, n), ago - 1))
    return F.coalesce(F.bit_or(bits) == F.lit((1 << n) - 1), F.lit(False))


def missing_stats(total: Column, missing: Column) -> Column:
    """Percentage, 0 for no rows."""
    return F.coalesce(fraction(missing * 100.0, total), F.lit(0.0))


def band_counts(
    df: DataFrame, key: str, col: str, edges: Sequence[float], names: Sequence[str], members: Sequence[str]
) -> DataFrame:
    """Rows per band of ``col`` for each fixed member of ``key``; a member without rows gets zeros.

    ``edges`` are the lower bounds of all bands but the first.
    """
    x = F.col(col)
    bounds = [None, *edges, None]
    bands = []
    for low, high, name in zip(bounds[:-1], bounds[1:], names, strict=True):
        inside = x.isNotNull() if low is None else x >= low
        if high is not None:
            inside = inside & (x < high)
        bands.append(F.count_if(inside).alias(name))
    counted = df.filter(F.col(key).isin(list(members))).groupBy(key).agg(*bands)
    numbered = F.posexplode(F.array(*[F.lit(m) for m in members])).alias("__nr", key)
    fixed = df.sparkSession.range(1).select(numbered)
    joined = fixed.join(counted, key, "left").fillna(0, subset=list(names))
    return joined.orderBy("__nr").select(key, *[F.col(f"`{n}`") for n in names])


def row_multiplicity(rows: DataFrame, facts: DataFrame, key: str, name: str) -> DataFrame:
    """Facts per key times the number of rows sharing that key, one line per key."""
    shared = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__shared"))
    counted = facts.groupBy(key).agg(F.count(F.lit(1)).alias("__facts"))
    return shared.join(counted, key).select(key, (F.col("__shared") * F.col("__facts")).alias(name))
