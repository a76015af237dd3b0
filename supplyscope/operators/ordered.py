"""Order-dependent operators: numbering, de-duplication, sorts and top-k. For pages see ``paging``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Row ids are whole numbers given once per row, so a window over this many consecutive ids holds at
# most this many rows of the source.
ID_SPAN = 1_000_000


def number_within(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    name: str,
    ties: Sequence[str] = (),
    span: int = ID_SPAN,
) -> DataFrame:
    """Running number from 1 within each group, in the order of the whole-number column ``order``.

    A plain window would sort a whole group in one task. Here a group is cut into stretches of ids;
    rows are numbered within their stretch, and each stretch starts after the rows counted in the
    stretches before it. The second window sees one row per (group, stretch).
    """
    # As a struct the group is never null itself, so the join below matches null keys with a plain
    # equality and reuses the window's partitioning.
    cut = df.withColumn("__group", F.struct(*keys)).withColumn("__stretch", F.floor(F.col(order) / span))
    piece = ["__group", "__stretch"]
    sizes = cut.groupBy(*piece).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy("__group").orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*piece, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*piece).orderBy(order, *ties)
    numbered = cut.withColumn("__nr", F.row_number().over(inside))
    joined = numbered.join(starts, piece, "left")
    return joined.withColumn(name, F.col("__start") + F.col("__nr")).drop(*piece, "__start", "__nr")


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "first") -> DataFrame:
    """One row per key: the first or last by ``order``, further ties settled by the other columns.

    An aggregate of structs rather than a window: it reduces each key to one row before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    own = [c for c in order if c not in keys]
    pick = {"first": F.min, "last": F.max}[keep]
    chosen = pick(F.struct(*own, *rest)).alias("__row")
    return df.groupBy(*keys).agg(chosen).select(*keys, "__row.*").select(*df.columns)


def dedupe_by_id(df: DataFrame, keys: Sequence[str], row_id: str, keep: str = "first") -> DataFrame:
    """One row per key: the one of least or greatest row id.

    ``row_id`` is a whole number given once per row and never null. What is aggregated is that number alone, so this is a hash
    aggregate of fixed-width state over the key columns; the rows of the chosen ids are then kept by a semi join on
    one number. :func:`dedupe` carries whole rows through its aggregate, which has to sort them by key.
    """
    pick = {"first": F.min, "last": F.max}[keep]
    chosen = df.groupBy(*keys).agg(pick(row_id).alias(row_id)).select(row_id)
    return df.join(chosen, row_id, "left_semi")


def sort_report(df: DataFrame, cols: Sequence[str], ties: Sequence[str] = ()) -> DataFrame:
    """Ascending sort with nulls last.

    ``ties`` make the order repeatable, and let the range partitioning split a value that fills a
    large part of the table.
    """
    return df.orderBy(*[F.col(f"`{c}`").asc_nulls_last() for c in [*cols, *ties]])


def sort_desc(df: DataFrame, col: str, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.col(col).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties])


def top_groups(df: DataFrame, key: str, k: int = 10, name: str = "count") -> DataFrame:
    """The ``k`` largest groups with their sizes; equal sizes in order of the key."""
    sizes = df.dropna(subset=[key]).groupBy(F.col(f"`{key}`")).agg(F.count(F.lit(1)).alias(name))
    return sizes.orderBy(F.desc(name), F.col(f"`{key}`")).limit(k)


def latest(df: DataFrame, col: str, n: int | None, ties: Sequence[str] = ()) -> DataFrame:
    """The ``n`` newest rows (all of them for None), undated rows last."""
    ordered = sort_desc(df, col, ties)
    return ordered if n is None else ordered.limit(n)
