"""Equi-joins with explicit null, cardinality and skew behaviour.

``null_safe=True`` lets a null key match a null key. Spark still plans such a join as a hash or
sort-merge join, so it costs no more than a plain one.

Broadcasts: no join here asks for one of a table that grows. Catalyst and AQE broadcast a side when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffle both sides otherwise.

Hot keys: AQE splits an oversized partition of an inner, left, semi or anti join on its left side, as
long as both sides come straight from a shuffle. It cannot do so where the right side was aggregated
by the join key (there is no shuffle in between); those joins use :func:`spread_join`. Full outer
joins cannot be split at all and are not used: :func:`outer_compare` aggregates the union of both sides.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialise
from .filters import with_prefix

# A key with more rows than this on the left of a `spread_join` is cut into pieces of about this
# size. It also bounds the list of such keys: there are fewer than rows / HOT_ROWS of them.
HOT_ROWS = 4_000_000

# In a join that null keys never match, left rows with one are spread over this many pieces. It costs
# nothing: no right row has to be repeated for them.
NULL_PIECES = 1024


def join_on(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    null_safe: bool = False,
) -> DataFrame:
    """Equi-join on equally named keys; the left side's key columns are kept."""
    if not null_safe:
        return left.join(right, list(keys), how)
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    match = _all(F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys)
    joined = left.join(renamed, match, how)
    return joined.drop(*[f"__right_{k}" for k in keys])


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def inner_on(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    return join_on(left, right, keys, "inner", null_safe)


def left_on(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    return join_on(left, right, keys, "left", null_safe)


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    counted: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Inner, left, semi or anti join whose left side may hold a huge share of its rows in one key.

    Keys are counted (with partial aggregation, reading only the key columns) in ``counted``, or in
    the left side itself: give a written table on the left, or in ``counted`` an earlier table with the
    same keys, or counting repeats the work behind the left side. The counts only steer the split and need
    not be those of the left side for the result to be right. The rows of a hot key
    get a piece number from a hash of the row, and the right rows of that key are repeated once per
    piece, so no task has to take the whole key. Rows of all other keys stay in piece 0 and their
    right rows are not repeated. Nothing is sampled or dropped, and the piece number depends only on
    the row, so a recomputed task after a lost executor puts each row where it was before.

    In a null-safe join the null key is a key like all others: it is taken apart if it was counted that
    often, and else no row is repeated for it.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a {how} join cannot repeat its right side")
    keys = list(keys)
    hot = (
        (left if counted is None else counted)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .filter(F.col("__rows") > hot_rows)
        .select(*keys, F.ceil(F.col("__rows") / hot_rows).cast("int").alias("__pieces"))
    )
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
    piece = F.when(F.col("__pieces").isNotNull(), F.pmod(row_hash, F.col("__pieces")))
    if not null_safe:
        unknown = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])
        piece = piece.when(unknown, F.pmod(row_hash, F.lit(NULL_PIECES)))
    left_hot = join_on(left, hot, keys, "left", null_safe)
    left_cut = left_hot.withColumn("__piece", piece.otherwise(F.lit(0)).cast("int")).drop("__pieces")
    return join_on(left_cut, repeated(right, hot, keys, null_safe), keys + ["__piece"], how, null_safe).drop("__piece")


def repeated(right: DataFrame, hot: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """The right side of a :func:`spread_join`: rows of a key in ``hot`` once for each of its ``__pieces``, others once."""
    marked = join_on(right, hot, list(keys), "left", null_safe)
    last_piece = F.coalesce(F.col("__pieces"), F.lit(1)) - 1
    return marked.withColumn("__piece", F.explode(F.sequence(F.lit(0), last_piece))).drop("__pieces")


def unique_on(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """The same rows; the job stops, naming a key, if a key occurs twice. Null is a key.

    Every row is numbered within its key as it streams by, and a second one stops the job: the rows are
    read once and nothing is held. They end up partitioned by ``__key``, a struct of the keys that is
    never null itself, by which a join can go on without another shuffle.
    """
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    stop = F.raise_error(F.concat(F.lit(f"{what}: more than one row for key "), shown)).cast("boolean")
    place = F.row_number().over(Window.partitionBy("__key").orderBy("__key"))
    numbered = df.withColumn("__key", F.struct(*keys)).withColumn("__nr", place)
    return numbered.filter(F.when(F.col("__nr") > 1, stop).otherwise(F.lit(True))).drop("__nr")


def left_join_m1(
    left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = True, what: str = "lookup"
) -> DataFrame:
    """Left join that must find at most one right row per key, else the job fails.

    All keys of the right side are tested, in the pass that shuffles and sorts it for the join. As the right side
    does not come straight from a shuffle, a hot key on the left is not split unless the right side is broadcast.
    """
    keys = list(keys)
    tested = unique_on(right, keys, what).drop(*keys)
    key = F.struct(*keys)
    if not null_safe:
        key = F.when(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]), key)
    return left.withColumn("__key", key).join(tested, "__key", "left").drop("__key")


def join_coerced(
    left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, how: str = "inner"
) -> DataFrame:
    """Join on two key expressions of differently named or typed columns.

    The caller renames overlapping columns beforehand. The computed keys are dropped again.
    """
    a = left.withColumn("__key", left_key)
    b = right.withColumn("__key", right_key)
    return a.join(b, "__key", how).drop("__key")


def outer_compare(left: DataFrame, right: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """Both sides matched by keys (null is a key): a union of their rows and one aggregate per key.

    This takes the place of a full outer join, which cannot be split. Rows combine before the one shuffle, so a key with
    very many rows on either side is a few rows by then. Either side may have several rows for a key, best reduced as far as
    that takes no shuffle of its own. A column that a side lacks is null in its rows; ``aggs`` say what becomes of
    the values. Without any, each side must have one row per key, and its values stand.
    """
    values = [c for c in [*left.columns, *right.columns] if c not in keys]
    if len(set(values)) < len(values):
        raise ValueError(f"columns on both sides: {sorted({c for c in values if values.count(c) > 1})}")
    both = left.unionByName(right, allowMissingColumns=True)
    return both.groupBy(*keys).agg(*(aggs or [F.max(f"`{c}`").alias(c) for c in values]))


def missing_in(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """Left rows whose key is not in ``right``."""
    return join_on(left, right.select(*keys), keys, "left_anti", null_safe)


def in_set(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Left rows whose key is in ``right``."""
    return join_on(left, right.select(*keys), keys, "left_semi", null_safe)


def exists_flag(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    name: str,
    null_safe: bool = False,
    counted: DataFrame | None = None,
) -> DataFrame:
    """All left rows, with a column telling whether the key is in ``right``.

    Where left rows may pile up on a key, ``counted`` gives a table to find such keys in.
    """
    marked = right.select(*keys).distinct().withColumn(name, F.lit(True))
    if counted is None:
        joined = left_on(left, marked, keys, null_safe)
    else:
        joined = spread_join(left, marked, keys, "left", null_safe, counted)
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def left_many(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Left join from one row per key to right rows that may pile up on a key.

    A left join can only be split on its left. So the matches are an inner join, which can be split on the
    side of the right rows. They are written once, and the gaps are the left rows whose key is not among the
    written keys: the right side is read once.
    """
    values = [c for c in right.columns if c not in keys]
    found = materialise(join_on(right, left, keys, "inner", null_safe).select(*left.columns, *values), "matches")
    gaps = missing_in(left, found.select(*keys).distinct(), keys, null_safe)
    return found.unionByName(gaps, allowMissingColumns=True)


def map_column(c: Column, mapping: Mapping, default=None) -> Column:
    """Value-to-value lookup in a small fixed mapping; unknown values give ``default``."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    found = F.create_map(*pairs)[c]
    return found if default is None else F.coalesce(found, F.lit(default))


def coverage_grid(
    expected: DataFrame,
    dimension: Sequence[Mapping[str, str]],
    actual: DataFrame,
    keys: Sequence[str],
    defaults: Mapping[str, str],
) -> DataFrame:
    """Every expected row for every member of a fixed dimension, with its actual rows.

    A cell with actual rows yields one row for each, a cell without yields one row of ``defaults``
    (null where none is given). ``dimension`` is a constant list, unrolled in place rather than
    cross-joined.
    """
    members = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in m.items()]) for m in dimension])
    cells = expected.withColumn("__member", F.explode(members)).select(*expected.columns, "__member.*")
    values = [c for c in actual.columns if c not in keys]
    clash = [c for c in values if c in cells.columns]
    if clash:
        raise ValueError(f"columns on both sides of the grid: {clash}")

    marked = actual.withColumn("__found", F.lit(True))
    grid = left_many(cells, marked, keys)
    filled = {
        c: F.when(F.col("__found"), F.col(c)).otherwise(F.lit(v).cast(actual.schema[c].dataType))
        for c, v in defaults.items()
        if c not in keys
    }
    return grid.withColumns(filled).drop("__found")


def enrich_roles(
    df: DataFrame, details: DataFrame, keys: Mapping[str, str], roles: Mapping[str, str], null_safe: bool = True
) -> DataFrame:
    """The same details looked up once per role.

    ``keys`` maps each key column of ``details`` to its column in ``df``, with ``{role}`` for the role's
    name; ``roles`` maps a role to the prefix its details get. ``details`` has one row per key.
    """
    for role, prefix in roles.items():
        own = {k: c.format(role=role) for k, c in keys.items()}
        renamed = with_prefix(details, prefix).withColumnsRenamed({prefix + k: c for k, c in own.items()})
        df = left_on(df, renamed, list(own.values()), null_safe)
    return df


def lookup_by_dataset(df: DataFrame, lookup: DataFrame, value: str, name: str) -> DataFrame:
    """Value from the lookup of the row's own dataset.

    ``lookup`` gathers the lookups of all datasets and holds one row per (dataset, entity).
    """
    values = lookup.select("dataset", "entity", F.col(value).alias(name))
    return left_on(df, values, ["dataset", "entity"], null_safe=True)
