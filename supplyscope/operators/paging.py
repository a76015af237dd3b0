"""Pages of an ordered table, from a stored index of ranges.

A table is sorted once, into as many ranges of its order as there are partitions, each a folder of its own. The
index has one row for each range: the number of its first row and how many rows it has. A page, or any stretch of
row numbers, then reads the index and the ranges that it meets, whatever the size of the table.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import scratch_dir

# A row's id holds the number of its range above the bits that hold its place within it.
_PLACE_BITS = 33


def store_ordered(df: DataFrame, order: Sequence[Column | str], path: str, ranges: int | None = None) -> None:
    """Write ``df`` in an order, which should be total, with its index, under a new folder.

    Runs two jobs. The index is written last: a folder without one is no stored table.
    """
    if not order:
        raise ValueError("a page needs an order")
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    in_range = F.shiftright("__id", _PLACE_BITS).cast("int")
    ranged.withColumn("__range", in_range).write.partitionBy("__range").parquet(f"{path}/rows")
    # As many rows as ranges; the files' footers have the counts. One more row says what columns there are.
    stored = T.StructType([*ranged.schema.fields, T.StructField("__range", T.IntegerType())])
    counts = spark.read.schema(stored).parquet(f"{path}/rows").groupBy("__range").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("__range").alias("range"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"), "rows")
    columns = spark.createDataFrame([(_COLUMNS, 0, 0, ranged.schema.json())], _INDEX)
    starts.withColumn("columns", F.lit(None).cast("string")).unionByName(columns).write.parquet(f"{path}/index")


_INDEX = "range int, first bigint, rows bigint, columns string"
#: The range of the index row that holds the columns.
_COLUMNS = -1


def _index(spark: SparkSession, path: str, *which: Column) -> tuple[T.StructType, list]:
    """Columns of the stored rows, and the index rows of some ranges."""
    rows = spark.read.schema(_INDEX).parquet(f"{path}/index")
    for condition in which:
        rows = rows.filter(condition | (F.col("range") == _COLUMNS))
    found = rows.collect()
    (columns,) = (r.columns for r in found if r.range == _COLUMNS)
    return T.StructType.fromJson(json.loads(columns)), [r for r in found if r.range != _COLUMNS]


def rows_between(spark: SparkSession, path: str, low: int, high: int) -> DataFrame:
    """Rows ``low`` to before ``high`` of a stored table, counted from 0, in order. Only the ranges they are in are read."""
    schema, met = _index(spark, path, (F.col("first") < high) & (F.col("first") + F.col("rows") > low))
    if not met:
        return spark.createDataFrame([], schema).drop("__id")
    rows = spark.read.schema(schema).parquet(*[f"{path}/rows/__range={r.range}" for r in met])
    # From a row's id to its number: what to add, by range.
    shift = F.create_map(*[F.lit(x) for r in met for x in (r.range, r.first - (r.range << _PLACE_BITS))])
    at = F.col("__id") + shift[F.shiftright("__id", _PLACE_BITS).cast("int")].cast("bigint")
    inside = rows.withColumn("__at", at).filter((F.col("__at") >= low) & (F.col("__at") < high))
    return inside.orderBy("__at").drop("__at", "__id")


def read_page(spark: SparkSession, path: str, size: int, number: int) -> DataFrame:
    """Page ``number``, from 0, of a stored table in pages of ``size`` rows. Beyond the last page there are no rows."""
    return rows_between(spark, path, size * number, size * (number + 1))


def page_count(spark: SparkSession, path: str, size: int) -> int:
    rows = spark.read.schema(_INDEX).parquet(f"{path}/index")
    return -(-rows.agg(F.sum("rows")).first()[0] // size)


def page_numbers(spark: SparkSession, path: str, size: int, name: str = "page") -> DataFrame:
    """All rows of a stored table with the number of their page."""
    schema, _ = _index(spark, path, F.lit(False))
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("__range", T.IntegerType())])).parquet(f"{path}/rows")
    starts = spark.read.schema(_INDEX).parquet(f"{path}/index").select(F.col("range").alias("__range"), "first")
    place = F.col("first") + F.col("__id").bitwiseAND((1 << _PLACE_BITS) - 1)
    return rows.join(starts, "__range").withColumn(name, F.floor(place / size)).drop("__range", "__id", "first")


def page(df: DataFrame, order: Sequence[Column | str], size: int, number: int) -> DataFrame:
    """One page of a table that is not stored yet. For several pages, store it once."""
    path = scratch_dir(df.sparkSession, "ordered")
    store_ordered(df, order, path)
    return read_page(df.sparkSession, path, size, number)
