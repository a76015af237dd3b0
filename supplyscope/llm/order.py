"""Row numbers and copies without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyscope.sources import materialise

_PER_PARTITION = 33  # bits that monotonically_increasing_id() leaves for the row within a partition


def numbered(df: DataFrame, keys: list[Column], name: str) -> DataFrame:
    """Adds ``name``, the number from 0 of each row by ``keys``, which should order rows completely.

    Rows are dealt and sorted by range and written; each range's first number is a sum over the counts of
    the ranges before it, of which there are as many as partitions.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)
    ranged = materialise(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("_at", _PER_PARTITION)
    counts = {r.p: r.n for r in ranged.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    starts, total = [], 0
    for p in range(max(counts, default=0) + 1):
        starts.append(total)
        total += counts.get(p, 0)
    begin = F.element_at(F.array(*[F.lit(x).cast("long") for x in starts]), (part + 1).cast("int"))
    within = F.col("_at") - F.shiftleft(part, _PER_PARTITION)
    return ranged.withColumn(name, begin + within).drop("_at")


def copies(df: DataFrame, count: str, place: str, keys: list[str], piece: int = 100_000) -> DataFrame:
    """Repeats each row ``count`` times with ``place`` running from 0, dropping ``count``.

    A row with very many copies is cut into pieces that are dealt out by ``keys`` and piece before they are
    unrolled, so no task has to produce more than a piece of it.
    """
    cut = df.where(F.col(count) > 0).withColumn("_first", F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1, F.lit(piece).cast("long"))))
    cut = cut.repartition(*keys, "_first")
    last = F.least(F.col(count), F.col("_first") + piece) - 1
    return cut.withColumn(place, F.explode(F.sequence("_first", last))).drop("_first", count)
