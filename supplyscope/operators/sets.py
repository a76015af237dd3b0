"""Set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(*dfs: DataFrame) -> DataFrame:
    """All rows of all tables by column name; a column a table lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_datasets(dfs: Mapping[str, DataFrame], wanted: Sequence[str]) -> DataFrame:
    """Tables of several datasets as one: wanted columns only, absent ones null, and the dataset
    name filled in from the table's tag where the table does not say."""
    if not dfs:
        raise ValueError("no datasets to combine")
    frames = []
    for slug, df in dfs.items():
        tagged = df if "dataset" in df.columns else df.withColumn("dataset", F.lit(None).cast("string"))
        named = tagged.withColumn("dataset", F.coalesce(F.col("dataset"), F.lit(slug)))
        frames.append(named.select(*[c for c in wanted if c in named.columns]))
    combined = union_all(*frames)
    absent = {c: F.lit(None).cast("string") for c in wanted if c not in combined.columns}
    return combined.withColumns(absent).select(*wanted)


def union_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return a.select(*keys).union(b.select(*keys)).distinct()


def minus(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that are not in ``b``."""
    return a.subtract(b)


def sorted_distinct(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).dropna().distinct().orderBy(col)
