"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyscope.sources import materialise


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``vertex`` and ``root`` (the smallest vertex it reaches) for every vertex with a link.

    Alternates the large-star and small-star steps of Kiveris et al., "Connected components in MapReduce
    and beyond" (2014), until the edges no longer change. Neighbours are only ever reduced to a minimum and
    joined back, so a vertex with very many links is combined before the shuffle and its join can be split.
    Each round is a written table. Null ends and self-links are left out; no links give no rows.
    """
    u, v = F.col(a), F.col(b)
    edges = links.where(u.isNotNull() & v.isNotNull() & (u != v))
    edges = materialise(edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialise(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        found = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (found.n, found.h) == state:
            break
        state = (found.n, found.h)
    roots = edges.select(F.col("v").alias("vertex"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("root")).unionByName(roots)
