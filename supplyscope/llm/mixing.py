"""Mixing sources to target weights by thresholds on a hash.

Every document has a fixed point in [0, 2**60), from a hash of its id and size. A source whose target is
between k and k + 1 times its size is taken k times whole, and once more below a threshold: budgets are
nested, a larger one keeps all that a smaller one takes. The threshold is found from histograms: words are
summed by source and hash bucket, the bucket in which the budget ends is the only one split further, until
it holds a single point. No document is sorted or moved; the last step is a filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplyscope.sources import materialise

from .order import copies, numbered

#: Bits of a point, and those that one histogram resolves.
POINT_BITS, STEP_BITS = 60, 12
WEIGHTS = (3, 1, 2)


def point(doc_id: Column, size: Column) -> Column:
    """60 bits of the MD5 of ``id:size``."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), size.cast("string"))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """Adds ``target`` to one row per source (``source``, ``source_size``).

    Weights go by the order of sources by code point, null last, repeating. All targets sum to ``share`` of
    all sizes and are in proportion to the weights, but none exceeds ``most`` times its source's size: what
    a source cannot take is shared out by weight among the others until none is above. Each round of that is
    an aggregate of two numbers.
    """
    order = [F.col("source").isNull(), F.col("source")]
    rows = numbered(sizes.select("source", "source_size"), order, "at")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("at") % len(weights) + 1).cast("int"))
    rows = rows.withColumn("weight", weight).withColumn("cap", F.lit(most) * F.col("source_size"))
    budget = share * (rows.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0  # words per unit of weight; it only rises, as capped sources leave
    while True:
        full = F.col("cap") <= F.col("weight") * level
        got = rows.agg(F.sum(F.when(full, F.col("cap"))).alias("capped"), F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if not got.open:
            break
        new = (budget - (got.capped or 0.0)) / got.open
        if new <= level:
            break
        level = new
    return rows.select("source", "source_size", F.least("cap", F.col("weight") * level).alias("target"))


def manifest(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """How often the mix takes each document: ``doc_id, source, size, source_size, target, copies, taken``.

    ``docs`` has ``doc_id``, ``text`` and ``source``; there is one row for each of its rows. Size is the number
    of words, ``taken`` is ``copies * size``. In each source the taken words differ from the target by no
    more than half the size of one document.

    - Null text: size 0, takes no part in the budget and is never taken. Null source: a source of its own.
    - Null ``doc_id``, or repeated rows: rows equal in id, source and size have one point; as many of them are
      taken as come nearest to the budget, and the rows being alike, it does not matter which.
    - Rows of equal point and different size go in order of size.
    - An empty table gives no rows. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), word_count(F.col("text")).alias("size"))
    rows = rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("m"))
    rows = materialise(rows.withColumn("point", point(F.col("doc_id"), F.col("size"))), "points")
    sizes = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"))
    aims = materialise(targets(sizes, weights, share, most), "targets")

    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    aims = aims.withColumn("whole", whole.cast("long")).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    # The bucket of each source in which its budget ends, as first point and words before it.
    ends = aims.where("source_size > 0").select("source", "rest", F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("below"))
    bits, several = POINT_BITS, True
    while several:
        bits -= STEP_BITS
        ends = materialise(_refined(rows, ends, bits), "ends")
        several = bits > 0 and ends.where("several").limit(1).count() > 0
    rows = rows.withColumnRenamed("source", "s")
    left = rows.join(ends.drop("several"), F.col("s").eqNullSafe(F.col("source")), "left").drop("source")
    # Rows with the very point at which the budget ends, if several, go one by one in order of size.
    edge = F.coalesce((F.shiftright(F.col("point") - F.col("low"), bits) == 0) & (F.col("size") > 0), F.lit(False))
    before = Window.partitionBy("s").orderBy("point", "size", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    tied = left.where(edge).withColumn("below", F.col("below") + F.coalesce(F.sum(F.col("size") * F.col("m")).over(before), F.lit(0)))
    nearest = F.floor((F.col("rest") - F.col("below")) / F.col("size") + 0.5).cast("long")
    tied = tied.withColumn("extra", F.greatest(F.lit(0), F.least("m", nearest)))
    others = left.where(~edge).withColumn("extra", F.when((F.col("size") > 0) & (F.col("point") < F.col("low")), F.col("m")).otherwise(0))
    both = others.unionByName(tied).select("doc_id", "s", "size", "m", "extra")
    both = copies(both, "m", "place", ["doc_id", "s", "size"]).join(aims, F.col("s").eqNullSafe(F.col("source")))
    times = F.when(F.col("size") > 0, F.col("whole") + F.when(F.col("place") < F.col("extra"), 1).otherwise(0)).otherwise(0)
    both = both.withColumn("copies", times.cast("long"))
    return both.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _refined(rows: DataFrame, ends: DataFrame, bits: int) -> DataFrame:
    """Splits each source's last bucket into buckets of ``bits`` bits and finds the one in which its budget ends.
    ``several`` tells whether that still holds different points."""
    last = ends.withColumnRenamed("source", "s")
    inside = rows.where("size > 0").join(last, F.col("source").eqNullSafe(F.col("s")))
    bucket = F.shiftright(F.col("point") - F.col("low"), bits)
    inside = inside.where(bucket.between(0, (1 << STEP_BITS) - 1))
    sums = inside.groupBy("source", "rest", "low", "below", bucket.alias("bucket")).agg(
        F.sum(F.col("size") * F.col("m")).alias("words"), F.min("point").alias("p0"), F.max("point").alias("p1")
    )
    upto = Window.partitionBy("source").orderBy("bucket")
    sums = sums.withColumn("upto", F.col("below") + F.sum("words").over(upto))
    first = sums.where("upto >= rest").groupBy("source", "rest").agg(
        F.min_by(F.struct("low", "bucket", (F.col("upto") - F.col("words")).alias("below"), (F.col("p0") < F.col("p1")).alias("several")), "bucket").alias("x")
    )
    low = F.col("x.low") + F.shiftleft("x.bucket", bits)
    return first.select("source", "rest", low.alias("low"), F.col("x.below").alias("below"), F.col("x.several").alias("several"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their columns; see ``manifest``."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    doc_id, text, source = (f"c{docs.columns.index(c)}" for c in ("doc_id", "text", "source"))
    apart = docs.toDF(*names).withColumn("size", word_count(F.col(text).cast("string")))
    # Rows equal in id, source and size are numbered, so that each gets one of their counts.
    alike = Window.partitionBy(doc_id, source, "size").orderBy(F.xxhash64(text), F.xxhash64(*names))
    counts = manifest(docs, **options).where("copies > 0").select("doc_id", "source", F.col("size").alias("words"), "copies")
    spread = counts.groupBy("doc_id", "source", "words").agg(F.count("*").alias("n"), F.max("copies").alias("hi"), F.min("copies").alias("lo"), F.sum("copies").alias("sum"))
    apart = apart.withColumn("place", F.row_number().over(alike) - 1)
    same = F.col(doc_id).cast("long").eqNullSafe(F.col("doc_id")) & F.col(source).cast("string").eqNullSafe(F.col("source")) & (F.col("size") == F.col("words"))
    joined = apart.join(spread, same)
    more = F.col("sum") - F.col("lo") * F.col("n")
    joined = joined.withColumn("times", F.col("lo") + F.when((F.col("hi") > F.col("lo")) & (F.col("place") < more), 1).otherwise(0))
    return joined.where("times > 0").withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select(*names).toDF(*docs.columns)
