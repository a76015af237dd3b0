"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``2**RING_BITS`` places. Every shard has virtual nodes at hashed places, every document a place
from its id, and a document goes to the first virtual node at or after its place, clockwise. No shard takes
more than its bound: what overflows goes on clockwise to the next node whose shard has room. With bounds
that sum to the number of rows, every shard is filled exactly, so the counts differ by one at most (law
``rows``), while most rows stay at their first node and keep their shard when shards are added or removed.

Only counts of rows by ring place matter for who overflows, so the walk runs over the arcs between nodes, of
which there are as many as virtual nodes, and yields pieces: the rows numbered ``lo`` to ``hi`` of an arc, in
ring order, go to a shard from one slot on. Rows are numbered within fine cells of the ring, whose first
numbers are sums of counts, so no task sorts an arc. Everything on rows is DataFrame expressions.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter, deque

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from supplyscope.sources import materialise

from .order import copies

RING_BITS = 14
#: A cell of the ring in which rows are numbered by one task holds about this many.
CELL_ROWS = 20_000


def nodes(shards: int, per_shard: int) -> list[tuple[int, int]]:
    """``(place, shard)`` of all virtual nodes in ring order; a place has one node, the lowest shard's.

    A shard of which all places are taken has one node, at the next free place clockwise; so every shard has one, or there are more
    shards than places, which are refused.
    """
    if shards > 1 << RING_BITS:
        raise ValueError(f"a ring of {1 << RING_BITS} places cannot hold {shards} shards")
    taken: dict[int, int] = {}
    for shard in range(shards):
        for k in range(per_shard):
            digest = hashlib.md5(f"shard {shard} node {k}".encode()).digest()
            place = int.from_bytes(digest[:8], "big") >> (64 - RING_BITS)
            taken.setdefault(place, shard)
    # Shards without a node: one of a shard that has several may have to make room, as places are few.
    left, free = set(range(shards)) - set(taken.values()), (1 << RING_BITS) - len(taken)
    if len(left) > free:
        many = Counter(taken.values())
        for place, shard in sorted(taken.items(), reverse=True):
            if many[shard] > 1 and len(left) > free:
                del taken[place]
                many[shard] -= 1
                free += 1
    for shard in sorted(left):
        place = int.from_bytes(hashlib.md5(f"shard {shard} node 0".encode()).digest()[:8], "big") >> (64 - RING_BITS)
        while place in taken:
            place = (place + 1) % (1 << RING_BITS)
        taken[place] = shard
    return sorted(taken.items())


def fill(counts: list[int], owners: list[int], bounds: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(arc, lo, hi, shard, slot)``: arc ``k`` has ``counts[k]`` rows and ends at a node of ``owners[k]``.

    All nodes take what arrives in ring order, as far as their shards have room, and pass the rest on; this
    goes round until all rows are placed.
    """
    used = [0] * len(bounds)
    waiting = [deque([(k, 0, n)] if n else []) for k, n in enumerate(counts)]
    pieces = []
    while any(waiting):
        for k, shard in enumerate(owners):
            queue = waiting[k]
            while queue and used[shard] < bounds[shard]:
                arc, lo, hi = queue.popleft()
                cut = min(hi, lo + bounds[shard] - used[shard])
                pieces.append((arc, lo, cut, shard, used[shard]))
                used[shard] += cut - lo
                if cut < hi:
                    queue.appendleft((arc, cut, hi))
        waiting.insert(0, waiting.pop())  # one node on
    return pieces


def _listed(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table from a short list of integers, of which there are no more than a few for each virtual node."""
    names = [c.split()[0] for c in schema.split(", ")]
    text = json.dumps([dict(zip(names, r, strict=True)) for r in rows])
    kind = f"array<struct<{schema.replace(' ', ': ').replace(',: ', ', ')}>>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), kind)))


def assign(docs: DataFrame, shards: int = 24, per_shard: int = 64) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for each row of ``docs`` (``doc_id``, ``text``).

    Size is the text's UTF-8 bytes plus 8. Slots are gapless from 0 in each shard.

    - Null text: size 8 and null ``text_crc32``. Null ``doc_id``: has a place of its own, like an id.
    - Repeated rows, and rows with a reused id, share a place; rows equal in id, size and crc are alike, and are
      counted before they are dealt out and numbered one by one after. Ties at a place go by crc and size.
    - Fewer rows than shards leave shards empty. An empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("m"))
    rows = materialise(rows.withColumn("place", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))), "ring-rows")

    ring = nodes(shards, per_shard)
    places = [p for p, _ in ring]
    spans = [(k, places[k - 1] + 1 if k else 0, p) for k, p in enumerate(places)] + [(0, places[-1] + 1, (1 << RING_BITS) - 1)]
    arcs = _listed(spark, spans, "arc int, lo int, hi int").where("lo <= hi").select("arc", F.explode(F.sequence("lo", "hi")).alias("at"))
    at = F.shiftrightunsigned("place", 64 - RING_BITS).cast("int").alias("at")
    total = rows.agg(F.sum("m")).first()[0] or 0
    fine = max(RING_BITS, (max(total, 1) // CELL_ROWS).bit_length())
    cell = F.shiftrightunsigned("place", 64 - fine).alias("cell")
    counts = rows.groupBy(at, cell).agg(F.sum("m").alias("n")).join(arcs, "at")
    # An arc may pass the end of the ring: its cells are then numbered from its own beginning.
    counts = materialise(counts.withColumn("turn", F.when(F.col("at") > places[-1], 0).otherwise(1)), "ring-cells")
    sums = {r.arc: r.n for r in counts.groupBy("arc").agg(F.sum("n").alias("n")).collect()}
    bounds = [total // shards + (s < total % shards) for s in range(shards)]
    pieces = fill([sums.get(k, 0) for k in range(len(ring))], [s for _, s in ring], bounds)

    before = Window.partitionBy("arc").orderBy("turn", "cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = counts.select("arc", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("cell").orderBy("place", "doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn("cell", cell).withColumn("within", F.coalesce(F.sum("m").over(inside), F.lit(0)))
    ranked = ranked.join(cells, "cell").withColumn("number", F.col("first") + F.col("within"))
    ranked = ranked.select("doc_id", "size", "text_crc32", "m", "arc", "number")
    single = copies(ranked, "m", "k", ["doc_id", "size", "text_crc32"]).withColumn("number", F.col("number") + F.col("k"))
    where = _listed(spark, pieces, "arc int, lo long, hi long, shard int, slot0 long")  # at most one more for each node and shard
    found = single.join(where, "arc").where("number >= lo AND number < hi")
    return found.select("doc_id", "size", "text_crc32", "shard", (F.col("slot0") + F.col("number") - F.col("lo")).alias("slot"))


def manifest(docs: DataFrame, shards: int = 24, per_shard: int = 64) -> DataFrame:
    """``assign`` with ``law`` (``rows``: counts differ by one at most) and ``grown_shard``, which this law leaves null."""
    found = assign(docs, shards, per_shard)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
