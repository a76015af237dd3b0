"""N-gram Jaccard join with a token-group matrix.

A text's set is its distinct windows of five words (A-Z lower-cased); a text of one to four words has one
shingle, the whole sequence. Two texts are linked when ``100 * |A and B| >= 75 * |A or B|``.

The join is exact and works on classes of texts with equal sets:

1. Every text's shingles are hashed to 64 bits. Jaccard >= 3/4 means that both sets share at least 3/4 of
   either, so under one order of all shingles (here: by hash) two linked sets share at least ``need`` of
   their first ``n - ceil(3n/4) + ceil(n/10)`` shingles. Only those leave the scan. Shingles that occur
   once are dropped, and with them every text left with fewer than ``need``. The others are counted
   again by their whole sets, of which three quarters must be shared with some text; of the shared
   shingles a text keeps the rarest, as many as must hold a common one: passages that very many texts
   share are counted but not followed.
2. Groups: the leader of a shingle and size class is the text whose shingles are most common. Each text is compared
   with the leader of most of its shingles and grouped with it if near; those at 3/4 are linked. Most near copies are connected
   by that, and no pairs inside a group are listed.
3. Token-group matrix: the union of each group's shingles, one row for each shingle and group; large groups are
   slices. A text asks a group with which it has a rare shingle in common, if the group has members of
   another, larger component. Where the overlap with the group's union is large enough for a link, the group
   is opened: the text is counted against all members at once, and only links come out.
4. All verified links go into connected components.

Texts are identified by their sets' 64-bit fingerprints, so equal texts, repeated rows and rows with a
reused ``doc_id`` need no case of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from supplyscope.sources import materialise

from .graph import components
from .words import mix, shingle_hashes, shingle_set, text_slices, word_hashes

_U = np.uint64


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, int]]:
    """Row, sorted shingles and fingerprint of each text of a batch."""
    for i, j, data, offsets in text_slices(batch.column("text")):
        words, _, _, first = word_hashes(data, offsets)
        windows = shingle_hashes(words)
        for row in range(j - i):
            a, b = first[row], first[row + 1]
            found = shingle_set(words[a:b], windows[a : max(a, b - 4)])
            with np.errstate(over="ignore"):
                mark = mix(np.array([mix(found).sum() + _U(len(found))], _U)).view(np.int64)[0]
            yield i + row, found, int(mark)


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [(len(s), mark) for _, s, mark in _sets(batch)]
        sizes, marks = zip(*found) if found else ((), ())
        columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(marks, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n", "mark"])


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first shingles of each set, once for the equal sets that this task meets."""
    seen: set[int] = set()
    for batch in batches:
        tokens, marks, counts = [], [], []
        for _, s, mark in _sets(batch):
            if len(s) and mark not in seen:
                seen.add(mark)
                n = len(s)
                tokens.append(s[: n - (3 * n + 3) // 4 + (n + 9) // 10])
                marks.append(mark)
                counts.append(len(tokens[-1]))
        if tokens:
            columns = [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.repeat(np.array(marks, np.int64), counts))]
            yield pa.RecordBatch.from_arrays(columns, ["token", "mark"])


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks, sets = [], []
        for _, s, mark in _sets(batch):
            marks.append(mark)
            sets.append(s.view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(marks, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["mark", "shingles"])


def _need(n: str) -> F.Column:
    """How many of its first shingles a set of ``n`` shares at least with any linked set."""
    return F.expr(f"((3 * {n} + 3) div 4 + 9) div 10")


def _compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Adds the sizes of both sets and of what they share, for pairs ``(a, b)`` of fingerprints."""
    left = pairs.join(sets.select(F.col("mark").alias("a"), F.col("shingles").alias("sa")), "a")
    both = left.join(sets.select(F.col("mark").alias("b"), F.col("shingles").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.select(*pairs.columns, F.size("sa").alias("na"), F.size("sb").alias("nb"), shared.alias("shared"))


_LINKED = "4L * shared >= 3L * (na + nb - shared)"


def _candidates(docs: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Full sets of the texts that may have a link, and their rare shingles as ``mark, n, weight, token``, where
    weight tells how common all their shingles are."""
    rows = docs.select("doc_id", "text").mapInArrow(_prefixes, "token long, mark long")
    shared = rows.groupBy("token").agg(F.count("*").alias("df")).where("df > 1").select("token")
    counts = rows.join(shared, "token").groupBy("mark").agg(F.count("*").alias("m"))
    # One text of each class, with an id if any has one.
    one = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("x")
    classes = sizes.where("n > 0").groupBy("mark").agg(F.max("n").alias("n"), one)
    left = counts.join(classes, "mark").where(F.col("m") >= _need("n"))
    left = materialise(left.select("mark", F.col("x.doc_id").alias("id"), F.col("x.text_hash").alias("hash")), "candidates")
    # The candidates grow with the corpus; merging gives one plan for every size.
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("hash"))
    texts = docs.select("doc_id", "text").join(left.select("id", "hash").distinct().hint("merge"), same).select("text")
    sets = texts.mapInArrow(_shingles, "mark long, shingles array<long>").join(left.select("mark"), "mark")
    sets = materialise(sets.groupBy("mark").agg(F.first("shingles").alias("shingles")), "sets")

    # Over the whole sets of these: at least three quarters shared, and of the shared ones the rarest.
    rows = sets.select("mark", F.explode("shingles").alias("token"))
    shared = rows.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    # A shingle's count and its lower bits in one number: in order of rarity, and only used to find candidates.
    rare = F.shiftleft(F.least("df", F.lit((1 << 19) - 1)), 44).bitwiseOR(F.col("token").bitwiseAND((1 << 44) - 1))
    kept = rows.join(shared, "token").select("mark", rare.alias("token"), "df").groupBy("mark")
    kept = kept.agg(F.collect_list("token").alias("found"), F.sum("df").alias("weight"))
    kept = kept.join(sets.select("mark", F.size("shingles").alias("n")), "mark").withColumn("weight", F.col("weight") / F.col("n"))
    least = F.expr("(3 * n + 3) div 4")
    kept = kept.where(F.size("found") >= least)
    rarest = F.slice(F.sort_array("found"), 1, (F.size("found") - least + 1).cast("int"))
    tokens = kept.select("mark", "n", "weight", F.explode(rarest).alias("token"))
    return sets, materialise(tokens, "tokens")


def _slices(rows: DataFrame, group: list[str], load: int, name: str) -> DataFrame:
    """Adds ``name``: cuts the rows of each group (``mark``, ``n``) so that a slice holds about ``load`` shingles."""
    total = rows.groupBy(*group).agg(F.sum("n").alias("_load"))
    cut = F.pmod(F.xxhash64("mark"), F.floor(F.col("_load") / load) + 1)
    return rows.join(total, group).withColumn(name, cut).drop("_load")


def _open(queries: pa.Table, members: pa.Table) -> pa.Table:
    """Links between the queries and members of one slice of a group, one for each query and component.

    The slice's shingles in order, with whose they are, answer for a query how many it shares with the union
    of the slice (too few: no member can be linked) and with each member.
    """
    found: list[tuple[int, int]] = []
    marks, roots, sizes = (members[c].to_numpy() for c in ("_mark", "_root", "_n"))
    if queries.num_rows and members.num_rows:
        tokens = members["_shingles"].combine_chunks().flatten().to_numpy()
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], np.repeat(np.arange(len(sizes)), sizes)[order]
        for mark, root, n, own in zip(*(queries[c] for c in ("mark", "root", "n", "shingles")), strict=True):
            own, n = own.values.to_numpy(), n.as_py()
            lo, hi = np.searchsorted(tokens, own, "left"), np.searchsorted(tokens, own, "right")
            lo, count = lo[hi > lo], (hi - lo)[hi > lo]
            if 4 * len(lo) < 3 * n:
                continue
            at = np.repeat(lo - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
            shared = np.bincount(owner[at], minlength=len(sizes))
            linked = np.flatnonzero((4 * shared >= 3 * (n + sizes - shared)) & (roots != root.as_py()))
            for k in linked[np.unique(roots[linked], return_index=True)[1]]:
                found.append((mark.as_py(), int(marks[k])))
    a, b = zip(*found) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


#: Shingles of the members, and of the queries, that one task holds when it opens a slice of a group.
_MEMBER_LOAD, _QUERY_LOAD = 200_000, 400_000
#: Leaders with which a text is compared, those of most of its rare shingles; groups are asked about the rest.
_LEADERS = 1
#: Texts nearer than this to a leader, as shared / union, are put in its group, linked or not.
_LOOSE = 0.3


def similar_sets(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc_id, text_hash, n, mark`` for every row, and links ``(a, b)`` between fingerprints that connect exactly the
    texts connected by Jaccard >= 3/4. ``docs`` needs ``doc_id`` (long) and ``text``.

    Runs jobs and writes intermediate tables. Rows without ``doc_id`` are linked like all others.
    """
    sizes = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    sizes = materialise(sizes.mapInArrow(_sizes, "doc_id long, text_hash long, n long, mark long"), "sizes")
    sets, tokens = _candidates(docs, sizes)

    # Each shingle's leader within a size class is the text whose shingles are most common: the middle of its copies.
    sized = tokens.withColumn("size_class", F.floor(F.log("n") / F.log(F.lit(4 / 3))))
    leaders = sized.groupBy("token", "size_class").agg(F.max(F.struct("weight", "mark")).alias("b"))
    stars = sized.join(leaders, ["token", "size_class"]).select(F.col("mark").alias("a"), F.col("b.mark").alias("b"))
    stars = stars.where("a != b").groupBy("a", "b").agg(F.count("*").alias("votes"))
    best = Window.partitionBy("a").orderBy(F.desc("votes"), "b")
    stars = stars.withColumn("k", F.row_number().over(best)).where(f"k <= {_LEADERS}").select("a", "b")
    stars = _compare(stars, sets).withColumn("j", F.expr("shared / (na + nb - shared)"))
    stars = materialise(stars.select("a", "b", "j", F.expr(_LINKED).alias("linked")), "stars")
    links = stars.where("linked").select("a", "b")

    # Groups: texts with what leads them, cut into slices; the components that the links give so far.
    near = stars.where(F.col("j") >= _LOOSE).groupBy("a").agg(F.max(F.struct("j", "b")).alias("x")).select("a", F.col("x.b").alias("b"))
    grouped = components(near, "a", "b").toDF("mark", "group")
    joined = components(links, "a", "b").toDF("mark", "root")
    texts = tokens.select("mark", "n").distinct().join(grouped, "mark", "left").join(joined, "mark", "left")
    texts = texts.select("mark", "n", F.coalesce("group", "mark").alias("group"), F.coalesce("root", "mark").alias("root"))
    texts = texts.join(texts.groupBy("root").agg(F.count("*").alias("members")), "root")
    texts = texts.select("mark", "n", "group", "root", F.struct("members", "root").alias("rank"))
    texts = materialise(_slices(texts, ["group"], _MEMBER_LOAD, "slice"), "texts")

    # The matrix: which shingles each slice of a group has, and who might be asked for. Of two texts in different
    # components, the one in the smaller component asks.
    rows = tokens.select("mark", "token").join(texts, "mark")
    matrix = rows.groupBy("token", "group", "slice").agg(F.max("rank").alias("top"), F.min("n").alias("lo"), F.max("n").alias("hi"))
    asks = rows.select("token", "mark", "n", "root", "rank").join(matrix, "token")
    asks = asks.where("top > rank AND 4 * hi >= 3 * n AND 4 * n >= 3 * lo").select("mark", "n", "root", "group", "slice").distinct()
    asks = materialise(_slices(asks, ["group", "slice"], _QUERY_LOAD, "part"), "asks")

    # Open the groups that qualify, a slice and a part of its queries at a time.
    key = ["group", "slice", "part"]
    members = asks.select(*key).distinct().join(texts.select("group", "slice", "mark", "n", "root"), ["group", "slice"])
    asked = asks.join(sets, "mark").select(*key, "mark", "n", "root", "shingles")
    members = members.join(sets, "mark").select(*key, "mark", "n", "root", "shingles")
    members = members.select(*[F.col(c).alias(f"_{c}") for c in members.columns])
    pairs = asked.groupBy(*key).cogroup(members.groupBy(*[f"_{c}" for c in key]))
    opened = pairs.applyInArrow(_open, "a long, b long")
    return sizes, links.unionByName(materialise(opened, "opened"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``n_shingles`` and ``component_id``.

    ``component_id`` is the smallest ``doc_id`` that the text reaches by links, its own included.

    - Null, empty or wordless text: an empty set, linked with nothing; ``component_id`` is ``doc_id``.
    - Null ``doc_id``: the text links like any other; ``component_id`` is null if it reaches no text with an id.
    - Repeated rows and reused ids: every row gets its row; equal sets are always in one component.
    - Other columns, of whatever name, are ignored. An empty table gives no rows.
    - Texts of any length are processed whole, each within one task.
    """
    sizes, links = similar_sets(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    roots = components(links, "a", "b").withColumnRenamed("vertex", "mark")
    classes = sizes.where("n > 0").groupBy("mark").agg(F.min("doc_id").alias("low")).join(roots, "mark", "left")
    classes = classes.select("mark", "low", F.coalesce("root", "mark").alias("root"))
    lowest = classes.groupBy("root").agg(F.min("low").alias("component_id"))
    component = classes.join(lowest, "root").select("mark", "component_id")
    full = sizes.where("n > 0").join(component, "mark").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return full.unionByName(sizes.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component of near duplicates stays.

    The row with the component's smallest ``doc_id`` stays, rows without id coming last; of rows that are alike in
    id and text one stays. Rows without words all stay. ``docs`` keeps its columns.
    """
    names = [f"c{k}" for k in range(len(docs.columns))]
    doc_id, text = (F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "text"))
    apart = docs.toDF(*names).withColumn("_id", doc_id.cast("long")).withColumn("_text", F.xxhash64(text.cast("string")))
    base = apart.select(F.col("_id").alias("doc_id"), text.cast("string").alias("text"))
    sizes, links = similar_sets(base)
    marks = sizes.withColumnsRenamed({"doc_id": "id", "text_hash": "hash"})
    roots = components(links, "a", "b").toDF("mark", "root")
    rows = marks.where("n > 0").groupBy("id", "hash", "mark").agg(F.count("*").alias("m")).join(roots, "mark", "left")
    rows = materialise(rows.select("id", "hash", "m", F.coalesce("root", "mark").alias("root")), "rooted")
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "hash")).alias("x"))
    rows = rows.join(first, "root").withColumn("stays", F.col("id").eqNullSafe(F.col("x.id")) & (F.col("hash") == F.col("x.hash")))
    rows = materialise(rows.select("id", "hash", "m", "stays"), "verdicts")

    def among(keys: DataFrame, kind: str, docs: DataFrame) -> DataFrame:
        return docs.join(keys.select("id", "hash"), F.col("_id").eqNullSafe(F.col("id")) & (F.col("_text") == F.col("hash")), kind)

    left = among(rows.where("NOT stays"), "left_anti", apart)
    alike = rows.where("stays AND m > 1")
    if alike.limit(1).count():
        once = among(alike, "left_semi", apart).dropDuplicates(["_id", "_text"])
        left = among(alike, "left_anti", left).unionByName(once)
    return left.select(*names).toDF(*docs.columns)
