"""Line deduplication with a deletion-neighbourhood join.

Lines are compared as sequences of words (A-Z lower-cased, spaces ignored). A line goes if an earlier one, by
document id and line number, has the same words, or, for lines of ``MIN_WORDS`` or more, words within one
edit (a word put in, left out or replaced). What is dropped does not depend on what else is dropped.

1. Equal lines: a line's 64-bit hash and its earliest place; one row per different line goes on.
2. Halves: within one edit, lines of M and M or M + 1 words share their first or their last M // 2 words. Lines
   that share neither half with any other line are done; this loses none.
3. Deletion neighbourhood: every other line emits the hashes of its words with each one left out, and of all
   its words. Two lines are one word apart in length if one's whole is another's variant, and differ in one
   word if their variants without the same place are equal. A key is reduced to its earliest line before the
   shuffle, and a line meets only that one, so no pairs within a key are listed: all lines of a key are one
   edit from each other.
4. The pairs' edit distance is verified on their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyscope.sources import materialise

from .order import numbered
from .words import mix, text_slices, word_hashes

_U = np.uint64
MIN_WORDS = 5
_STEP = 0xD1342543DE82EF95
_INVERSE = pow(_STEP, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Lines:
    """The lines of some texts: of each its text, number, words, and hashes of any run of its words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words, start, _, first = word_hashes(data, offsets)
        breaks = np.flatnonzero(data == 10)
        # A text has one line more than line breaks.
        ends = np.searchsorted(breaks, offsets[1:])
        counts = np.diff(np.concatenate(([0], ends))) + 1
        self.text = np.repeat(np.arange(len(counts)), counts)
        self.base = np.cumsum(counts) - counts
        self.number = np.arange(counts.sum()) - self.base[self.text]
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        line = self.base[owner] + np.searchsorted(breaks, start) - np.concatenate(([0], ends))[owner]
        self.n = np.bincount(line, minlength=len(self.text))
        self.first = np.cumsum(self.n) - self.n
        self._back = _powers(_INVERSE, len(self.words) + 1)
        self._sums = np.zeros(len(self.words) + 1, _U)
        np.cumsum(self.words * _powers(_STEP, len(self.words)), out=self._sums[1:])

    def run(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Hashes of ``n`` words from ``at`` on: sums of word times step ** place, places from 0."""
        return (self._sums[at + n] - self._sums[at]) * self._back[at]


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, offsets in text_slices(batch.column("text")):
            lines = _Lines(data, offsets)
            n, first = lines.n, lines.first
            hashes = mix(lines.run(first, n) + n.astype(_U))
            keys = []
            for size in (n, n - 1):
                half = np.maximum(size, 0) // 2
                salt = size.astype(_U) * _U(2)
                keys += [mix(lines.run(first, half)) + mix(salt), mix(lines.run(first + n - half, half)) + mix(salt + _U(1))]
            rows = pa.array(lines.text)
            columns = [batch.column(c).slice(i, j - i).take(rows) for c in ("doc_id", "mark")]
            columns += [pa.array(x.view(np.int64)) for x in (lines.number, n, hashes, *keys)]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _FACTS.split(", ")])


_FACTS = "doc_id long, mark long, line long, n long, hash long, k0 long, k1 long, k2 long, k3 long"


def _line_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the lines whose ranks and numbers come with each text."""
    for batch in batches:
        ranks, words = [], []
        for i, _, data, offsets in text_slices(batch.column("text")):
            lines = _Lines(data, offsets)
            for k, base in enumerate(lines.base):
                for x in batch.column("wanted")[i + k].as_py():
                    at = base + x["line"]
                    ranks.append(x["rank"])
                    words.append(lines.words[lines.first[at] : lines.first[at] + lines.n[at]].view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(ranks, pa.int64()), pa.array(words, pa.list_(pa.int64()))], ["rank", "words"])


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, rank, kind`` of each line: 0 all its words, 1 one left out, 2 one left out at a certain place."""
    for batch in batches:
        for rank, words in zip(batch.column("rank"), batch.column("words"), strict=True):
            w = words.values.to_numpy().view(_U)
            n = len(w)
            power = _powers(_STEP, n + 1)
            before = np.concatenate(([_U(0)], np.cumsum(w * power[:n])))
            after = np.concatenate(([_U(0)], np.cumsum(w[1:] * power[: n - 1])))  # words after the first, one place on
            left = before[:n] + after[-1] - after
            place = mix(np.arange(n, dtype=_U) + _U(1 << 40))
            keys = np.concatenate((mix(left), mix(left + place), mix(before[-1:])))
            kinds = np.repeat(np.array([1, 2, 0], np.int8), (n, n, 1))
            columns = [pa.array(keys.view(np.int64)), pa.array(np.full(len(keys), rank.as_py(), np.int64)), pa.array(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "rank", "kind"])


def within_one_edit(a: np.ndarray, b: np.ndarray) -> bool:
    if abs(len(a) - len(b)) > 1:
        return False
    m = min(len(a), len(b))
    differ = np.flatnonzero(a[:m] != b[:m])
    head = differ[0] if len(differ) else m
    differ = np.flatnonzero(a[len(a) - m :] != b[len(b) - m :])
    tail = m - 1 - differ[-1] if len(differ) else m
    return head + tail >= max(len(a), len(b)) - 1


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("wa"), batch.column("wb"), strict=True)
        good = [within_one_edit(a.values.to_numpy(), b.values.to_numpy()) for a, b in pairs]
        yield batch.select(["rank", "earlier"]).filter(pa.array(good, pa.bool_()))


def line_decisions(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, line, n, reason, first_doc, first_line`` for every line of every row of ``docs``.

    ``mark`` is the text's hash, ``line`` counts from 0, ``n`` its words. ``reason`` is ``exact``, ``near`` or null
    for a line that stays; ``first_doc`` and ``first_line`` tell the earlier line. Runs jobs.

    - A null text has no lines; an empty one, and any line without words, stays.
    - Null ``doc_id`` comes after all ids. Rows with the same id and different text go in order of mark.
    - A repeated row (same id and text) is the same document listed twice: it has the same decisions.
    - Lines of any length are read whole. An empty table gives no rows. Other columns are ignored.
    """
    base = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("text IS NOT NULL")
    base = base.withColumn("mark", F.xxhash64("text"))
    facts = materialise(base.mapInArrow(_facts, _FACTS), "lines")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark", "line")
    whole = facts.where("n > 0").groupBy("hash").agg(F.min(place).alias("place"), *[F.min(c).alias(c) for c in ("n", "k0", "k1", "k2", "k3")])
    whole = materialise(whole, "different-lines")

    keys = whole.where(f"n >= {MIN_WORDS}").select("hash", F.explode(F.array_distinct(F.array("k0", "k1", "k2", "k3"))).alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key")
    likely = keys.join(shared, "key").select("hash").distinct()
    likely = whole.join(likely, "hash").select("hash", "place.*")
    likely = numbered(likely, [F.col(c) for c in ("no_id", "doc_id", "mark", "line")], "rank")
    likely = materialise(likely, "likely")
    wanted = likely.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("line", "rank")).alias("wanted"))
    wanted = wanted.select(F.col("doc_id").alias("d"), F.col("mark").alias("m"), "wanted")
    texts = base.join(wanted, (F.col("mark") == F.col("m")) & F.col("doc_id").eqNullSafe(F.col("d")))
    words = texts.select("text", "wanted").mapInArrow(_line_words, "rank long, words array<long>")
    words = materialise(words.groupBy("rank").agg(F.first("words").alias("words")), "line-words")

    rows = words.mapInArrow(_variants, "key long, rank long, kind byte")
    first = [F.min(F.when(F.col("kind") == k, F.col("rank"))).alias(f"r{k}") for k in (0, 1, 2)]
    met = rows.groupBy("key").agg(*first, F.min("rank").alias("lo"), F.max("rank").alias("hi")).where("lo < hi")
    earlier = F.when(F.col("kind") == 0, F.col("r1")).when(F.col("kind") == 1, F.col("r0")).otherwise(F.col("r2"))
    pairs = rows.join(met.drop("lo", "hi"), "key").select("rank", earlier.alias("earlier")).where("earlier < rank").distinct()
    pairs = pairs.join(words.withColumnRenamed("words", "wa"), "rank")
    pairs = pairs.join(words.select(F.col("rank").alias("earlier"), F.col("words").alias("wb")), "earlier")
    near = pairs.select("rank", "earlier", "wa", "wb").mapInArrow(_verified, "rank long, earlier long")
    near = near.groupBy("rank").agg(F.min("earlier").alias("earlier"))
    near = near.join(likely.select("rank", "hash"), "rank")
    near = near.join(likely.select(F.col("rank").alias("earlier"), F.col("doc_id").alias("near_doc"), F.col("line").alias("near_line")), "earlier")
    near = materialise(near.select("hash", "near_doc", "near_line"), "near-lines")

    known = whole.select("hash", "place").join(near, "hash", "left")
    out = facts.select("doc_id", "mark", "line", "n", "hash").join(known, "hash", "left")
    is_first = F.col("doc_id").eqNullSafe(F.col("place.doc_id")) & (F.col("mark") == F.col("place.mark")) & (F.col("line") == F.col("place.line"))
    reason = F.when(F.col("n") == 0, None).when(~is_first, "exact").when(F.col("near_line").isNotNull(), "near")
    out = out.withColumn("reason", reason)
    return out.select(
        "doc_id", "mark", "line", "n", "reason",
        F.when(F.col("reason") == "exact", F.col("place.doc_id")).when(F.col("reason") == "near", F.col("near_doc")).alias("first_doc"),
        F.when(F.col("reason") == "exact", F.col("place.line")).when(F.col("reason") == "near", F.col("near_line")).alias("first_line"),
    )


def summary(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_exact, n_near`` and the ``dropped`` line numbers in order, for each different row of id
    and text in ``docs`` (once for repeated rows; rows without text are left out)."""
    lines = line_decisions(docs).dropDuplicates(["doc_id", "mark", "line"])
    dropped = F.sort_array(F.collect_list(F.when(F.col("reason").isNotNull(), F.col("line"))))
    counts = [F.count_if(F.col("reason") == x).alias(f"n_{x}") for x in ("exact", "near")]
    return lines.groupBy("doc_id", "mark").agg(F.count("*").alias("n_lines"), *counts, dropped.alias("dropped")).drop("mark")


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with their columns, the dropped lines taken out of ``text``."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    doc_id, text = (f"c{docs.columns.index(c)}" for c in ("doc_id", "text"))
    lines = line_decisions(docs).where("reason IS NOT NULL").groupBy("doc_id", "mark").agg(F.collect_set("line").alias("gone"))
    apart = docs.toDF(*names)
    same = F.col(doc_id).cast("long").eqNullSafe(F.col("doc_id")) & (F.xxhash64(F.col(text).cast("string")) == F.col("mark"))
    kept = F.filter(F.split(text, "\n"), lambda x, k: ~F.array_contains("gone", k.cast("long")))
    joined = apart.join(lines, same, "left")
    joined = joined.withColumn(text, F.when(F.col("gone").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")))
    return joined.select(*names).toDF(*docs.columns)
