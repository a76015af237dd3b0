"""Spelling variants by blocked Gram matrices of letter counts.

A word is a run of ``[A-Za-z\\u00C0-\\u00FF]+``, A-Z lower-cased. Two words are near if they differ by exactly one
inserted, deleted or replaced code point.

1. Every task counts the runs of whole texts with numpy and hands on one row for each different word of a few MB.
2. A word's vector counts its code points by column. One insertion changes one column by one, one replacement at most
   two; so near words have vectors at a squared distance of at most 2 and lengths that differ by at most one.
   (Different letters may share a column. That only lowers distances.)
3. Blocks: the letters are dealt out to ``CLASSES`` classes, and a block holds the words with the same count in
   each class (and so one length). Near words are in the same block or in blocks that differ by one in one class, or by
   plus one and minus one in two. Blocks are cut into slices of about ``SLICE`` words. For each pair of slices
   of neighbouring blocks one numpy product of their count matrices, their Gram matrix, gives all squared distances;
   pairs at most 2 apart have their edit distance verified by comparing code points. No task holds more than two
   slices and their product, however many words a block has.
4. A word's form is its near word of largest count, if that is at least ``ratio`` times its own. Counts grow by that factor at
   each step, so following forms ends after ``log(rows) / log(ratio)`` steps, halved by pointer jumping.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyscope.sources import materialise

from .words import span_hashes, text_slices

#: Letters, code points 97 to 122 and 192 to 255, dealt out in turn; what is no such letter is in the last class.
CLASSES = 6
_LETTERS = [chr(c) for c in (*range(97, 123), *range(192, 256))]
#: Words in a slice of a block, in the mean.
SLICE = 1000
#: Columns of a count vector.
_COLUMNS = 96
_SLICE_BYTES = 2 << 20

_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: UTF-8 writes U+00C0 to U+00FF as this byte and a following one, and no other code point has it.
_LEAD = 0xC3

_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1)


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end bytes of the maximal runs of letters of texts that lie end to end."""
    inside = _ASCII_LETTER[data]
    lead = data == _LEAD
    inside |= lead
    inside[1:] |= lead[:-1]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins, ends = offsets[:-1][offsets[:-1] < len(data)], offsets[1:][offsets[1:] > 0] - 1
    first[begins], last[ends] = inside[begins], inside[ends]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _crc32(state: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of spans, each continuing a checksum ``state``: one byte of all spans at a time."""
    out, size = state.copy(), end - start
    for k in np.flatnonzero(size > 64):
        out[k] = zlib.crc32(data[start[k] : end[k]].tobytes(), int(state[k]))
    order = np.flatnonzero(size <= 64)
    order = order[np.argsort(-size[order], kind="stable")]
    place, register = start[order], ~state[order]
    longer = np.searchsorted(-size[order], -np.arange(65), "left")  # how many spans have more than k bytes
    for k in range(64):
        if not (n := int(longer[k])):
            break
        register[:n] = _CRC[(register[:n] ^ data[place[:n] + k]) & 255] ^ (register[:n] >> 8)
    out[order] = ~register
    return out


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The spans as an Arrow column of strings."""
    size = end - start
    offsets = np.concatenate(([0], np.cumsum(size)))
    at = np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[at]))


def _counter(least: int, lot: int | None):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for i, j, data, offsets in text_slices(batch.column("text"), _SLICE_BYTES):
                if not len(data):
                    continue
                start, end = _runs(data, offsets)
                points = end - start
                leads = np.concatenate(([0], np.cumsum(data == _LEAD)))
                points -= leads[end] - leads[start]
                long = points >= least  # a deletion only shortens
                start, end, points, data = start[long], end[long], points[long], _LOWER[data]
                kept, edited = np.ones(len(start), bool), []
                if lot:
                    doc = np.searchsorted(offsets, start, "right") - 1
                    state = np.array([0 if x is None else zlib.crc32(f"{x}:".encode()) for x in ids[i:j]], np.uint32)
                    known = np.array([x is not None for x in ids[i:j]], bool)
                    h = _crc32(state[doc], data, start, end)
                    kept = (h % lot != 0) | ~known[doc]
                    for k in np.flatnonzero(~kept):
                        word, at = data[start[k] : end[k]].tobytes().decode(), int(h[k]) % int(points[k])
                        if points[k] > least:
                            edited.append(word[:at] + word[at + 1 :])
                _, one, n = np.unique(span_hashes(data, start[kept], end[kept]), return_index=True, return_counts=True)
                words = _strings(data, start[kept][one], end[kept][one])
                yield pa.RecordBatch.from_arrays([words, pa.array(n, pa.int64())], ["word", "n"])
                yield pa.RecordBatch.from_arrays([pa.array(edited, pa.string()), pa.array([1] * len(edited), pa.int64())], ["word", "n"])

    return count


def word_counts(docs: DataFrame, min_length: int = 6, min_count: int = 5, lot: int | None = None) -> DataFrame:
    """``word`` and ``n`` of all words of at least ``min_length`` code points with at least ``min_count`` occurrences.

    ``lot`` plants misspellings: where it divides h, the CRC-32 of ``<doc_id>:<word>``, the run loses its code point
    h modulo its length. Rows without ``doc_id`` keep their runs. Null and empty texts have no words; repeated rows count each.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(_counter(min_length, lot), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _shape() -> Column:
    """How many letters of a word are in each class."""
    word = F.col("word")
    known = [F.length(word) - F.length(F.translate(word, "".join(_LETTERS[k::CLASSES]), "")) for k in range(CLASSES - 1)]
    rest = F.length(word)
    for c in known:
        rest = rest - c
    return F.array(*known, rest)


def _steps() -> list[list[int]]:
    """Changes of a block's counts that lead to its neighbours, each pair of blocks once: none, one letter more, one
    letter of a class for one of a later class."""
    unit = np.eye(CLASSES, dtype=int)
    more = [unit[k] for k in range(CLASSES)]
    other = [unit[a] - unit[b] for a in range(CLASSES) for b in range(a + 1, CLASSES)]
    return [x.tolist() for x in (np.zeros(CLASSES, int), *more, *other)]


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row for each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def _vectors(codes: np.ndarray) -> np.ndarray:
    column = np.where(codes < 128, codes % 32, 32 + codes % 64)
    flat = np.arange(len(codes))[:, None] * _COLUMNS + column
    return np.bincount(flat.ravel(), minlength=len(codes) * _COLUMNS).reshape(len(codes), _COLUMNS).astype(np.float32)


def near(x: list[str], y: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the near pairs of two blocks of words; all of ``x`` have one length, all of ``y`` that or one more."""
    a, b = _codes(x), _codes(y)
    va, vb = _vectors(a), _vectors(b)
    gram = va @ vb.T
    gram *= -2
    gram += (va * va).sum(1)[:, None]
    gram += (vb * vb).sum(1)[None, :]
    i, j = np.divmod(np.flatnonzero((gram <= 2).ravel()), len(y))
    a, b = a[i], b[j]
    if a.shape[1] == b.shape[1]:
        good = (a != b).sum(1) == 1
    else:
        before = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(1)
        behind = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
        good = before + behind >= a.shape[1]
    return i[good], j[good]


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of pairs of slices, in both directions."""
    for batch in batches:
        for row in batch.to_pylist():
            x, y = ([w["word"] for w in row[side]] for side in ("x", "y"))
            i, j = near(x, y)
            if row["same"]:
                i, j = i[i < j], j[i < j]
            if len(i):
                n, m = (np.array([w["n"] for w in row[side]], np.int64) for side in ("x", "y"))
                a, b = np.array(x, object)[i], np.array(y, object)[j]
                columns = [np.concatenate(c) for c in ((a, b), (b, a), (m[j], n[i]))]
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2])], ["word", "other", "other_n"])


def near_words(words: DataFrame) -> DataFrame:
    """``word, other, other_n`` for each ordered pair of near words of a table ``word, n`` of different words.

    Empty words are in no pair.
    """
    shaped = words.where("word <> ''").select("word", "n", _shape().alias("block"))
    blocks = shaped.groupBy("block").agg(F.ceil(F.count("*") / SLICE).cast("int").alias("slices"))
    cut = shaped.join(blocks, "block").withColumn("slice", F.pmod(F.xxhash64("word"), F.col("slices")).cast("int"))
    slices = cut.groupBy("block", "slice").agg(F.collect_list(F.struct("word", "n")).alias("words"))
    slices = materialise(slices, "slices")

    moved = [F.array(*[F.element_at("block", k + 1) + d for k, d in enumerate(step)]) for step in _steps()]
    pairs = slices.select("block", "slice", F.explode(F.array(*moved)).alias("to")).where(F.array_min("to") >= 0)
    targets = slices.select(F.col("block").alias("to"), F.col("slice").alias("to_slice"))
    pairs = pairs.join(targets, "to").withColumn("same", (F.col("block") == F.col("to")) & (F.col("slice") == F.col("to_slice")))
    pairs = pairs.where((F.col("block") != F.col("to")) | (F.col("slice") <= F.col("to_slice")))
    x = slices.select("block", "slice", F.col("words").alias("x"))
    y = slices.select(F.col("block").alias("to"), F.col("slice").alias("to_slice"), F.col("words").alias("y"))
    rows = pairs.join(x, ["block", "slice"]).join(y, ["to", "to_slice"]).select("same", "x", "y")
    return rows.mapInArrow(_products, "word string, other string, other_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the last word that following ``form`` leads to. Each round doubles the steps taken."""
    found = materialise(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumped = found.join(ahead, "root", "left")
        jumped = materialise(jumped.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if jumped.where("moved").limit(1).count() == 0:
            return jumped.select("word", "root")
        found = jumped.select("word", "root")


def variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """One row for each row of ``words`` (``word, n``): ``word, form, root, n, n_near, form_n``.

    ``form`` is the near word of largest ``n`` (ties: the smallest by code point), if that is at least ``ratio`` (over 1)
    times the word's, else null, and ``form_n`` its count; ``root`` is the last word that following forms leads to, or the word
    itself; ``n_near`` counts near words. An empty table gives no rows. Runs jobs and writes intermediate tables.
    """
    words = materialise(words.select("word", "n"), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("best")
    linked = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    found = words.join(linked, "word", "left")
    has = -F.col("best.minus") >= ratio * F.col("n")
    found = found.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(has, F.col("best.other")).alias("form"),
        F.when(has, -F.col("best.minus")).alias("form_n"),
    )
    found = materialise(found, "linked")
    roots = _roots(found.where("form IS NOT NULL"))
    rows = found.join(roots, "word", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, min_length: int = 6, min_count: int = 5, ratio: int = 5, lot: int | None = None) -> DataFrame:
    """:func:`variants` of the :func:`word_counts` of whole texts.

    - Null or empty texts, and rows without letters: no words. An empty table gives no rows.
    - Null ``doc_id``: such a row's words count like all others; no misspelling is planted in them.
    - Repeated rows and reused ids: every row counts.
    - Texts and runs of any length are processed whole, each within one task.
    - Other columns, of whatever name, are ignored.
    """
    return variants(word_counts(docs, min_length, min_count, lot), ratio)
