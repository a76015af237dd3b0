"""Language identification by error-correcting output codes.

Each language has a codeword; every bit has a binary classifier over hashed byte trigrams that tells the languages
whose bit is set from the others (naive Bayes log-odds, each language counting equally). A text's bits are
decoded by loss: of all codewords the one with the least exponential loss wins, every bit weighted by how
often its classifier is right on the training texts of that language. How far the winner is ahead of the
second gives the score, and a text with little lead is flagged as ambiguous.

Training adds up trigram counts by language over all training texts; the model is languages x ``BUCKETS``
numbers. Prediction is one pass over whole texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyscope.sources import materialise

from .words import mix, text_slices

_U = np.uint64
BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
#: Codewords of up to this many languages have all distinct columns; more languages get random ones.
_ALL_COLUMNS = 6
AMBIGUOUS = 0.2

#: Digits, spaces and ASCII punctuation all read as one space.
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[[c for c in range(128) if not chr(c).isalpha()]] = 32


def codewords(languages: int) -> np.ndarray:
    """Codewords of +1 and -1, languages x bits.

    Up to ``_ALL_COLUMNS`` languages: all ways to split them, 2 ** (n - 1) - 1 bits, any two codewords differing in
    2 ** (n - 2). More: columns from a hash, six for each binary digit of the number of languages, of which
    the best of 64 tries by least distance is taken.
    """
    if languages <= 1:
        return np.ones((languages, 0))
    if languages <= _ALL_COLUMNS:
        columns = [(1, *c) for c in product((1, -1), repeat=languages - 1) if -1 in c]
        return np.array(columns, float).T
    bits, best = 6 * int(np.ceil(np.log2(languages))), None
    for k in range(64):
        h = mix(np.arange(languages * bits, dtype=_U) + _U(k << 32)).reshape(languages, bits)
        code = np.where(h & _U(1), 1.0, -1.0)
        gap = min((code[i] != code[i + 1 :]).sum(1).min() for i in range(languages - 1))
        mixed = (np.abs(code.sum(0)) < languages).all()
        if mixed and (best is None or gap > best[0]):
            best = (gap, code)
    return best[1] if best else code


def _grams(text: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, trigram buckets and each text's first trigram (one more at the end), a slice at a time."""
    lowered = pc.utf8_lower(pc.fill_null(text.cast(pa.large_string()), ""))
    for i, _, data, offsets in text_slices(lowered):
        if len(data) < 3:
            yield i, np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
            continue
        x = _FOLD[data]
        code = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
        inside = np.ones(len(code) + 2, bool)
        for back in (1, 2):  # windows that would run into the next text
            cut = offsets[1:] - back
            inside[cut[cut >= 0]] = False
        inside = inside[: len(code)] & ~((x[:-2] == 32) & (x[1:-1] == 32))
        first = np.concatenate(([0], np.cumsum(inside)))[np.minimum(offsets, len(code))]
        bucket = (code[inside] * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)
        yield i, bucket.astype(np.int64), first


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts by language of a task's texts."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        languages = batch.column("lang")
        for i, bucket, first in _grams(batch.column("text")):
            for k in range(len(first) - 1):
                have = counts.setdefault(languages[i + k].as_py(), np.zeros(BUCKETS, np.int64))
                have += np.bincount(bucket[first[k] : first[k + 1]], minlength=BUCKETS)
    for lang, have in counts.items():
        at = np.flatnonzero(have)
        columns = [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(have[at])]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])


def _margins(text: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Mean log-odds of each bit, texts x bits; zeros for texts without trigrams."""
    out = np.zeros((len(text), weights.shape[1]), np.float32)
    for i, bucket, first in _grams(text):
        count = np.diff(first)
        some = np.flatnonzero(count)
        if len(some):
            out[i + some] = np.add.reduceat(weights[bucket], first[some]) / count[some, None]
    return out


class Model:
    """Languages in order, codewords, trigram log-odds (buckets x bits) and the weight of each bit for each language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.code = codewords(len(languages))
        # A trigram that no language has tells nothing, however much text each language has.
        shares = counts / np.maximum(counts.sum(1, keepdims=True), 1) + 0.5 / max(counts.sum() / max(len(counts), 1), 1)
        ones, others = self.code.T > 0, self.code.T < 0
        self.weights = np.zeros((BUCKETS, self.code.shape[1]), np.float32)
        for k in range(self.code.shape[1]):
            self.weights[:, k] = np.log(shares[ones[k]].mean(0) / shares[others[k]].mean(0))
        self.trust = np.ones_like(self.code)
        self.scale = np.ones(self.code.shape[1])

    def decoded(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, score and lead of each text."""
        if len(self.languages) == 1:
            ones = np.ones(len(margins))
            return np.zeros(len(margins), np.int64), ones, ones
        trust = self.trust / self.trust.sum(1, keepdims=True)
        losses = (trust[None] * np.exp(-self.code[None] * (margins * self.scale)[:, None, :].clip(-20, 20))).sum(2)
        fit = np.exp(-4 * losses)
        fit /= fit.sum(1, keepdims=True)
        order = np.argsort(-fit, axis=1, kind="stable")
        rows = np.arange(len(fit))
        best = fit[rows, order[:, 0]]
        return order[:, 0], best, best - fit[rows, order[:, 1]]


def _checked(model: Model) -> Callable:
    """How often each bit is right, and the sizes of margins, by language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(model.languages)
        number = {lang: k for k, lang in enumerate(model.languages)}
        right, sizes, texts = np.zeros(model.code.shape), np.zeros(model.code.shape), np.zeros(n)
        for batch in batches:
            margins = _margins(batch.column("text"), model.weights)
            at = np.array([number[x.as_py()] for x in batch.column("lang")], np.int64)
            np.add.at(right, at, margins * model.code[at] > 0)
            np.add.at(sizes, at, np.abs(margins))
            np.add.at(texts, at, 1)
        k, b = np.indices(model.code.shape)
        columns = [k.ravel(), b.ravel(), right.ravel(), sizes.ravel(), texts[k.ravel()]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["lang", "bit", "right", "size", "texts"])

    return run


def fit(docs: DataFrame) -> Model:
    """Learns from all rows of ``docs`` (``text``, ``lang``) with a language and a text."""
    rows = docs.select(F.col("text").cast("string"), F.col("lang").cast("string")).where("text IS NOT NULL AND lang IS NOT NULL")
    counts = rows.mapInArrow(_counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = materialise(counts, "trigrams")
    languages = sorted(r.lang for r in counts.select("lang").distinct().collect())
    table = np.zeros((len(languages), BUCKETS))
    number = {lang: k for k, lang in enumerate(languages)}
    for r in counts.toLocalIterator():
        table[number[r.lang], r.bucket] = r.n
    model = Model(languages, table)
    if len(languages) > 1:
        known = rows.where(F.col("lang").isin(languages))
        sums = known.mapInArrow(_checked(model), "lang long, bit long, right double, size double, texts double")
        sums = sums.groupBy("lang", "bit").agg(*[F.sum(c).alias(c) for c in ("right", "size", "texts")]).collect()
        sizes, texts = np.zeros(model.code.shape), np.zeros(model.code.shape)
        for r in sums:
            model.trust[r.lang, r.bit] = (r.right + 1) / (r.texts + 2)
            sizes[r.lang, r.bit], texts[r.lang, r.bit] = r["size"], r.texts
        model.scale = 2 / np.maximum(sizes.sum(0) / np.maximum(texts.sum(0), 1), 1e-6)
    return model


_PREDICTIONS = "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean"


def _predicted(model: Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = batch.column("letters").to_pylist()
            best, score, lead = model.decoded(_margins(batch.column("text"), model.weights))
            known = [bool(x) for x in letters]
            columns = [
                batch.column("doc_id"),
                batch.column("held_out"),
                pa.array([model.languages[k] if ok else "und" for k, ok in zip(best, known, strict=True)], pa.string()),
                pa.array(np.where(known, score, 0.0), pa.float64()),
                pa.array([not ok or bool(x < AMBIGUOUS) for x, ok in zip(lead, known, strict=True)], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _PREDICTIONS.split(", ")])

    return run


def held_out(doc_id: Column) -> Column:
    """Documents that are not learned from: the remainder of their id's CRC-32 by 3 is 1. Null ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identified(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, ambiguous`` for each row of ``docs`` (``doc_id``, ``text``, ``lang``).

    ``lang`` is read of training rows only, to learn; predictions see the text alone.

    - Null text, or one without a letter: ``und``, score 0, ambiguous. Without any training row, all texts are ``und``.
    - Null ``lang``: not learned from. Null ``doc_id``: learned from if it has a language.
    - A text of one or two bytes has no trigram and gets the language that no evidence favours, ambiguous unless
      there is only one language. Equal fits go to the first language in order.
    - Repeated rows count and are answered each. An empty table gives no rows. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    rows = rows.withColumn("held_out", held_out(F.col("doc_id")))
    model = fit(rows.where("NOT held_out"))
    asked = rows.select("doc_id", "held_out", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    if not model.languages:
        return asked.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("ambiguous"))
    return asked.mapInArrow(_predicted(model), _PREDICTIONS)
