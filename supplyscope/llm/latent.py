"""Benchmark decontamination by latent semantic retrieval.

1. Fit, one pass over all texts: passages of ``WINDOW`` words are rows of a TF-IDF matrix A over the words of the
   benchmark. Every task sums its share of T'(T X), T the word counts and X a fixed sparse random sign matrix,
   and the passages each word is in. With D the inverse document frequencies, A = T D, so D times that sum
   is A'A applied to a random matrix, from which the Nystroem method gives the leading right singular vectors
   and values of A (Halko, Martinsson and Tropp 2011; Tropp et al. 2017). The benchmark's own passages are
   few; they are added with a weight that gives them as much of the whole as the corpus has, so that the
   latent axes tell them apart, and what is common in the corpus counts little. The sums are words of the
   benchmark x ``SKETCH`` numbers, however large the corpus is.
2. Search, one pass: passages that overlap by half are projected into the latent space, every axis scaled by its
   singular value, and compared with all queries of a block: by cosine, and by how much of the query's vector
   they hold. A query is an item, or for one of more than ``WINDOW`` words each of its passages that overlap by half;
   short items are compared with shorter passages of the texts.
3. Check: in the text around its candidate passages, as far as the whole item reaches, the longest common
   subsequence of words with the item must hold most of the item within one and a half times its length (``SHARE``, or
   ``SHORT_SHARE`` of a short item), and half of its answer: the last sentence, with those before it until it has ``LEAST_ANSWER`` words. Where nearly all of
   the item is there, the answer is not asked for. Words are compared without punctuation at their edges.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import PUNCTUATION, mix, text_slices, word_hashes

_U = np.uint64
RANK, SKETCH, TILE = 128, 16, 32
WINDOW = 2 * TILE
#: Most words of an item, and the tile of texts of which two are compared with it; longer ones take ``TILE``.
SHORT = ((6, 4), (12, 8), (24, 16))
#: Queries of one block; a larger benchmark takes more passes over the texts.
MOST_ITEMS = 1000
COSINE, HELD, SHARE, ANSWER, NEARLY = 0.35, 0.35, 0.6, 0.5, 0.9
LEAST_ANSWER = 5
#: Items of fewer words than this must be there but for one word in five: three words of five are common by chance.
SHORT_ITEM, SHORT_SHARE = 13, 0.8
#: Words of the vocabulary handled at a time.
_STRIP = 4096
_SENTENCE_END = re.compile(rb"[.!?](?=[ \t\n\x0b\x0c\r])|\n")
_BYTES = 1 << 20


def _signs(terms: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Axis and sign of each term's two entries in the random test matrix, from hashes of the term's number."""
    out = []
    for k in (1, 2):
        h = mix(np.arange(terms, dtype=_U) * _U(2) + _U(k << 32))
        out.append(((h % _U(SKETCH)).astype(np.int64), np.where((h >> _U(40)) & _U(1), 1.0, -1.0)))
    return out


def _sieve(vocabulary: np.ndarray) -> np.ndarray:
    sieve = np.zeros(1 << 16, bool)
    sieve[(vocabulary >> _U(48)).astype(np.int64)] = True
    return sieve


def _known(words: np.ndarray, vocabulary: np.ndarray, sieve: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words are in the vocabulary (sorted hashes), and their numbers there."""
    at = np.flatnonzero(sieve[(words >> _U(48)).astype(np.int64)])
    term = np.searchsorted(vocabulary, words[at])
    term[term == len(vocabulary)] = 0
    good = vocabulary[term] == words[at]
    return at[good], term[good]


def _row_sums(rows: np.ndarray, pick: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """For each of ``groups`` groups, the sum of the rows it picks; ``group`` is ascending.

    The first pick of every group is added at once, then the second, and so on: as many steps as the largest group has picks.
    """
    out = np.zeros((groups, rows.shape[1]), rows.dtype)
    if not len(pick):
        return out
    head = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.append(head, len(group)))
    order = np.argsort(-size, kind="stable")
    head, size, owner = head[order], size[order], group[head[order]]
    longer = np.searchsorted(-size, -np.arange(size[0]), "left")  # how many groups have more than k picks
    for k, n in enumerate(longer.tolist()):
        out[owner[:n]] += rows[pick[head[:n] + k]]
    return out


def _starts(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of the tiles of ``size`` words in which each text is cut, and each tile's text."""
    counts = -(-np.diff(first) // size)
    text = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return first[text] + within * size, text


def _sketch(vocabulary: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, passages = len(vocabulary), 0
        total, df = np.zeros((n, SKETCH)), np.zeros(n, np.int64)
        signs, sieve = _signs(n), _sieve(vocabulary)
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column("text"), _BYTES):
                words, _, _, first = word_hashes(data, offsets, edges=PUNCTUATION)
                if not len(words):
                    continue
                starts, _ = _starts(first, WINDOW)
                passages += len(starts)
                at, term = _known(words, vocabulary, sieve)
                if not len(at):
                    continue
                passage = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(words))))[at]
                keys, tf = np.unique(term * len(starts) + passage, return_counts=True)
                term, passage = np.divmod(keys, len(starts))
                y = sum(
                    np.bincount(passage * SKETCH + axis[term], weights=tf * sign[term], minlength=len(starts) * SKETCH)
                    for axis, sign in signs
                )
                at = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
                total[term[at]] += np.add.reduceat(y.reshape(-1, SKETCH)[passage] * tf[:, None], at)
                df[term[at]] += np.diff(np.append(at, len(term)))
        if passages:
            yield _sums(total, df, passages)

    return run


_SUMS = "total binary, df binary, passages long"


def _sums(total: np.ndarray, df: np.ndarray, passages: int) -> pa.RecordBatch:
    columns = [pa.array([total.tobytes()], pa.binary()), pa.array([df.tobytes()], pa.binary()), pa.array([passages], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["total", "df", "passages"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of what streams in; holds no more than that."""
    total, df, passages = 0.0, 0, 0
    for batch in batches:
        for a, b, c in zip(*(batch.column(k) for k in range(3)), strict=True):
            total = total + np.frombuffer(a.as_buffer(), np.float64)
            df = df + np.frombuffer(b.as_buffer(), np.int64)
            passages += c.as_py()
    if passages:
        yield _sums(total, df, passages)


def _fit(docs: DataFrame, items: dict) -> dict:
    """Adds to a block of items the projection of word counts into the latent space and the queries' vectors there.

    On the driver: sums of words x ``SKETCH`` numbers from as many tasks as one reduction leaves, and the latent axes, words x
    ``RANK`` numbers.
    """
    vocabulary = items["vocabulary"]  # of the queries
    parts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_sketch(vocabulary), _SUMS)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while partitions > 1:  # a tree of sums, so that no task reads many
        partitions = partitions // 16 + 1 if partitions > 16 else 1
        parts = parts.repartition(partitions).mapInArrow(_added, _SUMS)
    n = len(vocabulary)
    raw, df, passages = np.zeros((n, SKETCH)), np.zeros(n, np.int64), 0
    for r in parts.collect():
        raw = np.frombuffer(bytes(r.total)).reshape(n, SKETCH)
        df, passages = np.frombuffer(bytes(r.df), np.int64), r.passages
    idf = np.log((passages + 1) / (df + 1)) + 0.01
    test = np.zeros((n, SKETCH))
    for axis, sign in _signs(n):
        np.add.at(test, (np.arange(n), axis), sign)
    values, vectors = np.linalg.eigh((test.T @ raw + raw.T @ test) / 2)
    good = values > max(values[-1], 0.0) * 1e-9
    corpus = ((idf[:, None] * raw) @ (vectors[:, good] / np.sqrt(values[good]))).T
    axes, s = _axes(corpus, idf, items)
    projection = (idf[:, None] * axes / s).astype(np.float32)
    vectors = _row_sums(projection, items["term"], items["query"], len(items["item"]))
    norms = np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    return items | {"projection": projection, "vectors": vectors / norms, "norms": norms[:, 0], "sieve": _sieve(vocabulary)}


def _axes(corpus: np.ndarray, idf: np.ndarray, items: dict) -> tuple[np.ndarray, np.ndarray]:
    """Leading right singular vectors and values of the corpus' axes and the queries' TF-IDF rows, the latter with a weight.

    Of an item with more than ``MOST_ITEMS`` queries, evenly spaced ones stand for all: one passage found leads to the whole item. The
    rows' products are summed over strips of the vocabulary, so no matrix of queries and words is ever whole.
    """
    bound = np.searchsorted(items["item"], np.arange(len(items["ids"]) + 1))
    spaced = [np.linspace(a, b - 1, min(b - a, MOST_ITEMS)).astype(np.int64) for a, b in zip(bound[:-1], bound[1:], strict=True)]
    used = np.concatenate(spaced)
    row = np.searchsorted(used, items["query"])
    chosen = used[np.minimum(row, len(used) - 1)] == items["query"]
    row, term = row[chosen], items["term"][chosen]
    order = np.argsort(term, kind="stable")
    row, term = row[order], term[order]

    def strips() -> Iterator[tuple[slice, np.ndarray]]:
        for low in range(0, len(idf), _STRIP):
            high = min(low + _STRIP, len(idf))
            i, j = np.searchsorted(term, (low, high))
            flat = row[i:j] * (high - low) + term[i:j] - low
            own = np.bincount(flat, minlength=len(used) * (high - low)).reshape(len(used), high - low)
            yield slice(low, high), own * idf[low:high]

    weight = np.sqrt(max((corpus**2).sum(), 1.0) / max(sum((own**2).sum() for _, own in strips()), 1e-12))
    gram = sum(m @ m.T for m in (np.vstack([corpus[:, at], weight * own]) for at, own in strips()))
    values, left = np.linalg.eigh(gram)
    values, left = values[::-1], left[:, ::-1]
    kept = min(RANK, int((values > values[0] * 1e-10).sum()))
    s = np.sqrt(values[:kept])
    axes = np.concatenate([np.vstack([corpus[:, at], weight * own]).T @ left[:, :kept] for at, own in strips()])
    return axes / s, s


def _queries(words: list[np.ndarray]) -> list[tuple[int, int, int, int]]:
    """Item, first word, end and tile of each query: short items whole, others in passages that overlap by half."""
    out = []
    for k, w in enumerate(words):
        m = len(w)
        tile = next((t for most, t in SHORT if m <= most), TILE)
        out += [(k, max(0, min(a, m - WINDOW)), min(a + WINDOW, m), tile) for a in range(0, max(1, m - TILE), TILE)]
    return out


def _prepared(ids: list, texts: list[str]) -> dict | None:
    """Items with words: ids, word hashes, how many of them are the answer; their vocabulary, queries, and the terms of each query."""
    out: dict = {"ids": [], "words": [], "answer": []}
    for item_id, text in zip(ids, texts, strict=True):
        _, _, data, offsets = next(text_slices(pa.array([text])))
        words, start, _, _ = word_hashes(data, offsets, edges=PUNCTUATION)
        if not len(words):
            continue
        body = text.encode().rstrip(b" \t\n\x0b\x0c\r.!?")
        tails = [int((start > m.start()).sum()) for m in _SENTENCE_END.finditer(body)]
        answer = min((n for n in tails if n >= LEAST_ANSWER), default=len(words))
        out["ids"].append(item_id)
        out["words"].append(words)
        out["answer"].append(answer)
    if not out["ids"]:
        return None
    vocabulary = np.unique(np.concatenate(out["words"]))
    queries = _queries(out["words"])
    item, begin, end, tile = np.array(queries).T
    term = np.searchsorted(vocabulary, np.concatenate([out["words"][k][a:b] for k, a, b, _ in queries]))
    return out | {"vocabulary": vocabulary, "term": term, "query": np.repeat(np.arange(len(item)), end - begin), "item": item, "tile": tile}


def _lcs(masks: dict[int, int], words: list[int], length: int) -> int:
    """Length of the longest common subsequence of ``words`` and an item, all of whose places are bits of ``masks``."""
    row = full = (1 << length) - 1
    for word in words:
        match = row & masks.get(word, 0)
        row = ((row + match) | (row - match)) & full
    return length - row.bit_count()


def _check(words: np.ndarray, item: np.ndarray, answer: int) -> tuple[int, int, int] | None:
    """Common words, common words of the answer, and first word, where ``words`` hold the item best."""
    m, listed, text = len(item), item.tolist(), words.tolist()
    least = (SHORT_SHARE if m < SHORT_ITEM else SHARE) * m
    there = set(text)
    if sum(word in there for word in listed) < least:
        return None
    own = np.sort(item)
    place = np.minimum(np.searchsorted(own, words), m - 1)
    known = np.concatenate(([0], np.cumsum(own[place] == words)))
    masks: dict[int, int] = {}
    for k, word in enumerate(listed):
        masks[word] = masks.get(word, 0) | 1 << k
    tail: dict[int, int] = {}
    for k, word in enumerate(listed[m - answer :]):
        tail[word] = tail.get(word, 0) | 1 << k
    span, step, best = -(-3 * m // 2), max(1, m // 4), None
    for at in range(0, max(1, len(text) - span + step), step):
        part = text[at : at + span]
        if known[at + len(part)] - known[at] < least:
            continue
        common = _lcs(masks, part, m)
        if common >= least and (best is None or common > best[0]):
            last = _lcs(tail, part, answer)
            if last >= ANSWER * answer or common >= NEARLY * m:
                best = (common, last, at)
    return best


def _candidates(words: np.ndarray, first: np.ndarray, items: dict):
    """First word, length, text, query and cosine of the passages that may hold a query."""
    at, term = _known(words, items["vocabulary"], items["sieve"])
    size = int(items["tile"].min())
    starts, owner = _starts(first, size)
    tile = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(words))))[at]
    held = _row_sums(items["projection"], term, tile, len(starts))
    found = []
    while True:
        k = np.flatnonzero(items["tile"] == size)
        if len(k):
            head = np.r_[True, owner[1:] != owner[:-1]]
            pair = np.flatnonzero(np.r_[owner[1:] == owner[:-1], False])
            single = np.flatnonzero(head & np.r_[head[1:], True])
            passages = np.concatenate([held[pair] + held[pair + 1], held[single]])
            where = np.concatenate([pair, single])
            products = passages @ items["vectors"][k].T
            norms = np.linalg.norm(passages, axis=1)
            w, q = np.nonzero((products >= COSINE * norms[:, None]) & (products >= HELD * items["norms"][k]))
            found.append((starts[where[w]], np.full(len(w), 2 * size), owner[where[w]], k[q], products[w, q] / np.maximum(norms[w], 1e-12)))
        if size == TILE:
            return [np.concatenate(c) for c in zip(*found, strict=True)]
        # Two tiles of a text make one of the next size.
        head = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        number = np.arange(len(owner)) - np.repeat(head, np.diff(np.append(head, len(owner))))
        even = np.flatnonzero(number % 2 == 0)
        both = even[np.r_[owner[1:] == owner[:-1], False][even]]
        held[both] += held[both + 1]
        held, starts, owner, size = held[even], starts[even], owner[even], 2 * size


def _regions(at: np.ndarray, length: np.ndarray, span: int, begin: int, end: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Stretches of a text within ``span`` words of passages, merged, and which passages are in each."""
    order = np.argsort(at, kind="stable")
    lo, hi = np.maximum(begin, at[order] - span), np.minimum(end, np.maximum.accumulate(at[order] + length[order]) + span)
    new = np.flatnonzero(np.r_[True, lo[1:] > hi[:-1]])
    for a, b in zip(new, np.append(new[1:], len(at)), strict=True):
        yield int(lo[a]), int(hi[b - 1]), order[a:b]


def _matches(text: pa.Array, items: dict) -> Iterator[tuple[int, int, float, int, int, int]]:
    """Row, item, cosine, common words, common words of the answer and first word of every leak found."""
    for i, _, data, offsets in text_slices(text, _BYTES):
        words, _, _, first = word_hashes(data, offsets, edges=PUNCTUATION)
        if not len(words):
            continue
        at, length, owner, query, cosine = _candidates(words, first, items)
        if not len(at):
            continue
        item = items["item"][query]
        order = np.lexsort((at, item, owner))
        at, length, owner, item, cosine = (c[order] for c in (at, length, owner, item, cosine))
        new = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (item[1:] != item[:-1])])
        for a, b in zip(new, np.append(new[1:], len(at)), strict=True):
            row, k, best = int(owner[a]), int(item[a]), None
            span = -(-3 * len(items["words"][k]) // 2)
            for lo, hi, which in _regions(at[a:b], length[a:b], span, first[row], first[row + 1]):
                found = _check(words[lo:hi], items["words"][k], items["answer"][k])
                if found and (best is None or found[0] > best[1]):
                    best = (float(cosine[a:b][which].max()), found[0], found[1], int(lo - first[row] + found[2]))
            if best:
                yield i + row, k, *best


_LEAKS = "doc_id long, item_id long, cosine double, common long, item_words long, answer_common long, answer_words long, first_word long"


def _leaks(items: dict) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column("doc_id"), []
            for row, k, cosine, common, last, at in _matches(batch.column("text"), items):
                rows.append((ids[row].as_py(), items["ids"][k], cosine, common, len(items["words"][k]), last, items["answer"][k], at))
            kinds = [pa.int64()] * 2 + [pa.float64()] + [pa.int64()] * 5
            columns = list(zip(*rows, strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [c.split()[0] for c in _LEAKS.split(", ")])

    return run


def _clean(items: dict, text: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for row, *_ in _matches(batch.column(text), items):
                keep[row] = False
            yield batch.filter(pa.array(keep))

    return run


def _blocks(docs: DataFrame, benchmark: DataFrame) -> Iterator[dict]:
    """Fitted blocks of items with about ``MOST_ITEMS`` queries by hash, so that what each pass is sent has a bound."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text IS NOT NULL")
    queries = F.greatest(F.lit(1), F.ceil(F.size(F.split("text", r"[\x20\x09-\x0D]+")) / TILE) - 1)
    blocks = math.ceil((items.agg(F.sum(queries)).first()[0] or 0) / MOST_ITEMS)
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        found = _prepared([r.item_id for r in rows], [r.text for r in rows])
        if found:
            yield _fit(docs, found)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The items that documents leak, one row for each text and item: ids, ``cosine`` (the best of its passages), words in ``common`` of
    ``item_words``, ``answer_common`` of ``answer_words``, and the ``first_word`` of the passage.

    ``docs`` has ``doc_id`` and ``text``, ``benchmark`` has ``item_id`` and ``text``. Runs a job for the fit.

    - Null, empty or wordless texts and items match nothing. An empty table on either side gives no rows.
    - Null ids are carried as null. Repeated rows give repeated results. Other columns are ignored.
    - Texts of any length are read whole; a text shorter than a passage is one passage. Of equally good
      passages of a text the first counts.
    """
    base = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = base.sparkSession.createDataFrame([], _LEAKS)
    for items in _blocks(base, benchmark):
        out = out.unionByName(base.mapInArrow(_leaks(items), _LEAKS))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that leak no item, with their columns."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    text = names[docs.columns.index("text")]
    out = docs.toDF(*names)
    for items in _blocks(docs, benchmark):
        out = out.mapInArrow(_clean(items, text), out.schema)
    return out.toDF(*docs.columns)
