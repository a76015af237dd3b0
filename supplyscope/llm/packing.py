"""Vector best-fit packing of documents into training sequences.

A document is its token ids and an end id. Documents longer than a sequence, and only those, are cut into whole sequences
and a rest. A sequence has capacities of tokens, documents (pieces) and attention cost (the sum of squared piece
lengths); a piece demands ``(length, 1, length ** 2)`` of them.

1. One scan tokenizes whole texts, cuts them and numbers the pieces of each length within its task.
2. What a piece demands depends on its length only, so the counts of pieces by length, no more rows than a sequence has
   tokens, say all that a packing needs. :func:`plan` packs them on the driver: longest first, each length into the open
   sequences that fit best under every constraint, by the norm of what stays free or by the dot product of what is
   free and what is demanded, both weighted; new sequences are opened when none fits. Equal sequences are handled
   together, as ``(how many, what is free)``, so the work follows the number of lengths and not that of documents.
3. The plan's rows say which numbers of a length go where. A piece's number is its number within its task and the count of
   that length in the tasks before, so places are found by joins on (task, length). A length that very many
   documents have is spread over all tasks, and token ids are not shuffled unless asked for.

The tokenizer splits texts into words, which never span white space, and makes the ids of each word by itself. So a worker
has it make those of a different word once and remembers them.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplyscope.sources import materialise

from .words import text_slices

#: Words whose ids a worker remembers at most; beyond that it starts anew.
REMEMBERED = 1_000_000
PIECES = "doc_id long, piece int, start long, length long, ids binary, part int, nth long"

#: White space of ASCII, and characters that no normalising but lower case changes: printable ASCII and letters up to U+00FF.
_WHITE, _LETTERS = r" \t\n\r\x0b\x0c", "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = f"!-~{_LETTERS}"
_PLAIN_TEXT, _PLAIN_CHUNK = re.compile(f"[{_WHITE}{_PLAIN}]*"), re.compile(f"[{_PLAIN}]+")
_CHUNK = re.compile(f"[^{_WHITE}]+")
#: Words given to the tokenizer as one text.
_TOGETHER = 1000


class _Numbers(dict):
    """Numbers keys in the order in which they are first asked for, and lists the new ones."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        self.new.append(key)
        return n


class Remembered:
    """A tokenizer that splits texts into words by a pattern, and the ids of the words that this worker has met.

    In plain texts the pattern is applied here, in lower case as the tokenizer would; in others, a chunk between white space
    that has other characters is tokenized as it is.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task on each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        names = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(names.values()) + 1, bool)
        self.ends[[k for name, k in names.items() if name.endswith("</w>")]] = True
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        steps = json.loads(self.tokenizer.to_str())["pre_tokenizer"]
        pattern = steps.get("pretokenizers", [steps])[0]["pattern"]["Regex"]
        # The classes of the tokenizer's pattern, within plain text in lower case.
        self.pattern = re.compile(pattern.replace(r"\p{L}", "a-zß-öø-ÿ").replace(r"\p{N}", "0-9"))
        self.forget()

    def forget(self) -> None:
        self.numbers, self.flat, self.start = _Numbers(), np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def _units(self, text: str) -> list[str]:
        """Parts of a text whose ids end to end are the text's."""
        if any(x in text for x in self.special):
            return [text]
        if _PLAIN_TEXT.fullmatch(text):
            return self.pattern.findall(text.lower())
        chunks = _CHUNK.findall(text)
        return [u for c in chunks for u in (self.pattern.findall(c.lower()) if _PLAIN_CHUNK.fullmatch(c) else (c,))]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, units: list[str]) -> None:
        """Ids of new units. Plain words go to the tokenizer many at a time: a word's last token, and no other, ends a word."""
        ids, sizes = [self.flat], []
        for k in range(0, len(units), _TOGETHER):
            own = units[k : k + _TOGETHER]
            words = [u for u in own if _PLAIN_CHUNK.fullmatch(u) and u not in self.special]
            (whole,) = self._encode([" ".join(words)])
            stops = np.flatnonzero(self.ends[whole]) + 1
            if len(words) == len(own) == len(stops):
                ids.append(whole)
                sizes.append(np.diff(stops, prepend=0))
            else:
                found = self._encode(own)
                ids += found
                sizes.append(np.array([len(x) for x in found], np.int64))
        self.flat = np.concatenate(ids)
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(np.concatenate(sizes))])

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and where each text's begin (one more at the end)."""
        if len(self.numbers) > REMEMBERED:
            self.forget()
        units = [self._units(x) for x in texts]
        n = np.fromiter(map(len, units), np.int64, len(units))
        number = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(units)), np.int64, int(n.sum()))
        if self.numbers.new:
            self._learn(self.numbers.new)
            self.numbers.new = []
        sizes = self.start[number + 1] - self.start[number]
        bound = np.concatenate(([0], np.cumsum(sizes)))
        at = np.repeat(self.start[number] - bound[:-1], sizes) + np.arange(bound[-1])
        return self.flat[at], bound[np.concatenate(([0], np.cumsum(n)))]


_known: dict[str, Remembered] = {}


def _tokenize(path: str, limit: int, end: int):
    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _known:
            _known[path] = Remembered(path)
        part, counts, tail = TaskContext.get().partitionId(), np.zeros(limit + 1, np.int64), np.array([end], "<u4").tobytes()
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for i, j, data, offsets in text_slices(batch.column("text")):
                raw = data.tobytes()
                found, bound = _known[path].ids([raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)])
                rows = []
                for doc_id, lo, hi in zip(ids[i:j], bound[:-1].tolist(), bound[1:].tolist(), strict=True):
                    whole = found[lo:hi].tobytes() + tail
                    for piece, at in enumerate(range(0, len(whole), 4 * limit)):
                        own = whole[at : at + 4 * limit]
                        n = len(own) // 4
                        rows.append((doc_id, piece, at // 4, n, own, part, int(counts[n])))
                        counts[n] += 1
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
                names = ["doc_id", "piece", "start", "length", "ids", "part", "nth"]
                columns = zip(zip(*rows, strict=True), types, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names)

    return tokenize


def pieces(docs: DataFrame, tokenizer: str, limit: int = 4096, end: int = 1) -> DataFrame:
    """The pieces of every row of ``docs``: ``doc_id, piece, start, length, ids, part, nth``.

    ``tokenizer`` is the path of a tokenizer's JSON file on every machine. ``ids`` are little-endian unsigned 32-bit numbers. ``part`` and
    ``nth`` number the pieces of a length within a task; they hold for a written table, as the rows of a task may come
    in another order when it runs again. Null text is empty and has the end id only; null ids stay null.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_tokenize(tokenizer, limit, end), PIECES)


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds at most; None: as much as its tokens allow. ``weights`` rank the three."""

    tokens: int = 4096
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.0, 0.0)
    rule: str = "norm"

    def most(self) -> np.ndarray:
        documents = self.tokens if self.documents is None else self.documents
        attention = self.tokens**2 if self.attention is None else self.attention
        return np.array([self.tokens, documents, attention], np.int64)


@dataclass(frozen=True)
class Place:
    """Pieces ``first`` to ``first + n`` of a length go to the sequences from ``sequence``, ``per`` to each, from token ``at``."""

    length: int
    first: int
    n: int
    per: int
    sequence: int
    at: int


def plan(counts: dict[int, int], capacity: Capacity) -> list[Place]:
    """A packing of ``counts`` pieces by length. Pieces that fit no empty sequence are refused.

    A group of equal sequences takes as many pieces of a length as fit before the next group does. Each time that leaves
    less than half of the group's free tokens, and each length splits one group at most, so the groups and the places are
    bounded by the number of lengths, whatever the counts.
    """
    most = capacity.most()
    scale = np.array(capacity.weights) / np.maximum(most, 1)
    free = np.zeros((0, 3), np.int64)
    many: list[int] = []
    first: list[int] = []
    places, opened = [], 0
    for length in sorted((x for x, n in counts.items() if n), reverse=True):
        demand = np.array([length, 1, length * length], np.int64)
        if (demand > most).any():
            raise ValueError(f"a piece of {length} tokens is over a sequence's capacity")
        left, number = counts[length], 0
        while left:
            fits = np.flatnonzero((free >= demand).all(1))
            if len(fits):
                if capacity.rule == "norm":
                    fit = ((((free[fits] - demand) * scale) ** 2).sum(1)).argmin()
                else:
                    fit = (free[fits] / np.maximum(most, 1) @ (scale * demand)).argmax()
                g = int(fits[fit])
            else:
                per = int((most // demand).min())
                g = len(many)
                free = np.vstack((free, most))
                many.append(-(-left // per))
                first.append(opened)
                opened += many[g]
            per = int((free[g] // demand).min())
            at = int(most[0] - free[g][0])
            taken = min(left, per * many[g])
            places.append(Place(length, number, taken, per, first[g], at))
            full, rest = divmod(taken, per)
            for kept, pieces_of in ((many[g] - full - (rest > 0), 0), (int(rest > 0), rest)):
                if kept:  # behind the full ones: the one that has the rest, then those without
                    free = np.vstack((free, free[g] - pieces_of * demand))
                    many.append(kept)
                    first.append(first[g] + full + (rest > 0 if not pieces_of else 0))
            if full:
                free[g] -= per * demand
                many[g] = full
            else:
                many[g] = 0
            open_ = np.flatnonzero((free[:, 0] > 0) & (free[:, 1] > 0) & (np.array(many) > 0))
            free, many, first = free[open_], [many[k] for k in open_], [first[k] for k in open_]
            left, number = left - taken, number + taken
    return places


def packed(found: DataFrame, capacity: Capacity | None = None) -> DataFrame:
    """``found`` with ``sequence_id`` and ``offset`` for ``part`` and ``nth``.

    ``found`` is a table as of :func:`pieces`; further columns are kept, and ``ids`` should not be among them unless wanted, as rows
    are shuffled. Writes the rows once and runs jobs; the driver sees one row for each length. An empty table gives no rows.
    """
    capacity = capacity or Capacity()
    spark = found.sparkSession
    found = materialise(found, "pieces")
    shares = materialise(found.groupBy("length", "part").agg(F.count("*").alias("many")), "shares")
    counts = {r.length: r.n for r in shares.groupBy("length").agg(F.sum("many").alias("n")).collect()}
    fields = "length long, first long, placed long, per long, sequence long, at long"
    places = spark.createDataFrame([(p.length, p.first, p.n, p.per, p.sequence, p.at) for p in plan(counts, capacity)], fields)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.withColumn("begin", F.coalesce(F.sum("many").over(before), F.lit(0).cast("long")))
    crossed = (F.col("first") < F.col("begin") + F.col("many")) & (F.col("begin") < F.col("first") + F.col("placed"))
    spans = shares.join(places, "length").where(crossed)
    spans = spans.select("part", "length", F.struct("begin", "first", "placed", "per", "sequence", "at").alias("place"))
    rank = F.col("place.begin") + F.col("nth") - F.col("place.first")
    rows = found.join(spans, ["part", "length"]).where((rank >= 0) & (rank < F.col("place.placed")))
    return rows.select(
        *[c for c in found.columns if c not in ("part", "nth")],
        (F.col("place.sequence") + F.floor(rank / F.col("place.per"))).alias("sequence_id"),
        (F.col("place.at") + F.pmod(rank, F.col("place.per")) * F.col("length")).alias("offset"),
    )


def sequences(rows: DataFrame, ids: Column | str = "ids") -> DataFrame:
    """``sequence_id`` and the token ids of each sequence, from packed pieces with their ``ids``."""
    pieces_of = F.sort_array(F.collect_list(F.struct("offset", F.col(ids).alias("ids") if isinstance(ids, str) else ids.alias("ids"))))
    joined = F.aggregate(pieces_of, F.lit(b""), lambda whole, x: F.concat(whole, x["ids"]))
    return rows.groupBy("sequence_id").agg(joined.alias("ids"))


def best_fit(docs: DataFrame, tokenizer: str, capacity: Capacity | None = None, end: int = 1) -> DataFrame:
    """All pieces of ``docs`` with their places: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    - Null or empty text, or text without tokens: one piece, the end id.
    - Very long text: processed whole, within one task; its pieces are packed like all others.
    - Null, repeated or reused ``doc_id``: every row of ``docs`` is packed.
    - Ties between sequences that fit equally well go to the earliest opened group. Numbers of sequences run from 0.
    - Other columns, of whatever name, are ignored. An empty table gives no rows.
    """
    capacity = capacity or Capacity()
    found = pieces(docs, tokenizer, capacity.tokens, end)
    return packed(found.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "part", "nth"), capacity)
