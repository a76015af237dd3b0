"""Alignment of two tokenizers' tokens by lockstep vectorised merging.

Tokenizer A is a byte-level BPE file (``tokenizers``), B a SentencePiece model that adds a space in front; so both tokenize a
space and the text, to tokens that are spans of the same bytes. Two tokens are linked if their spans overlap; byte
offsets where tokens of both end are cuts, and cut a document's tokens into groups.

1. The merge of two lists of ends is a walk of two pointers: link the tokens pointed at, then advance the one that ends
   first, or both at a cut. :func:`merged` makes this step for all documents of a batch at once: one state vector
   holds a pointer into A's and one into B's tokens for each, every step emits a link for each and the cuts among them, and
   documents that ended are compacted away. A long document is cut beforehand at some of its cuts into lanes of about
   ``LANE`` tokens that walk side by side, so the steps of a batch do not grow with its longest document.
2. The scan gathers documents into blocks of about ``BLOCK_LINKS`` links. A block is a row: what each document has, the id pairs
   linked in the block with the number of its documents that have each, and each document's links as places in that list,
   sorted, as compressed differences.
3. Counts over the corpus are sums over the blocks' lists: each block asks for each of its pairs once, so a
   pair that every document has is one row for each block, not for each document. The answers go back to their block,
   whose links are added up with numpy.

Tokens come from the tokenizers themselves. A space behind a character that is no white space always begins a token of
either, whatever is in front; so texts are cut there, and a worker tokenizes each different piece once while it remembers it. A
SentencePiece model with pieces that go on behind a space is given whole texts.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyscope.sources import materialise

from .words import text_slices

#: Tokens of A in a lane, about, and how many are tried for a cut there.
LANE, _TRIED = 256, 32
BLOCK_LINKS = 4_000_000
REMEMBERED = 250_000
#: An id pair in one number: ids of B have so many bits.
B_BITS = 15

#: Pieces of text given to a tokenizer as one.
_TOGETHER = 1000
#: White space before a space, or at either end: where a part of a text split at spaces ends in white space, or is empty.
_OPEN = re.compile(r"\s(?: |\Z)|\A(?: |\Z)")

_known: dict[tuple[str, str], Tokenizers] = {}


class _Numbers(dict):
    """Numbers keys in the order in which they are first asked for, and lists the new ones."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        self.new.append(key)
        return n


class _Side:
    """One tokenizer's ids of the pieces met so far, end to end."""

    def __init__(self):
        self.flat, self.start = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def extend(self, found: list[np.ndarray], sizes: list[np.ndarray]) -> None:
        self.flat = np.concatenate([self.flat, *found])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(np.concatenate(sizes))])

    def gather(self, number: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of numbered pieces, and the bounds of texts of ``count`` pieces each."""
        sizes = self.start[number + 1] - self.start[number]
        bound = np.concatenate(([0], np.cumsum(sizes)))
        at = np.repeat(self.start[number] - bound[:-1], sizes) + np.arange(bound[-1])
        return self.flat[at], bound[np.concatenate(([0], np.cumsum(count)))]


class Tokenizers:
    """Both tokenizers, the bytes of their tokens, and the ids of pieces of text met before.

    A piece is a space and what follows; its key is what follows.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task on each core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = {c: b for b, c in _byte_letters().items()}
        names = self.a.get_vocab()
        self.bytes_a = [b""] * (max(names.values()) + 1)
        for name, k in names.items():
            self.bytes_a[k] = bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
        self.bytes_b = [self._piece_bytes(k) for k in range(self.b.get_piece_size())]
        if len(self.bytes_b) > 1 << B_BITS or len(self.bytes_a) > 1 << (31 - B_BITS):
            raise ValueError("too many ids for a pair in 31 bits")
        self.size_a, self.size_b = (np.array([len(x) for x in known], np.int64) for known in (self.bytes_a, self.bytes_b))
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.separable = not any("▁" in p.lstrip("▁") for p in pieces)
        self.forget()

    def forget(self) -> None:
        self.numbers, self.sides, self.faithful = _Numbers(), (_Side(), _Side()), np.zeros(0, bool)

    def _piece_bytes(self, k: int) -> bytes:
        if self.b.is_byte(k):
            return bytes([int(self.b.id_to_piece(k)[3:5], 16)])
        return self.b.id_to_piece(k).replace("▁", " ").encode()

    def encode(self, keys: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both tokenizers of a space and each key."""
        a = [np.array(e.ids, np.int64) for e in self.a.encode_batch_fast([" " + x for x in keys], add_special_tokens=False)]
        space = [self.b.piece_to_id("▁")]
        # B adds its space to all but the empty text.
        b = [np.array(e if x else space, np.int64) for x, e in zip(keys, self.b.encode(keys, num_threads=1), strict=True)]
        return a, b

    def is_faithful(self, key: str, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether the bytes of both tokenizers' tokens are those of a space and the key."""
        whole = b" " + key.encode()
        return all(b"".join(map(known.__getitem__, ids.tolist())) == whole for known, ids in ((self.bytes_a, a), (self.bytes_b, b)))

    def _learn(self, keys: list[str]) -> None:
        found, sizes, good = ([], []), ([], []), [self.faithful]
        for k in range(0, len(keys), _TOGETHER):
            own = keys[k : k + _TOGETHER]
            together = self._together(own)
            if together is None:
                sides = self.encode(own)
                good.append(np.array([self.is_faithful(x, a, b) for x, a, b in zip(own, *sides, strict=True)]))
                together = [(np.concatenate(side), np.array([len(x) for x in side], np.int64)) for side in sides]
            else:
                good.append(np.ones(len(own), bool))
            for n, (ids, size) in enumerate(together):
                found[n].append(ids)
                sizes[n].append(size)
        for n, side in enumerate(self.sides):
            side.extend(found[n], sizes[n])
        self.faithful = np.concatenate(good)

    def _together(self, keys: list[str]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Ids of pieces that were tokenized as one text, and how many each has; None if they cannot be told apart."""
        if not self.separable or any(not x or x[-1].isspace() for x in keys):
            return None
        text = " ".join(keys)
        sides = self.encode([text])
        if not self.is_faithful(text, sides[0][0], sides[1][0]):
            return None
        ends = np.cumsum(np.fromiter((len(x.encode()) for x in keys), np.int64, len(keys)) + 1)
        out = []
        for (ids,), size in zip(sides, (self.size_a, self.size_b), strict=True):
            at = np.cumsum(size[ids])
            last = np.searchsorted(at, ends)
            if (at[last] != ends).any():
                return None
            out.append((ids, np.diff(last + 1, prepend=0)))
        return out

    def ids(self, texts: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Ids of A and of B of a space and each text, all end to end, and each text's bounds. Empty texts, and those whose
        tokens have other bytes, have none."""
        if len(self.numbers) > REMEMBERED:
            self.forget()
        parts = [_pieces(x) if self.separable else [x] * bool(x) for x in texts]
        count = np.fromiter(map(len, parts), np.int64, len(parts))
        number = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(parts)), np.int64, int(count.sum()))
        if self.numbers.new:
            self._learn(self.numbers.new)
            self.numbers.new = []
        good = np.ones(len(number), bool)
        good[:] = self.faithful[number]
        if not good.all():
            owner = np.repeat(np.arange(len(parts)), count)
            for k in np.unique(owner[~good]):
                mine = owner == k
                a, b = (side.gather(number[mine], count[k : k + 1])[0] for side in self.sides)
                good[mine] = self.is_faithful(texts[k], a, b)
            count = np.bincount(owner[good], minlength=len(parts))
            number = number[good]
        return tuple(side.gather(number, count) for side in self.sides)


def _pieces(text: str) -> list[str]:
    """Keys of the pieces of a space and a text: it is cut before each space that follows a character that is no white
    space."""
    if not text:
        return []
    parts = text.split(" ")
    if not _OPEN.search(text):
        return parts
    units, begun = [], 0
    for k, p in enumerate(parts):
        if p and not p[-1].isspace():
            units.append(" ".join(parts[begun : k + 1]))
            begun = k + 1
    return units + [" ".join(parts[begun:])] * (begun < len(parts))


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable ones as themselves, the others from U+0100 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(other)}


def _tokenizers(paths: tuple[str, str]) -> Tokenizers:
    if paths not in _known:
        _known[paths] = Tokenizers(*paths)
    return _known[paths]


def _lanes(end_a, end_b, first_a, last_a, first_b) -> tuple[np.ndarray, np.ndarray]:
    """Where lanes begin, as places in A and B, and where they stop in A."""
    begin, stop = np.stack([first_a, first_b]), last_a
    long = np.flatnonzero(last_a - first_a > 2 * LANE)
    if len(long):
        tries = np.concatenate([np.arange(first_a[k] + LANE, last_a[k] - LANE, LANE) for k in long])
        window = tries[:, None] + np.arange(_TRIED)
        place = np.searchsorted(end_b, end_a[window])
        same = end_b[np.minimum(place, len(end_b) - 1)] == end_a[window]
        row, column = np.flatnonzero(same.any(1)), same.argmax(1)
        cut = np.stack([window[row, column[row]], place[row, column[row]]]) + 1
        begin = np.concatenate([begin, cut], axis=1)
        order = np.argsort(begin[0])
        begin = begin[:, order]
        stop = np.sort(np.concatenate([last_a, cut[0]]))
    return begin, stop


def merged(end_a, end_b, first_a, last_a, first_b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The links of all documents of a batch, as places in A and B in the order of steps, and for every token of A and of B
    whether a group ends with it.

    ``end_a`` and ``end_b`` are the end bytes of all tokens, documents lying end to end; document k has the tokens of A
    from ``first_a[k]`` to before ``last_a[k]`` and those of B from ``first_b[k]`` on; none is empty.
    """
    state, stop = _lanes(end_a, end_b, first_a, last_a, first_b)
    links, cut_a, cut_b = [np.zeros((2, 0), np.int64)], np.zeros(len(end_a), bool), np.zeros(len(end_b), bool)
    while len(stop):
        links.append(state)
        a, b = end_a[state[0]], end_b[state[1]]
        cut = a == b
        cut_a[state[0][cut]] = True
        cut_b[state[1][cut]] = True
        state = state + np.stack([a <= b, b <= a])
        going = state[0] < stop
        if not going.all():
            state, stop = state[:, going], stop[going]
    return np.concatenate(links, axis=1), cut_a, cut_b


@dataclass
class Batch:
    """Aligned texts: tokens of all, bounds of each text's tokens, links and group ends."""

    a: np.ndarray
    b: np.ndarray
    bound_a: np.ndarray
    bound_b: np.ndarray
    end_a: np.ndarray
    end_b: np.ndarray
    links: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray


def align(tok: Tokenizers, texts: list[str | None]) -> Batch:
    """Texts that are null or empty, or whose tokens' bytes are not those of a space and the text, have no tokens."""
    (a, bound_a), (b, bound_b) = tok.ids([x or "" for x in texts])
    bounds = (bound_a, bound_b)
    end_a, end_b = np.cumsum(tok.size_a[a]), np.cumsum(tok.size_b[b])
    full = np.flatnonzero(np.diff(bounds[0]))
    links, cut_a, cut_b = merged(end_a, end_b, bounds[0][full], bounds[0][full + 1], bounds[1][full])
    return Batch(a, b, *bounds, end_a, end_b, links, cut_a, cut_b)


def _cells(n: int, last: str) -> np.ndarray:
    """Decimal numbers and what comes behind them, a row of 6 bytes for each, padded with zeros."""
    return np.array([f"{k}{last}".encode() for k in range(n)], "S6").view(np.uint8).reshape(n, 6)


_CELL = 1 << 16
_INSIDE, _A_END, _B_END = (_cells(_CELL, x) for x in ",|;")


def group_digests(x: Batch) -> list[str]:
    """SHA-256 of each text's groups as ``a1,a2|b1;a3|b2,b3`` in ids; empty without tokens."""
    begins = [np.concatenate(([0], np.flatnonzero(cut) + 1)) for cut in (x.cut_a, x.cut_b)]
    group_a, group_b = (np.cumsum(cut) - cut for cut in (x.cut_a, x.cut_b))
    place_a = np.arange(len(x.a)) + begins[1][group_a]
    place_b = np.arange(len(x.b)) + begins[0][group_b + 1]
    cells = np.empty((len(x.a) + len(x.b), 6), np.uint8)
    cells[place_a] = np.where(x.cut_a[:, None], _A_END[x.a], _INSIDE[x.a])
    cells[place_b] = np.where(x.cut_b[:, None], _B_END[x.b], _INSIDE[x.b])
    used = cells != 0
    sizes = np.concatenate(([0], np.cumsum(used.sum(1))))[x.bound_a + x.bound_b]
    data = cells[used]
    return [hashlib.sha256(data[i : j - 1]).hexdigest() if j > i else "" for i, j in zip(sizes[:-1], sizes[1:], strict=True)]


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _aligned(paths: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizers(paths)
        for batch in batches:
            for i, j, _, _ in text_slices(batch.column("text")):
                x = align(tok, batch.column("text")[i:j].to_pylist())
                order = np.argsort(x.links.sum(0))
                link_a, link_b = x.links[0][order], x.links[1][order]
                bound = np.searchsorted(link_a, x.bound_a)
                columns = {"doc_id": batch.column("doc_id")[i:j]}
                lists = {"a": (x.a, x.bound_a), "b": (x.b, x.bound_b)}
                lists["link_a"] = (link_a - np.repeat(x.bound_a[:-1], np.diff(bound)), bound)
                lists["link_b"] = (link_b - np.repeat(x.bound_b[:-1], np.diff(bound)), bound)
                before = np.concatenate(([0], x.end_a))[x.bound_a]
                cuts = np.flatnonzero(x.cut_a)
                bound = np.searchsorted(cuts, x.bound_a)
                lists["cuts"] = (x.end_a[cuts] - np.repeat(before[:-1], np.diff(bound)), bound)
                columns |= {n: pa.ListArray.from_arrays(pa.array(o.astype(np.int32)), pa.array(v.astype(np.int32))) for n, (v, o) in lists.items()}
                yield pa.RecordBatch.from_pydict(columns)

    return run


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``doc_id``, ids ``a`` and ``b`` of both tokenizers, links as places ``link_a`` and ``link_b`` in them, in text order, and
    ``cuts``, the byte offsets in a space and the text where tokens of both end. One row for each row of ``docs``."""
    kind = "array<int>"
    return _rows(docs).mapInArrow(_aligned((path_a, path_b)), f"doc_id long, a {kind}, b {kind}, link_a {kind}, link_b {kind}, cuts {kind}")


_BLOCK = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, pairs array<int>, seen array<int>, links binary"
)


def _pack(places: np.ndarray) -> bytes:
    """Small numbers as compressed planes of their bytes."""
    planes = np.ascontiguousarray(places.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(pa.decompress(data, 4 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


class _Block:
    """Documents gathered so far: a list of columns for each batch, and their links as document and pair in one number."""

    def __init__(self):
        self.docs: list[dict] = []
        self.links: list[np.ndarray] = []
        self.n_docs = self.n_links = 0

    def add(self, ids: list, x: Batch) -> None:
        n = len(ids)
        doc = np.repeat(np.arange(n), np.diff(x.bound_a))[x.links[0]]
        pair = (x.a[x.links[0]] << B_BITS) | x.b[x.links[1]]
        keys = ((self.n_docs + doc) << 31) | pair
        keys.sort()
        groups = np.concatenate(([0], np.cumsum(x.cut_a)))
        self.docs.append({"doc_id": ids, "n_a": np.diff(x.bound_a), "n_b": np.diff(x.bound_b), "n_groups": np.diff(groups[x.bound_a]), "n_links": np.bincount(doc, minlength=n), "groups_sha256": group_digests(x)})
        self.links.append(keys)
        self.n_docs += n
        self.n_links += len(keys)

    def row(self, block: int) -> pa.RecordBatch:
        keys = np.concatenate(self.links)
        pair, doc = keys & ((1 << 31) - 1), keys >> 31
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        pairs, seen = np.unique(pair[new], return_counts=True)
        # A document's places ascend; the first counts from 0, the others from the one before, a repeated link as 0.
        place = np.searchsorted(pairs, pair)
        step = np.diff(place, prepend=0)
        head = np.ones(len(keys), bool)
        head[1:] = doc[1:] != doc[:-1]
        step[head] = place[head]
        columns = {"block": pa.array([block], pa.int64())}
        for name, kind in (("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())):
            columns[name] = pa.array([[v for part in self.docs for v in part[name]]], pa.list_(kind))
        columns |= {"pairs": pa.array([pairs.astype(np.int32)], pa.list_(pa.int32())), "seen": pa.array([seen.astype(np.int32)], pa.list_(pa.int32()))}
        return pa.RecordBatch.from_pydict(columns | {"links": pa.array([_pack(step)], pa.binary())})


def _blocks(paths: tuple[str, str], most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, part, number, block = _tokenizers(paths), TaskContext.get().partitionId(), 0, _Block()
        for batch in batches:
            for i, j, _, _ in text_slices(batch.column("text")):
                block.add(batch.column("doc_id")[i:j].to_pylist(), align(tok, batch.column("text")[i:j].to_pylist()))
                if block.n_links >= most:
                    yield block.row((part << 32) | number)
                    number, block = number + 1, _Block()
        if block.n_docs:
            yield block.row((part << 32) | number)

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up what the answers say of each document's links."""
    for batch in batches:
        for row in range(batch.num_rows):
            own = {name: batch.column(name)[row] for name in batch.schema.names}
            sizes = own["n_links"].values.to_numpy()
            step = _unpack(own["links"].as_py(), int(sizes.sum()))
            answers = own["answers"].values
            value = np.zeros(len(answers) if answers is not None else 0, np.int64)
            if len(value):
                value[answers.field("place").to_numpy()] = answers.field("value").to_numpy()
            bound = np.concatenate(([0], np.cumsum(sizes)))
            total = np.cumsum(step)
            before = np.concatenate(([0], total))[bound[:-1]]
            place = total - np.repeat(before, sizes)
            counts, best = (np.concatenate(([0], np.cumsum(v))) for v in (value[place] >> 1, value[place] & 1))
            names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
            columns = {n: own[n].values for n in names}
            columns |= {"n_best": pa.array(np.diff(best[bound])), "count_sum": pa.array(np.diff(counts[bound]))}
            yield pa.RecordBatch.from_pydict(columns | {"groups_sha256": own["groups_sha256"].values})


def _gathered(docs: DataFrame, path_a: str, path_b: str, block_links: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    blocks = materialise(_rows(docs).mapInArrow(_blocks((path_a, path_b), block_links), _BLOCK), "blocks")
    asked = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "seen")).alias("place", "x"))
    asked = asked.select("block", "place", F.col("x.pairs").alias("pair"), F.col("x.seen").alias("seen"))
    counts = asked.groupBy("pair").agg(F.sum("seen").alias("n")).withColumn("a", F.shiftright("pair", B_BITS))
    return blocks, asked, materialise(counts, "pair-counts")


def pair_counts(docs: DataFrame, path_a: str, path_b: str, block_links: int = BLOCK_LINKS) -> DataFrame:
    """``a, b, n``: in how many rows of ``docs`` a token with id ``a`` is linked to one with id ``b``."""
    _, _, counts = _gathered(docs, path_a, path_b, block_links)
    return counts.select("a", F.col("pair").bitwiseAND((1 << B_BITS) - 1).alias("b"), "n")


def alignment_digests(docs: DataFrame, path_a: str, path_b: str, block_links: int = BLOCK_LINKS) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    An id pair's count is the number of rows that have it linked. ``n_best`` counts a row's links whose pair's count is the
    highest of its id of A (ties included), ``count_sum`` adds up the counts of all its links.

    - Null or empty text, or text whose tokens' bytes differ from a space and the text (as U+2581, which B writes for
      a space): zeros and an empty digest.
    - Null, repeated or reused ``doc_id``: every row has its row and counts.
    - Very long text: processed whole, within one task, in lanes that walk side by side.
    - Other columns, of whatever name, are ignored. An empty table gives no rows.

    Runs jobs and writes intermediate tables.
    """
    blocks, asked, counts = _gathered(docs, path_a, path_b, block_links)
    top = counts.groupBy("a").agg(F.max("n").alias("most"))
    value = F.shiftleft("n", 1) + (F.col("n") == F.col("most")).cast("long")
    counts = materialise(counts.join(top, "a").select("pair", value.alias("value")), "pair-values")
    answers = asked.select("block", "place", "pair").join(counts, "pair")
    answers = answers.groupBy("block").agg(F.collect_list(F.struct("place", "value")).alias("answers"))
    rows = blocks.drop("pairs", "seen").join(answers, "block", "left")
    rows = rows.withColumn("answers", F.coalesce("answers", F.array().cast("array<struct<place:int,value:bigint>>"))).drop("block")
    fields = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return rows.mapInArrow(_summed, fields)
