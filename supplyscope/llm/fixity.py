"""Fixity audit of WARC replicas with Merkle trees.

A corpus of pages is kept as compressed WARC files, one per volume, in several places. Each record is hashed; the hashes of
a volume's records, in order of offset, are the leaves of a tree in which a node covers an ordered range of
``FANOUT`` nodes below it, and a last tree covers the volumes. Two replicas are compared from the root
down: nodes that agree are not opened, so that only the branches above damaged records are read.

Volumes are filled where the pages are read: a task packs its rows, in order, into volumes of about ``VOLUME_BYTES``, so pages are
neither grouped nor shuffled. All files of a replica lie in one folder. A file's first record is a ``warcinfo`` record
that names the volume, as the standard has it, so a copy is known whatever its file is called.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyscope.sources import materialise

from .order import numbered

FANOUT = 16
#: Bytes of a volume's records, about; a longer record is a volume of its own.
VOLUME_BYTES = 4 << 20
_END = b"\r\n\r\n"
_DATE = b"WARC-Date: 1970-01-01T00:00:00Z"
#: Volumes of one task at most.
_TASK_VOLUMES = 1 << 32


def _record(kind: bytes, name: bytes, more: list[bytes], media: bytes, block: bytes) -> bytes:
    head = [b"WARC/1.1", b"WARC-Type: " + kind, b"WARC-Record-ID: <" + name + b">", _DATE, *more, b"Content-Type: " + media]
    return b"\r\n".join([*head, b"Content-Length: %d" % len(block)]) + _END + block + _END


def _volume(number: int, records: list[bytes]) -> str:
    """A volume's text. The line break that ends the last record is written by the sink."""
    name = b"%d" % number
    info = _record(b"warcinfo", b"urn:volume:" + name, [b"WARC-Filename: " + name], b"application/warc-fields", b"format: WARC File Format 1.1\r\n")
    return (info + b"".join(records))[:-1].decode()


def _text(x: pa.Scalar) -> bytes:
    return b"" if x.as_py() is None else x.as_py().encode()


def _packed(volume_bytes: int) -> Callable:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, nth, place, held, size = TaskContext.get().partitionId() * _TASK_VOLUMES, 0, 0, [], 0
        for batch in batches:
            for page, url, html in zip(*(batch.column(k) for k in range(3)), strict=True):
                target = [] if url.as_py() is None else [b"WARC-Target-URI: " + b"".join(_text(url).splitlines())]
                name = b"urn:page:%s:%d" % (_text(page) or b"null", first + place)
                held.append(_record(b"resource", name, target, b"text/html", _text(html)))
                place += 1
                size += len(held[-1])
                if size >= volume_bytes:
                    yield pa.RecordBatch.from_pydict({"value": [_volume(first + nth, held)]})
                    nth, held, size = nth + 1, [], 0
        if held:
            yield pa.RecordBatch.from_pydict({"value": [_volume(first + nth, held)]})

    return pack


def _store(volumes: DataFrame, path: str) -> None:
    """Each row is a volume and a file. What is lost in deflating fast is made up for by what is not written twice."""
    files = volumes.write.option("maxRecordsPerFile", 1).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    files.option("lineSep", "\n").text(path)


def write_warc(pages: DataFrame, path: str, volume_bytes: int = VOLUME_BYTES) -> None:
    """Writes each row of ``pages`` (``page_id, url, html``) as a WARC/1.1 ``resource`` record with the HTML as its block.

    A record's id is made of the page id, and the numbers of the task and of the row within it.

    - Null ``url``: no target URI; line breaks in one are left out. Null or empty ``html``: a block of length 0. Null ``page_id``: ``null`` in the id.
    - Repeated rows, and reused page ids, are records of their own.
    - An empty table gives a folder without volumes. Other columns, of whatever name, are ignored.
    """
    rows = pages.select(*[F.col(c).cast("string").alias(c) for c in ("page_id", "url", "html")])
    _store(rows.mapInArrow(_packed(volume_bytes), "value string"), path)


def _inflated(content: bytes) -> bytes:
    """The bytes of a file; damaged compression ends it where it stands."""
    if not content.startswith(b"\x1f\x8b"):
        return content
    out = []
    while content:
        stream = zlib.decompressobj(31)
        try:
            out.append(stream.decompress(content))
        except zlib.error:
            break
        content = stream.unused_data
    return b"".join(out)


def _entries(data: bytes) -> Iterator[tuple[int, int, bytes | None, bytes]]:
    """Offset, end, id and type of the records of a file; what is no record is one without id."""
    at = 0
    while at < len(data):
        end, name, kind = 0, None, b""
        head = data.find(_END, at)
        if data.startswith(b"WARC/", at) and head >= 0:
            lines = (x.partition(b":") for x in data[at:head].split(b"\r\n")[1:])
            fields = {key.strip().lower(): value.strip() for key, _, value in lines}
            size = fields.get(b"content-length", b"")
            if size.isdigit() and data[head + 4 + int(size) : head + 8 + int(size)] == _END:
                end = head + 8 + int(size)
                name, kind = fields.get(b"warc-record-id", b"").strip(b"<>"), fields.get(b"warc-type", b"")
        if not end:  # damaged: go on at the next record
            more = data.find(_END + b"WARC/", at + 1)
            end = more + 4 if more >= 0 else len(data)
        yield at, end, name or None, kind
        at = end


def _number(data: bytes, name: bytes | None, kind: bytes) -> int | None:
    tail = (name or b"").rpartition(b":")[2]
    return int(tail) if kind == b"warcinfo" and tail.isdigit() else None


def _files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path)
    return files.select("content", "path")


def copy_warc(spark: SparkSession, source: str, target: str, change: Callable[[bytes, bytes], bytes | None] | None = None) -> None:
    """Writes a replica of all volumes under ``source``. ``change``, for drills, gets a record's id and bytes, and returns its bytes in the
    replica, in UTF-8, or None to leave it out."""

    def copied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                data = _inflated(content.as_py())
                parts = [(name, data[at:end]) for at, end, name, _ in _entries(data)]
                kept = [x if change is None else change(name or b"", x) for name, x in parts]
                whole = b"".join(x for x in kept if x is not None)
                if whole:  # a task without rows leaves an empty file
                    yield pa.RecordBatch.from_pydict({"value": [whole[:-1].decode()]})

    _store(_files(spark, source).mapInArrow(copied, "value string"), target)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    for batch in batches:
        for content, path in zip(batch.column("content"), batch.column("path"), strict=True):
            data, rows, volume, before = _inflated(content.as_py()), [], None, None
            # A file that has lost its first record is a volume that no other replica has.
            lost = -1 - (zlib.crc32(path.as_py().rpartition("/")[2].encode()) << 16)
            for at, end, name, kind in _entries(data):
                volume = _number(data, name, kind) if volume is None else volume
                text = None if name is None else name.decode("utf-8", "replace")
                rows.append((lost if volume is None else volume, len(rows), at, end - at, text, hashlib.sha256(data[at:end]).hexdigest(), before))
                before = text
            columns = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], _NAMES)


_NAMES = ["volume", "node", "offset", "length", "id", "digest", "before"]


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``volume, node, offset, length, id, digest, before``: the records of the files under ``path`` with their place in the volume, SHA-256
    and the id of the record before.

    Offsets are those in the inflated file. A stretch of bytes that is no well-formed record is one entry without id, up to where the
    next record starts.
    """
    types = "volume long, node long, offset long, length long, id string, digest string, before string"
    return _files(spark, path).mapInArrow(_parsed, types)


_UP = FANOUT.bit_length() - 1


def _levels(nodes: DataFrame, last: int, name: str) -> list[DataFrame]:
    """Written levels ``volume, node, digest`` above and with ``nodes``, up to node 0 for nodes numbered to ``last``.

    A node's digest is the hash of the numbers and digests of the up to ``FANOUT`` nodes below it, in order.
    """
    levels = [nodes]
    while last > 0:
        below = F.sort_array(F.collect_list(F.struct("node", "digest")))
        text = F.array_join(F.transform(below, lambda x: F.concat(x["node"].cast("string"), F.lit(":"), x["digest"])), ",")
        nodes = levels[-1].groupBy("volume", F.shiftright("node", _UP).alias("above")).agg(F.sha2(text, 256).alias("digest"))
        levels.append(materialise(nodes.select("volume", F.col("above").alias("node"), "digest"), name))
        last >>= _UP
    return levels


def audit(spark: SparkSession, first: str, second: str) -> DataFrame:
    """Where two replicas differ: ``volume, node, id, offset, length, other_id, other_offset, other_length, damage``.

    ``damage`` is ``changed``, ``missing`` (only in the first), or ``extra`` (only in the second). Nodes are ranges of
    places in a volume; under the ranges that differ, records are paired by id, and damaged ones
    without id with what followed the same record, so that one lost record is one finding, though it moves
    all behind it.

    - Equal replicas, also empty ones, give no rows. A volume that one replica lacks is missing record by record.
    """
    sides = [read_warc(spark, path) for path in (first, second)]
    sides = [materialise(s, "leaves") for s in sides]
    names = sides[0].select("volume").union(sides[1].select("volume")).distinct()
    places = materialise(numbered(names, [F.col("volume")], "place"), "volume-places")
    last = max(s.agg(F.max("node")).first()[0] or 0 for s in sides)
    inside = [_levels(s, last, "ranges") for s in sides]
    # The tree over the volumes numbers them from 0, as both replicas together have them.
    roots = [x[-1].join(places, "volume") for x in inside]
    tops = [x.select(F.lit(None).cast("long").alias("volume"), F.col("place").alias("node"), "digest") for x in roots]
    last = max(t.agg(F.max("node")).first()[0] or 0 for t in tops)
    over = [_levels(materialise(t, "volumes"), last, "volume-ranges") for t in tops]
    # From the root down to the volumes, then from their roots down to the records.
    found = None
    for pair in zip(*(reversed(x) for x in over), strict=True):
        found = _differing(pair, found)
        if not found.limit(1).count():
            return _findings(*(s.where("false") for s in sides))
    volumes = found.select(F.col("node").alias("place")).join(places, "place")
    found = volumes.select("volume", F.lit(0).cast("long").alias("node"))
    for pair in list(zip(*(reversed(x) for x in inside), strict=True))[1:]:
        found = _differing(pair, found)
    return _findings(*(s.join(found, ["volume", "node"], "left_semi") for s in sides))


def _differing(sides: tuple[DataFrame, DataFrame], above: DataFrame | None) -> DataFrame:
    """Nodes of a level, under the differing nodes of the level above, whose digests differ or that one side lacks."""
    if above is not None:
        opened = above.select(F.col("volume").alias("v"), F.col("node").alias("n"))
        sides = [s.join(opened, F.col("volume").eqNullSafe(F.col("v")) & (F.shiftright("node", _UP) == F.col("n")), "left_semi") for s in sides]
    a, b = sides[0].select("volume", "node", "digest"), sides[1].select(F.col("volume").alias("v2"), F.col("node").alias("n2"), F.col("digest").alias("d2"))
    both = a.join(b, F.col("volume").eqNullSafe(F.col("v2")) & (F.col("node") == F.col("n2")), "full")
    both = both.where("NOT digest <=> d2")
    return materialise(both.select(F.coalesce("volume", "v2").alias("volume"), F.coalesce("node", "n2").alias("node")), "differing")


def _findings(a: DataFrame, b: DataFrame) -> DataFrame:
    """Differing records of both sides, paired by id, else by the id of the record before them."""
    left = a.select("volume", F.col("node").alias("place"), "id", "before", "offset", "length", "digest")
    right = b.select("volume", F.col("node").alias("place"), "id", "before", "offset", "length", "digest")
    right = right.select(*[F.col(c).alias(f"{c}2") for c in right.columns])
    volume = F.col("volume") == F.col("volume2")
    same = materialise(left.join(right, volume & (F.col("id") == F.col("id2")), "full"), "paired")
    matched = same.where("volume IS NOT NULL AND volume2 IS NOT NULL AND digest != digest2")
    alone = same.where("volume2 IS NULL").select(*left.columns)
    others = same.where("volume IS NULL").select(*right.columns)
    # A record without id stands for the lost one that followed the same record.
    rest = alone.join(others, volume & F.col("id2").isNull() & F.col("before").eqNullSafe(F.col("before2")), "full")
    out = matched.unionByName(rest)
    damage = F.when(F.col("volume2").isNull(), "missing").when(F.col("volume").isNull(), "extra").otherwise("changed")
    return out.select(
        F.coalesce("volume", "volume2").alias("volume"), F.coalesce("place", "place2").alias("node"), "id", "offset", "length",
        F.col("id2").alias("other_id"), F.col("offset2").alias("other_offset"), F.col("length2").alias("other_length"), damage.alias("damage"),
    )
