"""Word hashes of Arrow text columns, computed with numpy inside Spark's tasks.

A word is a run of bytes other than space and 0x09 to 0x0D; UTF-8 continuation bytes never fall in that
range, so this is the same as ``[^\\x20\\x09-\\x0D]+`` over characters. A word's hash is a polynomial over
its bytes, modulo 2**64, passed through a bit mixer. Null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_STEPS = [_U(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[list(b".,;:!?\"'`()[]{}<>*_~")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes of text handled at a time; a longer single text is handled alone.
SLICE_BYTES = 2 << 20

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE_BYTES + 1), base, _U)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if len(have) <= 4 * SLICE_BYTES:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on all input bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def text_slices(text: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``i`` to ``j`` of a text column with their bytes and byte offsets, about ``limit`` bytes at a time."""
    text = pc.fill_null(text.cast(pa.large_string()), "")
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = text.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(text):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True, breaks: np.ndarray | None = None, edges: np.ndarray | None = None):
    """Hash, first byte and end byte of every word, and the index of each text's first word (one more at the end).

    ``breaks`` may name further bytes at which a word cannot be continued. Words lose the bytes of ``edges``
    (a mask, as ``PUNCTUATION``) at their edges, unless they are nothing else.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none.astype(_U), none, none, np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    first[begins] = inside[begins]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    last[ends] = inside[ends]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    if edges is not None and len(start):
        at = np.flatnonzero(edges[data[start]] | edges[data[end - 1]])
        solid = np.append(np.flatnonzero(~edges[data]), len(data))
        lo = solid[np.searchsorted(solid, start[at])]
        at, lo = at[lo < end[at]], lo[lo < end[at]]
        start[at], end[at] = lo, solid[np.searchsorted(solid, end[at]) - 1] + 1
    total = np.zeros(len(data) + 1, _U)
    values = (_LOWER[data] if lower else data).astype(_U)
    values += _U(1)
    values *= _power(_BASE, len(data))
    np.cumsum(values, out=total[1:])
    hashes = (total[end] - total[start]) * _power(_BASE_INVERSE, len(data))[start]
    return mix(hashes), start, end, np.searchsorted(start, offsets)


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of all windows of five words, without regard to where texts begin."""
    if len(words) < 5:
        return np.zeros(0, _U)
    n, out = len(words) - 4, None
    for k, step in enumerate(_STEPS):
        part = words[k : k + n] * step
        out = part if out is None else out + part
    return mix(out)


def shingle_set(words: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Sorted distinct shingles of one text: its ``windows`` of five words, or its fewer words as one."""
    if len(words) >= 5:
        return np.unique(windows)
    if not len(words):
        return np.zeros(0, _U)
    with np.errstate(over="ignore"):
        return mix(np.array([(words * np.array(_STEPS[: len(words)])).sum() + _U(len(words))], _U))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans ``start`` to ``end``; equal bytes have equal hashes wherever they stand."""
    total = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * _power(_BASE, len(data)), out=total[1:])
    # A span that starts at the end of the data is empty; any power does for it.
    return mix((total[end] - total[start]) * _power(_BASE_INVERSE, len(data) + 1)[start])
