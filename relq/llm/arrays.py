"""Arrow text columns as byte arrays, and word hashes over them.

Tasks receive Arrow batches of whole texts.  ``slices`` cuts a batch into
runs of rows of a few megabytes so that working arrays stay small however
long the texts are in sum (a single text is never cut); ``Words`` finds the
words of such a run and gives every word a hash of its bytes, with array
operations only.

The hash is a polynomial over a prime field.  (One modulo 2^64 would be
cheaper, but texts with equal values are easy to come by there.)
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_P = np.uint64((1 << 61) - 1)  # a prime
_BASE = 0x0F3D5A79B46C18E7 % int(_P)
_BLOCK = 1 << 19  # bytes whose powers are kept
_STEP = 1 << 13  # spans at a time: the working arrays stay in a core's cache
_LOW, _29 = np.uint64((1 << 32) - 1), np.uint64((1 << 29) - 1)
_S3, _S29, _S32, _S61 = (np.uint64(n) for n in (3, 29, 32, 61))


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _reduced(x: np.ndarray) -> np.ndarray:
    """x mod 2^61 - 1, for x below 2^63."""
    x = (x & _P) + (x >> _S61)
    x -= _P * (x >= _P)
    return x


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b mod 2^61 - 1, for a and b below 2^61."""
    a1, a0, b1, b0 = a >> _S32, a & _LOW, b >> _S32, b & _LOW
    middle, low = a1 * b0 + a0 * b1, a0 * b0
    return _reduced((low & _P) + (low >> _S61) + (a1 * b1 << _S3) + (middle >> _S29) + ((middle & _29) << _S32))


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base``."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, _times(out, np.uint64(pow(base, len(out), int(_P))))])
    return out[:n]


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    up = _powers(_BASE, _BLOCK)
    return (up & _LOW).astype(np.uint32), (up >> _S32).astype(np.uint32), _powers(pow(_BASE, -1, int(_P)), _BLOCK)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums S of data[i] * base^i mod 2^61 - 1, so that S[e] - S[s] tells
    the bytes s to e up to a power of the base.  The working arrays besides the
    result are as large as a block."""
    low, high, _ = _tables()
    out = np.zeros(len(data) + 1, np.uint64)
    for at in range(0, len(data), _STEP):
        own, within = data[at:at + _STEP].astype(np.uint64) + np.uint64(1), at % _BLOCK
        a, b = np.cumsum(own * low[within:within + len(own)]), np.cumsum(own * high[within:within + len(own)])  # below 2^54 and 2^51
        sums = _reduced(a + (b >> _S29) + ((b & _29) << _S32))
        if at >= _BLOCK:
            sums = _times(sums, np.uint64(pow(_BASE, at - within, int(_P))))
        out[at + 1:at + 1 + len(own)] = _reduced(sums + out[at])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end); equal spans hash alike."""
    *_, down = _tables()
    blocks = _powers(pow(_BASE, -_BLOCK, int(_P)), len(prefix) // _BLOCK + 1)
    out = np.empty(len(start), np.uint64)
    for at in range(0, len(start), _STEP):
        s, e = start[at:at + _STEP], end[at:at + _STEP]
        back = down[s & (_BLOCK - 1)]
        if len(blocks) > 1:
            back = _times(back, blocks[s // _BLOCK])
        difference = _reduced(prefix[e] + (_P - prefix[s]))
        length = (e - s).astype(np.uint64)
        length = length[:1] if (length == length[0]).all() else length
        out[at:at + _STEP] = mix(_times(difference, back) ^ mix(length))
    return out


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets (nulls are empty)."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    if raw is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most ``limit`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total, start = np.concatenate([[0], np.cumsum(size.astype(np.int64))]), 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(total, total[start] + limit, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end


class Words:
    """Words (runs of bytes for which ``is_word`` holds) of a run of texts.

    ``hash``: one per word; ``doc``: its row; ``first``: index of each row's
    first word (with one entry more at the end); ``length``: bytes.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
        inside = np.zeros(len(data) + 1, bool)
        inside[:-1] = is_word[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        before = np.concatenate([[False], inside[:-1]])
        start = np.flatnonzero(inside & (~before | cut))
        end = np.flatnonzero(before & (~inside | cut))
        self.start, self.length = start, end - start
        self.first = np.searchsorted(start, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.hash = span_hash(prefix_hash(data), start, end)


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable
    Latin-1 characters stand for themselves, the others follow from U+0100."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}
