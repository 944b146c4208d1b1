"""Byte-level BPE encoding and decoding with two-tier lookup.

A text is cut into pre-tokens by the vocabulary's pattern.  Tier one: a
minimal perfect hash over the whole vocabulary resolves a pre-token that is an
entry itself (its complete bytes are compared).  Tier two: any other
pre-token starts as linked single bytes, and a heap of neighbour pairs by
rank merges the lowest rank, leftmost first, until none is left.

Texts are walked in chunks between spaces: the chunk with its leading space
fixes its pre-tokens as long as no white space touches other white space, and
a bounded memo keeps the ids of chunks already seen.  Texts where white space
runs meet are matched by the pattern as a whole.  The memo changes no result.

Defined results: a null or empty text has no ids and decodes to no bytes;
repeated rows are encoded each for itself; a byte outside the vocabulary
(none in a full byte-level one) raises KeyError; an empty table gives no rows;
columns other than id and text are ignored, whatever their names.  Texts of any
length are encoded as a whole.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .arrays import mix, prefix_hash, slices, span_hash
from .memory import only

MEMO_ENTRIES = 600_000
# The white space of Unicode; a class of its own since libraries differ in \\s.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


class PerfectHash:
    """Minimal perfect hash by levels of bit arrays: a key that is alone at
    its position of a level is placed there, the others go a level down; the
    number of placed bits before it is the key's index."""

    def __init__(self, hashes: np.ndarray):
        self.levels, placed, left = [], 0, np.arange(len(hashes))
        while len(left):
            size = max(2 * len(left), 8)
            at = self._at(hashes[left], len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            rank = np.cumsum(alone) - alone + placed
            self.levels.append((size, alone, rank))
            placed += int(alone.sum())
            left = left[~alone[at]]
            if len(self.levels) > 64:
                raise ValueError("two keys share a 64-bit hash")

    @staticmethod
    def _at(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(hashes + np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)

    def index(self, hashes: np.ndarray) -> np.ndarray:
        """Index of each key; -1 or any index for what is no key."""
        out = np.full(len(hashes), -1, np.int64)
        left = np.arange(len(hashes))
        for level, (size, alone, rank) in enumerate(self.levels):
            at = self._at(hashes[left], level, size)
            hit = alone[at]
            out[left[hit]] = rank[at[hit]]
            left = left[~hit]
        return out


def _hashes(keys: list[bytes]) -> np.ndarray:
    size = np.array([len(k) for k in keys], np.int64)
    end = np.cumsum(size)
    return span_hash(prefix_hash(np.frombuffer(b"".join(keys), np.uint8)), end - size, end)


class Bpe:
    """Encoder for ``ranks`` (token bytes to id) and ``pattern``."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        pattern = pattern.replace(r"[^\s", f"[^{_SPACE}").replace(r"\s", f"[{_SPACE}]").replace(r"\S", f"[^{_SPACE}]")
        self.pattern = regex.compile(pattern)
        self.runs = regex.compile(f"[{_SPACE}][{_SPACE}]|^[{_SPACE}]|[{_SPACE}]$")
        keys = list(ranks)
        self.hash = PerfectHash(h := _hashes(keys))
        self.keys, self.ids = [b""] * len(keys), [0] * len(keys)
        for key, i in zip(keys, self.hash.index(h).tolist()):
            self.keys[i], self.ids[i] = key, ranks[key]
        self.memo: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a pre-token that is no entry itself."""
        ranks, n = self.ranks, len(piece)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        end = list(range(1, n + 1))  # end of the part that starts here; 0 once merged away
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = nxt[i]
            if not end[i] or j >= n or end[j] != stop:
                continue  # one of the two has been merged since
            end[i], end[j] = stop, 0
            k = nxt[i] = nxt[j]
            if k < n:
                prv[k] = i
                if (r := ranks.get(piece[i:end[k]])) is not None:
                    heapq.heappush(heap, (r, i, end[k]))
            if (p := prv[i]) >= 0 and (r := ranks.get(piece[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        return [ranks[piece[i:e]] for i, e in enumerate(end) if e]

    def learn(self, chunks: list[str]) -> None:
        """Put the ids of ``chunks`` into the memo."""
        cut = {c: self.pattern.findall(c) for c in chunks}
        new = list({w for ws in cut.values() for w in ws if w not in self.words})
        raw = [w.encode() for w in new]
        at = self.hash.index(_hashes(raw)).tolist() if raw else []
        for word, piece, i in zip(new, raw, at):
            ids = [self.ids[i]] if i >= 0 and self.keys[i] == piece else self.merge(piece)
            self.words[word] = np.array(ids, "<u4").tobytes()
        for c, ws in cut.items():
            self.memo[c] = b"".join([self.words[w] for w in ws])

    def _chunks(self, text: str) -> list[str]:
        if self.runs.search(text):
            return self.pattern.findall(text)
        head, *rest = text.split(" ")
        return [head, *[" " + c for c in rest]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        cut = [self._chunks(t) if t else [] for t in texts]
        if len(self.memo) > MEMO_ENTRIES:
            self.memo.clear()
        if len(self.words) > MEMO_ENTRIES:
            self.words.clear()
        new = set().union(*cut).difference(self.memo)
        if new:
            self.learn(list(new))
        get = self.memo.__getitem__
        return [b"".join(map(get, c)) for c in cut]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def read_ranks(path: str) -> dict[bytes, int]:
    """A .tiktoken file: base64 token and rank in each line (a vocabulary:
    its size is fixed, it does not grow with any table)."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(i) for t, i in map(bytes.split, f) if t}


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256[, ids]): each whole text
    encoded, and the digest of what its ids decode to.  ``keep_ids`` adds the
    ids themselves as little-endian unsigned 32-bit integers (binary)."""
    shared = df.sparkSession.sparkContext.broadcast(ranks)  # fixed size: the vocabulary
    key = ("bytes", hash(frozenset(ranks.items())), pattern)
    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids

    def run(batches):
        bpe = only(key, lambda: Bpe(shared.value, pattern))
        for part in slices(batches, "text"):
            ids = bpe.encode([t or "" for t in part.column("text").to_pylist()])
            out = {
                "id": part.column("id"), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids], pa.string()),
            }
            yield pa.record_batch(out | ({"ids": pa.array(ids, pa.binary())} if keep_ids else {}))

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(df: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text): texts of binary ids as made by ``encode(keep_ids=True)``;
    null ids are the empty text, bytes that are no UTF-8 are replaced."""
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    key = ("bytes", hash(frozenset(ranks.items())), pattern)

    def run(batches):
        bpe = only(key, lambda: Bpe(shared.value, pattern))
        for part in batches:
            texts = [bpe.decode(x or b"").decode(errors="replace") for x in part.column("ids").to_pylist()]
            yield pa.record_batch({"id": part.column("id"), "text": pa.array(texts, pa.string())})

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("binary").alias("ids"))
    return rows.mapInArrow(run, "id long, text string").withColumnRenamed("id", id_col)
