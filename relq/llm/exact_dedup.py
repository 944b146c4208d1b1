"""Exact dedup: Grace hash deduplication over complete texts.

Texts are equal when identical after replacing each run of ASCII white space
by one space.  First every input task groups its own rows, so a text with any
number of copies leaves a task once; then the groups' texts meet by content
hash and are grouped again.  Both steps are the same Grace hash: records over
the memory bound go to spill files by some bits of their hash, each file is
partitioned again by the next bits until it fits, and a bucket is resolved in
an open-addressing table that compares complete contents.

Rows are linked by a row number written with the first step (``staged``), so
a hot text costs one row for each input task, never one for each copy.

Defined results: a null text is the empty text; of equal texts the row with
the smallest id stays (a null id comes last; rows that share id and text: the
first in the staged order), so exactly one row of a group is kept; an empty
table gives no rows; other columns are ignored by ``dedup`` and kept by
``deduplicated``, whatever their names.  A text of any length is one record; one
beyond the memory bound is compared alone.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import slices
from .memory import drop, tidy
from .staging import staged

MEMORY_BYTES = 64 << 20
FANOUT_BITS = 4
MAX_DEPTH = 14  # 56 of the 64 hash bits; beyond, equal hashes stay in one table
_SPACES = bytes.maketrans(b"\t\n\v\f\r", b"     ")

Record = tuple[int, bytes, tuple]  # hash, content, values


def normalised(raw: bytes) -> bytes:
    """Runs of ASCII white space as one space each."""
    raw = raw.translate(_SPACES)
    while b"  " in raw:
        raw = raw.replace(b"  ", b" ")
    return raw


class OpenTable:
    """Linear probing over slots of group numbers; equality is by content."""

    def __init__(self):
        self.slots, self.groups = [-1] * 64, []  # groups: [hash, content, rows]

    def add(self, h: int, content: bytes, values: tuple) -> None:
        mask = len(self.slots) - 1
        i = h & mask
        while (g := self.slots[i]) >= 0:
            group = self.groups[g]
            if group[0] == h and group[1] == content:
                group[2].append(values)
                return
            i = (i + 1) & mask
        self.slots[i] = len(self.groups)
        self.groups.append([h, content, [values]])
        if 2 * len(self.groups) > len(self.slots):
            self._grow()

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for g, (h, _, _) in enumerate(self.groups):
            i = h & mask
            while self.slots[i] >= 0:
                i = (i + 1) & mask
            self.slots[i] = g


def grace_groups(records: Iterable[Record], memory: int = MEMORY_BYTES, depth: int = 0) -> Iterator[tuple[int, bytes, list[tuple]]]:
    """(hash, content, rows) of each distinct content.

    A table grows until its contents and rows exceed ``memory``; then what it
    holds and all that follows is dealt to spill files, each of which is
    handled alike.  Copies cost only their values, so a bucket that is one
    content with many copies still fits.
    """
    table, held, files = OpenTable(), 0, None
    shift = 64 - FANOUT_BITS * (depth + 1)
    with tempfile.TemporaryDirectory(prefix="relq-grace-") if depth < MAX_DEPTH else _nowhere() as folder:
        for h, content, values in records:
            if files is None:
                before = len(table.groups)
                table.add(h, content, values)
                held += 96 + (len(content) + 200 if len(table.groups) > before else 0)
                if held > memory and before and depth < MAX_DEPTH:
                    files = [open(Path(folder) / str(i), "wb") for i in range(1 << FANOUT_BITS)]
                    for group in table.groups:
                        for row in group[2]:
                            _spill(files, shift, group[0], group[1], row)
                    table = OpenTable()
            else:
                _spill(files, shift, h, content, values)
        if files is None:
            yield from ((h, content, rows) for h, content, rows in table.groups)
            return
        for f in files:
            f.close()
        for f in files:
            yield from grace_groups(_read(f.name), memory, depth + 1)
            Path(f.name).unlink()


class _nowhere:
    def __enter__(self):
        return None

    def __exit__(self, *_):
        return None


def _spill(files: list, shift: int, h: int, content: bytes, values: tuple) -> None:
    pickle.dump((h, content, values), files[(h >> shift) & ((1 << FANOUT_BITS) - 1)], pickle.HIGHEST_PROTOCOL)


def _read(path: str) -> Iterator[Record]:
    with open(path, "rb") as f:
        while True:
            try:
                yield pickle.load(f)
            except EOFError:
                return


def _batches(rows: Iterable[tuple], schema: pa.Schema, text_at: int | None = None, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + (len(row[text_at] or b"") if text_at is not None else 0)
        if size > limit:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema)
            held, size = [], 0
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema)


_LOCAL = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("sha", pa.string()), ("leader", pa.int64()), ("copies", pa.int64()), ("least", pa.int64()), ("least_rid", pa.int64()), ("content", pa.binary())])
_FINAL = pa.schema([("leader", pa.int64()), ("keep_rid", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64())])


def _first(rows: list[tuple]) -> tuple:
    """The (id, row number) that stays: smallest id, nulls last."""
    return min(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


@tidy
def _within_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    drop()

    def records():
        for part in slices(batches, "text"):
            for rid, doc_id, text in zip(part.column("rid").to_pylist(), part.column("doc_id").to_pylist(), part.column("text").cast(pa.binary()).to_pylist()):
                content = normalised(text or b"")
                sha = hashlib.sha256(content)
                yield int.from_bytes(sha.digest()[:8], "big"), content, (doc_id, rid)

    def rows():
        for _, content, members in grace_groups(records()):
            sha, (least, least_rid), leader = hashlib.sha256(content).hexdigest(), _first(members), members[0][1]
            yield leader, members[0][0], sha, leader, len(members), least, least_rid, content
            for doc_id, rid in members[1:]:
                yield rid, doc_id, sha, leader, None, None, None, None

    yield from _batches(rows(), _LOCAL, 7)


@tidy
def _across_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def records():
        for part in slices(batches, "content"):
            for sha, content, *values in zip(*(part.column(c).to_pylist() for c in ("sha", "content", "least", "least_rid", "leader", "copies"))):
                yield int(sha[:16], 16), content, tuple(values)

    def rows():
        for _, _, groups in grace_groups(records()):
            (keep_id, keep_rid, *_), size = _first(groups), sum(g[3] for g in groups)
            for g in groups:
                yield g[2], keep_rid, keep_id, size

    yield from _batches(rows(), _FINAL)


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for each row."""
    rows = df.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    local = staged(rows.mapInArrow(_within_task, "rid long, doc_id long, sha string, leader long, copies long, least long, least_rid long, content binary"), "exact")
    groups = local.where(F.col("copies").isNotNull()).select("sha", "content", "least", "least_rid", "leader", "copies")
    keep = groups.repartition("sha").mapInArrow(_across_tasks, "leader long, keep_rid long, keep_id long, group_size long")
    out = local.select("rid", "doc_id", "sha", "leader").join(keep, "leader")
    return out.select(F.col("doc_id").alias(id_col), "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), F.col("sha").alias("text_sha256"))


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all of their columns.

    A task's distinct texts are sent once, by content hash; the task that gets
    all rows of a content returns the one that stays.
    """
    names = df.columns
    id_at, text_at = names.index(id_col), names.index(text_col)

    def staying(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop()
        first = next(batches, None)
        if first is None:
            return
        own = list(first.schema)[:len(names) + 1]  # the table's columns and the row number

        def records() -> Iterator[Record]:
            for part in slices(_chain(first, batches), f"c{text_at}"):
                for row in zip(*(part.column(f.name).to_pylist() for f in own)):
                    content = normalised((row[text_at] or "").encode())
                    yield int.from_bytes(hashlib.sha256(content).digest()[:8], "big"), content, (row[id_at], row[-1], row)

        rows = ((*_first(members)[2], h - (1 << 63)) for h, _, members in grace_groups(records()))
        yield from _batches(rows, pa.schema([*own, pa.field("h", pa.int64())]), text_at)

    numbered = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.monotonically_increasing_id().alias("rid"))
    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(df.schema)) + ", rid long, h long"
    leaders = numbered.mapInArrow(tidy(staying), schema)
    kept = leaders.repartition("h").mapInArrow(tidy(staying), schema)
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])


def _chain(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest
