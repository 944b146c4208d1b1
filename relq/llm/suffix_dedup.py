"""Suffix-array dedup: bytes covered by a repeated string of ``LENGTH`` bytes.

A byte goes if it lies in a 400-byte string that also starts anywhere else,
in the same text or another.  Repeats are found by a distributed merge sort of
suffixes that knows common prefixes:

1. *Which suffixes.*  Two equal 400-byte strings contain the same anchor at the
   same place: the 100-byte gram with the smallest hash among their 301 grams.
   Only suffixes that start at an anchor whose gram occurs at several places
   can belong to a repeat; all others are left out before anything is sent.
2. *Runs.*  Each task sorts its suffixes (from the anchor as far as a string
   that has this anchor can reach) and sends them front-coded: the length of
   the prefix shared with the one before, and the rest.  The exchange goes by
   a range of the gram's hash, so suffixes with a common anchor meet.
3. *Merge.*  A loser tree merges the runs of a range.  It keeps, for each run,
   the prefix length known to be shared with the last output, decides by these
   lengths where they differ, and compares only bytes behind them where not.
4. *Repeats.*  Suffixes that share an anchor come out next to each other;
   among them, strings equal over all of their 400 bytes are repeats.

Texts equal as a whole are handled once: of n >= 400 bytes with a copy nothing
stays.  Equal texts leave a task once, so a hot group of copies costs a row
for each task.  An anchor that occurs more than ``HOT`` times would bring one
task too much; there, each 400-byte string is sent as a 128-bit fingerprint
by ranges of the fingerprint, once for each task, and equal ones meet.

Strings of an anchor's group that have one hash are compared byte by byte before
anything is removed; above ``HOT``, 128 bits of two hashes decide.  Defined
results: a null text is empty; texts below 400
bytes lose nothing; rows that share id and text are copies like any others; an
empty table gives no rows; other columns are ignored by ``remove_repeats`` and
``remaining`` and kept by ``without_repeats``, whatever their names.  Very
long texts are worked through in overlapping pieces.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from relq.operators.joins import aggregated_join

from .arrays import column_bytes, mix, prefix_hash, slices, span_hash
from .memory import drop, tidy
from .staging import staged

LENGTH = 400
GRAM = 100
WINDOW = LENGTH - GRAM + 1
HOT = 4096
RUN_BYTES = 24 << 20
RANGE_BYTES = 8 << 20
_SLICE = 1 << 19
_PLACE = np.uint64((1 << 31) - 1)
_TWIN = np.uint64(0x2545F4914F6CDD1D)
_EMPTY = hashlib.sha256(b"").hexdigest()


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every start of a 400-byte string (index into ``data``): its text's
    row, and the place of its anchor; and the hash of every gram.

    Of equal smallest hashes the last one counts, so that equal strings have
    their anchor at the same place.
    """
    if len(data) < LENGTH:
        return np.zeros((3, 0), np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = len(data) - GRAM + 1
    at = np.arange(grams)
    prefix = prefix_hash(data)
    gram = span_hash(prefix, at, at + GRAM)
    row = np.searchsorted(offsets, at, "right") - 1
    key = (gram & ~_PLACE) | (_PLACE - (at - offsets[row]).astype(np.uint64))
    # smallest key of each window: over blocks, from the left and from the right
    blocks = -(-grams // WINDOW)
    filled = np.full(blocks * WINDOW, ~np.uint64(0))
    filled[:grams] = key
    filled = filled.reshape(blocks, WINDOW)
    left = np.minimum.accumulate(filled, 1).ravel()
    right = np.minimum.accumulate(filled[:, ::-1], 1)[:, ::-1].ravel()
    size = np.maximum(np.diff(offsets) - LENGTH + 1, 0)
    first = np.cumsum(size) - size
    own = np.repeat(np.arange(len(size)), size)
    start = np.repeat(offsets[:-1] - first, size) + np.arange(int(size.sum()))
    least = np.minimum(right[start], left[start + WINDOW - 1])
    place = offsets[own] + (_PLACE - (least & _PLACE)).astype(np.int64)
    return np.stack([start, own, place]), place, gram


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """A run of texts, or a very long text in pieces: bytes, offsets and what
    comes before the piece.  Pieces overlap by one byte less than a string, and a
    string's anchor lies within it, so each start is in one piece with its anchor."""
    if len(offsets) != 2 or len(data) <= 2 * _SLICE:
        yield data, offsets, 0
        return
    for at in range(0, len(data) - LENGTH + 1, _SLICE):
        own = data[at:at + _SLICE + LENGTH - 1]
        yield own, np.array([0, len(own)]), at


_SKETCH = "rid long, doc_id long, body long, n_bytes long, whole string, leader long, grams array<long>"


@tidy
def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    drop()
    leaders: dict[bytes, int] = {}  # of this task's distinct texts
    for part in slices(batches, "text", _SLICE):
        data, offsets = column_bytes(part.column("text"))
        hashes, counts = [], np.zeros(part.num_rows, np.int64)
        for own_data, own_offsets, _ in _pieces(data, offsets):
            (_, own, place), _, gram = anchors(own_data, own_offsets)
            new = np.ones(len(place), bool)
            new[1:] = (place[1:] != place[:-1]) | (own[1:] != own[:-1])
            hashes.append(gram[place[new]].view(np.int64) if len(place) else np.zeros(0, np.int64))
            counts += np.bincount(own[new], minlength=part.num_rows)
        hashes, cut, raw = np.concatenate(hashes), np.concatenate([[0], np.cumsum(counts)]), data.tobytes()
        whole, leader, grams = [], [], []
        for i, rid in enumerate(part.column("rid").to_pylist()):
            digest = hashlib.sha256(raw[offsets[i]:offsets[i + 1]])
            whole.append(digest.hexdigest())
            leader.append(leaders.setdefault(digest.digest(), rid))
            grams.append(hashes[cut[i]:cut[i + 1]] if leader[-1] == rid else None)
        yield pa.record_batch({"rid": part.column("rid"), "doc_id": part.column("doc_id"), "body": part.column("body"), "n_bytes": pa.array(np.diff(offsets), pa.int64()),
                               "whole": pa.array(whole, pa.string()), "leader": pa.array(leader, pa.int64()), "grams": pa.array(grams, pa.list_(pa.int64()))})


def shared_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, ``known`` bytes of which are known."""
    n, step = min(len(a), len(b)), 16
    while known < n:
        end = min(known + step, n)
        if a[known:end] != b[known:end]:
            while end - known > 1:
                middle = (known + end) // 2
                if a[known:middle] == b[known:middle]:
                    known = middle
                else:
                    end = middle
            return known
        known, step = end, step * 2
    return n


def front_coded(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Prefix lengths shared with the string before, lengths and bytes of the rests."""
    shared, rests, last = [], [], b""
    for s in strings:
        n = shared_prefix(last, s, 0)
        shared.append(n)
        rests.append(s[n:])
        last = s
    return np.array(shared, "<u4"), np.array([len(r) for r in rests], "<u4"), b"".join(rests)


def decoded(shared: np.ndarray, size: np.ndarray, rests: bytes) -> Iterator[tuple[int, bytes]]:
    """(shared prefix, string) of a front-coded run."""
    at, last = 0, b""
    for n, m in zip(shared.tolist(), size.tolist()):
        last = last[:n] + rests[at:at + m]
        at += m
        yield n, last


class LoserTree:
    """Merges sorted runs of (shared prefix, string); yields (run, shared
    prefix with the last output, string)."""

    def __init__(self, runs: list[Iterator[tuple[int, bytes]]]):
        self.runs, self.width = runs, 1
        while self.width < len(runs):
            self.width *= 2
        self.head: list[bytes | None] = [None] * self.width
        self.known = [0] * self.width  # shared with the last output
        self.loser = [-1] * self.width
        for i in range(len(runs)):
            self._advance(i)
        self.winner = self._build(1)

    def _advance(self, i: int) -> None:
        n, s = next(self.runs[i], (0, None))
        self.known[i], self.head[i] = n, s

    def _build(self, node: int) -> int:
        if node >= self.width:
            return node - self.width
        a, b = self._build(2 * node), self._build(2 * node + 1)
        winner, self.loser[node] = self._play(a, b)
        return winner

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's known prefix becomes the one shared
        with the winner where the two had to be compared."""
        x, y = self.head[a], self.head[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        if self.known[a] != self.known[b]:
            return (a, b) if self.known[a] > self.known[b] else (b, a)
        n = shared_prefix(x, y, self.known[a])
        if n == len(x) and (n < len(y) or a < b) or n < min(len(x), len(y)) and x[n] < y[n]:
            self.known[b] = n
            return a, b
        self.known[a] = n
        return b, a

    def __iter__(self) -> Iterator[tuple[int, int, bytes]]:
        while self.head[self.winner] is not None:
            i = self.winner
            yield i, self.known[i], self.head[i]
            self._advance(i)
            node = (i + self.width) // 2
            while node:
                i, self.loser[node] = self._play(i, self.loser[node])
                node //= 2
            self.winner = i


def _packed(refs: np.ndarray, lefts: list[bytes], strings: list[bytes]) -> bytes:
    shared, size, rests = front_coded(strings)
    left = np.array([len(x) for x in lefts], "<u4")
    parts = [refs.astype("<i8").tobytes(), shared.tobytes(), size.tobytes(), rests, left.tobytes(), b"".join(lefts)]
    return struct.pack("<I6Q", len(strings), *map(len, parts)) + b"".join(parts)


def _unpacked(blob: bytes):
    n, *sizes = struct.unpack_from("<I6Q", blob)
    at, parts = 52, []
    for size in sizes:
        parts.append(blob[at:at + size])
        at += size
    return (np.frombuffer(parts[0], "<i8").reshape(n, 2), (np.frombuffer(parts[1], "<u4"), np.frombuffer(parts[2], "<u4"), parts[3]), np.frombuffer(parts[4], "<u4"), parts[5])


_RUN = "task long, hot boolean, run binary, cid long, first long, last long"


def _found(cid, first, last) -> pa.RecordBatch:
    n = len(cid)
    return pa.record_batch({"task": pa.nulls(n, pa.int64()), "hot": pa.nulls(n, pa.bool_()), "run": pa.nulls(n, pa.binary()), "cid": pa.array(cid, pa.int64()), "first": pa.array(first, pa.int64()), "last": pa.array(last, pa.int64())})


def _sent(rows: list[tuple[int, bool, bytes]]) -> pa.RecordBatch:
    none = pa.nulls(len(rows), pa.int64())
    return pa.record_batch({"task": pa.array([r[0] for r in rows], pa.int64()), "hot": pa.array([r[1] for r in rows], pa.bool_()), "run": pa.array([r[2] for r in rows], pa.binary()), "cid": none, "first": none, "last": none})


def _range(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each hash.  Mixed first: anchors are the smallest of many
    hashes and would all fall into the first ranges."""
    return ((mix(hashes ^ _TWIN) >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _intervals(cid: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts, first and last starts of the runs of consecutive starts."""
    order = np.lexsort((start, cid))
    cid, start = cid[order], start[order]
    cut = np.flatnonzero((cid[1:] != cid[:-1]) | (start[1:] > start[:-1] + 1)) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut - 1, [len(cid) - 1]])
    return cid[first], start[first], start[last]


class _Runs:
    """Collects a task's suffixes and hot strings and hands out sorted runs."""

    def __init__(self, ranges: int):
        self.ranges, self.held = ranges, 0
        self.suffixes: dict[int, list[tuple[bytes, bytes, int, int]]] = {}
        self.strings: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # fingerprints (n, 2), cid, start

    def add(self, task: int, left: bytes, suffix: bytes, cid: int, first: int) -> None:
        self.suffixes.setdefault(task, []).append((suffix, left, cid, first))
        self.held += len(left) + len(suffix) + 200

    def add_hot(self, fingerprints: np.ndarray, cid: int, start: np.ndarray) -> None:
        self.strings.append((fingerprints, np.full(len(start), cid), start))
        self.held += 32 * len(start)

    def flush(self) -> Iterator[pa.RecordBatch]:
        for task, own in sorted(self.suffixes.items()):
            own.sort()
            refs = np.array([(cid, first) for _, _, cid, first in own], np.int64)
            yield _sent([(task, False, _packed(refs, [x[1] for x in own], [x[0] for x in own]))])
        if self.strings:
            print_, cid, start = (np.concatenate(x) for x in zip(*self.strings))
            order = np.lexsort((start, cid, print_[:, 1], print_[:, 0]))
            print_, cid, start = print_[order], cid[order], start[order]
            again = np.zeros(len(cid), bool)  # the same place twice: a row that came twice
            again[1:] = (cid[1:] == cid[:-1]) & (start[1:] == start[:-1])
            print_, cid, start = print_[~again], cid[~again], start[~again]
            new = np.ones(len(cid), bool)
            new[1:] = (print_[1:] != print_[:-1]).any(1)
            count = np.diff(np.append(np.flatnonzero(new), len(cid)))
            repeated = np.repeat(count > 1, count)
            if repeated.any():
                yield _found(*_intervals(cid[repeated], start[repeated]))
            # one of equal ones goes out; what is repeated here needs no answer
            ref = np.where(repeated, -1, cid)[new]
            print_, start = print_[new], start[new]
            task = _range(print_[:, 0], self.ranges)
            for t in np.unique(task):
                at = task == t
                yield _sent([(int(t), True, print_[at].astype("<u8").tobytes() + ref[at].astype("<i8").tobytes() + start[at].astype("<i8").tobytes())])
        self.suffixes, self.strings, self.held = {}, [], 0


def _runs(ranges: int):
    def add_piece(out: _Runs, data: np.ndarray, offsets: np.ndarray, before: int, cid: list[int], common: list[set[int]], hot: list[set[int]]) -> None:
        (start, own, place), _, gram = anchors(data, offsets)
        if not len(start):
            return
        cut = np.concatenate([[0], np.flatnonzero((place[1:] != place[:-1]) | (own[1:] != own[:-1])) + 1, [len(start)]])
        first, last, at, row = start[cut[:-1]], start[cut[1:] - 1], place[cut[:-1]], own[cut[:-1]]
        hashes, raw, prefix = gram[at].view(np.int64).tolist(), data.tobytes(), None
        for h, task, a, z, p, r, base in zip(hashes, _range(gram[at], ranges).tolist(), first.tolist(), last.tolist(), at.tolist(), row.tolist(), (offsets[row] - before).tolist()):
            if h in common[r]:
                out.add(task, raw[a:p], raw[p:z + LENGTH], cid[r], a - base)
            elif h in hot[r]:
                prefix = prefix_hash(data) if prefix is None else prefix
                begin = np.arange(a, z + 1)
                one = span_hash(prefix, begin, begin + LENGTH)
                # a second, independent half: hashes of the string's four quarters
                two = sum((span_hash(prefix, begin + q, begin + q + LENGTH // 4) * np.uint64(2 * q + 1) for q in range(0, LENGTH, LENGTH // 4)), np.zeros(len(begin), np.uint64))
                out.add_hot(np.stack([one, mix(two * _TWIN)], 1), cid[r], begin - base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop()
        out = _Runs(ranges)
        for part in slices(batches, "text", _SLICE):
            cid = part.column("cid").to_pylist()
            common, hot = ([set(x) if x else set() for x in part.column(c).to_pylist()] for c in ("common", "hot"))
            for piece in _pieces(*column_bytes(part.column("text"))):
                add_piece(out, *piece, cid, common, hot)
            if out.held > RUN_BYTES:
                yield from out.flush()
        yield from out.flush()

    return tidy(run)


def _confirmed(data: np.ndarray, begin: np.ndarray, mate: np.ndarray) -> bool:
    """Whether every string data[begin:][:LENGTH] equals data[mate:][:LENGTH].

    Where the pair before is one byte to the left of both, only the last byte
    is new; whole strings are compared at the beginnings of such runs.
    """
    goes_on = np.zeros(len(begin), bool)
    goes_on[1:] = (begin[1:] == begin[:-1] + 1) & (mate[1:] == mate[:-1] + 1)
    if (data[begin[goes_on] + LENGTH - 1] != data[mate[goes_on] + LENGTH - 1]).any():
        return False
    place, fresh = np.arange(LENGTH), np.flatnonzero(~goes_on)
    return all((data[begin[k][:, None] + place] == data[mate[k][:, None] + place]).all() for k in np.array_split(fresh, len(fresh) // 512 + 1))


def _repeats(members: list[tuple[int, bytes, bytes, int, int]]) -> pa.RecordBatch | None:
    """Repeated strings among members (group, left, suffix, cid, first start).

    Strings of one anchor group are brought together by their hashes; that they
    are equal is then confirmed byte by byte."""
    size = np.array([len(x[1]) + len(x[2]) for x in members], np.int64)
    offset = np.cumsum(size) - size
    count = size - LENGTH + 1
    own = np.repeat(np.arange(len(members)), count)
    nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    data = np.frombuffer(b"".join(b"".join((x[1], x[2])) for x in members), np.uint8)
    prefix = prefix_hash(data)
    begin = offset[own] + nth
    to_anchor = np.array([len(x[1]) for x in members], np.int64)[own] - nth
    group = np.array([x[0] for x in members], np.int64)[own]
    key = mix(span_hash(prefix, begin, begin + LENGTH) + mix((group * LENGTH + to_anchor).astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    same = ordered[1:] == ordered[:-1]
    mate = np.full(len(key), -1)
    mate[order[1:][same]] = order[:-1][same]
    later = np.flatnonzero(mate >= 0)
    if not _confirmed(data, begin[later], begin[mate[later]]):
        # strings with one hash that differ: told apart by their bytes
        raw, number = data.tobytes(), {}
        exact = [number.setdefault((g, t, raw[b:b + LENGTH]), len(number)) for g, t, b in zip(group.tolist(), to_anchor.tolist(), begin.tolist())]
        order = np.argsort(exact, kind="stable")
        ordered = np.array(exact)[order]
        same = ordered[1:] == ordered[:-1]
    hit = np.zeros(len(key), bool)
    hit[order[1:]] = same
    hit[order[:-1]] |= same
    if not hit.any():
        return None
    at = np.flatnonzero(hit)
    cut = np.flatnonzero((own[at[1:]] != own[at[:-1]]) | (at[1:] != at[:-1] + 1)) + 1
    a, z = at[np.concatenate([[0], cut])], at[np.concatenate([cut - 1, [len(at) - 1]])]
    cid, first = np.array([x[3] for x in members]), np.array([x[4] for x in members])
    return pa.record_batch({"cid": pa.array(cid[own[a]], pa.int64()), "first": pa.array(first[own[a]] + nth[a], pa.int64()), "last": pa.array(first[own[z]] + nth[z], pa.int64())})


def _merged(runs: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Merge one range's runs and yield its repeats."""
    open_ = [_unpacked(r) for r in runs]
    place, left_at = [0] * len(open_), [0] * len(open_)
    batch, group, held, number, seen = [], [], 0, 0, set()

    def close():
        nonlocal held, number
        if len(group) > 1:
            batch.extend((number, *x) for x in group)
            held += sum(len(x[0]) + len(x[1]) for x in group)
            number += 1
        group.clear()
        seen.clear()

    for i, shared, suffix in LoserTree([decoded(*r[1]) for r in open_]):
        refs, _, sizes, lefts = open_[i]
        n, m = place[i], int(sizes[place[i]])
        left = lefts[left_at[i]:left_at[i] + m]
        place[i], left_at[i] = n + 1, left_at[i] + m
        if shared < GRAM:
            close()
            if held > 1 << 20:
                if (found := _repeats(batch)) is not None:
                    yield found
                batch, held = [], 0
        cid, first = refs[n].tolist()
        if (cid, first) not in seen:  # a row that came twice is one place
            seen.add((cid, first))
            group.append((left, suffix, cid, first))
    close()
    if batch and (found := _repeats(batch)) is not None:
        yield found


def _merged_hot(runs: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Places of fingerprints that several runs, or one run twice, hold."""
    parts = []
    for blob in runs:
        n = len(blob) // 32
        parts.append((np.frombuffer(blob, "<u8", 2 * n).reshape(n, 2), np.frombuffer(blob, "<i8", n, 16 * n), np.frombuffer(blob, "<i8", n, 24 * n)))
    print_, ref, start = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((start, ref, print_[:, 1], print_[:, 0]))
    print_, ref, start = print_[order], ref[order], start[order]
    keep = np.ones(len(ref), bool)
    keep[1:] = (print_[1:] != print_[:-1]).any(1) | (ref[1:] != ref[:-1]) | (start[1:] != start[:-1]) | (ref[1:] < 0)
    print_, ref, start = print_[keep], ref[keep], start[keep]
    same = (print_[1:] == print_[:-1]).all(1)
    hit = np.zeros(len(ref), bool)
    hit[1:], hit[:-1] = same, hit[:-1]
    hit[:-1] |= same
    # a run that holds the string twice says so by -1
    hit &= ref >= 0
    if hit.any():
        cid, first, last = _intervals(ref[hit], start[hit])
        yield pa.record_batch({"cid": pa.array(cid, pa.int64()), "first": pa.array(first, pa.int64()), "last": pa.array(last, pa.int64())})


@tidy
def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def one(key, runs):
        return _merged_hot(runs) if key[1] else _merged(runs)

    key, runs = None, []
    for batch in batches:
        for task, hot, run in zip(batch.column("task").to_pylist(), batch.column("hot").to_pylist(), batch.column("run").to_pylist()):
            if (task, hot) != key:
                if runs:
                    yield from one(key, runs)
                key, runs = (task, hot), []
            runs.append(run)
    if runs:
        yield from one(key, runs)


def _covered(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    """Maximal removed runs [a, b) of repeated starts first..last."""
    out: list[list[int]] = []
    for a, b in sorted(zip(first.tolist(), last.tolist())):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b + LENGTH)
        else:
            out.append([a, b + LENGTH])
    return [(a, b) for a, b in out]


def _rest(raw: bytes, found: list[dict]) -> tuple[bytes, int]:
    """What is left of a text, and the number of removed runs."""
    spans = _covered(np.array([f["first"] for f in found]), np.array([f["last"] for f in found]))
    kept, at = [], 0
    for a, b in spans:
        kept.append(raw[at:a])
        at = b
    return b"".join([*kept, raw[at:]]), len(spans)


@tidy
def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        rows = []
        for cid, text, found in zip(part.column("cid").to_pylist(), part.column("text").cast(pa.binary()).to_pylist(), part.column("found").to_pylist()):
            kept, spans = _rest(text, found)
            rows.append((cid, len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))], names=["cid", "n_removed", "n_spans", "kept_sha256", "kept"])


def places(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(sketch, classes, texts, found): every row with its leader; every distinct
    text with its class ``cid`` and number of copies; the texts that may lose
    bytes; and by class the first and last starts of repeated strings."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("body", F.xxhash64("text"))
    sketch = staged(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "body", "text").mapInArrow(_sketch, _SKETCH), "anchors")
    leaders = sketch.where(F.col("rid") == F.col("leader"))
    copies = sketch.groupBy("whole", "leader").agg(F.count("*").alias("n")).groupBy("whole").agg(F.sum("n").alias("copies"), F.min("leader").alias("cid"))
    classes = staged(leaders.join(copies, "whole").select("rid", "cid", "copies", "n_bytes", "doc_id", "body", F.when(F.col("rid") == F.col("cid"), F.col("grams")).alias("grams")), "texts")

    anchored = classes.where(F.col("rid") == F.col("cid")).select("cid", F.explode("grams").alias("gram"))
    several = anchored.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")
    found = aggregated_join(anchored, several, "gram")
    wanted = staged(found.groupBy("cid").agg(F.collect_set(F.when(F.col("n") <= HOT, F.col("gram"))).alias("common"), F.collect_set(F.when(F.col("n") > HOT, F.col("gram"))).alias("hot"), F.count("*").alias("n"))
                    .join(classes.where(F.col("rid") == F.col("cid")).select("cid", F.col("doc_id").alias("wid"), F.col("body").alias("wbody")), "cid"), "wanted")
    ranges = max(1, -(-(wanted.agg(F.sum("n")).first()[0] or 0) * (LENGTH + WINDOW // 2) // RANGE_BYTES))
    texts = staged(docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("wid")) & (F.col("body") == F.col("wbody"))).select("cid", "common", "hot", "text"), "candidates")
    runs = staged(texts.mapInArrow(_runs(ranges), _RUN), "runs")
    merged = runs.where(F.col("run").isNotNull()).select("task", "hot", "run").repartitionById(ranges, F.col("task").cast("int")).sortWithinPartitions("task", "hot").mapInArrow(_merge, "cid long, first long, last long")
    starts = merged.union(runs.where(F.col("cid").isNotNull()).select("cid", "first", "last"))
    by_text = starts.groupBy("cid").agg(F.collect_set(F.struct("first", "last")).alias("found"))
    return sketch, classes, texts, by_text


def repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sketch, classes, cut): as ``places``; and the texts that lose bytes, with
    what is left of them."""
    sketch, classes, texts, by_text = places(df, id_col, text_col)
    cut = texts.select("cid", "text").join(by_text, "cid").mapInArrow(_cut, "cid long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return sketch, classes, cut


def _results(sketch: DataFrame, classes: DataFrame, cut: DataFrame, keep_bytes: bool) -> DataFrame:
    """Each row's result, with the hash of its text (``body``)."""
    cut = cut.dropDuplicates(["cid"]) if keep_bytes else cut.drop("kept").dropDuplicates(["cid"])
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    result = classes.drop("grams", "doc_id", "body").join(cut, "cid", "left").select(
        F.col("rid").alias("leader"), F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.lit(_EMPTY)).otherwise(F.col("kept_sha256")).alias("own_sha256"), *([F.when(gone, F.lit(b"")).otherwise(F.col("kept")).alias("kept")] if keep_bytes else []))
    out = sketch.select("doc_id", "body", "n_bytes", "whole", "leader").join(result, "leader")
    return out.select("doc_id", "body", "n_bytes", "n_removed", "n_spans", F.coalesce("own_sha256", "whole").alias("kept_sha256"), *(["kept"] if keep_bytes else []))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_bytes: bool = False) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) of each row.

    ``keep_bytes`` adds what is left of the text as binary, null where all of
    it is left."""
    return _results(*repeats(df, id_col, text_col), keep_bytes).drop("body").withColumnRenamed("doc_id", id_col)


_REMAINING = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string"


@tidy
def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    drop()
    for part in slices(batches, "text"):
        rows = []
        for text, n, whole, gone, found in zip(*(part.column(c).to_pylist() for c in ("text", "n_bytes", "whole", "gone", "found"))):
            if gone:
                rows.append((n, 1, _EMPTY, None if text is None else ""))
            elif not found:
                rows.append((0, 0, whole, text))
            else:
                raw = text.encode()
                kept, spans = _rest(raw, found)
                rows.append((len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore")))
        removed, spans, sha, text = zip(*rows)
        yield pa.record_batch({"id": part.column("id"), "n_bytes": part.column("n_bytes"), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()),
                               "kept_sha256": pa.array(sha, pa.string()), "text": pa.array(text, pa.string())})


def remaining(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, text) of each row, the last
    being what is left of the text.  A character that a repeat's edge cuts
    through goes as a whole from ``text`` (the hash is of the exact bytes); a
    null text stays null.  Only the places of repeats are sent about; the texts
    meet them once, at the end."""
    sketch, classes, _, found = places(df, id_col, text_col)
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    of_class = classes.select("rid", "cid", gone.alias("gone")).join(found, "cid", "left").select(F.col("rid").alias("leader"), "gone", "found")
    of_row = sketch.select(F.col("doc_id").alias("found_id"), "body", "n_bytes", "whole", "leader").join(of_class, "leader").drop("leader").dropDuplicates(["found_id", "body"])
    own = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("own_body"))
    both = own.join(of_row, F.col("id").eqNullSafe(F.col("found_id")) & (F.col("own_body") == F.col("body")))
    return both.select("id", "text", "n_bytes", "whole", "gone", "found").mapInArrow(_finished, _REMAINING).withColumnRenamed("id", id_col)


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with repeated bytes taken out of its texts.  A character that a
    repeat's edge cuts through goes as a whole; a null text stays null.  As in
    ``remaining``, only places are sent about: a stage then has one Python worker
    a task, and an executor no more workers than cores."""
    sketch, classes, _, found = places(df, id_col, text_col)
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    of_class = classes.select("rid", "cid", gone.alias("gone")).join(found, "cid", "left").where(F.col("gone") | F.col("found").isNotNull()).select(F.col("rid").alias("leader"), "gone", "found")
    of_row = sketch.select(F.col("doc_id").alias("cut_id"), "body", "leader").join(of_class, "leader").drop("leader").dropDuplicates(["cut_id", "body"])
    text_at = df.columns.index(text_col)
    names = [f"c{i}" for i in range(len(df.columns))]
    text = F.col(f"c{text_at}").cast("string")
    own = df.toDF(*names).withColumn(f"c{text_at}", text).withColumn("own_body", F.xxhash64(F.coalesce(text, F.lit(""))))
    both = own.join(of_row, F.col(f"c{df.columns.index(id_col)}").cast("long").eqNullSafe(F.col("cut_id")) & (F.col("own_body") == F.col("body")), "left")
    left = both.select(*names, "gone", "found").mapInArrow(_without(text_at), own.select(*names).schema)
    return left.toDF(*df.columns)


def _without(text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop()
        for part in slices(batches, f"c{text_at}"):
            columns = part.columns[:-2]
            text, found = columns[text_at], part.column("found")
            changed = pc.and_(pc.fill_null(pc.or_kleene(part.column("gone"), found.is_valid()), False), text.is_valid())
            if pc.any(changed).as_py():
                rest = []
                for raw, gone, own in zip(*(x.filter(changed).to_pylist() for x in (text, part.column("gone"), found))):
                    rest.append("" if gone else _rest(raw.encode(), own)[0].decode(errors="ignore"))
                columns[text_at] = pc.replace_with_mask(text, changed, pa.array(rest, text.type))
            yield pa.record_batch(columns, names=part.schema.names[:-2])

    return tidy(run)
