"""MinHash near-dedup with b-bit signatures and exact confirmation.

A text's set is that of its 5-word shingles (lower-cased A-Z, words between
ASCII white space); a shorter text is one shingle.  Two texts are linked when
100 * |both| >= 85 * |either|; components of links share their smallest id.

1. Each text is sketched: ``BANDS * ROWS`` minima, a key for each band, and
   the low ``BITS`` bits of all minima packed into a signature.
2. Texts with equal sets are one class; classes that share a band's key are
   candidates.  In a bucket similarities are estimated by counting equal
   signature entries, corrected for chance agreement of the low bits, and
   classes estimated at the share less ``MARGIN`` or above are joined in a tree
   (never as all pairs).
   The clusters of these trees hold every pair that can be linked.
3. The full sets of a cluster meet, and links are confirmed on them; pairs
   already connected are skipped.  A tree of confirmed links leaves the task.

A class leaves its buckets above ``BLOCK`` classes if it has ``COLD`` others: bands
agree independently, so these find its links nearly as surely as all (a common
line or passage makes a few such buckets for each of its texts).  A bucket or
cluster that is still above ``BLOCK`` goes through rounds: all of its
members are compared with one of them, the pivot, wherever they are; members
that nothing outside of the pivot's surroundings can be linked with any more
(by the triangle inequality of the Jaccard distance) leave the group, and the
next round's pivot is one of the rest.  A round's work and rows are linear in
the group.  What is left after ``ROUNDS`` is cut into blocks, and each pair of
blocks is one task's work: nothing is capped, and no task holds more than two
blocks.  A pair exactly at 0.85 shares no band with a probability of
``(1 - 0.85 ** ROWS) ** BANDS`` (6e-11; at 0.8: 1e-7; with ``COLD`` bands 7e-10
and 6e-7), and its estimate is off
by ``MARGIN`` (over six and five standard deviations) with one below 1e-8;
more similar pairs far less often.

Equal sets leave each task once (the ``leader``), so that a hot group of
copies costs a row for each task.  Shingles are compared by 64-bit hashes.

Defined results: a text without words (or a null) has an empty set and is
linked with nothing; rows that share an id are linked as rows, and a null id
never names a component unless all of its members are null; an empty table
gives no rows; other columns are ignored by ``near_duplicates`` and kept by
``one_of_each``, whatever their names.  Whole texts are shingled; the working
arrays of a single text are about 60 times its bytes.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from relq.operators.joins import aggregated_join, key_probe

from .arrays import LOWER, NOT_SPACE, Words, column_bytes, mix, slices
from .components import connected_components
from .memory import drop, tidy
from .staging import staged

SHINGLE = 5
BANDS, ROWS, BITS = 40, 5, 4
SHARE, OF = 85, 100  # linked: OF * both >= SHARE * either
MARGIN = 0.17  # estimates this far below the share are still looked at
BLOCK = 4096
ROUNDS = 2
COLD = 36  # bands in buckets of at most BLOCK classes that are enough
LOOSE = 0.1  # estimates from which a member goes into its pivot's cluster
_HASHES = BANDS * ROWS
_rng = np.random.default_rng(20240229)
_MULTIPLY = (_rng.integers(0, 1 << 32, _HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_FLIP = _rng.integers(0, 1 << 32, _HASHES, dtype=np.uint64).astype(np.uint32)
_MIXERS = _rng.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the texts, and each text's first index."""
    words = Words(LOWER[data], offsets, NOT_SPACE)
    count = np.diff(words.first)
    made = np.where(count >= SHINGLE, count - SHINGLE + 1, (count > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(made)])
    at = np.repeat(words.first[:-1] - first[:-1], made) + np.arange(first[-1])
    left = np.minimum(np.repeat(words.first[1:], made) - at, SHINGLE)
    out = left.astype(np.uint64)
    padded = np.concatenate([words.hash, np.zeros(SHINGLE, np.uint64)])
    for k in range(SHINGLE):
        out += np.where(left > k, mix(padded[at + k] + np.uint64(k + 1)) * _MIXERS[k], np.uint64(0))
    return mix(out), first


def distinct_sets(hashes: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Each text's set as a sorted array."""
    return [np.unique(hashes[a:b]) for a, b in zip(first[:-1], first[1:])]


def minima(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(texts, hash functions); texts without shingles are left out."""
    full = np.flatnonzero(np.diff(first))
    start, short = first[full], (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(full), _HASHES), np.uint32)
    for i in range(_HASHES if len(full) else 0):
        v = (short ^ _FLIP[i]) * _MULTIPLY[i]
        v ^= v >> np.uint32(15)
        out[:, i] = np.minimum.reduceat(v, start)
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    """(texts, bands): 64-bit keys, different for each band."""
    key = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None] * np.uint64(0x9E3779B97F4A7C15), len(least), 0)
    for r in range(ROWS):
        key = mix(key ^ (least[:, r::ROWS].astype(np.uint64) + np.uint64(r << 33)))
    return key.view(np.int64)


_WORDS = -(-_HASHES // 64)  # 64-bit words of a bit plane


def packed(least: np.ndarray) -> np.ndarray:
    """(texts, bytes): the low ``BITS`` bits of each minimum, a plane of bits
    for each, padded to whole words."""
    planes = (least[:, None, :] >> np.arange(BITS, dtype=np.uint32)[None, :, None] & 1).astype(np.uint8)
    padded = np.zeros((len(least), BITS, _WORDS * 64), np.uint8)
    padded[:, :, :_HASHES] = planes
    return np.packbits(padded, axis=2).reshape(len(least), -1)


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarities of signatures (.., words), broadcast against each other: the
    share of entries that are equal in all planes, less chance agreement."""
    apart = 0
    for w in range(_WORDS):
        differ = a[..., w] ^ b[..., w]
        for plane in range(1, BITS):
            differ |= a[..., plane * _WORDS + w] ^ b[..., plane * _WORDS + w]
        apart = apart + np.bitwise_count(differ).astype(np.int16)
    equal, chance = 1 - apart / _HASHES, 1 / (1 << BITS)
    return (equal - chance) / (1 - chance)


_SKETCH = "rid long, doc_id long, body long, n_shingles long, leader long, keyed binary, bands array<long>, signature binary"


@tidy
def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    drop()
    leaders: dict[bytes, int] = {}  # of this task's distinct sets
    for part in slices(batches, "text"):
        hashes, first = shingles(*column_bytes(part.column("text")))
        sets, least = distinct_sets(hashes, first), minima(hashes, first)
        keys, bits, at = band_keys(least), packed(least), 0
        out = {k: [] for k in ("leader", "keyed", "bands", "signature")}
        for rid, own in zip(part.column("rid").to_pylist(), sets):
            keyed = hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None
            leader = leaders.setdefault(keyed, rid) if keyed else rid
            new = keyed is not None and leader == rid
            out["leader"].append(leader)
            out["keyed"].append(keyed)
            out["bands"].append(keys[at] if new else None)
            out["signature"].append(bits[at].tobytes() if new else None)
            at += keyed is not None
        yield pa.record_batch({
            "rid": part.column("rid"), "doc_id": part.column("doc_id"), "body": part.column("body"), "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
            "leader": pa.array(out["leader"], pa.int64()), "keyed": pa.array(out["keyed"], pa.binary()), "bands": pa.array(out["bands"], pa.list_(pa.int64())), "signature": pa.array(out["signature"], pa.binary())})


_PIVOTS = 32


def _tree(signature: np.ndarray, side: np.ndarray | None, least: float, confirm=None) -> list[tuple[int, int]]:
    """Pairs that connect what the estimates (and ``confirm``) connect.

    Grown from one member at a time: a member that has been reached is compared
    with those that have not, so a dense group takes few comparisons and each
    pair at most one.  ``side``: with two blocks, only pairs across count."""
    waiting, out = np.arange(len(signature)), []
    while len(waiting):
        reached, waiting = [int(waiting[0])], waiting[1:]
        while reached and len(waiting):
            own, reached = np.array(reached[:_PIVOTS]), reached[_PIVOTS:]
            value = estimates(signature[own][:, None], signature[waiting][None])
            near = value >= least
            if side is not None:
                near &= side[own][:, None] != side[waiting][None]
            hit = near.any(0)
            if confirm is None:
                out += zip(own[near[:, hit].argmax(0)].tolist(), waiting[hit].tolist())
            else:
                for c in np.flatnonzero(hit).tolist():
                    rows = np.flatnonzero(near[:, c])
                    found = next((r for r in rows[np.argsort(-value[rows, c], kind="stable")].tolist() if confirm(int(own[r]), int(waiting[c]))), None)
                    if found is None:
                        hit[c] = False
                    else:
                        out.append((int(own[found]), int(waiting[c])))
            reached += waiting[hit].tolist()
            waiting = waiting[~hit]
    return out


def _whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows in tables that end with a group, and where groups begin
    (with the number of rows at the end)."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        own = table.column(key).to_numpy()
        cut = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1])
        if cut[-1]:
            yield table.slice(0, cut[-1]), cut
        rest = table.slice(cut[-1]).combine_chunks()
    if rest is not None:
        yield rest, np.array([0, rest.num_rows])


def blocked(rows: DataFrame, group: str, member: str, block: int = BLOCK) -> DataFrame:
    """``rows`` with a long ``task`` and an int ``side``: all rows of a group share
    a task if there are at most ``block``; else the group is cut into blocks by
    the member's hash, and each pair of blocks is a task (side 0 and 1; a block
    alone: side null, as with a small group)."""
    large = rows.groupBy(group).agg(F.count("*").alias("members")).where(F.col("members") > block)
    parts = F.ceil(F.col("members") / (block / 2)).cast("int")
    rows = aggregated_join(rows, large, group, how="left").withColumn("parts", F.coalesce(parts, F.lit(1))).withColumn("part", F.pmod(F.xxhash64(member), F.col("parts")).cast("int"))
    other = F.when(F.col("parts") > 1, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.lit(0)))
    out = rows.withColumn("other", F.explode(other))
    one, two = F.least("part", "other"), F.greatest("part", "other")
    return (out.withColumn("task", F.when(F.col("parts") == 1, F.xxhash64(group)).otherwise(F.xxhash64(group, one, two)))
            .withColumn("side", F.when(F.col("part") != F.col("other"), (F.col("part") == two).cast("int"))).drop("members", "parts", "part", "other"))


def _against_pivots(pool: DataFrame, sizes: DataFrame, by: str, judge, drop) -> tuple[DataFrame, list[DataFrame]]:
    """Rounds of pivots over the groups of ``pool(group, cid, <binary columns>)``
    that have more than ``BLOCK`` members by ``sizes(group, members)``: what is
    left of the pool, and tables of pairs (u, v).

    ``judge``: similarities and joined-or-not of columns of own and pivot's
    ``by`` values; ``drop(joined, distance, nearest)``: whether a member leaves, by its
    distance from the pivot and that of the nearest member that is not joined
    (null if there is none).
    """
    large = staged(sizes.where(F.col("members") > BLOCK).select("group"), "large", "uncompressed")
    if large.isEmpty():
        return pool, []
    carried = [c for c in pool.columns if c not in ("group", "cid")]
    schema = "group long, cid long, pivot long, joined boolean, distance double, " + ", ".join(f"{c} binary" for c in carried)

    @tidy
    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            asked = batch.filter(batch.column("pivot").is_valid())
            similarity, joined = (x.astype(t) for x, t in zip(judge(asked.column(by), asked.column("other")), (float, bool)))
            rest = batch.filter(pc.is_null(batch.column("pivot")))
            for part, d, j in ((asked, pa.array(1 - similarity), pa.array(joined)), (rest, pa.nulls(rest.num_rows, pa.float64()), pa.nulls(rest.num_rows, pa.bool_()))):
                yield pa.record_batch({"group": part.column("group"), "cid": part.column("cid"), "pivot": part.column("pivot"), "joined": j, "distance": d, **{c: part.column(c) for c in carried}})

    rest = key_probe(pool, ["group"], large, ["group"], "left_anti")
    now = staged(key_probe(pool, ["group"], large, ["group"], "left_semi"), "hot", "uncompressed")
    edges: list[DataFrame] = []
    for number in range(ROUNDS):
        pivots = now.groupBy("group").agg(F.count("*").alias("members"), F.min_by(F.struct("cid", by), F.xxhash64("cid", F.lit(number))).alias("p"))
        pivots = staged(pivots.where(F.col("members") > BLOCK).select("group", F.col("p.cid").alias("pivot"), F.col(f"p.{by}").alias("other")), "pivots", "uncompressed")
        if pivots.isEmpty():
            break
        found = staged(aggregated_join(now, pivots, "group", how="left").mapInArrow(judged, schema), "judged", "uncompressed")
        edges.append(found.where("joined and cid <> pivot").select(F.col("pivot").alias("u"), F.col("cid").alias("v")))
        nearest = found.groupBy("group").agg(F.min(F.when(~F.col("joined"), F.col("distance"))).alias("nearest"))
        leaves = drop(F.col("joined"), F.col("distance"), F.col("nearest")) | (F.col("cid") == F.col("pivot"))
        now = aggregated_join(found, nearest, "group").where(F.col("pivot").isNull() | ~leaves).select(pool.columns)
    return rest.unionByName(now), edges


def _without_common_buckets(members: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``members`` without the rows of large buckets that their class can spare:
    with ``COLD`` bands in other buckets, those find its links (see the module
    text).  What a common line or passage brings together goes this way; near
    copies share all of their buckets and stay.  Also the sizes of what is left
    of the large buckets."""
    large = staged(sizes.where(F.col("members") > BLOCK).select("group"), "common", "uncompressed")
    if large.isEmpty():
        return members, sizes
    hot = staged(key_probe(members, ["group"], large, ["group"], "left_semi"), "hot", "uncompressed")
    tied = hot.groupBy("cid").agg(F.count("*").alias("n")).where(F.col("n") > BANDS - COLD).select("cid")
    left = staged(key_probe(hot, ["cid"], tied, ["cid"], "left_semi"), "tied", "uncompressed")
    return key_probe(members, ["group"], large, ["group"], "left_anti").unionByName(left), left.groupBy("group").agg(F.count("*").alias("members"))


def _judge_estimates(own: pa.Array, other: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    a, b = (np.frombuffer(b"".join(x.to_pylist()), np.uint64).reshape(len(x), -1) for x in (own, other))
    value = estimates(a, b) if len(a) else np.zeros(0)
    return value, value >= LOOSE


def _judge_sets(share: int):
    def judge(own: pa.Array, other: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        both, either = np.zeros(len(own), np.int64), np.ones(len(own), np.int64)
        for i, pair in enumerate(zip(own, other)):
            a, b = (np.frombuffer(x.as_py(), np.uint64) for x in pair)
            both[i] = np.isin(a, b, assume_unique=True).sum()
            either[i] = len(a) + len(b) - both[i]
        return both / either, OF * both >= share * either

    return judge


def _by_estimate(share: int):
    """A member leaves if what it may be linked with is joined to the pivot as
    well: links reach as far as the share allows, and both estimates may be off."""
    far = 1 - (LOOSE + (1 - share / OF) + 2 * MARGIN)
    return lambda joined, distance, nearest: joined & (distance <= far)


def _by_sets(share: int):
    """A member linked with the pivot leaves if no member that is not is within
    reach of a link."""
    reach = 1 - share / OF
    return lambda joined, distance, nearest: joined & (nearest.isNull() | (distance + reach + 1e-9 < nearest))


def _signatures(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint64).reshape(table.num_rows, -1)


def _sides(table: pa.Table) -> np.ndarray:
    """0 or 1, and -1 where a block stands alone."""
    return table.column("side").fill_null(-1).to_numpy()


def _edges(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _estimated(share: int):
    least = share / OF - MARGIN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cut in _whole_groups(batches, "task"):
            cid, signature, side = table.column("cid").to_numpy(), _signatures(table), _sides(table)
            size = np.diff(cut)
            two = cut[:-1][size == 2]  # most groups: all at once
            two = two[(estimates(signature[two], signature[two + 1]) >= least) & ((side[two] < 0) | (side[two] != side[two + 1]))]
            if len(two):
                yield _edges(cid[two], cid[two + 1])
            for a, b in zip(cut[:-1][size > 2].tolist(), cut[1:][size > 2].tolist()):
                pairs = np.array(_tree(signature[a:b], side[a:b] if side[a] >= 0 else None, least), np.int64).reshape(-1, 2) + a
                if len(pairs):
                    yield _edges(cid[pairs[:, 0]], cid[pairs[:, 1]])

    return tidy(run)


def _confirmed(share: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cut in _whole_groups(batches, "task"):
            every, signatures, sides, own = table.column("cid").to_numpy(), _signatures(table), _sides(table), table.column("own")
            for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
                cid, at = np.unique(every[a:b], return_index=True)  # rows that share id and text come twice
                if len(cid) < 2:
                    continue
                at += a
                sets = [frozenset(np.frombuffer(own[i].as_py(), np.uint64).tolist()) for i in at.tolist()]

                def linked(x: int, y: int) -> bool:
                    both = len(sets[x] & sets[y])
                    return OF * both >= share * (len(sets[x]) + len(sets[y]) - both)

                pairs = np.array(_tree(signatures[at], sides[at] if sides[a] >= 0 else None, share / OF - MARGIN, linked), np.int64).reshape(-1, 2)
                if len(pairs):
                    yield _edges(cid[pairs[:, 0]], cid[pairs[:, 1]])

    return tidy(run)


@tidy
def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        own = distinct_sets(*shingles(*column_bytes(part.column("text"))))
        yield pa.record_batch({"cid": part.column("cid"), "cluster": part.column("cluster"), "signature": part.column("signature"), "own": pa.array([x.tobytes() for x in own], pa.binary())})


def _tasks(rows: DataFrame) -> DataFrame:
    return rows.repartition("task").sortWithinPartitions("task")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = SHARE, keep_body: bool = False) -> DataFrame:
    """(id, n_shingles, component_id, kept[, body]) of each row; ``kept`` marks one row
    of each component, that of the smallest id; ``keep_body`` adds the text's hash."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("body", F.xxhash64("text"))
    sketch = staged(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "body", "text").mapInArrow(_sketch, _SKETCH), "sketch")
    leaders = sketch.where(F.col("rid") == F.col("leader"))
    classes = staged(leaders.where(F.col("keyed").isNotNull()).groupBy("keyed").agg(F.min_by(F.struct("rid", "doc_id", "body", "bands", "signature"), "rid").alias("c")).select("keyed", "c.*").withColumnRenamed("rid", "cid"), "classes")

    # candidate clusters
    buckets = classes.select("cid", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = aggregated_join(buckets, shared.select("bucket"), "bucket").join(classes.select("cid", "signature"), "cid")
    members, sizes = _without_common_buckets(members.select(F.col("bucket").alias("group"), "cid", "signature"), shared.select(F.col("bucket").alias("group"), F.col("n").alias("members")))
    pool, near = _against_pivots(members, sizes, "signature", _judge_estimates, _by_estimate(share))
    tree = _tasks(blocked(pool, "group", "cid").select("task", "side", "cid", "signature")).mapInArrow(_estimated(share), "u long, v long")
    clusters = connected_components(functools.reduce(DataFrame.union, near, tree))

    # links confirmed on full sets
    wanted = clusters.join(classes, F.col("node") == F.col("cid")).select("cid", F.col("component").alias("cluster"), F.col("doc_id").alias("wid"), F.col("body").alias("wbody"), "signature")
    texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("wid")) & (F.col("body") == F.col("wbody"))).select("cid", "cluster", "signature", "text")
    sets = staged(texts.mapInArrow(_sets, "cid long, cluster long, signature binary, own binary"), "sets")
    sets = sets.withColumnRenamed("cluster", "group")
    pool, near = _against_pivots(sets, sets.groupBy("group").agg(F.count("*").alias("members")), "own", _judge_sets(share), _by_sets(share))
    links = _tasks(blocked(pool, "group", "cid").select("task", "side", "cid", "signature", "own")).mapInArrow(_confirmed(share), "u long, v long")
    linked = connected_components(functools.reduce(DataFrame.union, near, links))

    # every row: leader -> class -> component -> smallest id
    of_class = classes.join(linked, F.col("cid") == F.col("node"), "left").select("keyed", F.coalesce("component", "cid").alias("part"))
    of_leader = leaders.select("rid", "keyed").join(of_class, "keyed", "left").select(F.col("rid").alias("leader"), F.coalesce("part", "rid").alias("part"))
    rows = staged(sketch.select("rid", "doc_id", "body", "n_shingles", "leader").join(of_leader, "leader").drop("leader"), "rows")
    first = rows.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("least")).select(F.col("part"), F.col("least.doc_id").alias("component_id"), F.col("least.rid").alias("first_rid"))
    return aggregated_join(rows, first, "part").select(F.col("doc_id").alias(id_col), "n_shingles", "component_id", (F.col("rid") == F.col("first_rid")).alias("kept"), *(["body"] if keep_body else []))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = SHARE) -> DataFrame:
    """The rows of ``df`` that are kept, with all of their columns (rows that
    share id and text are kept or dropped together)."""
    kept = near_duplicates(df, id_col, text_col, share, keep_body=True).where("kept").select(F.col(id_col).alias("kept_id"), "body").distinct()
    body = F.xxhash64(F.coalesce(df[text_col].cast("string"), F.lit("")))
    return df.join(kept, df[id_col].cast("long").eqNullSafe(kept["kept_id"]) & (body == kept["body"]), "left_semi")
