"""Document fingerprints: SimHash over weighted word pairs.

A text's terms are its pairs of neighbouring words (lower-cased A-Z, split at
ASCII white space, with a mark before the first and after the last word).  A
term weighs as many votes as it has bytes, ``MAX_WEIGHT`` at most: long pairs
say more than ``of the``.  Each of the 128 bits of a term's hash votes plus or
minus that weight; the sign of the sum is the fingerprint's bit, a tie is 0.
Weights are integers, so equal texts have equal fingerprints.

Defined results: a null or word-less text has the all-zero fingerprint;
repeated rows are fingerprinted each for itself; the fingerprint of a text
never depends on other rows; an empty table gives no rows; columns other than
id and text are ignored, whatever their names.  A text of any length is one
fingerprint; its words are arrays of about 60 times its bytes while it is read.

``near_pairs`` finds all fingerprints within a Hamming radius k by permuted
block tables: with the bits cut into k + 2 blocks, two fingerprints within
the radius agree on at least two whole blocks, so joining one table for each
choice of two blocks loses none.  ``with_lookups`` looks up every
``LOOKUP_EVERY``-th id among the fingerprints of all rows, within ``RADIUS``
bits (few edited words of a long text; 10 tables).
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from relq.operators.joins import aggregated_join

from .arrays import LOWER, NOT_SPACE, SLICE_BYTES, Words, column_bytes, mix, slices
from .staging import staged

BITS = 128
MAX_WEIGHT = 24
RADIUS, LOOKUP_EVERY = 3, 20
_EDGE = np.uint64(0x5851F42D4C957F2D)
_LEFT = np.uint64(0xD6E8FEB86659FD93)
_SECOND = np.uint64(0xA0761D6478BD642F)
_SIGNS = np.where(np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1) > 0, 1.0, -1.0)


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``BITS // 8`` bytes for each text."""
    n, words = len(offsets) - 1, Words(LOWER[data], offsets, NOT_SPACE)
    count = np.diff(words.first)
    # each row's words with an edge mark before and after: pairs never cross rows
    row = np.arange(n)
    at = np.arange(len(words.hash)) + 2 * words.doc + 1
    size = len(words.hash) + 2 * n
    hashes, length = np.full(size, _EDGE), np.zeros(size, np.int64)
    hashes[at], length[at] = words.hash, words.length
    doc = np.repeat(row, count + 2)
    pair = (doc[1:] == doc[:-1]) & np.repeat(count > 0, count + 2)[1:] if size else np.zeros(0, bool)
    term = mix(hashes[:-1][pair] * _LEFT + hashes[1:][pair])
    weight = np.minimum(length[:-1][pair] + length[1:][pair], MAX_WEIGHT).astype(np.float64)
    doc = doc[1:][pair]
    out = np.zeros((n, BITS // 8), np.uint8)
    for half, bits in enumerate((term, mix(term ^ _SECOND))):
        for k, column in enumerate(np.ascontiguousarray(bits).view(np.uint8).reshape(-1, 8).T):
            votes = np.bincount(doc * 256 + column, weight, n * 256).reshape(n, 256) @ _SIGNS
            out[:, half * 8 + k] = np.packbits(votes > 0, axis=1)[:, 0]
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosine that the share of differing bits stands for, 0 at least."""
    apart = np.unpackbits(a ^ b, axis=1).sum(1) / BITS
    return np.where(apart == 0, 1.0, np.maximum(0.0, np.cos(np.pi * apart)))


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return column_bytes(pa.array(texts, pa.large_string()))


def fingerprint_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint): lower-case hex of each row's fingerprint."""
    def run(batches):
        for part in slices(batches, "text"):
            prints = fingerprints(*column_bytes(part.column("text")))
            yield pa.record_batch({"id": part.column("id"), "fingerprint": pa.array([x.tobytes().hex() for x in prints], pa.string())})

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, fingerprint string").withColumnRenamed("id", id_col)


def near_pairs(queries: DataFrame, prints: DataFrame, radius: int, column: str = "fingerprint") -> DataFrame:
    """All (fingerprint, near) with a query's and a row's distinct fingerprints
    within ``radius`` bits, and their ``distance``.

    Works on distinct fingerprints (copies are joined back by their value), so
    a large group of copies is one row.  Null fingerprints are left out.
    """
    blocks = radius + 2
    edge = [round(i * BITS / 4 / blocks) for i in range(blocks + 1)]  # in hex digits
    tables = list(combinations(range(blocks), 2))

    def keyed(df: DataFrame, name: str) -> DataFrame:
        cut = [F.substring(name, edge[i] + 1, edge[i + 1] - edge[i]) for i in range(blocks)]
        # hashes and raw bytes: half of what the strings would shuffle; distances are compared in full
        keys = F.array(*[F.xxhash64(F.lit(f"{i}-{j}"), cut[i], cut[j]) for i, j in tables])
        return df.select(F.unhex(name).alias(name), F.explode(keys).alias("block"))

    a = queries.select(F.col(column).alias("fingerprint")).where(F.col("fingerprint").isNotNull()).distinct()
    b = prints.select(F.col(column).alias("near")).where(F.col("near").isNotNull()).distinct()
    apart = sum((F.bit_count(F.conv(F.substring("fingerprint", i, 8), 16, 10).cast("long").bitwiseXOR(
        F.conv(F.substring("near", i, 8), 16, 10).cast("long"))) for i in range(1, BITS // 4, 8)), F.lit(0))
    pairs = keyed(a, "fingerprint").join(keyed(b, "near"), "block").select(F.lower(F.hex("fingerprint")).alias("fingerprint"), F.lower(F.hex("near")).alias("near")).withColumn("distance", apart)
    return pairs.where(F.col("distance") <= radius).select("fingerprint", "near", "distance").distinct()


ROWS_PER_RUN, MAX_RUNS = 4_096, 100_000


def _in_runs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows dealt to one task for each run of ascending ids, in order; after a
    run's own rows (extra = 0) come copies of the next run's first rows
    (extra = 1; the last run is followed by the table's first rows).

    Only the cut ids and each run's first id reach the driver: two longs for a
    run, ``MAX_RUNS`` runs at most.  A null id counts as the smallest.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("rank", F.coalesce("id", F.lit(-(1 << 63))))
    runs = max(1, min(MAX_RUNS, -(-rows.count() // ROWS_PER_RUN)))
    share = [i / runs for i in range(1, runs)]
    cuts = np.array(sorted({int(x) for x in rows.approxQuantile("rank", share, 0.2 / runs)}) if share else [], np.int64)

    @F.pandas_udf("int")
    def run_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ids.to_numpy(), "right").astype(np.int32))

    rows = rows.withColumn("run", run_of("rank"))
    heads = sorted((r["head"], r["run"]) for r in rows.select("rank", "run").groupBy("run").agg(F.min("rank").alias("head")).collect())
    head = np.array([h for h, _ in heads], np.int64)
    before = np.array([heads[i - 1][1] for i in range(len(heads))], np.int32)

    @F.pandas_udf("int")
    def run_before(ids: pd.Series) -> pd.Series:
        at = np.minimum(np.searchsorted(head, ids.to_numpy()), len(head) - 1)
        return pd.Series(np.where(head[at] == ids.to_numpy(), before[at], -1).astype(np.int32))

    at = F.array(F.struct(F.col("run").alias("run"), F.lit(0).alias("extra")), F.struct(run_before("rank").alias("run"), F.lit(1).alias("extra")))
    if not heads:
        at = F.array(F.struct(F.col("run").alias("run"), F.lit(0).alias("extra")))
    dealt = rows.withColumn("at", F.explode(at)).select("id", "rank", "text", "at.run", "at.extra").where("run >= 0")
    return dealt.repartitionById(runs, F.col("run")).sortWithinPartitions("run", "extra", "rank", "text")


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter of code points replaced by as many (or
    all) of the first ones of ``following``."""
    q = len(text) // 4
    return text[:len(text) - q] + following[:q]


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(block: list[tuple[int | None, str]], following: str) -> pa.RecordBatch:
    ids, texts = [i for i, _ in block], [t for _, t in block] + [following]
    own = fingerprints(*_joined(texts))
    changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
    other = fingerprints(*_joined(changed))
    return pa.record_batch({
        "doc_id": pa.array(ids, pa.int64()), "n_chars": pa.array([len(t) for t in texts[:-1]], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
        "fingerprint": pa.array([x.tobytes().hex() for x in own[:-1]], pa.string()),
        "edited_fingerprint": pa.array([x.tobytes().hex() for x in other], pa.string()),
        "near_edited": pa.array(likeness(own[:-1], other), pa.float64()), "near_next": pa.array(likeness(own[:-1], own[1:]), pa.float64()),
    })


def compare_neighbours(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's fingerprint against that of its edited text and of the next
    row's text in ascending id (after the last: the first).

    Rows that share an id follow each other in the order of their texts.
    """
    def run(batches):
        block, size, ended = [], 0, False
        for part in slices(batches, "text"):
            texts = part.column("text").to_pylist()
            for i, text, extra in zip(part.column("id").to_pylist(), texts, part.column("extra").to_pylist()):
                if ended:
                    break
                text = text or ""
                if extra or size >= SLICE_BYTES:
                    yield _compare(block, text)
                    block, size, ended = [], 0, bool(extra)
                block.append((i, text))
                size += len(text)

    out = _in_runs(df, id_col, text_col).select("id", "text", "extra").mapInArrow(run, SCHEMA)
    return out.withColumnRenamed("doc_id", id_col)


def with_lookups(compared: DataFrame, id_col: str = "doc_id", radius: int = RADIUS, every: int = LOOKUP_EVERY) -> DataFrame:
    """``compared`` and ``n_within``: for ids that ``every`` divides, how many
    other distinct fingerprints of all rows are within ``radius`` bits of the
    row's own; null for other ids."""
    rows = staged(compared, "simhash")  # read for lookups, tables and the result
    asked = F.coalesce(F.col(id_col) % every == 0, F.lit(False))
    pairs = near_pairs(rows.where(asked), rows, radius).where("distance > 0")
    found = pairs.groupBy(F.col("fingerprint").alias("near_of")).agg(F.count("*").alias("n_within"))
    own = aggregated_join(rows.where(asked), found, "fingerprint", "near_of", how="left").drop("near_of")
    return own.withColumn("n_within", F.coalesce("n_within", F.lit(0).cast("long"))).unionByName(rows.where(~asked).withColumn("n_within", F.lit(None).cast("long")))
