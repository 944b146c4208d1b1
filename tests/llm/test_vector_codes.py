"""Vector codes against a plain k-means, and the curve they are sorted along."""

import hashlib
import itertools
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from relq.llm import queries, vector_codes as V

DIMS = 16


def brute(rows, parts=V.PARTS, entries=V.ENTRIES, rounds=V.ROUNDS):
    """Codes, errors, error by label, digest: all points against all entries."""
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = [[v[p * width:(p + 1) * width] for _, v, _ in kept] for p in range(parts)]
    books = [[list(x) for x in cut[p][:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = [nearest(x, books[p])[1] for x in cut[p]]
            for k in range(len(books[p])):
                if members := [x for x, o in zip(cut[p], own) if o == k]:
                    books[p][k] = [sum(c) // len(members) for c in zip(*members)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, by_label = [], {}
    for n, (i, _, label) in enumerate(kept):
        best = [nearest(cut[p][n], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), label))
        by_label[label] = by_label.get(label, 0) + out[-1][2]
    return [(i, code, error, by_label[label], digest) for i, code, error, label in out]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, code string, id int").repartition(4)


def result(df):
    return sorted((tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def vectors(n, seed, spread=1.0, dims=DIMS):
    rng = random.Random(seed)
    f32 = lambda x: float(np.float32(x))
    return [[f32(rng.gauss(rng.choice([-1, 0, 2]), spread)) for _ in range(dims)] for _ in range(n)]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_codes_equal_brute_force(spark):
    own = vectors(300, 1)
    rows = [(i, v, [None, 1, 1, 2][i % 4]) for i, v in enumerate(own)]
    rows += [(1000 + i, own[7], 5) for i in range(200)]  # one vector many times
    rows += [(2000, None, 1), (2001, [None] + own[0][1:], 1), (2002, [float("nan")] + own[0][1:], None), (2003, own[0][:-1] + [float("-inf")], 2)]
    rows += [(None, own[3], None), (None, own[4], None), (17, own[17], 2), (17, own[17], 2)]
    assert result(V.encode(frame(spark, rows))) == order(brute(rows))


@pytest.mark.parametrize("spread", [0.0, 0.001, 30.0])
def test_blocks_with_one_or_many_candidates(spark, spread):
    rows = [(i, v, i % 3) for i, v in enumerate(vectors(260, 2, spread))]
    assert result(V.encode(frame(spark, rows))) == order(brute(rows))


def test_fewer_vectors_than_entries_and_other_parts(spark):
    rows = [(i, v, None) for i, v in enumerate(vectors(5, 3))]
    assert result(V.encode(frame(spark, rows))) == order(brute(rows))
    many = [(i, v, None) for i, v in enumerate(vectors(90, 4))]
    assert result(V.encode(frame(spark, many), parts=4, entries=7, rounds=3)) == order(brute(many, 4, 7, 3))


def test_empty_tables(spark):
    assert V.encode(frame(spark, [(1, None, 1)]).limit(0)).count() == 0
    assert V.encode(frame(spark, [(1, None, 1), (2, [None] * DIMS, 2)])).count() == 0


def test_lengths_and_sizes_that_cannot_be_coded(spark):
    for rows in ([(1, [1.0] * 15, 1)], [(1, [1.0] * 16, 1), (2, [1.0] * 24, 1)], [(1, [1e30] * 16, 1)]):
        with pytest.raises(Exception, match="components|lengths|too large"):
            V.encode(frame(spark, rows)).count()


def test_result_does_not_depend_on_chunks(spark, monkeypatch):
    rows = [(i, v, i % 2) for i, v in enumerate(vectors(400, 5))]
    whole = result(V.encode(frame(spark, rows).coalesce(1)))
    assert result(V.encode(frame(spark, rows).repartition(9))) == whole


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_curve_steps_to_neighbours(monkeypatch, dims, bits):
    monkeypatch.setattr(V, "_KEY_BITS", dims * bits)
    grid = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = V.hilbert_keys(grid)
    assert sorted(keys.tolist()) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_shortlists_hold_every_nearest_entry():
    rng = np.random.default_rng(6)
    points = rng.integers(-3000, 3000, (1000, 2)).astype(np.int32)
    blocks = V.Blocks.of(points[np.argsort(V.hilbert_keys(points))])
    book = rng.integers(-3000, 3000, (16, 2))
    short = blocks.shortlists(book)
    true = ((blocks.points[:, None].astype(np.int64) - book) ** 2).sum(2)
    at, entry, distance = blocks.nearest(book, short, np.arange(len(blocks.size)))
    assert (entry == true.argmin(1)).all() and (distance == true.min(1)).all() and (at == np.arange(1000)).all()
    assert short.mean() < 0.7  # boxes do leave entries out


def test_sql_says_the_same(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    got = queries.REGISTRY["op11_vector_codes"](spark, folder)
    want = con.execute(queries.SQL["op11_vector_codes"])
    assert [c[0] for c in want.description] == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_label_types(spark):
    rows = [(i, v, i % 2) for i, v in enumerate(vectors(40, 8))]
    as_text = V.encode(frame(spark, rows).withColumn("label", F.when(F.col("label") == 1, "=").otherwise(F.lit(None))))
    assert {(r["label"]) for r in as_text.collect()} == {"=", None}
    assert sorted(r[:4] for r in result(as_text)) == sorted(r[:4] for r in result(V.encode(frame(spark, rows))))
