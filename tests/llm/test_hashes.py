"""Texts that weaker hashes take for one another."""

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from relq.llm import arrays, minhash, simhash, suffix_dedup

P = (1 << 61) - 1


def thue_morse(n, letters="ab"):
    bits = [0]
    while len(bits) < n:
        bits += [1 - b for b in bits]
    return "".join(letters[b] for b in bits[:n])


# equal under a polynomial modulo 2^64, whatever its base
TWINS = [(thue_morse(1024), thue_morse(1024, "ba")), ("q" * 388 + "xwxxbwzcmixr", "q" * 388 + "mlvhpmsfyhwp")]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, P - 1), min_size=1, max_size=20), st.integers(0, P - 1))
def test_field_products(values, by):
    got = arrays._times(np.array(values, np.uint64), np.uint64(by))
    assert got.tolist() == [v * by % P for v in values]


def test_prefix_sums_over_several_blocks():
    data = np.random.default_rng(1).integers(0, 256, 3 * arrays._BLOCK + 77).astype(np.uint8)
    sums = arrays.prefix_hash(data)
    power, total = 1, 0
    for i, x in enumerate(data.tolist()):
        total, power = (total + (x + 1) * power) % P, power * arrays._BASE % P
        if i % 5003 == 0 or i == len(data) - 1:
            assert int(sums[i + 1]) == total
    data[arrays._BLOCK * 2 + 10:arrays._BLOCK * 2 + 500] = data[5:495]
    sums = arrays.prefix_hash(data)
    start = np.array([5, arrays._BLOCK * 2 + 10])
    one, other = arrays.span_hash(sums, start, start + 490)
    assert one == other and arrays.span_hash(sums, start, start + 489)[0] != one


@pytest.mark.parametrize(("a", "b"), TWINS)
def test_twins_differ(spark, a, b):
    data = np.frombuffer((a + b).encode(), np.uint8)
    sums = arrays.prefix_hash(data)
    ends = np.array([len(a), len(data)])
    one, other = arrays.span_hash(sums, np.array([0, len(a)]), ends)
    assert one != other
    docs = spark.createDataFrame([(1, f"{a} the same words follow here"), (2, f"{b} the same words follow here")], "doc_id long, text string")
    assert [r["component_id"] for r in minhash.near_duplicates(docs).orderBy("doc_id").collect()] == [1, 2]
    texts = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    assert len({r["fingerprint"] for r in simhash.compare_neighbours(texts).collect()}) == 2
    want = [(i, 0, t) for i, t in ((1, a), (2, b))] if len(a) == 400 else None
    if want:
        assert sorted((r["doc_id"], r["n_removed"], r["text"]) for r in suffix_dedup.remaining(texts).collect()) == want


def test_strings_of_one_hash_are_compared(monkeypatch):
    """The merge's last step with a hash that hardly tells anything."""
    rng = random.Random(2)
    base = [bytes(rng.choices(b"abcd", k=700)) for _ in range(3)]
    members = []
    for k, b in enumerate([base[0], base[0][:650] + base[1][:50], base[1], base[2], base[2]]):
        members.append((0, b[:120], b[120:], k, 10))
    true = suffix_dedup._repeats(members).to_pylist()
    assert true
    monkeypatch.setattr(suffix_dedup, "span_hash", lambda p, s, e: arrays.span_hash(p, s, e) & np.uint64(7))
    monkeypatch.setattr(suffix_dedup, "mix", lambda h: h & np.uint64(15))
    assert suffix_dedup._repeats(members).to_pylist() == true


def test_remaining_text(spark):
    passage = "é".join("abcdefghij"[i % 10] * (i % 7 + 1) for i in range(200))
    rows = [(1, "start " + passage + " end"), (2, "other " + passage), (3, "plain"), (4, None), (5, passage), (5, passage), (5, "plain too"), (None, "")]
    starts = {}
    for n, (_, text) in enumerate(rows):
        raw = (text or "").encode()
        for at in range(len(raw) - suffix_dedup.LENGTH + 1):
            starts.setdefault(raw[at:at + suffix_dedup.LENGTH], []).append((n, at))
    want = []
    for n, (i, text) in enumerate(rows):
        raw = (text or "").encode()
        gone = {b for places in starts.values() if len(places) > 1 for m, at in places if m == n for b in range(at, at + suffix_dedup.LENGTH)}
        left = bytes(x for k, x in enumerate(raw) if k not in gone).decode(errors="ignore")
        want.append((i, len(raw), len(gone), None if text is None else left))
    got = suffix_dedup.remaining(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["text"]) for r in got), key=str) == sorted(want, key=str)
    assert sum(r["n_removed"] > 0 for r in got) == 4


def test_a_very_long_text_in_pieces(spark):
    """Whatever the pieces, the same strings go: of texts longer than several of them."""
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(20_000)]
    text = " ".join(rng.choices(words, k=500_000))  # about 3 MB
    passage = text[1_000_000:1_003_000]
    rows = [(1, text + passage + " end"), (2, "start " + passage), (3, text[:600]), (4, "other words " * 3)]
    got = {r["doc_id"]: r for r in suffix_dedup.remaining(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["text"] == text[600:1_000_000] + text[1_003_000:] + " end" and got[1]["n_spans"] == 3
    assert got[2]["text"] == "start " and got[3]["text"] == "" and got[4]["n_removed"] == len(rows[3][1]) * (len(rows[3][1]) > 800)


def test_pieces_have_every_start_once():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 103, 3 * suffix_dedup._SLICE + 1234).astype(np.uint8)
    offsets = np.array([0, len(data)])
    whole = suffix_dedup.anchors(data, offsets)[0]
    parts = [(s + before, p + before) for d, o, before in suffix_dedup._pieces(data, offsets) for s, _, p in [suffix_dedup.anchors(d, o)[0]]]
    assert np.array_equal(np.concatenate([s for s, _ in parts]), whole[0]) and np.array_equal(np.concatenate([p for _, p in parts]), whole[2])
