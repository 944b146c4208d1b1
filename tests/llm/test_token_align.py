"""Alignment of two tokenizers' tokens against the libraries and plain loops."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from relq.llm import queries, token_align as V

with open(P.path("byte_bpe_50k.json")) as f:
    A_JSON = f.read()
with open(P.path("piece_bpe_32k.model"), "rb") as f:
    B_MODEL = f.read()
REFERENCE_A = Tokenizer.from_str(A_JSON)
REFERENCE_A.encode_special_tokens = True
REFERENCE_B = sentencepiece.SentencePieceProcessor(model_proto=B_MODEL)
LETTERS = V.byte_letters()
A_BYTES = {i: bytes(LETTERS[c] for c in t) for t, i in REFERENCE_A.get_vocab().items() if i < 50256}
SIGNS = ["a", "b", "X", " ", "  ", "\n", "\t", "\r", "é", "é", "İ", "Ω", "数", "́", "<|endoftext|>", "\x1c", "\xa0", "　", "-", "_", "'s", "9", "12", "<s>", "<unk>",
         "▁", "😀", "\x00", "\x85", " ", "​", "word", "the", " the", "\n\n", " \n ", "<0x0A>"]


def b_bytes(i):
    piece = REFERENCE_B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if REFERENCE_B.is_byte(i) else piece.replace("▁", " ").encode()


def brute(docs):
    """The whole result, from whole texts and byte by byte."""
    aligned, count = [], collections.Counter()
    for i, text in docs:
        aligned.append((i, None))
        if not text:
            continue
        raw = (" " + text).encode()
        a = REFERENCE_A.encode(" " + text, add_special_tokens=False).ids
        b = REFERENCE_B.encode(text)
        if b"".join(A_BYTES[k] for k in a) != raw or b"".join(map(b_bytes, b)) != raw:
            continue
        of_a = [n for n, k in enumerate(a) for _ in A_BYTES[k]]  # the token of each byte
        of_b = [n for n, k in enumerate(b) for _ in b_bytes(k)]
        links = [(a[x], b[y]) for x, y in sorted(set(zip(of_a, of_b)))]
        groups, start = [], 0
        for at in range(1, len(raw) + 1):
            if at == len(raw) or of_a[at] != of_a[at - 1] and of_b[at] != of_b[at - 1]:
                show = lambda of, ids: ",".join(str(ids[n]) for n in sorted(set(of[start:at])))
                groups.append(f"{show(of_a, a)}|{show(of_b, b)}")
                start = at
        count.update(set(links))
        aligned[-1] = (i, (len(a), len(b), groups, links))
    most = collections.Counter()
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for i, found in aligned:
        if found is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, groups, links = found
            out.append((i, n_a, n_b, len(groups), len(links), sum(count[x] == most[x[0]] for x in links), sum(count[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def mixed(seed, n):
    rng = random.Random(seed)
    return [(i, "".join(rng.choices(SIGNS, k=rng.randint(1, 40)))) for i in range(n)]


def test_align_equals_brute_force(spark):
    sample = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars < 4000").collect()]
    docs = sample + [(10_000 + i, t) for i, t in mixed(1, 1500)] + [(1, None), (2, ""), (3, " "), (3, " "), (None, "the end"), (None, "the end "), (4, "\n"), (5, "\nx\n"), (6, "\t\t a  ")]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, block int, pair string").repartition(5)
    assert result(V.align(df, A_JSON, B_MODEL)) == brute(docs)


def test_blocks_and_memo_do_not_change_results(spark, monkeypatch):
    docs = mixed(2, 400)
    want = brute(docs)
    pair = V.Aligner(V.TokenPair(A_JSON, B_MODEL))
    monkeypatch.setattr(V, "MEMO_BYTES", 1 << 14)
    for size in (7, 400):
        aligned = [d for at in range(0, len(docs), size) for d in V._aligned(pair, [t for _, t in docs[at:at + size]])]
        got = sorted(((i, *d.n.tolist(), int(d.links()[1].sum()), d.groups_sha256()) for (i, _), d in zip(docs, aligned)), key=str)
        assert got == sorted(((r[0], *r[1:5], r[7]) for r in want), key=str)


def test_long_texts_in_pieces(monkeypatch):
    docs = mixed(3, 300)
    text = " and ".join(t for _, t in docs if "▁" not in t)
    aligner = V.Aligner(V.TokenPair(A_JSON, B_MODEL))
    whole = V._aligned(aligner, [text])[0]
    want = [x.tolist() for x in whole.links()], whole.n.tolist(), whole.groups_sha256()
    for size in (10, 500):
        monkeypatch.setattr(V, "PIECE_CHARS", size)
        parts = list(V._pieces(text))
        assert "".join(parts) == " " + text and len(parts) > 3
        own = V._aligned(aligner, [text, "short"])[0]
        assert ([x.tolist() for x in own.links()], own.n.tolist(), own.groups_sha256()) == want
        lost = V._aligned(aligner, [text + " ▁ " + text])[0]
        assert lost.n.tolist() == [0, 0, 0] and lost.groups_sha256() == "" and not len(lost.links()[0])


def test_text_without_white_space_is_one_piece(monkeypatch):
    monkeypatch.setattr(V, "PIECE_CHARS", 100)
    assert list(V._pieces("x" * 1000)) == [" " + "x" * 1000]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 60), max_size=25), st.lists(st.integers(1, 60), max_size=25), st.integers(61, 62)), max_size=5))
def test_shared_cuts_are_the_common_ends(texts):
    a, b, a_first, b_first, base = [], [], [0], [0], 0
    for x, y, end in texts:
        a += [base + e for e in sorted({*x, end})]
        b += [base + e for e in sorted({*y, end})]
        a_first.append(len(a))
        b_first.append(len(b))
        base += end
    a, b = np.array(a, np.int64), np.array(b, np.int64)
    got = V.shared_cuts(a, b, np.array(a_first), np.array(b_first))
    assert a[got].tolist() == np.intersect1d(a, b).tolist()


def test_a_long_interval_without_cuts():
    n = 200_000
    a, b = np.append(np.arange(1, n) * 2, 3 * n), np.append(np.arange(1, n) * 2 + 1, 3 * n)
    assert V.shared_cuts(a, b, np.array([0, n]), np.array([0, n])).tolist() == [n - 1]


def test_numbers_survive_packing():
    for numbers in ([], [0], [1, 255, 256, 2**32 - 1, 7]):
        assert V._unpacked(V._packed(np.array(numbers, np.int64))).tolist() == numbers


def test_tokenizer_a_gives_the_ids_of_its_file():
    """Every character, before and after letters, digits, blanks and signs."""
    pair = V.TokenPair(A_JSON, B_MODEL)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 50_000):
        texts = [f"a{chr(c)}1 {chr(c)}{chr(c)}b  {chr(c)}.{chr(c)}" for c in points[at:at + 50_000:7]]
        assert [e.ids for e in REFERENCE_A.encode_batch(texts, add_special_tokens=False)] == [pair.a.encode_ordinary(t) for t in texts]


def test_unsuited_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        with open(P.path("word_bpe_49k.json")) as f:
            V.TokenPair(f.read(), B_MODEL)


def test_query(spark, tmp_path):
    docs = mixed(4, 200) + [(900, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.REGISTRY["op13_token_align"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert result(got) == brute(docs)
    assert V.align(spark.createDataFrame(docs, "doc_id long, text string").where(F.lit(False)), A_JSON, B_MODEL).count() == 0
