"""Nulls, empty and very long texts, repeats, empty tables, clashing columns."""

import hashlib
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from relq.llm import bpe, exact_dedup, html_main, langid, license_scan, minhash, packing, simhash, suffix_dedup, url_filter

JSON = Path(public_tokenizers.path("word_bpe_49k.json")).read_text()


@pytest.fixture(scope="module")
def ranks(spark):
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def local(df):
    return [(r["doc_id"], r["text"] or "") for r in df.collect()]


def test_simhash(docs, no_docs):
    got = simhash.compare_neighbours(docs).collect()
    rows = sorted(local(docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert len(got) == len(rows)
    want = {}
    for (i, t), (_, following) in zip(rows, rows[1:] + rows[:1]):
        want.setdefault(i, []).append((len(t), hashlib.sha256(simhash.edited(t, following).encode()).hexdigest()))
    have = {}
    for r in got:
        have.setdefault(r["doc_id"], []).append((r["n_chars"], r["edited_sha256"]))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    prints = {r["doc_id"]: r["fingerprint"] for r in got}
    assert prints[2] == prints[3] == prints[4] == "0" * 32 and prints[6] == prints[7] and prints[1] == prints[5]
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert next(r["near_next"] for r in got if r["doc_id"] == 6) == 1.0
    assert simhash.compare_neighbours(no_docs).count() == 0
    assert simhash.fingerprint_texts(docs).count() == len(rows)


def test_packing(docs, no_docs):
    from tokenizers import Tokenizer

    reference = Tokenizer.from_str(JSON)
    got = packing.pack_documents(docs, JSON).collect()
    want = []
    for i, t in local(docs):
        ids = [*reference.encode(t, add_special_tokens=False).ids, 1]
        want += [(i, n, at, len(ids[at:at + 4096]), zlib.crc32(np.array(ids[at:at + 4096], "<u4").tobytes())) for n, at in enumerate(range(0, len(ids), 4096))]
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by_sequence.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(by_sequence) == -(-sum(r["length"] for r in got) // 4096)
    assert packing.pack_documents(no_docs, JSON).count() == 0


def test_exact_dedup(docs, no_docs):
    import re

    got = exact_dedup.dedup(docs).collect()
    groups = {}
    for i, t in local(docs):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), []).append(i)
    want = sorted((i is None, i or 0, min((x for x in own if x is not None), default=None), len(own), hashlib.sha256(t.encode()).hexdigest()) for t, own in groups.items() for i in own)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    assert sum(r["kept"] for r in got) == len(groups)
    kept = exact_dedup.deduplicated(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in got if r["kept"]}
    assert exact_dedup.dedup(no_docs).count() == 0 and exact_dedup.deduplicated(no_docs).count() == 0


def test_license_scan(docs, no_docs):
    got = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    assert license_scan.scan(docs).count() == docs.count() and license_scan.scan(no_docs).count() == 0
    assert (got[16]["n_base"], got[16]["first_word"], got[16]["last_word"], got[16]["base_labels"], got[16]["score"]) == (2, 3, 6, "cc-by,mit", 1.0)
    assert [(got[i]["n_words"], got[i]["n_base"], got[i]["first_word"], got[i]["labels"], got[i]["score"]) for i in (2, 3, 4)] == [(0, 0, None, "", 0.0)] * 3


def test_langid(docs, no_docs):
    net = langid.fit(docs)
    got = langid.predict(docs, net).collect()
    assert len(got) == docs.count()
    by = {r["doc_id"]: r for r in got}
    assert by[2]["lang_pred"] == by[3]["lang_pred"] == by[4]["lang_pred"] == "und" and by[2]["score"] == 0.0
    assert by[6]["lang_pred"] == "en" and by[None]["held_out"] is False
    assert all(by[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in by if i is not None)
    assert langid.identify(no_docs).count() == 0
    unknown = langid.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in unknown.collect()} == {"und"}
    kept = langid.accepted(docs, net)
    assert kept.columns == docs.columns and {2, 3, 4}.isdisjoint(r["doc_id"] for r in kept.collect())


def test_minhash(docs, no_docs):
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == docs.count() and minhash.near_duplicates(no_docs).count() == 0
    by = {r["doc_id"]: r for r in got}
    assert (by[2]["n_shingles"], by[2]["component_id"], by[2]["kept"], by[4]["n_shingles"]) == (0, 2, True, 0)
    assert [by[i]["component_id"] for i in (1, 5, 6, 7, 8, 9, 10, 12)] == [1, 1, 6, 6, 6, 9, 9, 12]
    assert by[9]["n_shingles"] == 1 and by[15]["n_shingles"] == 1 and by[None]["component_id"] is None
    kept = minhash.one_of_each(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} >= {1, 6, 9, 12, None}
    assert minhash.one_of_each(no_docs).count() == 0


def test_bpe(docs, no_docs, ranks):
    import tiktoken

    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, keep_ids=True)
    got = sorted((r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in encoded.collect())
    want = []
    for i, t in local(docs):
        ids = reference.encode_ordinary(t)
        want.append((i or 0, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert got == sorted(want)
    back = bpe.decode(encoded, ranks, public_tokenizers.PATTERN)
    assert sorted((r["doc_id"] or 0, r["text"]) for r in back.collect()) == sorted((i or 0, t) for i, t in local(docs))
    assert bpe.encode(no_docs, ranks, public_tokenizers.PATTERN).count() == 0


def test_suffix_dedup(docs, no_docs):
    got = suffix_dedup.remove_repeats(docs)
    assert got.count() == docs.count() and suffix_dedup.remove_repeats(no_docs).count() == 0
    by = {r["doc_id"]: r for r in got.collect()}
    assert (by[2]["n_bytes"], by[2]["n_removed"], by[2]["kept_sha256"]) == (0, 0, hashlib.sha256(b"").hexdigest())
    assert by[6]["n_removed"] == by[6]["n_bytes"] and by[6]["n_spans"] == 1
    assert by[15]["n_removed"] == by[15]["n_bytes"] and by[9]["n_removed"] == 0
    left = suffix_dedup.without_repeats(docs)
    assert left.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in left.collect()}
    assert texts[2] is None and texts[6] == "" and texts[12].startswith("a start here") and texts[12].endswith("and an end") and len(texts[12]) < 40


def test_without_repeats_takes_one_python_worker_a_task(spark, docs):
    """A second one in a stage would stay with the executor, idle, for the stages that follow."""
    left = suffix_dedup.without_repeats(docs)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and plan.split("Exchange")[0].count("MapInArrow") == 1
    want = {(r["doc_id"], r["text"]) for r in suffix_dedup.remaining(docs).collect()}
    assert {(r["doc_id"], r["text"]) for r in left.collect()} == want
    # columns of any type
    passage = "é" * 150 + "".join(chr(0x400 + i * 7 % 200) for i in range(120))
    rows = [(1, None, "a" + passage + "b", [1, 2]), (2, 0.5, "c" + passage + "d", None), (3, 1.0, passage[2:] * 2, []), (3, 1.0, passage[2:] * 2, []), (None, 2.0, None, [3])]
    typed = spark.createDataFrame(rows, "doc_id int, x double, text string, y array<long>")
    left = suffix_dedup.without_repeats(typed)
    assert left.dtypes == typed.dtypes
    want = [(1, None, "ab", [1, 2]), (2, 0.5, "cd", None), (3, 1.0, "", []), (3, 1.0, "", []), (None, 2.0, None, [3])]
    assert sorted(map(str, map(tuple, left.collect()))) == sorted(map(str, want))


def test_language_bounds_start_no_python_workers(spark, docs, monkeypatch):
    """Rows of Python objects would be pickled by workers of their own on each executor."""
    from pyspark import SparkContext

    want = langid.fit(docs).languages
    monkeypatch.setattr(SparkContext, "parallelize", None)
    assert langid.fit(docs).languages == want == ["en"]


def test_pages(spark):
    rows = [(1, "http://Sub.Example.org/es/x?q", "<p>x"), (2, None, None), (3, "no scheme", ""), (3, "no scheme", ""),
            (None, "https://a.com", "<article>" + "<p>word word word</p>" * 20000 + "</article>"), (4, "ftp://example.org/en/1#f", "<script>if (a < b) {}"), (5, "x://com/de/", "<!-- only a comment")]
    pages = spark.createDataFrame([(*r, "k", "r") for r in rows], "page_id long, url string, html string, keys string, rule string")
    rules = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
    got = {(r["page_id"], r["host"], r["path"]): (r["rule"], r["verdict"]) for r in url_filter.judge(pages, rules).collect()}
    assert got[1, "sub.example.org", "/es/x"] == ("example.org/es/", "block")
    assert got[2, "", ""] == got[3, "", ""] == (None, "allow") and got[None, "a.com", ""] == (None, "allow")
    assert got[4, "example.org", "/en/1"] == ("example.org/en/1", "block") and got[5, "com", "/de/"] == ("com/de/", "block")
    assert url_filter.judge(pages, rules).count() == 7 and url_filter.judge(pages.limit(0), rules).count() == 0
    assert url_filter.judge(pages, []).where("verdict = 'allow' and rule is null").count() == 7
    texts = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_main.extract(pages).collect()}
    assert texts[1] == ("x", 1) and texts[2] == texts[3] == texts[4] == texts[5] == ("", 0)
    assert texts[None][0] == "\n".join(["word word word"] * 20000)
    assert html_main.extract(pages.limit(0)).count() == 0


def test_pipeline_runs_on_edge_tables(spark, docs, no_docs, tmp_path):
    """Written and read again between stages: clashing columns, nulls, long texts, repeats; and no rows."""
    import corpus_pipeline

    docs.write.parquet(f"{tmp_path}/some/documents.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_path}/some").collect()
    ids = [r["doc_id"] for r in got if r["piece"] == 0]
    assert {2, 3, 4}.isdisjoint(ids) and ids.count(17) == 1 and ids.count(9) + ids.count(10) == 1 and {1, 12, 19} <= set(ids)
    assert sum(i in (6, 7, 8) for i in ids) == 1 and {13, 14}.isdisjoint(ids)  # near copies of 12
    no_docs.write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_a_shared_folder_is_asked_for_off_local_mode(monkeypatch):
    from types import SimpleNamespace

    from relq.llm import staging

    none = SimpleNamespace(isDefined=lambda: False)
    context = SimpleNamespace(master="spark://host:7077", _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: none)))
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_folder(session)
