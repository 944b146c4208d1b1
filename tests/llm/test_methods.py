"""The methods against brute force on small inputs."""

import math
import random
import time

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from relq.llm import bpe, exact_dedup, html_main, langid, license_scan, minhash, packing, queries, simhash, suffix_dedup, url_filter
from relq.llm.arrays import column_bytes
from relq.llm.components import connected_components


def buffers(texts):
    return column_bytes(pa.array(texts, pa.string()))


def test_near_pairs_equal_brute_force(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(128) for _ in range(30)]
    prints = base + [b ^ sum(1 << i for i in rng.sample(range(128), k)) for b in base for k in (1, 3, 4, 6)]
    df = spark.createDataFrame([(f"{p:032x}",) for p in prints + prints[:5]] + [(None,)], "fingerprint string")
    got = {(r["fingerprint"], r["near"]): r["distance"] for r in simhash.near_pairs(df, df, 4).collect()}
    want = {(f"{a:032x}", f"{b:032x}"): (a ^ b).bit_count() for a in prints for b in prints if (a ^ b).bit_count() <= 4}
    assert got == want


def test_simhash_query_looks_up_all_fingerprints(spark, tmp_path):
    rng = random.Random(4)
    long = [" ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(600)) for _ in range(6)]
    texts = [t + f" x{k}" * (k > 0) for t in long for k in range(20)] + [None, "", long[0], long[0]]
    rng.shuffle(texts)
    spark.createDataFrame([*enumerate(texts), (None, long[0])], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.REGISTRY["op1_simhash"](spark, str(tmp_path)).collect()
    prints = {int(r["fingerprint"], 16) for r in got}
    assert len(got) == len(texts) + 1 and sum(r["n_within"] or 0 for r in got) > 0
    for r in got:
        own = int(r["fingerprint"], 16)
        want = sum(0 < (own ^ p).bit_count() <= simhash.RADIUS for p in prints) if r["doc_id"] is not None and r["doc_id"] % 20 == 0 else None
        assert r["n_within"] == want


def test_likeness_follows_the_edit():
    rng = random.Random(1)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(200)) for _ in range(30)]
    own = simhash.fingerprints(*buffers(texts))
    other = simhash.fingerprints(*buffers([simhash.edited(a, b) for a, b in zip(texts, texts[1:] + texts[:1])]))
    near, far = simhash.likeness(own, other), simhash.likeness(own, np.roll(own, 1, 0))
    assert near.min() > 0.5 > far.max()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60), st.integers(1, 6))
def test_best_fit_equals_a_plain_search(lengths, limit):
    fast, open_, made = packing.OpenSequences(20, limit), [], 0
    for n in lengths:
        fits = [s for s in open_ if s[0] >= n]
        if fits:
            best = min(s[0] for s in fits)
            number, offset = fast.place(n)
            chosen = next(s for s in open_ if s[1] == number)
            assert chosen[0] == best and offset == 20 - best
            open_.remove(chosen)
            space = best
        else:
            number, offset = fast.place(n)
            assert (number, offset) == (made, 0)
            made, space = made + 1, 20
        if space > n:
            if len(open_) >= limit:
                fullest = min(s[0] for s in open_)
                gone = [s for s in open_ if s[0] == fullest and s[1] not in fast.free.get(fullest, [])]
                open_.remove(gone[0])
            open_.append((space - n, number))
        assert sorted(s[1] for s in open_) == sorted(x for own in fast.free.values() for x in own)


def test_grace_groups_spill_and_compare_contents():
    rng = random.Random(5)
    records = [(rng.choice([1, 1 << 63, rng.getrandbits(64)]), str(rng.randint(0, 60)).encode() * 50, (i,)) for i in range(2000)]
    want = {}
    for h, content, row in records:
        want.setdefault((h, content), []).append(row)
    for memory in (10_000, 1 << 30):
        got = {(h, c): sorted(rows) for h, c, rows in exact_dedup.grace_groups(records, memory)}
        assert got == {k: sorted(v) for k, v in want.items()}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_equal_their_sql(spark, name):
    folder, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    df = queries.REGISTRY[name](spark, folder)
    want = con.execute(queries.SQL[name])
    at = [[d[0] for d in want.description].index(c) for c in df.columns]
    assert sorted(map(tuple, df.collect()), key=str) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=str)


def test_license_blocks_equal_brute_force(spark):
    rng = random.Random(2)
    vocabulary = sorted({w for _, t in license_scan.TEMPLATES for w in t.split()})
    docs = []
    for i in range(120):
        lines = []
        for _ in range(rng.randint(0, 4)):
            words = rng.choice(license_scan.TEMPLATES)[1].split()
            words = [w for w in words if rng.random() < 0.9] + rng.choices(vocabulary, k=rng.randint(0, 5))
            rng.shuffle(words)
            lines.append(rng.choice([" ", ", "]).join(words))
        docs.append((i, "\n".join(lines)))
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in license_scan.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, text in docs:
        labels, score, flat = set(), 0.0, " " + text.replace(",", " ").replace("\n", " ") + " "
        for phrase, label in license_scan.BASE.items():
            if f" {phrase} " in " ".join(flat.split()).join("  "):
                labels.add(label)
                score = 1.0
        for line in text.split("\n"):
            held = set(line.replace(",", " ").split())
            for label, template in license_scan.TEMPLATES:
                own = set(template.split())
                if len(own & held) >= math.ceil(license_scan.THRESHOLD * len(own) - 1e-9):
                    labels.add(label)
                    score = max(score, len(own & held) / len(own))
        assert got[i] == (",".join(sorted(labels)), score), text


WRAPPED = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction"),
    ("bsd", " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions\n * are met:"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that"),
    ("mpl", "# This Source Code Form is subject to the terms of the Mozilla Public\n# License, v. 2.0. If a copy of the MPL was not distributed"),
    ("gpl", "    This program is free software: you can redistribute it and/or modify\n    it under the terms of the GNU General Public License as published by\n    the Free Software Foundation, either version 3"),
]


def _licenses(spark, folder, texts):
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in queries.REGISTRY["op5_license_scan"](spark, str(folder)).collect()}
    return [got[i] for i in range(len(texts))]


def test_wrapped_license_notices(spark, tmp_path):
    prose = "some words of the text that go on\n" * 50
    texts = [around + text + after for _, text in WRAPPED for around, after in (("", ""), (prose, "\n" + prose))]
    assert _licenses(spark, tmp_path, texts) == [(label, 1.0) for label, _ in WRAPPED for _ in range(2)]


def test_notices_of_other_licenses(spark, tmp_path):
    far = "released " + "word " * 3000 + "under " + "word " * 3000 + "the mit " + "word " * 3000 + "license"
    texts = {
        "Released under the Apache License": "apache", "released under the BSD license": "", far: "", "Released under the new license": "",
        "Licensed under the Mozilla Public License, Version 2.0": "", "Licensed under the Educational Community License, Version 2.0": "",
        "This work is licensed under the Eclipse Public License, version 3.": "", "This work is licensed under the GNU Affero General Public License, version 3.": "",
        "This Source Code Form is subject to the terms of the Eclipse Public License, v. 2.0": "",
        "it is released under MIT license terms": "mit", "Licensed under the Apache License,\nVersion 2.0": "apache", "Released under\nthe MIT\nLicense.": "mit",
    }
    assert [labels for labels, _ in _licenses(spark, tmp_path, list(texts))] == list(texts.values())


def test_license_spans_equal_brute_force(spark, tmp_path):
    rng = random.Random(5)
    vocabulary = sorted({w for _, t in license_scan.TEMPLATES for w in t.split()}) + ["other"]
    texts = []
    for _ in range(80):
        words = []
        for _ in range(rng.randint(0, 3)):
            words += rng.choices(vocabulary, k=rng.randint(0, 12))
            words += [w for w in rng.choice(license_scan.TEMPLATES)[1].split() for w in [w] * (rng.random() < 0.9) + ["other"] * (rng.random() < 0.1)]
        texts.append("".join(w + rng.choice([" ", ", ", "\n"]) for w in words))
    for text, (labels, score) in zip(texts, _licenses(spark, tmp_path, texts)):
        words, want, best = text.replace(",", " ").split(), set(), 0.0
        for phrase, label in license_scan.BASE.items():
            if f" {phrase} " in f" {' '.join(words)} ":
                want, best = want | {label}, 1.0
        for label, template in license_scan.TEMPLATES:
            own, n = set(template.split()), license_scan.width(template)
            for at in range(len(words)):
                shared = len(own & set(words[at:at + n]))
                named = license_scan.name_of(template) == "" or f" {license_scan.name_of(template)} " in f" {' '.join(words[at:at + n])} "
                if named and shared >= math.ceil(license_scan.THRESHOLD * len(own) - 1e-9):
                    want, best = want | {label}, max(best, shared / len(own))
        assert (labels, score) == (",".join(sorted(want)), best), text


def test_network_gradients_and_held_out_accuracy(spark):
    net = langid.Network(["a", "b", "c"], 3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, y = np.random.default_rng(0).integers(0, 256, (5, 4)).astype(np.uint8), np.array([0, 1, 2, 1])
    _, grad = net.gradients(x, y)
    for k, at in (("gate_l", (0, 1)), ("gate_r", (2, 4)), ("cand_r", (1, 2)), ("out_l", (0, 1)), ("in_r", (x[0, 0], 2)), ("bias", (1,))):
        net.p[k][at] += 1e-4
        up = net.gradients(x, y)[0]
        net.p[k][at] -= 2e-4
        down = net.gradients(x, y)[0]
        net.p[k][at] += 1e-4
        assert (up - down) / 2e-4 == pytest.approx(grad[k][at], abs=2e-4)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    told = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    share = told.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert share > 0.97


def test_more_than_64_languages(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_TOTAL", 280)
    monkeypatch.setattr(langid, "STEPS", 40)
    alphabet = [chr(0x4E00 + 97 * i) for i in range(140)]
    rows = [(20 * k + j, alphabet[k] * 40 + " " + "ab"[j % 2], f"l{k:03}") for k in range(140) for j in range(12)]
    df = spark.createDataFrame(rows + [(9000, "abc", None)], "doc_id long, text string, lang string")
    net = langid.fit(df)
    assert len(net.languages) == 140
    got = langid.predict(df, net).collect()
    assert len(got) == len(rows) + 1 and all(r["lang_pred"] in net.languages for r in got)


def test_every_byte_of_a_long_text_counts():
    net = langid.Network(["a", "b"], 4)
    text = "abc " * 500
    data, offsets = buffers([text, "", text[:10]])
    scores = langid.document_scores(net, data, offsets)
    raw, total = np.frombuffer(text.encode(), np.uint8), np.zeros(2)
    for at in range(0, len(raw), langid.WINDOW):
        own = raw[at:at + langid.WINDOW][:, None]
        total += net.probabilities(own, own[::-1], np.array([len(own)]))[:, 0].sum(0)
    assert scores[0] == pytest.approx(total / len(raw), abs=1e-6)
    alone = langid.document_scores(net, *buffers([text[:10]]))
    assert scores[2] == pytest.approx(alone[0], abs=1e-6)  # whatever is scored beside it
    assert (scores[1] == 0).all()


def _linked(sets, share):
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= share * len(a | sets[j]):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("block", [4096, 8])
@pytest.mark.parametrize("share", [85, 80])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, share, block):
    rng = random.Random(11)
    texts = []
    for _ in range(6):
        words = [f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(30, 120))]
        for _ in range(12):
            texts.append(" ".join(words))
            words = [w if rng.random() > 0.01 else f"n{rng.randint(0, 5000)}" for w in words]
    monkeypatch.setattr(minhash.blocked, "__defaults__", (block,))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df, share=share).collect()}
    sets = [{tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    assert [got[i] for i in range(len(texts))] == _linked(sets, share)


@pytest.mark.parametrize("share", [85, 60])
def test_hot_groups_of_near_copies_equal_brute_force(spark, monkeypatch, share):
    """Groups far above the block size: chains of copies, some of which only link through others."""
    rng = random.Random(share)
    texts = []
    for size, noise in ((70, 0.002), (50, 0.01), (40, 0.03)):
        start = [f"w{rng.randint(0, 5000)}" for _ in range(100)]
        words = list(start)
        for k in range(size):
            texts.append(" ".join(words))
            words = [w if rng.random() > noise else f"n{rng.randint(0, 5000)}" for w in (words if k % 5 else start)]
    texts += texts[:30] + [None, "", "w1 w2"]
    rng.shuffle(texts)
    sets = [{tuple((t or "").split()[i:i + 5]) for i in range(max(1, len((t or "").split()) - 4))} if (t or "").split() else set() for t in texts]
    want = _linked(sets, share)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for block, rounds in ((6, 4), (6, 1), (512, 4)):
        monkeypatch.setattr(minhash, "BLOCK", block)
        monkeypatch.setattr(minhash, "ROUNDS", rounds)
        monkeypatch.setattr(minhash.blocked, "__defaults__", (block,))
        got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df, share=share).collect()}
        assert [got[i] for i in range(len(texts))] == want


def test_signature_estimates():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    sets = [np.unique(pool[a:a + 1000]) for a in range(0, 1000, 100)]
    least = minhash.minima(np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets]))
    signature = minhash.packed(least).view(np.uint64)
    got = minhash.estimates(signature[:, None], signature[None])
    true = np.array([[len(np.intersect1d(a, b)) / len(np.union1d(a, b)) for b in sets] for a in sets])
    assert np.abs(got - true).max() < 0.15 and np.allclose(np.diag(got), 1)


def test_components_of_long_paths(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 102), (102, 100), (7, 7)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(path, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 104)}}


def test_many_rules_and_keys_of_one_hash(spark, monkeypatch):
    rules = [("block" if i % 3 else "allow", f"site{i}.org/p{i % 7}/") for i in range(20_000)]
    urls = [(i, f"http://www.site{i % 30_000}.org/p{i % 7}/x") for i in range(0, 60_000, 7)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    known = {k: v for v, k in rules}
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge(pages, rules).collect()}
    for i, _ in urls:
        key = f"site{i % 30_000}.org/p{i % 7}/"
        assert got[i] == ((key, known[key]) if key in known else (None, "allow"))
    # a cascade that takes every key for listed: the text decides
    monkeypatch.setattr(url_filter.Cascade, "listed", lambda self, keys: np.ones(len(keys), bool))
    few = url_filter.judge(pages.limit(5), rules[:1]).collect()
    assert [r["rule"] for r in few] == [rules[0][1] if r["host"] == "www.site0.org" and r["path"].startswith("/p0/") else None for r in few]


def test_cascade_is_exact(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BITS_PER_KEY", 2)  # many false positives: many levels
    universe = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("xxhash64(key) % 5 = 0")
    cascade = url_filter.build(listed, universe)
    rows = universe.select("key", F.xxhash64("key").alias("h"), (F.expr("xxhash64(key) % 5 = 0")).alias("inside")).toPandas()
    assert len(cascade.levels) > 3
    assert (cascade.listed(rows.h.to_numpy().astype(np.uint64)) == rows.inside.to_numpy()).all()


def test_perfect_hash_and_merges():
    hashes = np.unique(np.random.default_rng(2).integers(0, 1 << 63, 5000, dtype=np.uint64))
    table = bpe.PerfectHash(hashes)
    assert sorted(table.index(hashes).tolist()) == list(range(len(hashes)))
    import tiktoken

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    own = bpe.Bpe(ranks, public_tokenizers.PATTERN)
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab 's\n\t  é'tre12\x1f\x1c\x85\xa0\u2028!?字😀") for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    for text, ids in zip(texts, own.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text), repr(text)
        assert own.decode(ids) == text.encode()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=6), max_size=12), min_size=1, max_size=6))
def test_loser_tree_merges_and_knows_prefixes(runs):
    coded = [suffix_dedup.decoded(*suffix_dedup.front_coded(sorted(r))) for r in runs]
    last, out = b"", []
    for _, shared, s in suffix_dedup.LoserTree(coded):
        assert shared == suffix_dedup.shared_prefix(last, s, 0)
        out.append(s)
        last = s
    assert out == sorted(s for r in runs for s in r)


@pytest.mark.parametrize("hot", [4096, 3])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdé", k=rng.randint(2, 7)))
    passages = [" ".join(word() for _ in range(n)) for n in (60, 90, 200)]
    texts = []
    for i in range(40):
        parts = [" ".join(word() for _ in range(rng.randint(5, 120)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            parts += [p[rng.randint(0, 40):len(p) - rng.randint(0, 40)], " ".join(word() for _ in range(rng.randint(0, 30)))]
        texts.append(" ".join(parts))
    texts += [texts[0], texts[5], "z" * 1000, "xy" * 300 + "!", passages[2]]
    raw = [t.encode() for t in texts]
    seen = {}
    for i, r in enumerate(raw):
        for at in range(len(r) - 399):
            seen.setdefault(r[at:at + 400], []).append((i, at))
    gone = [np.zeros(len(r), bool) for r in raw]
    for places in seen.values():
        if len(places) > 1:
            for i, at in places:
                gone[i][at:at + 400] = True
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(df, keep_bytes=True).collect()}
    for i, r in enumerate(raw):
        left = np.frombuffer(r, np.uint8)[~gone[i]].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone[i].astype(int)])) == 1).sum())
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"]) == (len(r), int(gone[i].sum()), spans)
        assert left == (r if got[i]["kept"] is None else bytes(got[i]["kept"]))


def test_main_text_of_pages_without_article():
    weight = html_main.weights({})
    page = ("<html><head><title>t</title></head><body><nav><a href=/>Home</a> <a href=/x>About us</a></nav>"
            "<div><h1>Heading</h1><p>First &amp; foremost\n a paragraph of <a href=x>several</a> words, long enough to count.</p>"
            "<form>Your name <input></form><aside>Read this as well</aside>"
            "<p>A second paragraph that goes on for a while, with many more words in it.<ul><li>an item of the list</li></ul></div>"
            "<div id='comments'><p>First!</p></div><footer>All rights reserved</footer></body></html>")
    assert html_main.main_text(page, weight) == (
        "Heading\nFirst & foremost a paragraph of several words, long enough to count.\n"
        "A second paragraph that goes on for a while, with many more words in it.\nan item of the list")


ARTICLE = "<h1>Heading of it</h1><p>First a paragraph of many words, long enough to count as content.</p><p>And then a second one that goes on for a while, with some more words.</p>"
PLAIN = "Heading of it\nFirst a paragraph of many words, long enough to count as content.\nAnd then a second one that goes on for a while, with some more words."
NAV = "<nav><a href=/>Home</a> <a href=/x>About</a></nav>"
SIDE = "<div class=sidebar><p>Most read of all our pages this week</p></div>"


@pytest.mark.parametrize("body", [
    f"<form id=aspnetForm>{NAV}{ARTICLE}<footer>All rights reserved</footer></form>",
    f"{NAV}<div class=content-sidebar-wrap><div>{ARTICLE}</div>{SIDE}</div>",
    f"<form id=aspnetForm>{NAV}<div class='content-sidebar-wrap'><main>{ARTICLE}</main>{SIDE}</div></form>",
    f"<form>{NAV}<div class=content-sidebar-wrap><div>{ARTICLE}</div>{SIDE}</div></form>",
    f"{NAV}<div class='post no-sidebar'>{ARTICLE}</div>{SIDE}",
    f"{NAV}<article class='post no-sidebar'>{ARTICLE}<div class=ad>Buy this now and then buy it again, it is so very good</div></article>{SIDE}",
    f"{NAV}<main class=search-results>{ARTICLE}</main>",
    f"<main>{ARTICLE}</main><div id=comments><article class=comment-body><p>First of all the comments, and one that has many words in it!</p></article></div>",
])
def test_main_text_in_frames(body):
    assert html_main.main_text(f"<html><body>{body}</body></html>", html_main.weights({})) == PLAIN


def test_login_form_adverts_and_comments_are_no_frames():
    weight = html_main.weights({})
    assert html_main.main_text(f"<body>{NAV}<form>Your name <input> Your password <input></form></body>", weight) == ""
    advert = "<div class=ad>Buy this now and then buy it again, it is so very good</div>"
    assert html_main.main_text(f"<body>{NAV}{advert}<article><h1>Short text</h1></article></body>", weight) == "Short text"
    assert html_main.main_text(f"<body>{NAV}{advert}<article></article></body>", weight) == ""
    comments = "<p>One of the many comments on this page, each as long as this.</p>" * 9
    assert html_main.main_text(f"<body><div>{ARTICLE}</div><div id=comments>{comments}</div></body>", weight) == PLAIN


def test_names_around_marked_content_learn_to_speak_for_it(spark):
    pages = spark.createDataFrame([(f"<body><form>{NAV}<article>{ARTICLE}</article></form>{SIDE}</body>",)] * 20, "html string")
    weight = html_main.learn(pages)
    assert weight["<form>"] > 0 > weight["sidebar"] and weight["<nav>"] < 0


def _without_repeats(texts: dict) -> dict:
    seen: dict[bytes, list] = {}
    raw = {i: t.encode() for i, t in texts.items()}
    for i, r in raw.items():
        for at in range(len(r) - 399):
            seen.setdefault(r[at:at + 400], []).append((i, at))
    gone = {i: np.zeros(len(r), bool) for i, r in raw.items()}
    for places in seen.values():
        if len(places) > 1:
            for i, at in places:
                gone[i][at:at + 400] = True
    return {i: np.frombuffer(r, np.uint8)[~gone[i]].tobytes().decode(errors="ignore") for i, r in raw.items()}


def test_pipeline_equals_brute_force(spark):
    import re
    from tokenizers import Tokenizer

    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "near_dedup", "suffix_dedup", "packing"]
    want = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        rows = out.collect()
        if name == "language_id":  # every invented text has letters of a known language
            want = {i: t for i, t in want.items() if any(map(str.isalpha, t))}
        elif name == "exact_dedup":
            first = {}
            for i in sorted(want):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", want[i]), i)
            want = {i: want[i] for i in first.values()}
        elif name == "near_dedup":
            ids = sorted(want)
            low = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), want[i])) for i in ids]
            sets = [{tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for w in low]
            want = {ids[k]: want[ids[k]] for k, root in enumerate(_linked(sets, corpus_pipeline.NEAR)) if root == k}
        else:
            want = _without_repeats(want)
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
        assert {r["doc_id"]: r["text"] for r in rows} == want, name
        docs = spark.createDataFrame(rows, docs.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    reference = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    total = {i: len(reference.encode(t, add_special_tokens=False).ids) + 1 for i, t in want.items()}
    have = {}
    for r in packed:
        have[r["doc_id"]] = have.get(r["doc_id"], 0) + r["length"]
    assert have == total
    assert len({r["sequence_id"] for r in packed}) <= -(-sum(total.values()) // 4096) + 1


def test_word_encoder_equals_the_library():
    """Every word of the vocabulary, every plain character between others, and mixtures."""
    import json

    from tokenizers import Tokenizer

    with open(public_tokenizers.path("word_bpe_49k.json")) as f:
        text = f.read()
    reference, encoder = Tokenizer.from_str(text), packing.WordEncoder(text)
    back = {c: b for c, b in packing.byte_letters().items()}
    words = []
    for token in json.loads(text)["model"]["vocab"]:
        raw = bytes(back[c] for c in token.removesuffix("</w>") if c in back)
        words.append(raw.decode(errors="ignore"))
    rng = random.Random(12)
    signs = [*"abXYZ ,.'!?\n\t09éßİΩ数_-", "'s", "'LL", "'ve", "''", "<|endoftext|>", "\x1c", "\xa0", "\x85", "don't", "ı", "ﬁ", "é", "̀", "ǅ", "²", "½"]
    texts = [" ".join(words[i:i + 50]) for i in range(0, len(words), 50)] + words[::7]
    texts += [f"a{chr(c)}b {chr(c)}{chr(c)}1'{chr(c)} '{chr(c)}s" for c in range(0x2FF)]
    texts += ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(6000)] + ["", " ", "'", "'r", "'re", "x'", "'l'l", "''s", "1's", "'tis 'veto 'llama"]
    got = [x for i in range(0, len(texts), 500) for x in encoder.encode(texts[i:i + 500])]
    want = [e.ids for e in reference.encode_batch(texts, add_special_tokens=False)]
    wrong = [t for t, g, w in zip(texts, got, want) if np.frombuffer(g, "<u4").tolist() != w]
    assert not wrong, wrong[:3]


def test_br_is_white_space():
    page = "<article><p>one two<br>three<br/>four <b>fi</b>ve</p><p>six<BR>\n seven</p></article>"
    assert html_main.main_text(page, html_main.weights({})) == "one two three four five\nsix seven"


@pytest.mark.parametrize("page", [
    "<div class=nav>" * 60_000 + "x", "<article>" * 100_000 + "some words here", '<a href="x ' * 90_000, "<a b='" + "<b " * 300_000,
    "</p>" * 250_000, "<b>" * 250_000 + "<p>x" * 1000, '<a "\'' * 200_000, "<b>" * 100_000 + "</i>" * 100_000,
    ("<div class=nav><p>" + "w " * 12) * 20_000, "<" * 1_000_000, "<!--" * 250_000, "<a" * 500_000], ids=range(12))
def test_a_bad_page_of_a_megabyte_takes_linear_time(page):
    weight = html_main.weights({})
    started = time.process_time()
    html_main.main_text(page, weight)
    html_main.counts(page)
    assert time.process_time() - started < 5


def test_a_quote_that_is_never_closed_ends_the_page():
    weight = html_main.weights({})
    assert html_main.main_text("<article><p>one two</p><p class='x>three</p></article>", weight) == "one two"
    assert html_main.main_text("<article><p \">one two</p><p =x a=b'c>three</p></article>", weight) == "one two\nthree"


def best_sum(gains):
    """The largest sum of a run, by trying all."""
    return max((sum(gains[a:b]) for a in range(len(gains)) for b in range(a + 1, len(gains) + 1)), default=0.0)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(1, 6), st.sampled_from(["b", "i", "td", "zz"])), max_size=25))
def test_the_scan_finds_the_best_run(items):
    """Words and tags without containers: the region is a run of the largest sum."""
    weight = html_main.weights({}) | {"word": 0.7, "b/": -0.9, "i/": -1.0, "td/": -0.4, "tag/": -0.8}
    page, gains, words = "", [], []
    for n, x in enumerate(items):
        if isinstance(x, int):
            if words and words[-1]:  # neighbouring texts would be one token
                page += "<wbr>"
                gains.append(weight["tag/"])
                words.append([])
            words.append([f"<{n}x{k}>".strip("<>") for k in range(x)])
            page += " ".join(f"|{w}|" for w in words[-1])
            gains.append(weight["word"] * x)
        else:
            page += f"</{x}>"
            gains.append(weight[f"{x}/" if x in html_main.KNOWN_TAGS else "tag/"])
            words.append([])
    got, best = html_main.main_text(page, weight), best_sum(gains)
    inside = [i for i, own in enumerate(words) if own and all(f"|{w}|" in got for w in own)]
    if best <= 1e-9:
        assert got == ""
    else:
        assert abs(sum(gains[inside[0]:inside[-1] + 1]) - best) < 1e-6


def test_packing_reaches_its_bound_and_stays_near_the_least(spark):
    rng = random.Random(13)
    lengths = [min(4096, int(rng.lognormvariate(6.4, 1.2)) + 1) for _ in range(20_000)]
    pieces = spark.createDataFrame([(i, 0, n) for i, n in enumerate(lengths)], "doc_id long, piece int, length long")
    got = packing.pack(pieces, 3).collect()
    filled = {}
    for r in got:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in filled.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 4096
    groups = {k >> 36: 0 for k in filled}
    for k, own in filled.items():
        groups[k >> 36] += sum(n for _, n in own)
    for g, tokens in groups.items():
        assert sum(k >> 36 == g for k in filled) <= -(-tokens // 4096) + 2
    # the bound is reached
    open_ = packing.OpenSequences(4096, packing.OPEN_LIMIT)
    at_bound = 0
    for a in range(0, len(lengths), packing.RUN_ROWS):
        for n in sorted(lengths[a:a + packing.RUN_ROWS], reverse=True):
            open_.place(n)
            at_bound += open_.count == packing.OPEN_LIMIT
    assert at_bound > 100


def test_runs_do_not_depend_on_batches():
    rows = pa.table({"pack_group": [1] * 7 + [2] * 3 + [3] * 9, "n": list(range(19))})
    want = [(1, [0, 1, 2, 3]), (1, [4, 5, 6]), (2, [7, 8, 9]), (3, [10, 11, 12, 13]), (3, [14, 15, 16, 17]), (3, [18])]
    for size in (1, 2, 5, 19):
        got = [(g, t.column("n").to_pylist()[a:b]) for t, runs in packing._in_runs(iter(rows.to_batches(size)), 4) for g, a, b in runs]
        assert got == want


def test_license_query_equals_its_sql_on_wrapped_and_damaged_notices(spark, tmp_path):
    rng = random.Random(14)
    vocabulary = sorted({w for _, t in license_scan.TEMPLATES for w in t.split()}) + ["other", "words"]
    texts = [t for _, t in WRAPPED] + [None, "", " ", "released under the MIT license", "Released under the Apache License", "Licensed under CC BY 4.0", "x " * 200 + WRAPPED[0][1]]
    for _ in range(150):
        words = []
        for _ in range(rng.randint(0, 3)):
            words += rng.choices(vocabulary, k=rng.randint(0, 10))
            words += [w for w in rng.choice(license_scan.TEMPLATES)[1].split() if rng.random() < 0.92]
        texts.append(rng.choice(["", " ", "* "]) + rng.choice([" ", "\n", ", "]).join(words) + rng.choice(["", ".", " \n"]))
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.REGISTRY["op5_license_scan"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(queries.SQL["op5_license_scan"])
    at = [[d[0] for d in want.description].index(c) for c in got.columns]
    rows = sorted(map(tuple, got.collect()))
    assert rows == sorted(tuple(r[i] for i in at) for r in want.fetchall())
    assert sum(r[got.columns.index("labels")] != r[got.columns.index("base_labels")] for r in rows) > 20
    assert any(0 < r[got.columns.index("score")] < 1 for r in rows)
