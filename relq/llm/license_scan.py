"""License scans: an exact set-similarity join of text spans with templates.

A template is the set of words of a license notice; a span is a run of words
of a text, wherever its lines break, a quarter longer than the notice
(``width``).  Every template of which some span of a text holds at least
``THRESHOLD`` of the words, and among them the licence's name where the notice
has one (``NAMES``, its words one after the other), is found (``similar_spans``, what the query runs),
by built-in functions and joins only: the spans around each word of a
template's prefix (below), or around the rarest word of its name, are counted
in full.

``similar_blocks`` takes single lines for spans, however long they are, and misses
notices that are wrapped.  Both rules give the same on texts whose notices stand
on one line each.  Its filters:

* template words are ordered by how many texts of the corpus hold them, rare
  ones first, counted over all rows;
* a block that reaches the threshold holds one of a template's first
  ``size - need + 1`` words in that order (prefix filter), has at least
  ``need`` template words itself (length filter), and from the first shared
  word on both have enough words left (positional filter);
* what is left is counted in full.

Words outside of all templates can't be shared, so blocks carry only template
words.  The template index is broadcast: its size is that of the fixed list
below.  A word held by every block costs nothing unless it is in a prefix,
and prefixes hold the corpus's rarest template words.

Besides, base phrases are found word by word in every text.

Defined results: a null, empty or word-less text has no words, places, labels
and score 0; repeated rows are scanned each for itself; ties don't arise; an
empty table gives no rows; columns other than id and text are ignored, whatever
their names.  Whole texts are scanned, however long; spans are bounded by the
notice.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

THRESHOLD = 0.8

# What separates words, base phrases and labels, notice templates.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "released under the mit license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
# What a notice must not lack: without it, most of the words name another licence
# (GNU's lesser and Affero licences are not gpl; cc-by is all that starts with CC BY).
NAMES = ["mit", "apache", "gnu general public license", "creative commons attribution", "cc by", "mozilla public license"]


def lowered(text: Column) -> Column:
    """A-Z in lower case; a null text is empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(text: Column) -> Column:
    return F.split(text, SEPARATORS)


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _places(words: Column, phrase: str) -> Column:
    """Starts of a phrase's words standing one after the other."""
    parts = phrase.split()
    starts = F.sequence(F.lit(0), F.size(words) - 1)

    def fits(i: Column) -> Column:
        found = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            found = found & F.coalesce(F.get(words, i + k) == part, F.lit(False))
        return found

    return F.when(F.size(words) > 0, F.filter(starts, fits)).otherwise(F.array().cast("array<int>"))


def frequency_order(texts: DataFrame, templates: list[tuple[str, str]]) -> list[str]:
    """All template words, rarest first by the number of rows that hold them
    (ties by the word).  One row for each template word reaches the driver."""
    vocabulary = sorted({w for _, t in templates for w in t.split()})
    held = texts.select(F.explode(F.array_intersect("words", _strings(vocabulary))).alias("word"))
    count = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (count.get(w, 0), w))


def similar_blocks(docs: DataFrame, templates: list[tuple[str, str]], order: list[str], threshold: float, keys: list[str]) -> DataFrame:
    """(keys, template, score) of all blocks and templates that reach the
    threshold; ``docs`` has the keys, ``lowered`` and ``words``."""
    rank = {w: i for i, w in enumerate(order)}
    index, whole = [], []
    for number, (_, text) in enumerate(templates):
        own = sorted(set(text.split()), key=rank.__getitem__)
        need = math.ceil(threshold * len(own) - 1e-9)
        whole.append((number, own, need))
        index += [(word, number, at, len(own), need) for at, word in enumerate(own[:len(own) - need + 1])]
    spark = docs.sparkSession
    prefix = spark.createDataFrame(index, "word string, template int, at int, size int, need int")
    full = spark.createDataFrame(whole, "template int, own array<string>, need int").select("template", "own")
    starters = _strings(sorted({w for w, *_ in index}))
    least = min(need for *_, need in whole)
    # arrays of template words in the global order: the literal comes first
    blocks = (docs.where(F.arrays_overlap("words", starters))
              .select(*keys, F.posexplode(F.split("lowered", "\n")).alias("line", "block"))
              .withColumn("held", F.array_intersect(_strings(order), _words(F.col("block"))))
              .where((F.size("held") >= least) & F.arrays_overlap("held", starters)))
    tokens = blocks.select(*keys, "line", "held", F.posexplode("held").alias("pos", "word"))
    near = tokens.join(F.broadcast(prefix), "word").where(
        (F.size("held") >= F.col("need")) & (F.least(F.col("size") - F.col("at"), F.size("held") - F.col("pos")) >= F.col("need") - F.least("at", "pos")))
    shared = F.size(F.array_intersect("held", "own"))
    return (near.dropDuplicates([*keys, "line", "template"]).join(F.broadcast(full), "template")
            .where(shared >= F.col("need")).select(*keys, "template", (shared / F.col("size")).alias("score")))


def width(text: str) -> int:
    """Words of a span: those of the notice and room for what stands between
    them (comment marks that are words, a name)."""
    n = len(text.split())
    return n + max(2, n // 4)


def name_of(text: str) -> str:
    """The licence's name in a notice; empty if it has none."""
    return next((name for name in NAMES if f" {name} " in f" {text} "), "")


def similar_spans(docs: DataFrame, templates: list[tuple[str, str]], order: list[str], threshold: float, keys: list[str]) -> DataFrame:
    """(keys, template, score) of all templates of which a span of the text
    reaches the threshold, with the best span around each prefix word;
    ``docs`` has the keys and ``words``."""
    rank = {w: i for i, w in enumerate(order)}
    index = []
    for number, (_, text) in enumerate(templates):
        own = sorted(set(text.split()), key=rank.__getitem__)
        need = math.ceil(threshold * len(own) - 1e-9)
        name = name_of(text)
        first = [min(name.split(), key=rank.__getitem__)] if name else own[:len(own) - need + 1]
        index += [(word, number, own, need, width(text), f" {name} " if name else "") for word in first]
    prefix = docs.sparkSession.createDataFrame(index, "word string, template int, own array<string>, need int, width int, name string")
    starters, widest = sorted({w for w, *_ in index}), max(width(t) for _, t in templates)

    def hit(word: Column, i: Column) -> Column:
        before = F.least(i, F.lit(widest - 1))
        return F.when(word.isin(starters), F.struct(word.alias("word"), before.alias("before"), F.slice("words", i - before + 1, before + widest).alias("around")))

    hits = docs.where(F.arrays_overlap("words", _strings(starters))).select(*keys, F.explode(F.array_compact(F.transform("words", hit))).alias("hit")).select(*keys, "hit.*")
    before = F.least(F.col("before"), F.col("width") - 1)
    near = hits.join(F.broadcast(prefix), "word").withColumn("near", F.slice("around", F.col("before") - before + 1, before + F.col("width")))
    near = near.where(F.size(F.array_intersect("near", "own")) >= F.col("need")).select(*keys, "template", "near", "own", "need", "width", "name")
    spans = F.transform(F.sequence(F.lit(1), F.greatest(F.size("near") - F.col("width") + 1, F.lit(1))), lambda at: F.slice("near", at, F.col("width")))
    named = F.filter(spans, lambda span: F.concat(F.lit(" "), F.array_join(span, " "), F.lit(" ")).contains(F.col("name")))
    shared = F.array_max(F.transform(named, lambda span: F.size(F.array_intersect(span, "own"))))
    return near.withColumn("shared", shared).where(F.col("shared") >= F.col("need")).select(*keys, "template", (F.col("shared") / F.size("own")).alias("score"))


def scan(df: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
         similar: Callable[..., DataFrame] = similar_blocks) -> DataFrame:
    """One row for each row of ``df``: words, places of base phrases, labels."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), lowered(F.col(text_col)).alias("lowered"))
    rows = rows.select("id", F.xxhash64("lowered").alias("body"), "lowered", _words(F.col("lowered")).alias("words"))
    order = frequency_order(rows, templates)
    label = F.array(*[F.lit(name) for name, _ in templates])
    matched = (similar(rows, templates, order, threshold, ["id", "body"])
               .groupBy("id", "body").agg(F.collect_set(F.get(label, F.col("template"))).alias("method"), F.max("score").alias("method_score")))

    blank = F.when(F.get("words", F.lit(0)) == "", 1).otherwise(0) + F.when((F.size("words") > 1) & (F.element_at("words", -1) == ""), 1).otherwise(0)
    maybe = F.col("lowered").contains("license") | F.col("lowered").rlike(r"cc" + SEPARATORS + "by")
    # only a text that may hold a phrase has its words walked through
    walked = F.when(maybe, F.filter("words", lambda w: w != "")).otherwise(F.array().cast("array<string>"))
    base = rows.select("id", "body", (F.size("words") - blank).cast("long").alias("n_words"), walked.alias("walked"))
    base = base.select("id", "body", "n_words", *[_places(F.col("walked"), phrase).alias(f"at{k}") for k, phrase in enumerate(BASE)])
    places = [F.col(f"at{k}") for k in range(len(BASE))]
    every = F.concat(*places)
    base = base.select("id", "body", "n_words", F.size(every).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
                       F.array_compact(F.array(*[F.when(F.size(p) > 0, F.lit(name)) for p, name in zip(places, BASE.values())])).alias("own"))
    out = base.join(matched.withColumnsRenamed({"id": "mid", "body": "mbody"}), F.col("id").eqNullSafe(F.col("mid")) & (F.col("body") == F.col("mbody")), "left")
    both = F.array_union("own", F.coalesce("method", F.array().cast("array<string>")))
    return out.select(F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", F.array_join(F.array_sort(F.array_distinct("own")), ",").alias("base_labels"),
                      F.array_join(F.array_sort(both), ",").alias("labels"), F.greatest(F.when(F.col("n_base") > 0, 1.0).otherwise(0.0), F.coalesce("method_score", F.lit(0.0))).alias("score"))


def oracle_sql() -> str:
    """The query's rule as SQL that tries every span of every text that holds
    enough of a template's words at all."""
    def strings(values) -> str:
        return "[" + ", ".join(f"'{v}'" for v in values) + "]"

    def entry(name: str, text: str) -> str:
        own = sorted(set(text.split()))
        called = name_of(text)
        return f"('{name}', {strings(own)}, {math.ceil(THRESHOLD * len(own) - 1e-9)}, {width(text)}, '{f' {called} ' if called else ''}')"

    listed = ", ".join(entry(*t) for t in TEMPLATES)
    places = ", ".join(
        "list_filter(range(0, len(w)), lambda i: " + " AND ".join(f"w[i + {k + 1}] = '{p}'" for k, p in enumerate(phrase.split())) + f") AS at{n}"
        for n, phrase in enumerate(BASE))
    every = " || ".join(f"coalesce(at{n}, [])" for n in range(len(BASE)))
    own = ", ".join(f"CASE WHEN len(at{n}) > 0 THEN '{name}' END" for n, name in enumerate(BASE.values()))
    cut = SEPARATORS
    return rf"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
t(label, own, need, width, name) AS (VALUES {listed}),
cut AS MATERIALIZED (SELECT doc_id, string_split_regex(body, '{cut}') AS w FROM d),
near AS (SELECT doc_id, w, label, own, need, width, name FROM cut, t WHERE len(list_intersect(w, own)) >= need),
spans AS (SELECT doc_id, label, own, need, name, w[i:i + width - 1] AS span FROM (SELECT *, unnest(range(1, greatest(len(w) - width + 1, 1) + 1)) AS i FROM near)),
m AS (SELECT doc_id, label, len(list_intersect(span, own)) / len(own) AS score FROM spans
  WHERE len(list_intersect(span, own)) >= need AND contains(' ' || array_to_string(span, ' ') || ' ', name)),
method AS (SELECT doc_id, list(DISTINCT label) AS labels, max(score) AS score FROM m GROUP BY doc_id),
words AS (SELECT doc_id, list_filter(w, lambda x: x <> '') AS w FROM cut),
p AS (SELECT doc_id, len(w) AS n_words, {places} FROM words),
b AS (SELECT doc_id, n_words, {every} AS every_at, list_filter([{own}], lambda x: x IS NOT NULL) AS own FROM p)
SELECT doc_id, n_words, len(every_at) AS n_base, list_min(every_at) AS first_word, list_max(every_at) AS last_word,
  array_to_string(list_sort(own), ',') AS base_labels, array_to_string(list_sort(list_distinct(own || coalesce(labels, []))), ',') AS labels,
  greatest(CASE WHEN len(every_at) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END, coalesce(score, 0.0)) AS score
FROM b LEFT JOIN method USING (doc_id)"""
