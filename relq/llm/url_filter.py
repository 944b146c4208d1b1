"""URL filters: a Bloom filter cascade over keys of host and path.

A rule is a key: host suffix (whole labels) and path prefix, as in
``example.org/en/1``.  A url's candidate keys are its host suffixes joined
with its path prefixes, of the shapes (number of labels, length of prefix)
that occur in the list at all.  The cascade answers exactly, for every key of
the corpus, whether it is listed: level one encodes the listed keys, level
two the false positives of level one among all candidate keys of the corpus,
level three those listed keys that level two takes for false positives, and
so on until a level has none.  No table is joined.

The cascade works on 64-bit hashes; keys that it takes for listed -- few, as a
rule -- are looked up by their text before they decide, so two keys of one hash
are never mixed up.

A level's bits are proportional to the keys it encodes, and the first level's
to the list: at most ``MAX_LISTED`` keys, which is checked.  False positives
are found by Spark over the whole corpus, made distinct there, and only their
hashes come to the driver: with ``HASHES`` of ``BITS_PER_KEY`` bits about one
in 70,000 of the distinct keys that are not listed.

Defined results: a null url, or one without ``://``, has an empty host and
path and no candidate keys; no rule fits it and it is allowed.  Repeated rows
are judged each for itself.  Of the fitting rules the longest wins (of equally
long ones the alphabetically first).  An empty table gives no rows, an empty list
allows all; columns other than id and url are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .arrays import mix

MAX_LISTED = 1_000_000
BITS_PER_KEY = 24
HASHES = 12


class Level:
    """A Bloom filter over 64-bit key hashes."""

    def __init__(self, keys: np.ndarray, level: int):
        self.level, self.size = level, max(64, BITS_PER_KEY * len(keys))
        self.bits = np.zeros(-(-self.size // 8), np.uint8)
        for at in self._at(keys):
            np.bitwise_or.at(self.bits, at >> 3, (1 << (at & 7)).astype(np.uint8))

    def _at(self, keys: np.ndarray):
        a = mix(keys.astype(np.uint64) + np.uint64(self.level * 2 + 1))
        b = mix(a + np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        for i in range(HASHES):
            yield ((a + np.uint64(i) * b) % np.uint64(self.size)).astype(np.int64)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        hit = np.ones(len(keys), bool)
        for at in self._at(keys):
            hit &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return hit


class Cascade:
    """Alternating levels: listed keys, false positives, listed keys, ..."""

    def __init__(self):
        self.levels: list[Level] = []

    def depth(self, keys: np.ndarray) -> np.ndarray:
        """How many levels in a row hold each key."""
        out, left = np.zeros(len(keys), np.int64), np.arange(len(keys))
        for level in self.levels:
            left = left[level.holds(keys[left])]
            out[left] += 1
        return out

    def listed(self, keys: np.ndarray) -> np.ndarray:
        return self.depth(keys) % 2 == 1


def build(listed: DataFrame, universe: DataFrame, key: str = "key") -> Cascade:
    """Cascade for ``listed[key]`` that is exact over ``universe[key]``."""
    spark = listed.sparkSession
    rows = listed.select(F.xxhash64(key).alias("h")).where(F.col(key).isNotNull()).distinct()
    n = rows.count()
    if n > MAX_LISTED:
        raise ValueError(f"{n} listed keys; the cascade is built for {MAX_LISTED} at most")
    members = np.array([r["h"] for r in rows.collect()], np.int64).astype(np.uint64)
    cascade = Cascade()
    own = spark.sparkContext.broadcast(np.sort(members))
    candidates = universe.where(F.col(key).isNotNull()).select(F.xxhash64(key).alias("h"))
    inside, outside = members, None
    while len(inside) if len(cascade.levels) % 2 == 0 else len(outside):
        even = len(cascade.levels) % 2 == 0
        cascade.levels.append(Level(inside if even else outside, len(cascade.levels)))
        if even and outside is None:
            first = spark.sparkContext.broadcast(cascade.levels[0])

            @F.pandas_udf("boolean")
            def false_positive(h: pd.Series) -> pd.Series:
                keys = h.to_numpy().astype(np.uint64)
                hit = np.flatnonzero(first.value.holds(keys))
                at = np.minimum(np.searchsorted(own.value, keys[hit]), len(own.value) - 1)
                out = np.zeros(len(keys), bool)
                out[hit] = own.value[at] != keys[hit]
                return pd.Series(out)

            outside = np.array([r["h"] for r in candidates.where(false_positive("h")).distinct().collect()], np.int64).astype(np.uint64)
        elif even:
            outside = outside[cascade.levels[-1].holds(outside)]
        else:
            inside = inside[cascade.levels[-1].holds(inside)]
    return cascade


def host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end."""
    rest = F.when(F.locate("://", url) > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """After the host, up to ``?``, ``#`` or the end."""
    rest = F.when(F.locate("://", url) > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise(F.lit(""))
    return F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def judge(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) of each row; ``rules``: (verdict, key)
    with a key of host and path, decided by the longest that fits."""
    spark = pages.sparkSession
    shape = sorted({(k.partition("/")[0].count(".") + 1, len(k) - k.index("/")) for _, k in rules})
    verdict = {k: v for v, k in rules}
    parsed = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"))
    parsed = parsed.select("id", F.coalesce(host(F.col("url")), F.lit("")).alias("host"), F.coalesce(path(F.col("url")), F.lit("")).alias("path"))
    labels = F.size(F.split("host", r"\."))
    keys = F.array_compact(F.array(*[
        F.when((labels >= n) & (F.length("path") >= m), F.concat(F.substring_index("host", ".", -n), F.substring("path", 1, m)))
        for n, m in shape]))
    keyed = parsed.withColumn("keys", keys) if shape else parsed.withColumn("keys", F.array().cast("array<string>"))
    universe = keyed.select(F.explode("keys").alias("key"))
    listed = spark.createDataFrame([(k,) for k in verdict], "key string")
    cascade = spark.sparkContext.broadcast(build(listed, universe))

    @F.pandas_udf("array<boolean>")
    def holds(hashes: pd.Series) -> pd.Series:
        size = np.array([len(x) for x in hashes], np.int64)
        flat = np.concatenate([*hashes, np.zeros(0, np.int64)]).astype(np.int64).astype(np.uint64)
        return pd.Series(np.split(cascade.value.listed(flat), np.cumsum(size)[:-1]) if len(size) else [])

    table = spark.sparkContext.broadcast(verdict)  # at most MAX_LISTED rules

    @F.pandas_udf("rule string, verdict string")
    def decided(fitting: pd.Series) -> pd.DataFrame:
        known, rule = table.value, []
        for keys in fitting:
            own = [k for k in keys if k in known]
            rule.append(min(own, key=lambda k: (-len(k), k)) if own else None)
        return pd.DataFrame({"rule": pd.Series(rule, dtype=object), "verdict": pd.Series([known.get(r, "allow") for r in rule], dtype=object)})

    hit = keyed.withColumn("hit", holds(F.transform("keys", lambda k: F.xxhash64(k))))
    out = hit.withColumn("decided", decided(F.expr("filter(keys, (k, i) -> hit[i])")))
    return out.select(F.col("id").alias(id_col), "host", "path", "decided.rule", "decided.verdict")
