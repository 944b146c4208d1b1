"""Benchmark decontamination: word windows of test items found in documents.

Words are runs of digits, lower-cased letters and non-ASCII characters.  Every
run of ``WINDOW`` words of an item is a window; an item of fewer words is one
window as a whole.  A document word within any occurrence of a window is hit.

*Set.*  The items' windows, each kept once in normal form (words joined by
single spaces) with the items that hold it, form a hash set that is broadcast.
Its size is checked first: items of more than ``SET_BYTES`` of text are dealt
to several sets, each of about that size, and the documents are scanned once
for each; a single item beyond that is a set of its own.

*Scan.*  A task turns a run of texts into word hashes and combines them to a
hash of each window.  A bitmap of the set's hashes lets almost all windows go;
the others are looked up, and a hit counts only if its words, byte by byte,
are those of the window.  Texts of more than ``PIECE_BYTES`` are scanned in
pieces that overlap by one word less than a window, so working memory is
bounded whatever a text's length.  With one set nothing is shuffled.

Defined results: null and empty texts have no words; an item without words has
no window and is never found; items with equal ids are one item, a null id is
the empty string; repeated rows of either table change nothing else; columns
other than id and text are carried along by ``decontaminated`` whatever their
names; an empty table on either side leaves all documents clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import LOWER, Words, column_bytes, mix, slices
from .memory import drop, tidy
from .staging import staged

WINDOW = 10
SET_BYTES = 4 << 20
PIECE_BYTES = 2 << 20
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True
_VERIFY = 4096  # windows compared at a time


class Text:
    """The words of a run of texts: places, hashes and normal form."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        low = LOWER[data]
        words = Words(low, offsets, IS_WORD)
        self.first, self.doc, self.hash = words.first, words.doc, words.hash
        self.start, self.end = words.start, words.start + words.length
        # each word followed by one space
        self.at = np.concatenate([[0], np.cumsum(words.length + 1)])
        self.normal = np.full(self.at[-1], 32, np.uint8)
        place = np.arange(int(words.length.sum())) + np.repeat(np.arange(len(words.length)), words.length)
        self.normal[place] = low[place + np.repeat(words.start - self.at[:-1], words.length)]

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of the windows of ``n`` words, and the windows' hashes."""
        count = len(self.hash) - n + 1
        if count <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        first = np.flatnonzero(self.doc[:count] == self.doc[n - 1:])
        total = np.zeros(count, np.uint64)
        for j, factor in enumerate(mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)):
            total += self.hash[j:j + count] * factor
        return first, mix(total[first])


def _same(a: np.ndarray, a_from: np.ndarray, b: np.ndarray, b_from: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the byte spans a[a_from:][:length] and b[b_from:][:length] agree."""
    out = np.ones(len(length), bool)
    for at in range(0, len(length), _VERIFY):
        size = length[at:at + _VERIFY]
        begin = np.cumsum(size) - size
        step = np.arange(int(size.sum())) - np.repeat(begin, size)
        differs = a[np.repeat(a_from[at:at + _VERIFY], size) + step] != b[np.repeat(b_from[at:at + _VERIFY], size) + step]
        out[at:at + _VERIFY] = np.add.reduceat(differs, begin) == 0
    return out


class WindowSet:
    """The windows of some items: hashes in order, normal forms, items."""

    def __init__(self, ids: list[str], texts: list[str | None], window: int = WINDOW):
        self.window = window
        self.ids = sorted(set(ids))
        number = {i: n for n, i in enumerate(self.ids)}
        data, offsets = column_bytes(pa.array(texts, pa.string()))
        text = Text(data, offsets)
        self.normal = text.normal
        n_words = np.diff(text.first)
        first, size, hashes = [], [], []
        for n in np.unique(np.minimum(n_words[n_words > 0], window)).tolist():
            at, h = text.windows(n)
            own = np.flatnonzero(n_words[text.doc[at]] == n) if n < window else np.arange(len(at))
            first.append(at[own])
            size.append(np.full(len(own), n))
            hashes.append(h[own])
        first, size, hashes = (np.concatenate([np.zeros(0, t), *x]) for x, t in ((first, np.int64), (size, np.int64), (hashes, np.uint64)))
        order = np.lexsort((first, hashes))
        first, size, hashes = first[order], size[order], hashes[order]
        item = np.array([number[i] for i in ids], np.int64)[text.doc[first]]
        begin, length = text.at[first], text.at[first + size] - text.at[first] - 1
        form = self._forms(hashes, begin, length)
        place = np.unique(np.stack([form, item], 1), axis=0) if len(form) else np.zeros((0, 2), np.int64)
        kept = np.unique(form, return_index=True)[1]
        self.hashes, self.begin, self.length, self.size = hashes[kept], begin[kept], length[kept], size[kept]
        self.items, self.items_at = place[:, 1], np.searchsorted(place[:, 0], np.arange(len(kept) + 1))
        self.sizes = np.unique(self.size).tolist()
        self.shift = np.uint64(64 - max(16, int(16 * len(kept)).bit_length()))
        self.bitmap = np.zeros(1 << (64 - int(self.shift)), bool)
        self.bitmap[(self.hashes >> self.shift).astype(np.int64)] = True

    def _forms(self, hashes: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Numbers of the distinct normal forms of windows in hash order."""
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        again = np.flatnonzero(~new)
        alike = length[again] == length[again - 1]
        alike[alike] = _same(self.normal, begin[again[alike]], self.normal, begin[again[alike] - 1], length[again[alike]])
        if alike.all():
            return np.cumsum(new) - 1
        # different windows of one hash: told apart by their words
        raw, seen, form = self.normal.tobytes(), {}, np.empty(len(hashes), np.int64)
        for i, (h, a, n) in enumerate(zip(hashes.tolist(), begin.tolist(), length.tolist())):
            form[i] = seen.setdefault((h, raw[a:a + n]), len(seen))
        return form

    def found(self, text: Text) -> tuple[np.ndarray, np.ndarray]:
        """(first words, windows) of all occurrences in ``text``."""
        places, windows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n in self.sizes:
            first, hashes = text.windows(n)
            asked = np.flatnonzero(self.bitmap[(hashes >> self.shift).astype(np.int64)])
            first, hashes = first[asked], hashes[asked]
            at = np.searchsorted(self.hashes, hashes)
            while len(at):
                live = at < len(self.hashes)
                live[live] = self.hashes[at[live]] == hashes[live]
                first, hashes, at = first[live], hashes[live], at[live]
                begin = text.at[first]
                length = text.at[first + n] - begin - 1
                same = (self.size[at] == n) & (self.length[at] == length)
                same[same] = _same(text.normal, begin[same], self.normal, self.begin[at[same]], length[same])
                places.append(first[same])
                windows.append(at[same])
                first, hashes, at = first[~same], hashes[~same], at[~same] + 1
        return np.concatenate(places), np.concatenate(windows)


def _runs(doc: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of each text's word intervals [first, end), touching ones joined."""
    order = np.argsort(first, kind="stable")
    doc, first, reach = doc[order], first[order], np.maximum.accumulate(end[order])
    new = np.ones(len(first), bool)
    new[1:] = (first[1:] > reach[:-1]) | (doc[1:] != doc[:-1])
    cut = np.flatnonzero(new)
    return doc[cut], first[cut], reach[np.append(cut[1:], len(first)) - 1]


class Finding:
    """What was found in one text."""

    def __init__(self) -> None:
        self.n_words = 0
        self.spans: list[tuple[int, int, int, int]] = []  # words and bytes, first and end
        self.items: set[int] = set()

    def closed(self) -> tuple[int, list[tuple[int, int, int, int]]]:
        """Hit words, and the maximal runs of them."""
        out: list[list[int]] = []
        for a, b, x, y in sorted(self.spans):
            if out and a <= out[-1][1]:
                if b > out[-1][1]:
                    out[-1][1], out[-1][3] = b, y
            else:
                out.append([a, b, x, y])
        return sum(b - a for a, b, _, _ in out), [tuple(s) for s in out]


def _look(windows: WindowSet, data: np.ndarray, offsets: np.ndarray, out: list[Finding], word: int = 0, byte: int = 0) -> Text:
    """Enter what a run of texts holds; ``word`` and ``byte``: what came before."""
    text = Text(data, offsets)
    for finding, a, b in zip(out, text.first[:-1].tolist(), text.first[1:].tolist()):
        finding.n_words = word + b - a
    first, own = windows.found(text)
    if len(first):
        doc = text.doc[first]
        for d, a, b in zip(*(x.tolist() for x in _runs(doc, first, first + windows.size[own]))):
            base, start = int(text.first[d]), int(offsets[d])
            out[d].spans.append((word + a - base, word + b - base, byte + int(text.start[a]) - start, byte + int(text.end[b - 1]) - start))
        for d, w in np.unique(np.stack([doc, own], 1), axis=0).tolist():
            out[d].items.update(windows.items[windows.items_at[w]:windows.items_at[w + 1]].tolist())
    return text


def search(windows: WindowSet, column: pa.Array) -> list[Finding]:
    """What each text of a column holds of a set of windows."""
    data, offsets = column_bytes(column)
    out = [Finding() for _ in range(len(column))]
    long = np.flatnonzero(np.diff(offsets) > PIECE_BYTES).tolist()
    edges = [-1, *long, len(column)]
    for a, b in zip(edges, edges[1:]):
        if a + 1 < b:
            _look(windows, data[offsets[a + 1]:offsets[b]], offsets[a + 1:b + 1] - offsets[a + 1], out[a + 1:b])
    for i in long:
        _in_pieces(windows, data[offsets[i]:offsets[i + 1]], out[i])
    return out


def _in_pieces(windows: WindowSet, data: np.ndarray, finding: Finding) -> None:
    at, word, total, size = 0, 0, len(data), PIECE_BYTES
    while True:
        end = min(at + size, total)
        while end < total and IS_WORD[LOWER[data[end - 1]]] and IS_WORD[LOWER[data[end]]]:
            more = data[end:end + PIECE_BYTES]
            stop = np.flatnonzero(~IS_WORD[LOWER[more]])
            end += int(stop[0]) if len(stop) else len(more)
        text = _look(windows, data[at:end], np.array([0, end - at]), [finding], word, at)
        if end == total:
            return
        # the last words may begin a window that goes on behind the piece
        n = len(text.start) - windows.window + 1
        if n > 0:
            at, word, size = at + int(text.start[n]), word + n, PIECE_BYTES
        else:
            size += PIECE_BYTES


_REPORT = "id long, n_words long, n_hit long, items array<string>, spans array<struct<first_byte: long, end_byte: long>>"


def _span_rows(spans: list[tuple[int, int, int, int]]) -> list[dict]:
    return [{"first_byte": x, "end_byte": y} for _, _, x, y in spans]


def _report(shared):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop()
        windows = shared.value
        for part in slices(batches, "text"):
            found = search(windows, part.column("text"))
            hit, spans = zip(*[f.closed() for f in found])
            yield pa.record_batch({"id": part.column("id"), "n_words": pa.array([f.n_words for f in found], pa.int64()), "n_hit": pa.array(hit, pa.int64()),
                                   "items": pa.array([[windows.ids[i] for i in sorted(f.items)] for f in found], pa.list_(pa.string())),
                                   "spans": pa.array([_span_rows(s) for s in spans], pa.list_(pa.struct([("first_byte", pa.int64()), ("end_byte", pa.int64())])))})

    return run


_PARTIAL = "id long, n_words long, items array<string>, found array<struct<a: long, b: long, x: long, y: long>>"


def _partial(shared):
    """What one of several sets finds; rows of texts without a hit are left out."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop()
        windows = shared.value
        for part in slices(batches, "text"):
            rows = [(i, f) for i, f in zip(part.column("id").to_pylist(), search(windows, part.column("text"))) if f.spans]
            yield pa.record_batch({"id": pa.array([i for i, _ in rows], pa.int64()), "n_words": pa.array([f.n_words for _, f in rows], pa.int64()),
                                   "items": pa.array([[windows.ids[i] for i in f.items] for _, f in rows], pa.list_(pa.string())),
                                   "found": pa.array([[dict(zip("abxy", s)) for s in f.closed()[1]] for _, f in rows], pa.list_(pa.struct([(c, pa.int64()) for c in "abxy"])))})

    return run


@tidy
def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hit, spans, items = [], [], []
        for found, own in zip(batch.column("found").to_pylist(), batch.column("items").to_pylist()):
            finding = Finding()
            finding.spans = [tuple(f[c] for c in "abxy") for part in found or [] for f in part]
            n, runs = finding.closed()
            hit.append(n)
            spans.append(_span_rows(runs))
            items.append(sorted({i for part in own or [] for i in part}))
        yield pa.record_batch({"id": batch.column("id"), "n_words": batch.column("n_words"), "n_hit": pa.array(hit, pa.int64()), "items": pa.array(items, pa.list_(pa.string())),
                               "spans": pa.array(spans, pa.list_(pa.struct([("first_byte", pa.int64()), ("end_byte", pa.int64())])))})


def window_sets(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW, set_bytes: int = SET_BYTES) -> Iterator[WindowSet]:
    """The benchmark's windows in sets of about ``set_bytes`` of text at most."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("string").alias("text")).where(F.length("text") > 0).distinct()
    total = items.agg(F.sum(F.octet_length("text") + F.octet_length("id") + 16)).first()[0] or 0
    sets = max(1, -(-int(total) // set_bytes))
    for k in range(sets):
        own = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(sets)) == k).toArrow()  # about set_bytes
        yield WindowSet(own.column("id").to_pylist(), own.column("text").to_pylist(), window)


def scan(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, set_bytes: int = SET_BYTES) -> DataFrame:
    """(id, n_words, n_hit, items, spans) of each document: hit words, found
    items in order, and the maximal runs of hit words as byte spans."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    spark = docs.sparkSession
    shared = [spark.sparkContext.broadcast(s) for s in window_sets(benchmark, item_col, item_text, window, set_bytes)]  # about set_bytes each
    if len(shared) == 1:
        return rows.mapInArrow(_report(shared[0]), _REPORT).withColumnRenamed("id", id_col)
    numbered = staged(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")
    words = numbered.select(F.col("row").alias("id"), "text").mapInArrow(_report(spark.sparkContext.broadcast(WindowSet([], [], window))), _REPORT).select(F.col("id").alias("row"), "n_words")
    found = None
    for s in shared:
        own = numbered.select(F.col("row").alias("id"), "text").mapInArrow(_partial(s), _PARTIAL)
        found = own if found is None else found.union(own)
    found = found.groupBy(F.col("id").alias("row")).agg(F.collect_list("items").alias("items"), F.collect_list("found").alias("found"))
    every = numbered.select("row", "id").join(words, "row").join(found, "row", "left").select("id", "n_words", "items", "found")
    return every.mapInArrow(_united, _REPORT).withColumnRenamed("id", id_col)


def _cut(text: str | None, spans) -> str | None:
    if text is None or spans is None or not len(spans):
        return text
    raw, kept, at = text.encode(), [], 0
    for s in spans:  # words begin and end at whole characters
        kept.append(raw[at:s["first_byte"]])
        at = s["end_byte"]
    return b"".join([*kept, raw[at:]]).decode()


def decontaminated(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", text_col: str = "text", least: float = 0.0, **options) -> DataFrame:
    """``docs`` without what stands in the benchmark.

    ``remove="spans"`` takes the runs of hit words out of the texts;
    ``remove="documents"`` drops documents with a share of hit words above
    ``least``.  Columns and other rows stay as they are."""
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove must be 'spans' or 'documents', not {remove!r}")
    numbered = staged(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("given")), "given")
    texts = numbered.select("row", F.col("given").getField(text_col).alias("text"))
    found = scan(texts, benchmark, "row", "text", **options).where("n_hit > 0")
    if remove == "documents":
        gone = found.where(F.col("n_hit") > least * F.col("n_words")).select("row")
        return numbered.join(gone, "row", "left_anti").select("given.*")

    @F.pandas_udf("string")
    def without(text: pd.Series, own: pd.Series) -> pd.Series:
        return pd.Series([_cut(t, s) for t, s in zip(text, own)])

    both = numbered.join(found.select("row", "spans"), "row", "left")
    text = F.when(F.col("spans").isNull(), F.col("given").getField(text_col)).otherwise(without(F.col("given").getField(text_col).cast("string"), "spans"))
    return both.select(F.col("given").withField(text_col, text).alias("given")).select("given.*")


def oracle_sql(window: int = WINDOW) -> str:
    """What the query returns, in DuckDB's SQL."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = rf"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return rf"""
WITH d AS MATERIALIZED (SELECT doc_id, {words} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {words} AS w FROM benchmark),
bw AS MATERIALIZED (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT item, w, least(len(w), {window}) AS n, unnest(range(1, len(w) - least(len(w), {window}) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS MATERIALIZED (SELECT doc_id, i, dw.n, item FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)"""
