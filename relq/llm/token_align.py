"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Tokenizer A reads a space and the text, tokenizer B the text (it adds the
space itself); both sequences then cover the same bytes.  Byte offsets where
tokens of both end cut them into groups; two tokens are linked where their
byte ranges overlap.

*Cuts.*  Divide and conquer: of an interval that begins and ends at common
ends, a common end near its middle is looked for -- A's ends from the middle
outwards, each by bisection among B's ends -- and both halves go the same way;
an interval without a common end inside is a group.  All intervals of a run of
texts take each step together, as arrays.

*Tokens.*  Neither tokenizer joins text over a change from other characters to
white space (blank, newline, tab); ``TokenPair`` checks this for B's
vocabulary.  A text is cut there into chunks, and B's ids of chunks seen before
are taken from a memo.  Texts of more than ``PIECE_CHARS`` go through in pieces
that end where a chunk ends.

*Counts.*  Each task turns its documents into blocks: the distinct linked id
pairs of a block, how many of its documents hold each, and each document's
links by place in that list.  Blocks are written once to the shared folder.
Only a block's distinct pairs are shuffled, to be counted over the corpus, and
come back to the block with their count; no list of links or pairs passes the
driver.

Defined results: null and empty texts, and texts that a tokenizer does not
give back byte by byte (U+2581 for B), have no tokens: zeros and an empty
string; repeated rows count as documents of their own; a null id is kept;
columns other than id and text are ignored, whatever their names; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from relq.operators.joins import aggregated_join

from .arrays import byte_letters, slices
from .memory import only, tidy, trim
from .staging import staged

PIECE_CHARS = 1 << 18
SLICE_BYTES = 1 << 18
BLOCK_BYTES = 4 << 20  # of text whose links make a block
MEMO_BYTES = 16 << 20
_ENTRY_BYTES = 200  # a short string, its number, their place in a dict, its ids
_B_BITS = 24  # of a pair of ids

# Fixed value: how byte-level vocabularies of this kind cut text before merging.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# An end of a piece of text that no token crosses.
_EDGE = re.compile(r"(?<=\S)(?=[ \n\t])")
_PLAIN_CHUNK = re.compile(r"\s*\S+|\s+")
_ODD_SPACE = re.compile(r"[^\S \n\t]")


class _Runs:
    """Runs of values one behind the other: run k is flat[at[k]:at[k + 1]]."""

    def __init__(self, flat: np.ndarray, at: np.ndarray):
        self.flat, self.at = flat, at

    @classmethod
    def none(cls, kind: type) -> _Runs:
        return cls(np.zeros(0, kind), np.zeros(1, np.int64))

    @classmethod
    def of(cls, runs: list, kind: type = np.uint8) -> _Runs:
        at = np.concatenate([[0], np.cumsum(np.fromiter(map(len, runs), np.int64, len(runs)))])
        flat = np.frombuffer(b"".join(runs), np.uint8) if kind is np.uint8 else np.fromiter(chain.from_iterable(runs), kind, int(at[-1]))
        return cls(flat, at)

    def take(self, which: np.ndarray) -> _Runs:
        size = self.at[which + 1] - self.at[which]
        at = np.concatenate([[0], np.cumsum(size)])
        return _Runs(self.flat[np.repeat(self.at[which] - at[:-1], size) + np.arange(int(at[-1]))], at)

    def joined(self, cuts: np.ndarray) -> _Runs:
        """Runs cuts[k]:cuts[k + 1] as one."""
        return _Runs(self.flat, self.at[cuts])

    def plus(self, other: _Runs) -> _Runs:
        return _Runs(np.concatenate([self.flat, other.flat]), np.concatenate([self.at, other.at[1:] + self.at[-1]]))

    def equal(self, other: _Runs) -> np.ndarray:
        """Which runs agree with those of ``other``."""
        out = np.diff(self.at) == np.diff(other.at)
        asked = np.flatnonzero(out)
        a, b = self.take(asked), other.take(asked)
        differs = np.concatenate([[0], np.cumsum(a.flat != b.flat)])
        out[asked] = differs[a.at[1:]] == differs[a.at[:-1]]
        return out


class TokenPair:
    """Ids of two tokenizers.

    ``a_json``: a byte-level BPE file of ``tokenizers``, whose ids follow its
    merges, so that ``tiktoken`` gives the same ids from its vocabulary;
    ``b_model``: a BPE model of ``sentencepiece`` with byte fallback, whose ids
    of chunks are kept in a memo.
    """

    def __init__(self, a_json: str, b_model: bytes):
        import sentencepiece
        import tiktoken

        spec, letters = json.loads(a_json), byte_letters()
        before, model = spec["pre_tokenizer"], spec["model"]
        if spec["normalizer"] is not None or before.get("type") != "ByteLevel" or not before.get("use_regex") or before.get("add_prefix_space"):
            raise ValueError("tokenizer A must be byte-level, without a normalizer")
        by_id = {i: t for t, i in model["vocab"].items()}
        special = {t["id"] for t in spec["added_tokens"]}
        self.a_bytes = [bytes(letters[c] for c in by_id[i]) if i not in special else b"" for i in range(len(by_id))]
        merged = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if [model["vocab"][x + y] for x, y in merged] != [i for i, t in enumerate(self.a_bytes) if len(t) > 1]:
            raise ValueError("tokenizer A's ids do not follow its merges")
        self.a = tiktoken.Encoding("a", pat_str=BYTE_LEVEL, mergeable_ranks={t: i for i, t in enumerate(self.a_bytes) if t}, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if any(re.search("[^▁]▁|[ \n\t]", p) for p in pieces):
            raise ValueError("tokenizer B joins text over white space")
        self.a_length, self.b_length = (np.array([len(x) for x in own], np.int64) for own in (self.a_bytes, self.b_bytes))
        self.b_table = _Runs.of(self.b_bytes)
        self.blank = self.b.piece_to_id("▁")
        self.forget()

    def forget(self) -> None:
        self.memo: dict[str, int] = {}  # chunk -> its place in the two below
        self.b_ids, self.good = _Runs.none(np.uint32), np.zeros(0, bool)
        self.seen = 0

    def _learn(self, chunks: list[str]) -> None:
        found = self.b.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
        for i, c in enumerate(chunks):
            if c == " ":  # an empty text gets no blank
                found[i] = [self.blank]
            elif c[0] != " " and found[i][:1] == [self.blank]:  # B put its blank before a newline or tab
                found[i] = found[i][1:]
        ids = _Runs.of(found, np.uint32)
        same = self.b_table.take(ids.flat).joined(ids.at).equal(_Runs.of([c.encode() for c in chunks]))
        self.memo.update(zip(chunks, range(len(self.good), len(self.good) + len(chunks))))
        self.b_ids, self.good = self.b_ids.plus(ids), np.concatenate([self.good, same])
        self.seen += sum(map(len, chunks))

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, _Runs, _Runs]:
        """For pieces of blank and text: the numbers of those that are given
        back byte by byte, and these pieces' ids of A and of B."""
        cut = [_EDGE.split(p) if _ODD_SPACE.search(p) else _PLAIN_CHUNK.findall(p) for p in pieces]
        if len(self.memo) * _ENTRY_BYTES + 2 * self.seen > MEMO_BYTES:
            self.forget()
        if new := list(set().union(*cut).difference(self.memo)):
            self._learn(new)
        at = np.concatenate([[0], np.cumsum([len(c) for c in cut], dtype=np.int64)])
        place = np.fromiter(map(self.memo.__getitem__, chain.from_iterable(cut)), np.int64, int(at[-1]))
        lost = np.concatenate([[0], np.cumsum(~self.good[place])])
        known = np.flatnonzero(lost[at[1:]] == lost[at[:-1]])
        if len(known) < len(cut):
            size = np.diff(at)[known]
            place = place[np.repeat(at[:-1][known] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))]
            at = np.concatenate([[0], np.cumsum(size)])
        return known, _Runs.of([self.a.encode_ordinary(pieces[i]) for i in known.tolist()], np.uint32), self.b_ids.take(place).joined(at)


def _near_middle(a_end: np.ndarray, b_end: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For intervals A[low:high], the index of the common end nearest to the
    middle, the last end left out, among A's ends and B's; -1 if there is none."""
    middle = (low + high - 2) // 2
    at_a, at_b = np.full(len(low), -1), np.full(len(low), -1)
    pending, near, width = np.arange(len(low)), 0, 1
    while len(pending):
        step = np.arange(near, near + width)
        step = step if near == 0 else np.stack([step, -step], 1).ravel()
        asked = middle[pending, None] + step
        inside = (asked >= low[pending, None]) & (asked <= high[pending, None] - 2)
        asked = np.where(inside, asked, middle[pending, None])
        ends = a_end[asked]
        place = np.searchsorted(b_end, ends)  # never past the end: the interval's last end is common
        common = inside & (b_end[place] == ends)
        which = common.argmax(1)
        found = common[np.arange(len(pending)), which]
        at_a[pending[found]], at_b[pending[found]] = asked[found, which[found]], place[found, which[found]]
        pending = pending[~found & inside.any(1)]
        near, width = near + width, 2 * width
    return at_a, at_b


def shared_cuts(a_end: np.ndarray, b_end: np.ndarray, a_first: np.ndarray, b_first: np.ndarray) -> np.ndarray:
    """Indexes into ``a_end`` of the ends that ``b_end`` shares, in order.

    ``a_end`` and ``b_end`` rise over consecutive texts, text k having
    A[a_first[k]:a_first[k + 1]] and B likewise; each text's last ends agree.
    """
    held = a_first[1:] > a_first[:-1]
    a_low, a_high, b_low, b_high = a_first[:-1][held], a_first[1:][held], b_first[:-1][held], b_first[1:][held]
    cuts = [a_high - 1]
    while True:
        split = (a_high - a_low > 1) & (b_high - b_low > 1)  # else nothing lies inside
        a_low, a_high, b_low, b_high = a_low[split], a_high[split], b_low[split], b_high[split]
        if not len(a_low):
            return np.sort(np.concatenate(cuts))
        at_a, at_b = _near_middle(a_end, b_end, a_low, a_high)
        found = at_a >= 0  # else a leaf
        at_a, at_b = at_a[found], at_b[found]
        cuts.append(at_a)
        # halves side by side: the intervals stay in order, and so do the look-ups
        a_low, a_high = np.stack([a_low[found], at_a + 1], 1).ravel(), np.stack([at_a + 1, a_high[found]], 1).ravel()
        b_low, b_high = np.stack([b_low[found], at_b + 1], 1).ravel(), np.stack([at_b + 1, b_high[found]], 1).ravel()


class Aligner:
    """Groups and links of pieces of text."""

    def __init__(self, pair: TokenPair):
        self.pair = pair
        size_a, size_b = len(pair.a_bytes), len(pair.b_bytes)
        self.a_shown = np.array([b"%d%c" % (i, s) for s in b",|" for i in range(size_a)], object).reshape(2, size_a)
        self.b_shown = np.array([b"%d%c" % (i, s) for s in b",;" for i in range(size_b)], object).reshape(2, size_b)

    def align(self, a_ids: _Runs, b_ids: _Runs) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
        """For pieces given by ids: (n_a, n_b, n_groups) of each, its groups as
        text with a final ``;``, where each piece's links begin, and all links
        as id pairs."""
        a, b = a_ids.flat.astype(np.int64), b_ids.flat.astype(np.int64)
        a_first, b_first = a_ids.at, b_ids.at
        a_end, b_end = np.cumsum(self.pair.a_length[a]), np.cumsum(self.pair.b_length[b])
        cuts = shared_cuts(a_end, b_end, a_first, b_first)
        cuts_b = np.searchsorted(b_end, a_end[cuts])
        a_last, b_last = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        a_last[cuts], b_last[cuts_b] = 1, 1
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        # a token's place when groups follow each other, A's tokens before B's
        shown = np.empty(len(a) + len(b), object)
        shown[np.arange(len(a)) + np.concatenate([[0], cuts_b + 1])[a_group]] = self.a_shown[a_last, a]
        shown[np.arange(len(b)) + (cuts + 1)[b_group]] = self.b_shown[b_last, b]
        first = (a_first + b_first).tolist()
        groups = [b"".join(shown[x:y].tolist()) for x, y in zip(first, first[1:])]
        n_groups = np.diff(np.searchsorted(cuts, a_first))
        # between neighbouring ends of either lies one link
        total = int(a_end[-1]) if len(a_end) else 0
        ends_a, ends_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        ends_a[a_end], ends_b[b_end] = True, True
        ends = np.flatnonzero(ends_a | ends_b)
        of_a, of_b = (np.cumsum(x, dtype=np.int32)[ends] - x[ends] for x in (ends_a, ends_b))
        begin = np.concatenate([[0], a_end])[a_first]  # bytes before each piece
        return np.stack([np.diff(a_first), np.diff(b_first), n_groups], 1), groups, np.searchsorted(ends, begin, "right"), a[of_a] << _B_BITS | b[of_b]


def _pieces(text: str) -> Iterator[str]:
    """Blank and text, in pieces that end where a chunk ends."""
    text, at = " " + text, 0
    while len(text) - at > PIECE_CHARS and (edge := _EDGE.search(text, at + PIECE_CHARS)):
        yield text[at:edge.start()]
        at = edge.start()
    yield text[at:]


class Document:
    """Totals and links of one text, added piece by piece."""

    def __init__(self) -> None:
        self.n = np.zeros(3, np.int64)
        self.digest, self.held = hashlib.sha256(), b""
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, n: np.ndarray, groups: bytes, pairs: np.ndarray) -> None:
        self.n += n
        self.digest.update(self.held)
        self.held = groups  # the last ; of all does not count
        self.pairs.append(np.unique(pairs, return_counts=True))

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs and how often each is linked."""
        if len(self.pairs) == 1:
            return self.pairs[0]
        none = np.zeros(0, np.int64)
        pairs, counts = (np.concatenate([none, *x]) for x in zip(*self.pairs)) if self.pairs else (none, none)
        distinct, place = np.unique(pairs, return_inverse=True)
        return distinct, np.bincount(place, counts, len(distinct)).astype(np.int64)

    def groups_sha256(self) -> str:
        if not self.n[0]:
            return ""
        self.digest.update(self.held[:-1])
        self.held = b""
        return self.digest.hexdigest()


def _aligned(aligner: Aligner, texts: list[str | None]) -> list[Document]:
    out = [Document() for _ in texts]
    short = [(d, " " + t) for d, t in zip(out, texts) if t and len(t) < PIECE_CHARS]
    if short:
        known, a, b = aligner.pair.encode([t for _, t in short])
        n, groups, cut, pairs = aligner.align(a, b)
        for k, i in enumerate(known.tolist()):
            short[i][0].add(n[k], groups[k], pairs[cut[k]:cut[k + 1]])
    for i, t in enumerate(texts):
        if t and len(t) >= PIECE_CHARS:
            for piece in _pieces(t):
                known, a, b = aligner.pair.encode([piece])
                if not len(known):
                    out[i] = Document()
                    break
                n, groups, _, pairs = aligner.align(a, b)
                out[i].add(n[0], groups[0], pairs)
    return out


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers below 2^32, by byte planes, compressed."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(numbers).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _unpacked(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    planes = np.frombuffer(pa.decompress(blob[8:], 4 * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel().astype(np.int64)


_LISTS = {"ids": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "groups_sha256": pa.string(), "pairs": pa.int64(), "holders": pa.int64()}
_BLOCK = "ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, groups_sha256 array<string>, pairs array<long>, holders array<long>, first binary, place binary, times binary"


def _block(ids: list, docs: list[Document]) -> pa.RecordBatch:
    links = [d.links() for d in docs]
    size = np.array([len(p) for p, _ in links], np.int64)
    pairs, times = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*links))
    distinct, place, holders = np.unique(pairs, return_inverse=True, return_counts=True)
    n = np.stack([d.n for d in docs])
    lists = {"ids": ids, "n_a": n[:, 0], "n_b": n[:, 1], "n_groups": n[:, 2], "groups_sha256": [d.groups_sha256() for d in docs], "pairs": distinct, "holders": holders}
    arrays = {c: pa.array([v], pa.list_(_LISTS[c])) for c, v in lists.items()}
    # frequent pairs get low numbers, which compress well
    rank = np.empty(len(distinct), np.int64)
    rank[np.argsort(-holders, kind="stable")] = np.arange(len(distinct))
    arrays |= {c: pa.array([_packed(v)], pa.binary()) for c, v in (("first", np.concatenate([[0], np.cumsum(size)])), ("place", rank[place]), ("times", times))}
    return pa.record_batch(arrays)


def _blocks(shared_a, shared_b):
    def made() -> Aligner:
        aligner = Aligner(TokenPair(shared_a.value, shared_b.value))
        trim()
        return aligner

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = only(("align", hash(shared_a.value), hash(shared_b.value)), made)
        ids, docs, held = [], [], 0
        for part in slices(batches, "text", SLICE_BYTES):
            ids += part.column("id").to_pylist()
            texts = part.column("text").to_pylist()
            docs += _aligned(aligner, texts)
            held += sum(len(t) for t in texts if t)
            if held >= BLOCK_BYTES:
                yield _block(ids, docs)
                ids, docs, held = [], [], 0
        aligner.pair.forget()  # the worker may stay idle for long
        if docs:
            yield _block(ids, docs)

    return run


_RESULT = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


@tidy
def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i] for c in batch.schema.names}
            first, place, times = (_unpacked(row[c].as_py()) for c in ("first", "place", "times"))
            pairs, holders = (row[c].values.to_numpy(zero_copy_only=False) for c in ("pairs", "holders"))
            known = row["known"].values.flatten() if row["known"].is_valid else None
            count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
            if known is not None:
                pair, n, top = (x.to_numpy(zero_copy_only=False) for x in known)
                at = np.searchsorted(pairs, pair)
                count[at], best[at] = n, top
            order = np.argsort(-holders, kind="stable")
            count, best = count[order][place], best[order][place]

            def by_doc(values: np.ndarray) -> np.ndarray:
                total = np.concatenate([[0], np.cumsum(values)])
                return total[first[1:]] - total[first[:-1]]

            out = {c: row[c].values for c in ("n_a", "n_b", "n_groups")}
            out |= {"n_links": pa.array(by_doc(times)), "n_best": pa.array(by_doc(times * best)), "count_sum": pa.array(by_doc(times * count)), "groups_sha256": row["groups_sha256"].values}
            yield pa.record_batch({"id": row["ids"].values} | out)


def align(df: DataFrame, a_json: str, b_model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of
    each row: its tokens, groups and links, the links whose pair is held by as
    many documents as any pair of its A id, and the sum of the links' counts."""
    context = df.sparkSession.sparkContext
    shared = context.broadcast(a_json), context.broadcast(b_model)  # two vocabulary files
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    blocks = staged(rows.mapInArrow(_blocks(*shared), _BLOCK).withColumn("block", F.monotonically_increasing_id()), "blocks")
    held = blocks.select("block", F.explode(F.arrays_zip("pairs", "holders")).alias("p")).select("block", F.col("p.pairs").alias("pair"), F.col("p.holders").alias("holders"))
    counts = staged(held.groupBy("pair").agg(F.sum("holders").alias("n")).withColumn("a", F.shiftright("pair", _B_BITS)), "counts")
    ranked = aggregated_join(counts, counts.groupBy("a").agg(F.max("n").alias("most")), "a").select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))
    known = aggregated_join(held.select("block", "pair"), ranked, "pair").groupBy("block").agg(F.collect_list(F.struct("pair", "n", "best")).alias("known"))
    return blocks.join(known, "block", "left").drop("block").mapInArrow(_counted, _RESULT).withColumnRenamed("id", id_col)
