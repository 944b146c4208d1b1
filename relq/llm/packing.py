"""Best-fit packing of tokenized documents into sequences of fixed length.

Bounded-space online best-fit: a fixed number of open sequences is kept in a
bitset keyed by free space.  A piece goes to the open sequence with the least
free space that holds it (the lowest set bit from its length on); if none
does, a new one is opened, and when the bound is reached the fullest open
sequence closes first.

Documents are dealt to packing groups by a hash of id and piece, so a hot id
or source spreads evenly, and within a group the pieces arrive in the order of
that hash, ``RUN_ROWS`` at a time; a run is placed longest first, so that its short
pieces fill what its long ones leave.  The bound on open sequences is reached
again and again, and what closes is full but for a few tokens: on the given
tables a group of 16,384 documents takes one or two sequences more than its
tokens need at least (longest first over a whole group would take none, and
thousands of open sequences; plain arrival takes half a percent more).  Each
group packs for itself.

Defined results: a null or empty text is the end token alone; a document
longer than a sequence is cut into full sequences and a rest; repeated rows
are packed each for itself; a null id is packed like any other; an empty table
gives no rows; columns other than id and text are ignored, whatever their names.
A text of any length is encoded as a whole and cut into sequences.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .arrays import byte_letters, slices
from .memory import only, tidy, trim

SEQUENCE = 4096
OPEN_LIMIT = 256
RUN_ROWS = 1024
DOCS_PER_GROUP = 16_384
END_ID = 1
# How the file's pre-tokenizer cuts lower-cased text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SHORT, LONG = "stmd", ("re", "ve", "ll")  # what stands behind the apostrophe of a word of its own

_PLAIN = 0x300  # code points below: NFC as they are, two bytes at most
_INNER, _LAST = 0x100, 0x200  # letters for a word's bytes (inner ones from 0x80 on) and for its last byte


class WordEncoder:
    """Ids of a word-level BPE tokenizer file.

    The file's model merges the bytes of a word, the last of which carries the
    end-of-word mark.  Texts of code points below U+0300 are cut into words as
    arrays and rewritten with one letter for each byte and another for a byte
    that ends a word; over these letters the merges are those of a plain byte
    pair encoding, which ``tiktoken`` runs.  Other texts, and those that hold a
    special token's text, are encoded by ``tokenizers``.
    """

    def __init__(self, tokenizer_json: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        spec = json.loads(tokenizer_json)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        if split["pattern"]["Regex"] != WORDS or [n["type"] for n in spec["normalizer"]["normalizers"]] != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("a tokenizer of another kind")
        odd = [f"[{chr(_PLAIN)}-\U0010ffff\x1c-\x1f]", *(re.escape(t["content"]) for t in spec["added_tokens"])]
        self.odd = re.compile("|".join(odd)).search
        self.kind = np.array([0 if regex.match(r"\s", chr(c)) else 1 if regex.match(r"\p{L}", chr(c)) else 2 if regex.match(r"\p{N}", chr(c)) else 3 for c in range(_PLAIN)], np.uint8)

        mark, letters = model["end_of_word_suffix"], byte_letters()
        symbol = {c + m: chr((_LAST if m else _INNER if b >= 0x80 else 0) + b).encode() for c, b in letters.items() for m in ("", mark)}

        def written(token: str) -> bytes:
            last = token.endswith(mark)
            own = token[:-len(mark)] if last else token
            return b"".join([*(symbol[c] for c in own[:-1]), symbol[own[-1] + mark * last]])

        ranks = {bytes([b]): b for b in range(256)}
        ids = dict.fromkeys(range(256), -1)
        for token, code in symbol.items():  # written as two bytes: joined before all else
            rank = ranks.setdefault(code, len(ranks))
            ids[rank] = model["vocab"][token]
        for x, y in (m.split(" ") if isinstance(m, str) else m for m in model["merges"]):
            rank = ranks.setdefault(written(x + y), len(ranks))
            ids[rank] = model["vocab"][x + y]
        self.ids = np.array([ids[r] for r in range(len(ranks))], np.int64).astype("<u4")
        self.words = tiktoken.Encoding("words", pat_str=f"[^{chr(_LAST)}-{chr(_LAST + 255)}]*[{chr(_LAST)}-{chr(_LAST + 255)}]", mergeable_ranks=ranks, special_tokens={})

    def _ends(self, points: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Which code points end a word; ``points`` is followed by white space."""
        end = np.zeros(len(points), bool)
        end[:-1] = (kind[:-1] != 0) & ((kind[:-1] == 2) | (kind[:-1] != kind[1:]))
        at = np.flatnonzero(points == ord("'"))
        at = at[(at == 0) | (kind[at - 1] != 3)]  # else it is inside a run of signs
        one = np.isin(points[at + 1], [ord(c) for c in SHORT])
        following = np.minimum(at + 2, len(points) - 1)
        two = np.zeros(len(at), bool)
        for x, y in LONG:
            two |= (points[at + 1] == ord(x)) & (points[following] == ord(y))
        end[at[one | two]] = False
        end[at[two] + 1] = False
        end[at[one] + 1], end[at[two] + 2] = True, True
        return end

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        low = [t.lower() for t in texts]
        plain = [not self.odd(t) and not self.odd(w) for t, w in zip(texts, low)]
        own = [w for w, p in zip(low, plain) if p]
        # a blank behind each text
        points = np.frombuffer("".join([w + " " for w in own]).encode("utf-32-le"), "<u4")
        kind = self.kind[points]
        end, used, wide = self._ends(points, kind), kind != 0, points >= 0x80
        size = used * (1 + wide.astype(np.int64))
        at = np.concatenate([[0], np.cumsum(size)])
        letters = np.zeros(int(at[-1]), "<u4")
        two = used & wide
        letters[at[:-1][two]] = _INNER + (0xC0 | points[two] >> 6)
        byte = np.where(wide, 0x80 | points & 0x3F, points)
        letters[at[1:][used] - 1] = (byte + np.where(end, _LAST, np.where(wide, _INNER, 0)))[used]
        first = at[np.concatenate([[0], np.cumsum([len(w) + 1 for w in own])]).astype(np.int64)].tolist()
        written = letters.tobytes().decode("utf-32-le")
        rows = (self.ids[np.array(self.words.encode_ordinary(written[a:b]), np.int64)].tobytes() for a, b in zip(first, first[1:]))
        return [next(rows) if p else self._whole(t) for t, p in zip(texts, plain)]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def tokenized_pieces(df: DataFrame, tokenizer_json: str, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE, keep_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of each row's pieces."""
    shared = df.sparkSession.sparkContext.broadcast(tokenizer_json)  # fixed size: the vocabulary file
    key, end = ("words", hash(tokenizer_json)), END_ID.to_bytes(4, "little")

    def made() -> WordEncoder:
        encoder = WordEncoder(shared.value)
        trim()  # the file's parsed form is gone
        return encoder

    @tidy
    def run(batches):
        encoder = only(key, made)
        for part in slices(batches, "text"):
            rows = []
            for doc, ids in zip(part.column("id").to_pylist(), encoder.encode([t or "" for t in part.column("text").to_pylist()])):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * sequence)):
                    own = ids[at:at + 4 * sequence]
                    rows.append((doc, piece, at // 4, len(own) // 4, zlib.crc32(own), own))
            doc, piece, start, length, crc, own = zip(*rows)
            out = {"id": pa.array(doc, pa.int64()), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}
            yield pa.record_batch(out | ({"ids": pa.array(own, pa.binary())} if keep_ids else {}))

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids).withColumnRenamed("id", id_col)


class OpenSequences:
    """The open sequences of one packing group."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.bits, self.count, self.made = 0, 0, 0
        self.free: dict[int, list[int]] = {}  # free space -> open sequences

    def _take(self, space: int) -> int:
        own = self.free[space]
        number = own.pop()
        if not own:
            self.bits ^= 1 << space
        self.count -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) of a piece."""
        fits = self.bits >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            number = self._take(space)
        else:
            space, number = self.capacity, self.made
            self.made += 1
        left = space - length
        if left:
            if self.count >= self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)
            own = self.free.setdefault(left, [])
            if not own:
                self.bits |= 1 << left
            own.append(number)
            self.count += 1
        return number, self.capacity - space


def _in_runs(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Table, list[tuple[int, int, int]]]]:
    """Rows in tables, with (group, first, end) of runs of at most ``size`` rows
    of a group; runs are counted from a group's first row on."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        group = table.column("pack_group").to_numpy()
        begin = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(group)]
        runs = [(int(group[a]), x, min(x + size, b)) for a, b in zip(begin, begin[1:]) if b > a for x in range(a, b, size)]
        keep = runs.pop()[1] if runs and runs[-1][2] - runs[-1][1] < size else len(group)  # may go on
        if runs:
            yield table.slice(0, keep), runs
        rest = table.slice(keep).combine_chunks()
    if rest is not None and rest.num_rows:
        yield rest, [(rest.column("pack_group")[0].as_py(), 0, rest.num_rows)]


def pack(pieces: DataFrame, groups: int, id_col: str = "doc_id", sequence: int = SEQUENCE, open_limit: int = OPEN_LIMIT, run_rows: int = RUN_ROWS) -> DataFrame:
    """``pieces`` (with piece and length) and their sequence_id and offset.

    ``groups``: how many packing groups; a group's rows pass the packer as a
    stream, in the order of a hash, ``run_rows`` at a time.
    """
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, open_ = None, None
        for table, runs in _in_runs(batches, run_rows):
            length = table.column("length").to_numpy()
            number, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for g, a, b in runs:
                if g != group:
                    group, open_ = g, OpenSequences(sequence, open_limit)
                for i in (a + np.argsort(-length[a:b], kind="stable")).tolist():
                    n, offset[i] = open_.place(int(length[i]))
                    number[i] = (g << 36) + n
            out = table.drop_columns(["pack_group"]).append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offset))
            yield from out.combine_chunks().to_batches()

    dealt = pieces.withColumn("pack_hash", F.xxhash64(id_col, "piece", "length")).withColumn("pack_group", F.pmod("pack_hash", F.lit(groups)))
    dealt = dealt.repartition(groups, "pack_group").sortWithinPartitions("pack_group", "pack_hash", id_col, "piece").drop("pack_hash")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return dealt.mapInArrow(packed, schema)


def pack_documents(df: DataFrame, tokenizer_json: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenize and pack: one row for each piece of each document."""
    groups = max(1, -(-df.select(id_col).count() // DOCS_PER_GROUP))
    return pack(tokenized_pieces(df, tokenizer_json, id_col, text_col), groups, id_col)
