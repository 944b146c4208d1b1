"""Vector codes: product quantisation with exact integer k-means.

Components become whole numbers, vectors are cut into equal parts, and each
part position gets a small codebook by rounds of assignment and averaging.

*Blocks.*  Each task cuts its vectors into chunks of a few megabytes.  Within
a chunk the points of a part position are sorted along a Hilbert curve and cut
into flat blocks of ``BLOCK`` points; each block stores its box (smallest and
largest components) and the sum of its points.  The chunks are written once to
the shared folder; every round reads them.

*Rounds.*  For a block and a codebook entry, the box gives the least and the
greatest possible distance.  Entries that are farther from all of the box than
another entry is at most are left out; the rest is the block's shortlist.  A
block with one entry left gives its stored sum without looking at a point; for
the others small whole-number kernels compare each point with the shortlist.
A task hands back one sum and count for each part, entry and component; Spark
adds them up, and the driver sees the codebook alone (its size is fixed by
parts, entries and dimensions).

Sums and distances are whole numbers, so that results do not depend on how
rows are dealt.  Defined results: rows whose vector is null or holds a null,
NaN or infinite component are left out; repeated rows count each for itself;
ties go to the lower entry; null ids come last when the first codebook is
chosen, and among equal ids the vectors' order decides; with fewer vectors
than entries the codebook is shorter; an empty table gives no rows; columns
other than the three named ones are ignored, whatever their names.  Vectors
must have one length, divisible by the number of parts, and components small
enough for 64-bit distances; otherwise a ValueError says so.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from relq.operators.joins import aggregated_join

from .memory import drop, tidy
from .staging import staged

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
BLOCK = 64
CHUNK_BYTES = 2 << 20
_KEY_BITS = 64


def hilbert_keys(points: np.ndarray) -> np.ndarray:
    """Places along a Hilbert curve of points (n, width) of whole numbers.

    The box of all points is laid over a grid; of more than 64 dimensions the
    first 64 count.  The order only decides how tight blocks are.
    """
    n, width = points.shape
    width = min(width, _KEY_BITS)
    if not n or not width:
        return np.zeros(n, np.uint64)
    bits = max(1, min(12, _KEY_BITS // width))
    low = points[:, :width].min(0)
    span = np.maximum((points[:, :width].max(0) - low).astype(np.float64), 1.0)
    grid = ((points[:, :width] - low) / span * ((1 << bits) - 1)).astype(np.uint64).T.copy()
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        bit, below = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for i in range(width):
            turned = (grid[i] & bit) != 0
            swapped = np.where(turned, np.uint64(0), (grid[0] ^ grid[i]) & below)
            grid[0] ^= np.where(turned, below, swapped)
            if i:
                grid[i] ^= swapped
    for a, b in zip(grid[:-1], grid[1:]):
        b ^= a
    flips = np.zeros(n, np.uint64)
    for level in range(bits - 1, 0, -1):
        flips ^= np.where(grid[-1] & np.uint64(1 << level), np.uint64((1 << level) - 1), np.uint64(0))
    grid ^= flips
    keys = np.zeros(n, np.uint64)
    for level in range(bits - 1, -1, -1):
        for axis in grid:
            keys = (keys << one) | ((axis >> np.uint64(level)) & one)
    return keys


def _starts(n: int) -> np.ndarray:
    return np.arange(0, n, BLOCK)


def _sizes(n: int) -> np.ndarray:
    return np.diff(np.append(_starts(n), n))


class Blocks:
    """One part position of a chunk: points in curve order, boxes and sums."""

    def __init__(self, points: np.ndarray, low: np.ndarray, high: np.ndarray, total: np.ndarray):
        self.points, self.low, self.high, self.total = points, low, high, total
        self.size = _sizes(len(points))

    @classmethod
    def of(cls, points: np.ndarray) -> Blocks:
        """``points`` are in curve order."""
        at = _starts(len(points))
        return cls(points, np.minimum.reduceat(points, at), np.maximum.reduceat(points, at), np.add.reduceat(points.astype(np.int64), at))

    def shortlists(self, book: np.ndarray) -> np.ndarray:
        """(blocks, entries): whether an entry may be the nearest of a point."""
        shape = len(self.size), len(book)
        least, most = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        low, high = self.low.astype(np.int64), self.high.astype(np.int64)
        for k, entry in enumerate(book):
            below, above = low - entry, entry - high
            outside = np.maximum(np.maximum(below, above), 0)
            far = np.maximum(np.abs(below), np.abs(above))
            least[:, k], most[:, k] = (outside * outside).sum(1), (far * far).sum(1)
        return least <= most.min(1, keepdims=True)

    def nearest(self, book: np.ndarray, short: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the points of ``blocks``: their places, nearest entries, distances."""
        size = self.size[blocks]
        begin = np.cumsum(size) - size
        at = np.repeat(blocks * BLOCK - begin, size) + np.arange(int(size.sum()))
        points = self.points[at].astype(np.int64)
        best, entry = np.full(len(at), np.iinfo(np.int64).max), np.zeros(len(at), np.int64)
        for k in range(len(book)):
            asked = np.flatnonzero(np.repeat(short[blocks, k], size))
            if len(asked):
                gap = points[asked] - book[k]
                distance = np.einsum("ij,ij->i", gap, gap)
                nearer = distance < best[asked]  # ties stay with the lower entry
                asked = asked[nearer]
                best[asked], entry[asked] = distance[nearer], k
        return at, entry, best

    def sums(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many points each entry gets, and their sums."""
        short = self.shortlists(book)
        alone = short.sum(1) == 1
        whole, mixed = np.flatnonzero(alone), np.flatnonzero(~alone)
        owner = short[whole].argmax(1)
        at, entry, _ = self.nearest(book, short, mixed)
        k, width = book.shape
        count, total = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        np.add.at(count, owner, self.size[whole])
        np.add.at(total, owner, self.total[whole])
        count += np.bincount(entry, minlength=k)
        points = self.points[at]
        for j in range(width):  # float64 holds these sums exactly
            total[:, j] += np.bincount(entry, points[:, j], k).astype(np.int64)
        return count, total


def whole_numbers(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows kept, their vectors as floor(scale * x)) of a list column."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    end = np.cumsum(size)
    kept = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False) & (bad[end] == bad[end - size]))
    widths = np.unique(size[kept])
    if len(widths) > 1:
        raise ValueError(f"vectors of different lengths: {widths.tolist()}")
    width = int(widths[0]) if len(widths) else 0
    at = (end - size)[kept][:, None] + np.arange(width)
    return kept, _floored(flat[at], scale)


def _floored(x: np.ndarray, scale: int) -> np.ndarray:
    big = np.abs(x).max(initial=0.0)
    # 4 * dims * max^2 is the most that a distance over all parts can be
    limit = (2.0 ** 61 / max(1, x.shape[1])) ** 0.5 - 1
    if big * scale > limit:
        raise ValueError(f"component {big} is too large for 64-bit distances (limit {limit / scale:.6g})")
    return np.floor(x * scale).astype(np.int32)


_LEAST = T.ArrayType(T.StructType([T.StructField("id", T.LongType()), T.StructField("vector", T.ArrayType(T.LongType()))]))


def _chunk_schema(label: T.DataType) -> T.StructType:
    binary = [T.StructField(c, T.BinaryType()) for c in ("points", "placed", "low", "high", "total")]
    return T.StructType([T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("labels", T.ArrayType(label)), T.StructField("width", T.IntegerType()), *binary, T.StructField("least", _LEAST)])


def _chunk(ids: pa.Array, labels: pa.Array, vectors: np.ndarray, parts: int, entries: int) -> pa.RecordBatch:
    n, width = vectors.shape
    if width % parts:
        raise ValueError(f"vectors of {width} components can't be cut into {parts} equal parts")
    placed = np.empty((parts, n), np.int32)
    columns: dict[str, list[bytes]] = {c: [] for c in ("points", "low", "high", "total")}
    for p, points in enumerate(np.split(vectors, parts, 1)):
        placed[p] = np.argsort(hilbert_keys(points), kind="stable")
        own = Blocks.of(np.ascontiguousarray(points[placed[p]]))
        for name, kept in columns.items():
            kept.append(getattr(own, name).tobytes())
    key = np.where(ids.is_valid().to_numpy(zero_copy_only=False), pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), np.iinfo(np.int64).max)
    first = np.lexsort((*vectors.T[::-1], key, pc.is_null(ids).to_numpy(zero_copy_only=False)))[:entries]
    least = [{"id": ids[int(i)].as_py(), "vector": vectors[i].tolist()} for i in first]
    arrays = {"ids": pa.array([ids], pa.list_(pa.int64())), "labels": pa.array([labels], pa.list_(labels.type)), "width": pa.array([width], pa.int32())}
    arrays |= {"points": pa.array([b"".join(columns["points"])], pa.binary()), "placed": pa.array([placed.tobytes()], pa.binary())}
    arrays |= {c: pa.array([b"".join(columns[c])], pa.binary()) for c in ("low", "high", "total")}
    arrays["least"] = pa.array([least], pa.list_(pa.struct([("id", pa.int64()), ("vector", pa.list_(pa.int64()))])))
    return pa.record_batch(arrays)


def _chunks(parts: int, entries: int, scale: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop()
        held: list[tuple[pa.Array, pa.Array, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            ids, labels, vectors = zip(*held)
            if len({v.shape[1] for v in vectors}) > 1:
                raise ValueError(f"vectors of different lengths: {sorted({v.shape[1] for v in vectors})}")
            held.clear()
            return _chunk(pa.concat_arrays(ids), pa.concat_arrays(labels), np.concatenate(vectors), parts, entries)

        for batch in batches:
            kept, vectors = whole_numbers(batch.column("vector"), scale)
            step = max(BLOCK, CHUNK_BYTES // max(1, 4 * vectors.shape[1]))
            for at in range(0, len(kept), step):
                rows = pa.array(kept[at:at + step])
                held.append((batch.column("id").take(rows), batch.column("label").take(rows), vectors[at:at + step]))
                if sum(v.nbytes for _, _, v in held) >= CHUNK_BYTES:
                    yield flush()
        if held:
            yield flush()

    return run


def _parts_of(row: dict, parts: int) -> Iterator[Blocks]:
    """The part positions of a stored chunk."""
    n, width = len(row["ids"]), row["width"] // parts
    shape = parts, len(_starts(n)), width
    points = np.frombuffer(row["points"], np.int32).reshape(parts, n, width)
    low, high = (np.frombuffer(row[c], np.int32).reshape(shape) for c in ("low", "high"))
    total = np.frombuffer(row["total"], np.int64).reshape(shape)
    for p in range(parts):
        yield Blocks(points[p], low[p], high[p], total[p])


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch.column(c)[i].values if pa.types.is_list(batch.column(c).type) else batch.column(c)[i].as_py() for c in names}


_STORED = ["ids", "width", "points", "low", "high", "total"]


def _round(book: np.ndarray):
    """Counts and sums of a task's points by part and entry, for one round."""
    parts, entries, width = book.shape

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop()
        count, total = np.zeros((parts, entries, 1), np.int64), np.zeros(book.shape, np.int64)
        for row in _rows(batches, _STORED):
            for p, blocks in enumerate(_parts_of(row, parts)):
                n, sums = blocks.sums(book[p])
                count[p, :, 0] += n
                total[p] += sums
        values = np.concatenate([count, total], 2)
        part, entry, place = np.nonzero(values)
        yield pa.record_batch({"part": pa.array(part, pa.int32()), "entry": pa.array(entry, pa.int32()), "place": pa.array(place, pa.int32()), "value": pa.array(values[part, entry, place], pa.int64())})

    return run


def improved(book: np.ndarray, chunks: DataFrame) -> np.ndarray:
    """The codebooks after one more round over all points."""
    values = np.zeros((*book.shape[:2], book.shape[2] + 1), object)
    added = chunks.select(*_STORED).mapInArrow(_round(book), "part int, entry int, place int, value long").groupBy("part", "entry", "place").agg(F.sum("value").alias("value"))
    for r in added.collect():  # at most one for each component of the codebooks and their counts
        values[r["part"], r["entry"], r["place"]] = r["value"]
    used = values[:, :, 0] > 0
    new = book.copy()
    new[used] = (values[used][:, 1:] // values[used][:, :1]).astype(np.int64)
    return new


def _assigned(book: np.ndarray):
    parts = len(book)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop()
        hexed = np.array([f"{k:02x}" for k in range(book.shape[1])])
        for row in _rows(batches, [*_STORED, "labels", "placed"]):
            n = len(row["ids"])
            placed = np.frombuffer(row["placed"], np.int32).reshape(parts, n)
            code, error = np.empty((n, parts), hexed.dtype), np.zeros(n, np.int64)
            for p, blocks in enumerate(_parts_of(row, parts)):
                at, entry, distance = blocks.nearest(book[p], blocks.shortlists(book[p]), np.arange(len(blocks.size)))
                own = placed[p][at]
                code[own, p] = hexed[entry]
                error[own] += distance
            joined = np.ascontiguousarray(code).view(f"U{2 * parts}").ravel()
            yield pa.record_batch({"id": row["ids"], "label": row["labels"], "code": pa.array(joined.tolist(), pa.string()), "error": pa.array(error)})

    return run


def train(chunks: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (parts, entries, width) of staged chunks; None without vectors."""
    widths = [r["width"] for r in chunks.select("width").distinct().limit(2).collect()]
    if len(widths) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(widths)}")
    if not widths:
        return None
    least = chunks.select(F.explode("least").alias("v")).select("v.*").orderBy(F.asc_nulls_last("id"), "vector").limit(entries)
    first = [r["vector"] for r in least.collect()]
    first = np.array(first, np.int64).reshape(len(first), parts, widths[0] // parts)
    book = np.ascontiguousarray(first.transpose(1, 0, 2))
    for _ in range(rounds):
        book = improved(book, chunks)
    return book


def chunked(df: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int = PARTS, entries: int = ENTRIES, scale: int = SCALE) -> DataFrame:
    """The kept vectors as staged chunks of Hilbert-sorted blocks."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label"))
    return staged(rows.mapInArrow(_chunks(parts, entries, scale), _chunk_schema(df.schema[label_col].dataType)), "vectors")


def encode(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(id, label, code, error, label_error, codebooks_sha256) of each kept row.

    ``error``: the squared distances to the chosen entries, summed over parts;
    ``label_error``: these summed over the rows of a label (nulls are one)."""
    chunks = chunked(df, id_col, vector_col, label_col, parts, entries)
    label = df.schema[label_col].dataType
    out = T.StructType([T.StructField("id", T.LongType()), T.StructField("label", label), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    book = train(chunks, parts, entries, rounds)
    if book is None:
        book = np.zeros((parts, 0, 0), np.int64)
    digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    codes = staged(chunks.select(*_STORED, "labels", "placed").mapInArrow(_assigned(book), out), "codes")
    codes = codes.withColumn("group", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")))
    codes = aggregated_join(codes, codes.groupBy("group").agg(F.sum("error").alias("label_error")), "group")
    return codes.select(F.col("id").alias(id_col), F.col("label").alias(label_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def oracle_sql(dims: int = 64, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same codes in DuckDB's SQL, for vectors of ``dims`` components."""
    width = dims // parts

    def assigned(book: str) -> str:
        distance = " + ".join(f"(p.x[{i}] - c.x[{i}]) * (p.x[{i}] - c.x[{i}])" for i in range(1, width + 1))
        return f"SELECT p.vec_id, p.part, any_value(p.x) AS x, arg_min(c.entry, ({distance}) * {entries} + c.entry) AS entry, min({distance}) AS d FROM p JOIN {book} c ON c.part = p.part GROUP BY p.vec_id, p.part"

    def floor_mean(i: int) -> str:
        return f"CAST((sum(x[{i}]) - ((sum(x[{i}]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT)"

    steps = [f"""WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda v: CAST(floor({SCALE} * CAST(v AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0)""",
             f"p AS MATERIALIZED (SELECT vec_id, part, v[part * {width} + 1:(part + 1) * {width}] AS x FROM kept, (SELECT CAST(range AS INTEGER) AS part FROM range({parts})))",
             f"b0 AS MATERIALIZED (SELECT part, entry, x FROM (SELECT part, x, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM p) WHERE entry < {entries})"]
    for r in range(rounds):
        means = ", ".join(floor_mean(i) for i in range(1, width + 1))
        steps.append(f"m{r} AS MATERIALIZED (SELECT part, entry, [{means}] AS x FROM ({assigned(f'b{r}')}) GROUP BY part, entry)")
        steps.append(f"b{r + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM b{r} b LEFT JOIN m{r} m ON m.part = b.part AND m.entry = b.entry)")
    steps.append(f"coded AS MATERIALIZED (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM ({assigned(f'b{rounds}')}) GROUP BY vec_id)")
    return ",\n".join(steps) + f"""
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) FROM b{rounds}) AS codebooks_sha256
FROM kept k JOIN coded c ON c.vec_id = k.vec_id"""
