"""Language ID: a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are cut into windows of ``WINDOW`` bytes, all of them,
the last one shorter.  In each window a gated recurrent unit runs over the
bytes from the left and another from the right; at every position their
states give the probability of each language.  A document's probabilities are
the means over all its positions.

The network is trained in numpy by backpropagation through time on a bounded
sample of labelled rows (``SAMPLE_ROWS`` for each language at most, the ones
with the smallest hash; ``SPAN`` bytes of each), in ``STEPS`` batches that hold
as many windows of each language.  Languages may be any number: from 65 on each
has fewer rows, so that the sample has ``SAMPLE_TOTAL`` (one row of each at
least), and from ``BATCH + 1`` on a batch holds a random choice of them, with
as many more steps.  Gates are piecewise linear (cheap to
evaluate for every byte of a corpus).  Prediction runs over
whole texts.

Defined results: a null text and one without a letter is ``und`` with score 0
(as is every text if there is nothing to learn from); repeated rows are
predicted each for itself; a tie goes to the alphabetically first language.
Language, source and id are never inputs.  An empty table gives no rows; other
columns are ignored by ``predict`` and kept by ``accepted``, whatever their names.
All bytes of a text are read, in windows, however long it is.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import column_bytes, slices
from .memory import drop, tidy

WINDOW = 192
STATE = 8
SAMPLE_ROWS = 1500
TRAIN_WINDOW, SPAN = 64, 256
STEPS = 320
BATCH = 128
RATE = 0.015
SAMPLE_TOTAL = 64 * SAMPLE_ROWS
_LANES, _CELLS = 2048, 64 * 2048  # windows evaluated side by side; windows times languages


def _gate(x: np.ndarray) -> np.ndarray:
    """min(max(x / 4 + 1/2, 0), 1), in place."""
    x *= 0.25
    x += 0.5
    return np.clip(x, 0.0, 1.0, out=x)


class Network:
    """Parameters of both directions and of the output."""

    def __init__(self, languages: list[str], state: int = STATE, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages, self.state = languages, state
        self.p = {}
        for d in "lr":  # from the left, from the right
            self.p[f"in_{d}"] = rng.normal(0, 0.5, (256, 3 * state)).astype(np.float32)  # update, reset, candidate
            self.p[f"in_{d}"][:, :2 * state] *= 0.5
            self.p[f"gate_{d}"] = rng.normal(0, 0.4, (state, 2 * state)).astype(np.float32)
            self.p[f"cand_{d}"] = rng.normal(0, 0.4, (state, state)).astype(np.float32)
            self.p[f"out_{d}"] = rng.normal(0, 0.4, (state, len(languages))).astype(np.float32)
        self.p["bias"] = np.zeros(len(languages), np.float32)

    def states(self, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States after each step of ``x`` (steps, lanes), which is in the order
        in which direction ``d`` reads."""
        n, p = self.state, self.p
        table, gate, cand = p[f"in_{d}"], p[f"gate_{d}"], p[f"cand_{d}"]
        h = np.zeros((x.shape[1], n), np.float32)
        out = np.empty((*x.shape, n), np.float32)
        for t in range(len(x)):
            a = table[x[t]]
            raw = a[:, :2 * n] + h @ gate
            z = _gate(raw.copy()) if keep is not None else _gate(raw)
            u, r = z[:, :n], z[:, n:]
            c = np.tanh(a[:, 2 * n:] + (r * h) @ cand)
            new = h + u * (c - h)
            if keep is not None:
                keep.append((t, h, u, r, c, (z > 0) & (z < 1)))
            out[t] = h = new
        return out

    def probabilities(self, x: np.ndarray, back: np.ndarray, length: np.ndarray) -> np.ndarray:
        """(steps, lanes, languages) for byte windows ``x`` (steps, lanes) and
        ``back``, the same read from their ends; ``length``: each lane's bytes.
        What a lane holds beyond its length changes nothing before."""
        y = self.states(x, "l") @ self.p["out_l"]
        steps = np.arange(len(x))[:, None]
        mirrored = np.maximum(length - 1 - steps, 0)[:, :, None]
        y += np.take_along_axis(self.states(back, "r") @ self.p["out_r"], mirrored, 0)
        y += self.p["bias"]
        y -= y.max(2, keepdims=True)
        np.exp(y, out=y)
        y /= y.sum(2, keepdims=True)
        y[steps >= length] = 0
        return y

    def gradients(self, x: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over all positions and its gradient by backpropagation
        through time; ``label``: each lane's language."""
        n, p, grad = self.state, self.p, {k: np.zeros_like(v) for k, v in self.p.items()}
        kept, states = {d: [] for d in "lr"}, {}
        order = {"l": x, "r": x[::-1]}
        for d in "lr":
            states[d] = self.states(order[d], d, kept[d])
        y = states["l"] @ p["out_l"] + (states["r"] @ p["out_r"])[::-1] + p["bias"]
        y -= y.max(2, keepdims=True)
        e = np.exp(y)
        prob = e / e.sum(2, keepdims=True)
        lanes = np.arange(x.shape[1])
        loss = float(-np.log(prob[:, lanes, label] + 1e-9).mean())
        dy = prob
        dy[:, lanes, label] -= 1
        dy /= x.size
        grad["bias"] = dy.sum((0, 1))
        for d in "lr":
            own = dy if d == "l" else dy[::-1]
            grad[f"out_{d}"] = np.einsum("tbn,tbl->nl", states[d], own)
            back, dh = own @ p[f"out_{d}"].T, np.zeros((x.shape[1], n), np.float32)
            gate, cand = p[f"gate_{d}"], p[f"cand_{d}"]
            for t, h, u, r, c, inner in reversed(kept[d]):
                dh = dh + back[t]
                dc = dh * u * (1 - c * c)
                du = dh * (c - h)
                drh = dc @ cand.T
                dz = np.concatenate([du, drh * h], 1) * inner * np.float32(0.25)
                np.add.at(grad[f"in_{d}"], order[d][t], np.concatenate([dz, dc], 1))
                grad[f"gate_{d}"] += h.T @ dz
                grad[f"cand_{d}"] += (r * h).T @ dc
                dh = dh * (1 - u) + drh * r + dz @ gate.T
        return loss, grad


def train(windows: list[bytes], label: list[str], seed: int = 7) -> Network:
    """A network fitted by Adam on equally long byte windows."""
    languages = sorted(set(label))
    net = Network(languages, seed=seed)
    if len(languages) < 2:
        return net
    x = np.frombuffer(b"".join(windows), np.uint8).reshape(len(windows), -1).T
    y = np.array([languages.index(v) for v in label])
    of_language = [np.flatnonzero(y == i) for i in range(len(languages))]
    share = max(1, BATCH // len(languages))
    rng, first, second = np.random.default_rng(seed), {}, {}
    steps = STEPS * -(-len(languages) // BATCH)
    for step in range(1, steps + 1):
        drawn = of_language if len(languages) <= BATCH else [of_language[i] for i in rng.choice(len(languages), BATCH, replace=False)]
        own = np.concatenate([rng.choice(rows, share) for rows in drawn])
        _, grad = net.gradients(x[:, own], y[own])
        rate = RATE * (1 - step / (steps + 1))
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        for k, g in grad.items():
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            first[k] = 0.9 * first.get(k, 0) + 0.1 * g
            second[k] = 0.99 * second.get(k, 0) + 0.01 * g * g
            net.p[k] -= (rate * first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return net


def document_scores(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(documents, languages): mean probabilities over all positions."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    doc = np.repeat(np.arange(len(size)), count)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[:-1][doc] + number * WINDOW
    length = np.minimum(WINDOW, offsets[1:][doc] - start)
    out = np.zeros((len(size), len(net.languages)), np.float64)
    order = np.argsort(-length, kind="stable")  # short last windows side by side
    lanes = max(1, min(_LANES, _CELLS // max(1, len(net.languages))))
    for at in range(0, len(order), lanes):
        own = order[at:at + lanes]
        steps = int(length[own].max())
        # a short window is repeated cyclically: no byte outside of the text is read
        step = np.arange(steps)[:, None] % length[own]
        y = net.probabilities(data[start[own] + step], data[start[own] + length[own] - 1 - step], length[own])
        np.add.at(out, doc[own], y.sum(0, dtype=np.float64))
    return out / np.maximum(size, 1)[:, None]


def learning_rows(df: DataFrame, id_col: str, lang_col: str) -> DataFrame:
    """Rows to learn from: a language is given and crc32(id) mod 4 is not 2."""
    return df.where(F.col(lang_col).isNotNull() & (F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 != 2))


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Network:
    """Train on a bounded sample: for each language the ``SAMPLE_ROWS`` distinct
    texts with the smallest hash, ``SPAN`` bytes of each (at a place that the
    hash says), cut into windows of ``TRAIN_WINDOW`` (a shorter one is
    repeated).  Twice as many rows are expected to reach the driver, whatever
    the table's size: those whose hash is below a bound set by row counts.
    Besides, one count for each language does."""
    rows = learning_rows(df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")), "id", "lang")
    place = F.pmod(F.xxhash64(F.xxhash64("text")), F.lit(1 << 62))
    found = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min(F.when(F.length("text") > 0, place)).alias("least")).collect()
    most = min(SAMPLE_ROWS, max(1, SAMPLE_TOTAL // max(1, len(found))))
    # whatever the bound by counts leaves, each language keeps its smallest
    bounds = [(r["lang"], max(min(1 << 62, int((1 << 62) * 2 * most / r["n"])), (-1 if r["least"] is None else r["least"]) + 1)) for r in found]
    # as an Arrow table: one of Python rows would start further Python workers on each executor
    bounds = pa.table({"lang": pa.array([x[0] for x in bounds], pa.string()), "below": pa.array([x[1] for x in bounds], pa.int64())})
    rows = rows.join(F.broadcast(df.sparkSession.createDataFrame(bounds)), "lang")
    low = rows.where(F.length("text") > 0).withColumn("h", F.xxhash64("text")).where(F.pmod(F.xxhash64("h"), F.lit(1 << 62)) < F.col("below"))
    raw = F.encode("text", "utf-8")
    at = F.pmod(F.col("h"), F.greatest(F.octet_length("text") - SPAN + 1, F.lit(1))).cast("int") + 1
    picked = low.select("lang", "h", F.substring(raw, at, F.lit(SPAN)).alias("raw")).dropDuplicates(["lang", "h"]).collect()
    taken, of_language = [], {}
    for r in picked:
        of_language.setdefault(r["lang"], []).append((r["h"], bytes(r["raw"])))
    for language in sorted(of_language):
        taken += [(raw, language) for _, raw in sorted(of_language[language])[:most]]
    windows, label = [], []
    for raw, language in taken:
        for place in range(0, max(1, len(raw) - TRAIN_WINDOW // 2), TRAIN_WINDOW):
            own = raw[place:place + TRAIN_WINDOW]
            windows.append((own * -(-TRAIN_WINDOW // len(own)))[:TRAIN_WINDOW])
            label.append(language)
    return train(windows, label) if taken else Network([])


SCHEMA = "id long, held_out boolean, lang_pred string, score double"


def predict(df: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, lang_pred, score) of each row."""
    shared = df.sparkSession.sparkContext.broadcast(net)  # fixed size: the parameters

    def run(batches):
        drop()
        net = shared.value
        for part in slices(batches, "text"):
            ids = part.column("id").to_pylist()
            lang, score = judge(net, part.column("text"))
            held = [i is not None and zlib.crc32(str(i).encode()) % 4 == 2 for i in ids]
            yield pa.record_batch({"id": pa.array(ids, pa.int64()), "held_out": pa.array(held, pa.bool_()), "lang_pred": pa.array(lang, pa.string()), "score": pa.array(score, pa.float64())})

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidy(run), SCHEMA).withColumnRenamed("id", id_col)


MIN_SCORE = 0.35


def judge(net: Network, texts: pa.Array) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    values = texts.to_pylist()
    letters = [bool(t) and any(map(str.isalpha, t)) for t in values]
    if not net.languages:
        return ["und"] * len(values), [0.0] * len(values)
    y = document_scores(net, *column_bytes(texts))
    best, score = y.argmax(1), y.max(1)
    return ([net.languages[b] if ok else "und" for b, ok in zip(best, letters)], [float(x) if ok else 0.0 for x, ok in zip(score, letters)])


def accepted(df: DataFrame, net: Network, text_col: str = "text", least: float = MIN_SCORE) -> DataFrame:
    """The rows of ``df`` whose language is told: not ``und``, and with a score
    of at least ``least`` (below it no language holds a fair share of the text)."""
    shared = df.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        drop()
        for part in slices(batches, text_col):
            lang, score = judge(shared.value, part.column(text_col))
            yield part.filter(pa.array([x != "und" and s >= least for x, s in zip(lang, score)]))

    return df.mapInArrow(tidy(run), df.schema)


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the labelled rows of ``df`` and predict all of them."""
    return predict(df, fit(df, id_col, text_col, lang_col), id_col, text_col)
