"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import mix, text_bytes, window_hash, word_hashes
from pricelens.llm.repetition import repeated
from pricelens.llm.sampling import map_texts, row_sums, sample_ids, sigmoid

HASHED = 1 << 14
STATS = ("log words", "mean word length", "upper case", "digits", "punctuation", "exclamation marks", "log lines", "log words per line", "repeated lines",
         "word equals the one before", "distinct words", "most frequent word", "one-character words", "words in repeated trigrams", "deviation of word length",
         "log n_chars", "n_chars per word")
DIM = HASHED + len(STATS)
_BYTES = np.arange(256)
UPPER = (_BYTES >= 65) & (_BYTES <= 90)
DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
PUNCT = np.array([33 <= b < 127 and not chr(b).isalnum() for b in range(256)])


def features(text: bytes | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(indices, values): unit-length log counts of hashed lower-cased words, then the raw statistics."""
    text = text or b""
    words, size = text.split(), max(1, len(text))
    n = len(words)
    hist = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    lines = [x for x in text.split(b"\n") if x.strip()]
    h = word_hashes([w.lower() for w in words])[:, 0]
    counts = np.bincount((h & np.uint64(HASHED - 1)).astype(np.int64), minlength=HASHED)
    at = np.flatnonzero(counts)
    value = np.log1p(counts[at])
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    tri = repeated(mix(window_hash(h, 3)))
    stats = np.array([
        np.log1p(n), lengths.mean() if n else 0, hist[UPPER].sum() / size, hist[DIGIT].sum() / size, hist[PUNCT].sum() / size, hist[33] / size,
        np.log1p(len(lines)), np.log1p(n / max(1, len(lines))), 1 - len(set(lines)) / max(1, len(lines)), float((h[1:] == h[:-1]).mean()) if n > 1 else 0,
        len(set(words)) / max(1, n), counts.max() / max(1, n), float((lengths == 1).mean()) if n else 0, len(tri) / max(1, n), lengths.std() if n else 0,
        np.log1p(max(0, n_chars or 0)), (n_chars or 0) / max(1, n),
    ])
    return (np.append(at, HASHED + np.arange(len(STATS))).astype(np.int32),
            np.append(value / max(1e-9, np.sqrt((value ** 2).sum())), stats).astype(np.float32))


@dataclass
class Machine:
    bias: float
    linear: np.ndarray  # (DIM,)
    factors: np.ndarray  # (DIM, rank)
    centre: np.ndarray  # of the statistics
    spread: np.ndarray

    def scaled(self, idx: np.ndarray, val: np.ndarray) -> np.ndarray:
        s = idx >= HASHED
        out = val.astype(np.float64)
        j = idx[s] - HASHED
        out[s] = np.clip((out[s] - self.centre[j]) / self.spread[j], -4, 4)
        return out

    def margin(self, starts: np.ndarray, idx: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Value of every row, and its factor sums: pairs cost linear time, as the sum of products over all pairs is
        half the square of the sum less the sum of squares."""
        vx = self.factors[idx] * x[:, None]
        s = row_sums(vx, starts)
        pairs = 0.5 * ((s ** 2).sum(axis=1) - row_sums((vx ** 2).sum(axis=1), starts))
        return self.bias + row_sums(self.linear[idx] * x, starts) + pairs, s


def fit(y: np.ndarray, weight: np.ndarray, starts: np.ndarray, idx: np.ndarray, val: np.ndarray, rank: int, epochs: int, rate: float, l2: float, seed: int) -> Machine:
    """AdaGrad on the weighted logistic loss, in shuffled batches of 128 rows."""
    rng = np.random.default_rng(seed)
    stats = val.reshape(-1)[idx >= HASHED].reshape(len(y), len(STATS)).astype(np.float64)
    m = Machine(float(np.log((weight * y).sum() / max(1e-9, (weight * (1 - y)).sum()))), np.zeros(DIM), rng.normal(0, 0.02, (DIM, rank)),
                stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-6))
    x = m.scaled(idx, val)
    seen_w, seen_v, seen_b = np.full(DIM, 1e-6), np.full((DIM, rank), 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(y), 128):
            rows = order[k:k + 128]
            size = starts[rows + 1] - starts[rows]
            at = np.concatenate([np.arange(starts[r], starts[r + 1]) for r in rows])
            bounds, row = np.concatenate([[0], np.cumsum(size)]), np.repeat(np.arange(len(rows)), size)
            i, xi = idx[at], x[at]
            z, s = m.margin(bounds, i, xi)
            g = (sigmoid(z) - y[rows]) * weight[rows] / len(rows)
            gx = g[row] * xi
            own, place = np.unique(i, return_inverse=True)
            gw = np.bincount(place, weights=gx) + l2 * m.linear[own]
            pull = gx[:, None] * (s[row] - m.factors[i] * xi[:, None])
            gv = np.stack([np.bincount(place, weights=pull[:, f]) for f in range(rank)], axis=1) + l2 * m.factors[own]
            seen_w[own] += gw ** 2
            seen_v[own] += gv ** 2
            seen_b += g.sum() ** 2
            m.linear[own] -= rate * gw / np.sqrt(seen_w[own])
            m.factors[own] -= 0.3 * rate * gv / np.sqrt(seen_v[own])
            m.bias -= rate * g.sum() / np.sqrt(seen_b)
    return m


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    n_chars = F.coalesce(docs["n_chars"].cast("long"), F.length(docs[text_col])) if "n_chars" in docs.columns else F.length(docs[text_col]).cast("long")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"), n_chars.alias("n_chars"))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 2000, rank: int = 8, epochs: int = 8, rate: float = 0.1, l2: float = 1e-5, seed: int = 11,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Machine | None:
    """Learn from at most ``per_class`` rows of each label 0 and 1 (pass only label rows to learn from).

    The sample's weights bring the labels back to their share among all of ``labels``. Labels that are null or not
    0 or 1, and repeated label rows, are left out. None unless both labels occur.
    """
    y = F.col(label_col).cast("int")
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), y.alias("y")).where("doc_id is not null and y in (0, 1)").distinct()
    total = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    ids = sample_ids(known, per_class, seed)
    src = _source(docs, id_col, text_col).join(F.broadcast(ids), "doc_id").select("y", "doc_id", "text", "n_chars")  # two times per_class ids

    def run(b: pa.RecordBatch) -> list:
        got = [features(t.as_py(), c.as_py()) for t, c in zip(b.column(2), b.column(3))]
        return [b.column(0), b.column(1), pa.array([i.tobytes() for i, _ in got], pa.binary()), pa.array([v.tobytes() for _, v in got], pa.binary())]

    seen = map_texts(src, run, "y int, doc_id long, i binary, v binary")
    seen = seen.groupBy("y", "doc_id").agg(F.min(F.struct("i", "v")).alias("f")).select("y", "doc_id", "f.*")  # one row an id, also where ids repeat
    rows = sorted((r["y"], r["doc_id"], bytes(r["i"]), bytes(r["v"])) for r in seen.collect())
    y = np.array([r[0] for r in rows], dtype=np.float64)
    if len(set(y)) < 2:
        return None
    idx = [np.frombuffer(r[2], dtype=np.int32) for r in rows]
    starts = np.concatenate([[0], np.cumsum([len(i) for i in idx])])
    weight = np.array([total[c] for c in (0, 1)], dtype=float) / np.bincount(y.astype(int))
    weight = (weight / (weight * np.bincount(y.astype(int))).sum() * len(y))[y.astype(int)]
    return fit(y, weight, starts, np.concatenate(idx), np.concatenate([np.frombuffer(r[3], dtype=np.float32) for r in rows]), rank, epochs, rate, l2, seed)


def score(docs: DataFrame, model: Machine | None, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score, predicted)`` of every whole text, one row per row of ``docs``; score is the probability of label 1.

    Null and empty texts are scored by their (empty) statistics. Without a model the score is 0.5.
    A very long text is scored whole by its distinct words. Rows that repeat, and null ids, are scored each for itself;
    an empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(b: pa.RecordBatch) -> list:
        m = shared.value
        p = np.full(b.num_rows, 0.5)
        if m is not None:
            got = [features(t.as_py(), c.as_py()) for t, c in zip(b.column(1), b.column(2))]
            idx = np.concatenate([i for i, _ in got])
            starts = np.concatenate([[0], np.cumsum([len(i) for i, _ in got])])
            p = sigmoid(m.margin(starts, idx, m.scaled(idx, np.concatenate([v for _, v in got])))[0])
        return [b.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))]

    return map_texts(_source(docs, id_col, text_col), run, "doc_id long, score double, predicted int")
