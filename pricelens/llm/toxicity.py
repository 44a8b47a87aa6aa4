"""Toxicity: non-negative positive-unlabelled learning."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import text_bytes
from pricelens.llm.sampling import map_texts, row_sums, sample_ids, sigmoid

BITS = 18
PREFIXES = (4, 5)
#: ASCII letters lower-cased; ASCII digits and signs become blanks.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def features(text: bytes | None) -> np.ndarray:
    """Sorted hashed indices of the text's distinct words and of their beginnings."""
    words = set(text.translate(FOLD).split()) if text else ()
    found = [xxhash.xxh3_64_intdigest(w) for w in words]
    for k in PREFIXES:
        found += [xxhash.xxh3_64_intdigest(w, k) for w in {w[:k] for w in words if len(w) >= k}]
    return np.unique((np.array(found, dtype=np.uint64) >> np.uint64(64 - BITS)).astype(np.int32))


@dataclass
class Model:
    bias: float
    weights: np.ndarray  # (2 ** BITS,) float32

    def margin(self, starts: np.ndarray, idx: np.ndarray) -> np.ndarray:
        return self.bias + row_sums(self.weights[idx], starts)


def risk(z: np.ndarray, positive: np.ndarray, prior: float) -> tuple[float, np.ndarray]:
    """Non-negative risk of margins ``z`` under the logistic loss, and its gradient.

    The negative class has no examples: its risk is that of the unlabelled rows less the positives' share of it,
    prior times the risk of positives taken as negative. Where that estimate falls below zero, which only overfitting
    can bring about, its gradient is turned round, as non-negative positive-unlabelled learning does.
    """
    p, u = positive, ~positive
    n_p, n_u = max(1, p.sum()), max(1, u.sum())
    as_positive, as_negative = np.logaddexp(0, -z), np.logaddexp(0, z)
    negative = as_negative[u].sum() / n_u - prior * as_negative[p].sum() / n_p
    g, s = np.zeros_like(z), sigmoid(z)
    turn = 1.0 if negative >= 0 else -1.0
    g[u] = turn * s[u] / n_u
    g[p] = -turn * prior * s[p] / n_p + (prior * (s[p] - 1) / n_p if turn > 0 else 0)
    return prior * as_positive[p].sum() / n_p + max(0.0, negative), g


def telling(positive: np.ndarray, starts: np.ndarray, idx: np.ndarray, min_z: float) -> np.ndarray:
    """Features whose share of rows differs between positives and unlabelled by ``min_z`` standard errors, in five rows at least."""
    p_rows = np.repeat(positive, np.diff(starts))
    n_p, n_u = positive.sum(), (~positive).sum()
    in_p, in_u = (np.bincount(idx[k], minlength=1 << BITS) for k in (p_rows, ~p_rows))
    share = (in_p + in_u + 0.5) / (n_p + n_u + 1)
    z = (in_p / n_p - in_u / n_u) / np.sqrt(share * (1 - share) * (1 / n_p + 1 / n_u))
    return np.flatnonzero((np.abs(z) >= min_z) & (in_p + in_u >= 5))


def fit(positive: np.ndarray, starts: np.ndarray, idx: np.ndarray, prior: float, min_z: float, epochs: int, rate: float, l2: float, seed: int) -> Model:
    """Adam over shuffled batches that hold positives and unlabelled rows in the sample's proportion."""
    rng = np.random.default_rng(seed)
    used = telling(positive, starts, idx, min_z)
    place = np.full(1 << BITS, -1)
    place[used] = np.arange(len(used))
    w, b = np.zeros(len(used)), float(np.log(prior / (1 - prior)))
    m1, m2, c1, c2, t = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0, 0
    where = [rng.permutation(np.flatnonzero(k)) for k in (positive, ~positive)]
    batches = max(1, len(positive) // 1024)
    for _ in range(epochs):
        split = [np.array_split(rng.permutation(k), batches) for k in where]
        for rows in (np.concatenate(x) for x in zip(*split)):
            i = place[np.concatenate([idx[starts[r]:starts[r + 1]] for r in rows])]
            bounds = np.concatenate([[0], np.cumsum(starts[rows + 1] - starts[rows])])
            row, keep = np.repeat(np.arange(len(rows)), np.diff(bounds)), i >= 0
            i, row = i[keep], row[keep]
            z = b + np.bincount(row, weights=w[i], minlength=len(rows))
            _, g = risk(z, positive[rows], prior)
            gw = np.bincount(i, weights=g[row], minlength=len(w)) + l2 * w
            t += 1
            m1, m2 = 0.9 * m1 + 0.1 * gw, 0.999 * m2 + 0.001 * gw ** 2
            w -= rate * (m1 / (1 - 0.9 ** t)) / (np.sqrt(m2 / (1 - 0.999 ** t)) + 1e-8)
            c1, c2 = 0.9 * c1 + 0.1 * g.sum(), 0.999 * c2 + 0.001 * g.sum() ** 2
            b -= rate * (c1 / (1 - 0.9 ** t)) / (np.sqrt(c2 / (1 - 0.999 ** t)) + 1e-8)
    full = np.zeros(1 << BITS, dtype=np.float32)
    full[used] = w
    return placed(Model(b, full), positive, starts, idx, prior)


def placed(m: Model, positive: np.ndarray, starts: np.ndarray, idx: np.ndarray, prior: float, at: float = 0.7, slope: float = 2.0) -> Model:
    """The same order of texts, with score ``at`` where toxic and other rows part.

    Positive-unlabelled margins are timid, as every batch also holds toxic rows as unlabelled. The parting is taken
    halfway between the margin that leaves the prior's share of the unlabelled rows above it, and the one that leaves
    95 in 100 confirmed rows above it.
    """
    z = m.margin(starts, idx)
    cut = 0.5 * (np.quantile(z[~positive], 1 - prior) + np.quantile(z[positive], 0.05))
    return Model(float(slope * (m.bias - cut) + np.log(at / (1 - at))), (slope * m.weights).astype(np.float32))


def train(docs: DataFrame, confirmed: DataFrame, unlabelled: DataFrame, prior: float, max_positive: int = 3000, max_unlabelled: int = 9000, min_z: float = 4.0,
          epochs: int = 30, rate: float = 0.02, l2: float = 1e-4, seed: int = 5, id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """Learn from the ids in ``confirmed`` (toxic) and ``unlabelled`` (any), at most ``max_positive`` and ``max_unlabelled`` of them.

    ``prior`` is the share of toxic text among the unlabelled. Only feature indices of those rows come to the
    driver. None if there is no confirmed text or no unlabelled text, or the prior is not inside 0..1.
    """
    if not 0 < prior < 1:
        return None
    kinds = [(confirmed, 1, max_positive), (unlabelled, 0, max_unlabelled)]
    ids = [sample_ids(t.select(F.col(id_col).cast("long").alias("doc_id"), F.lit(y).alias("y")).where("doc_id is not null").distinct(), n, seed) for t, y, n in kinds]
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    src = src.join(F.broadcast(ids[0].union(ids[1])), "doc_id").select("y", "doc_id", "text")  # max_positive + max_unlabelled ids

    def run(b: pa.RecordBatch) -> list:
        return [b.column(0), b.column(1), pa.array([features(t.as_py()).tobytes() for t in b.column(2)], pa.binary())]

    seen = map_texts(src, run, "y int, doc_id long, i binary")
    seen = seen.groupBy("y", "doc_id").agg(F.min("i").alias("i"))  # one row an id, also where ids repeat
    rows = sorted((r["y"], r["doc_id"], bytes(r["i"])) for r in seen.collect())
    positive = np.array([r[0] == 1 for r in rows], dtype=bool)
    if positive.all() or not positive.any():
        return None
    idx = [np.frombuffer(r[2], dtype=np.int32) for r in rows]
    return fit(positive, np.concatenate([[0], np.cumsum([len(i) for i in idx])]), np.concatenate(idx), prior, min_z, epochs, rate, l2, seed)


def score(docs: DataFrame, model: Model | None, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score, predicted)`` of every whole text, one row per row of ``docs``; score is the probability of toxic.

    Null and empty texts have no features and get the model's bias. Without a model the score is 0. A very long text is
    scored whole by its distinct features. Rows that repeat, and null ids, are scored each for itself; an empty table gives
    an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(b: pa.RecordBatch) -> list:
        m = shared.value
        p = np.zeros(b.num_rows)
        if m is not None:
            got = [features(t.as_py()) for t in b.column(1)]
            p = sigmoid(m.margin(np.concatenate([[0], np.cumsum([len(i) for i in got])]), np.concatenate(got)))
        return [b.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))]

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    return map_texts(src, run, "doc_id long, score double, predicted int")
