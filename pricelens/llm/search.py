"""Ranked lexical search of many queries at once: shared term sets become partial accumulators, combined along a DAG."""

from __future__ import annotations

import heapq
import math
import string
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import materialize, pieces, text_bytes
from pricelens.llm.sampling import map_texts

LENGTH_PERCENT = 25  # a document's length counts for so much per cent of its norm
#: Bytes that end a term become blanks, A-Z become small; bytes from 0x80 on belong to terms.
TABLE = bytes(i + 32 if chr(i) in string.ascii_uppercase else i if i >= 0x80 or chr(i).isalnum() else 32 for i in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """Maximal runs of 0-9, A-Z, a-z and everything beyond ASCII, A-Z lower-cased."""
    return text.translate(TABLE).split() if text else []


def mine(queries: list[set], least: int = 2) -> tuple[list[tuple], list[list]]:
    """Shared sets of symbols: ``(pairs, rests)``.

    The pair of symbols that most queries have in common becomes a symbol of its own, which takes the pair's place in all of them;
    again and again until no pair is in ``least`` queries. ``pairs[i]`` are the two symbols (or earlier pairs,
    as ``("pair", j)``) that pair i adds up, and ``rests`` what is left of each query: its symbols add up to the query.
    """
    sets = [set(q) for q in queries]
    rank = {s: i for i, s in enumerate(sorted({s for q in sets for s in q}))}
    having: dict = defaultdict(set)
    for i, q in enumerate(sets):
        for s in q:
            having[s].add(i)
    count: Counter = Counter()

    def key(a, b) -> tuple:
        return (a, b) if rank[a] < rank[b] else (b, a)

    for q in sets:
        own = sorted((s for s in q if len(having[s]) >= least), key=rank.__getitem__)
        count.update((a, b) for k, a in enumerate(own) for b in own[k + 1:])
    heap = [(-n, rank[a], rank[b], a, b) for (a, b), n in count.items() if n >= least]
    heapq.heapify(heap)
    pairs: list[tuple] = []
    while heap:
        n, _, _, a, b = heapq.heappop(heap)
        both = having[a] & having[b]
        if len(both) < least:
            continue
        if len(both) < -n:  # counted before other pairs took its symbols: back with its count of now
            heapq.heappush(heap, (-len(both), rank[a], rank[b], a, b))
            continue
        new = ("pair", len(pairs))
        rank[new] = len(rank)
        pairs.append((a, b))
        beside: Counter = Counter()
        for i in both:
            sets[i] -= {a, b}
            beside.update(sets[i])
            sets[i].add(new)
        having[a] -= both
        having[b] -= both
        having[new] = both
        for s, m in beside.items():
            if m >= least:
                x, y = key(s, new)
                heapq.heappush(heap, (-m, rank[x], rank[y], x, y))
    return pairs, [sorted(q, key=rank.__getitem__) for q in sets]


@dataclass
class Plan:
    """One block of queries: leaves, then levels of shared sums, then each query's own sum."""

    vocabulary: dict[bytes, int]  # term -> its column
    leaf_term: np.ndarray  # for each leaf (a term so many times in a query) the term's column
    leaf_times: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # rows of nodes, and of the two nodes that they add up
    nodes: int
    parts: np.ndarray  # nodes of all queries, one after another
    begins: np.ndarray  # where each query's nodes begin
    queries: list[int]  # number of each query

    @staticmethod
    def of(queries: list[tuple[int, list[bytes]]]) -> Plan | None:
        """``queries``: (number, terms). None if none of them has a term."""
        queries = [(i, Counter(q)) for i, q in queries if q]
        if not queries:
            return None
        pairs, rests = mine([set(q.items()) for _, q in queries])
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, q in queries for t in q}))}
        leaves = sorted({leaf for _, q in queries for leaf in q.items()})
        node = {leaf: i for i, leaf in enumerate(leaves)} | {("pair", i): len(leaves) + i for i in range(len(pairs))}
        depth = [0] * len(leaves)
        by_level: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for i, (a, b) in enumerate(pairs):
            x, y = node[a], node[b]
            depth.append(1 + max(depth[x], depth[y]))
            by_level[depth[-1]].append((len(leaves) + i, x, y))
        levels = [tuple(np.array(c, dtype=np.int64) for c in zip(*by_level[d])) for d in sorted(by_level)]
        parts = [[node[s] for s in q] for q in rests]
        begins = np.cumsum([0, *map(len, parts)])[:-1]
        return Plan(vocabulary, np.array([vocabulary[t] for t, _ in leaves]), np.array([n for _, n in leaves], dtype=np.int64), levels, len(depth),
                    np.concatenate(parts).astype(np.int64), begins, [i for i, _ in queries])

    def scores(self, weights: np.ndarray, documents: list[tuple[dict[int, int], int]]) -> np.ndarray:
        """(queries, documents) sums; a document is its terms' frequencies by column, and its length norm ``m``."""
        gain = np.zeros((len(self.vocabulary), len(documents)), dtype=np.int64)
        for j, (tf, m) in enumerate(documents):
            if tf:
                n = np.fromiter(tf.values(), dtype=np.int64, count=len(tf))
                gain[np.fromiter(tf, dtype=np.int64, count=len(tf)), j] = (1_000_000_000 * n) // (1000 * n + 12 * m)
        gain *= weights[:, None]
        total = np.empty((self.nodes, len(documents)), dtype=np.int64)
        total[:len(self.leaf_term)] = gain[self.leaf_term] * self.leaf_times[:, None]
        for out, a, b in self.levels:
            total[out] = total[a] + total[b]
        return np.add.reduceat(total[self.parts], self.begins, axis=0)

    def additions(self) -> tuple[int, int]:
        """Additions that a document takes along the DAG, and without sharing."""
        size = np.zeros(self.nodes, dtype=np.int64)
        size[:len(self.leaf_term)] = 1
        for out, a, b in self.levels:
            size[out] = size[a] + size[b]
        return sum(len(o) for o, _, _ in self.levels) + len(self.parts), int(size[self.parts].sum())


def query_blocks(items: DataFrame, block: int, id_col: str, text_col: str) -> Iterator[list[tuple[int, int | None, list[bytes]]]]:
    """(number, id, terms) of the distinct queries, at most about ``block`` of them at a time."""
    src = items.select(F.col(id_col).cast("long").alias("item_id"), text_bytes(text_col).alias("text")).distinct()
    blocks = max(1, math.ceil(src.count() / block))
    number = 0
    for k in range(blocks):
        rows = src.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        rows = sorted(((r["item_id"], bytes(r["text"] or b"")) for r in rows), key=lambda r: (r[0] is None, r))
        yield [(number + i, item, terms(t)) for i, (item, t) in enumerate(rows)]
        number += len(rows)


def corpus_counts(src: DataFrame, vocabulary: dict[bytes, int]) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and the documents that hold each term of ``vocabulary``: one pass, counted in the tasks."""
    shared = src.sparkSession.sparkContext.broadcast(vocabulary)
    width = len(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, length, df = shared.value.keys(), 0, 0, Counter()
        for b in batches:
            for t in b.column(0):
                words = terms(t.as_py())
                n += bool(words)
                length += len(words)
                df.update(known & set(words))
        ids = [shared.value[t] for t in df] + [width, width + 1]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([*df.values(), n, length], pa.int64())], names=["k", "n"])

    counts = np.zeros(width + 2, dtype=np.int64)
    for r in src.select("text").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        counts[r["k"]] = r["n"]
    return int(counts[width]), int(counts[width + 1]), counts[:width]


def term_weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)


class Best:
    """The ``k`` best (score, id) of every query so far, ties by the smaller id, null ids last."""

    def __init__(self, n: int, k: int):
        self.k, self.rows = k, [[] for _ in range(n)]
        self.least = np.zeros(n, dtype=np.int64)

    def add(self, scores: np.ndarray, ids: list[int | None]) -> None:
        hits = scores >= np.maximum(self.least, 1)[:, None]
        for q in np.flatnonzero(hits.any(axis=1)):
            at = np.flatnonzero(hits[q])
            own = self.rows[q] + [(-int(scores[q, j]), ids[j] is None, ids[j] or 0) for j in at]
            own.sort()
            del own[self.k:]
            self.rows[q] = own
            if len(own) == self.k:
                self.least[q] = -own[-1][0]


def search(docs: DataFrame, items: DataFrame, k: int = 20, block: int = 512, batch: int = 128, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The ``k`` highest-scoring documents of every item: ``(item_id, rank, doc_id, score)``.

    Terms, weights and scores are integers after the weight: see ``terms``, ``term_weights`` and ``Plan.scores``. Documents with score 0 are
    left out; equal scores rank by ascending id.

    1. One pass over all texts counts documents, terms and the documents that hold each term of a block's items.
    2. The term sets that items of the block share are mined (``mine``): each is a node of a DAG, and one partial accumulator a
       document. A second pass counts a batch of whole texts, fills the accumulators level by level, adds up each item's nodes, and keeps
       the ``k`` best of every item in the task.
    3. The tasks' best, ``k`` rows for each task and item, are ranked in two steps: by item and a share of the tasks, then by item.

    Items are the stated query set; they are collected and sent out in blocks of about ``block``, and all documents pass by each block.
    Null and empty texts have no terms and are not counted; an item without terms, or an empty table on either side, gives no rows. Very
    long texts are counted whole, one after another. Rows that repeat an id are documents of their own; a null id ranks last among equals.
    Repeated rows of the items are one item; items with the same id and another text are ranked each by itself.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    schema = "item_id long, rank int, doc_id long, score long"
    out = spark.createDataFrame([], schema)
    for queries in query_blocks(items, block, item_col, item_text_col):
        plan = Plan.of([(i, t) for i, _, t in queries])
        if plan is None:
            continue
        n_docs, length, df = corpus_counts(src, plan.vocabulary)
        if not n_docs:
            continue
        found = materialize(best_of_tasks(src, plan, term_weights(n_docs, df), n_docs, length, k, batch), "search-best")
        order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        some = found.withColumn("r", F.row_number().over(Window.partitionBy("q", "part").orderBy(*order))).where(F.col("r") <= k)
        ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*order))).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, item) for i, item, _ in queries], "q int, item_id long")
        # at most ``block`` rows
        out = out.union(ranked.join(F.broadcast(names), "q").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return out


def best_of_tasks(src: DataFrame, plan: Plan, weights: np.ndarray, n_docs: int, length: int, k: int, batch: int) -> DataFrame:
    """``(q, doc_id, score, part)``: the ``k`` best documents of every query in each task; ``part`` deals the tasks over 64 shares."""
    shared = src.sparkSession.sparkContext.broadcast((plan, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, w = shared.value
        known, best = p.vocabulary, Best(len(p.queries), k)
        for b in pieces(batches, batch):
            ids, documents = [], []
            for doc_id, t in zip(b.column(0).to_pylist(), b.column(1)):
                words = terms(t.as_py())
                if words:
                    ids.append(doc_id)
                    tf = Counter(c for c in map(known.get, words) if c is not None)
                    documents.append((tf, 100 - LENGTH_PERCENT + LENGTH_PERCENT * len(words) * n_docs // length))
            if documents:
                best.add(p.scores(w, documents), ids)
        rows = [(q, None if null else doc_id, -s) for q, own in zip(p.queries, best.rows) for s, null, doc_id in own]
        cols = zip(*rows) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int64()))], names=["q", "doc_id", "score"])

    return src.mapInArrow(run, "q int, doc_id long, score long").withColumn("part", F.spark_partition_id() % 64)
