"""Benchmark decontamination: CGK embedding of edit distance, bit-sampling LSH, exact edit verification."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import mix, pieces, text_bytes, window_hash, word_hashes

FILTER_BITS = 18
MATCH = 0.6  # share of embedding coordinates that two windows at the edit threshold have in common, for the number of tables

LONG = 12  # items of at least so many words have an index of their own, whose windows no shorter item narrows
AGREE = 0.4  # share of all coordinates that a candidate must have in common with an entry in one of the walks


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z) words."""
    return text.lower().split() if text else []


def embed(symbols: np.ndarray, starts: np.ndarray, steps: int) -> list[np.ndarray]:
    """CGK walk from every start: at each step put out the symbol and move on if the symbol's bit for the step says so.

    The bits come from the symbol itself (a hash for this repetition), so equal texts walk alike, and after an
    edit two walks fall into step again at random: their Hamming distance follows the edit distance.
    """
    at, out = starts.copy(), []
    for t in range(steps):
        s = symbols[at]
        out.append(s)
        at += ((s >> np.uint64(t)) & np.uint64(1)).astype(np.int64)
    return out


@dataclass
class Short:
    """Items of fewer words than the embedding needs, found by word equality: for each length and run hash the items."""

    runs: dict[int, dict[int, list[tuple[int, list[bytes]]]]]

    def matches(self, number: int, words: list[bytes], h: np.ndarray) -> Iterator[tuple[int, int, int, int, int, int]]:
        """Rows of ``matches`` for one text: the first place of each item."""
        for n, items in self.runs.items():
            run = window_hash(h, n).view(np.int64)
            at = np.flatnonzero(np.isin(run, np.fromiter(items, dtype=np.int64)))
            for key in np.unique(run[at]).tolist():
                for item, want in items[key]:
                    place = next((p for p in at[run[at] == key].tolist() if words[p:p + n] == want), None)
                    if place is not None:
                        yield number, item, n, 0, place, place + n


def build_short(items: list[tuple[int, bytes]], min_words: int) -> Short | None:
    """The items of one to ``min_words - 1`` words; None if there are none."""
    runs: dict[int, dict[int, list[tuple[int, list[bytes]]]]] = {}
    for i, t in items:
        words = words_of(t)
        if 0 < len(words) < min_words:
            key = int(window_hash(word_hashes(words)[:, 0], len(words)).view(np.int64)[0])
            same = runs.setdefault(len(words), {}).setdefault(key, [])
            same.append((i, words))
    return Short(runs) if runs else None


@dataclass
class Index:
    """Tables of sampled embedding coordinates of the items of one block, and what verification needs."""

    stride: int
    steps: int
    seeds: list[int]  # one walk each
    samples: list[list[np.ndarray]]  # for each walk the coordinates of each of its tables
    tables: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]]  # sorted keys, entries, key filter
    walked: list[list[np.ndarray]]  # the entries' embeddings
    agree: int  # coordinates that a candidate must have in common with an entry
    entry_item: np.ndarray
    entry_offset: np.ndarray
    items: list[tuple[int, list[int], dict[int, int]]]  # id, word hashes, pattern masks
    similarity: float

    def symbols(self, h: np.ndarray, walk: int) -> np.ndarray:
        return mix(h ^ np.uint64(self.seeds[walk]))

    @staticmethod
    def key(walked: list[np.ndarray], sample: np.ndarray) -> np.ndarray:
        out = np.zeros_like(walked[0])
        with np.errstate(over="ignore"):
            for c in sample:
                out = out * np.uint64(0x9E3779B97F4A7C15) + walked[c]
        return mix(out)

    def candidates(self, h: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(anchor number, entry) pairs with a key in common and near by Hamming distance, each once; ``h`` has ``steps`` pads after every text."""
        found = []
        for w in range(len(self.seeds)):
            walked = embed(self.symbols(h, w), anchors, self.steps)
            for sample, (keys, entries, seen) in zip(self.samples[w], self.tables[w]):
                k = self.key(walked, sample)
                hit = np.flatnonzero(seen[k >> np.uint64(64 - FILTER_BITS)])
                low, high = np.searchsorted(keys, k[hit], "left"), np.searchsorted(keys, k[hit], "right")
                n = high - low
                who = np.repeat(hit, n)
                nth = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
                entry = entries[np.repeat(low, n) + nth]
                same = np.zeros(len(who), dtype=np.int64)
                for own, other in zip(walked, self.walked[w]):
                    same += own[who] == other[entry]
                near = same >= self.agree
                found.append(np.stack([who[near], entry[near]], axis=1))
        both = np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), dtype=np.int64)
        return both[:, 0], both[:, 1]


@dataclass
class Block:
    """What is sent out for one block of the benchmark."""

    indexes: list[Index]
    short: Short | None


def build_index(items: list[tuple[int, bytes]], similarity: float, recall: float, min_words: int, below: int | None = None,
                walks: int = 4, per_key: int = 3, seed: int = 17) -> Index | None:
    """Index of the ``items`` (id, text) of at least ``min_words`` words, and fewer than ``below``; None if there are none.

    Texts are looked at from every ``stride``-th word only. So that none is missed, each item is entered at every
    word from which the window of the shortest item still fits: whichever of a passage's words a text is looked at from, the item has an
    entry that begins with that word, and a passage is tried once for each ``stride`` words it has.
    """
    split = [(i, words_of(t)) for i, t in items]
    split = [(i, w) for i, w in split if min_words <= len(w) < (below or math.inf)]
    if not split:
        return None
    shortest = min(len(w) for _, w in split)
    stride = max(1, min(8, shortest // 3))
    window = shortest - stride + 1
    steps = min(60, 2 * window)
    rng = np.random.default_rng(seed)
    per_key = min(per_key, steps)
    tables = math.ceil(math.log(1 - recall) / math.log(1 - MATCH ** per_key))
    per_walk = math.ceil(tables / walks)
    hashes = [word_hashes(w)[:, 0] for _, w in split]
    flat = np.concatenate([np.append(h, np.zeros(steps, dtype=np.uint64)) for h in hashes])
    begins = np.concatenate([[0], np.cumsum([len(h) + steps for h in hashes])])
    entry_item = np.concatenate([np.full(len(h) - window + 1, i) for i, h in enumerate(hashes)])
    entry_offset = np.concatenate([np.arange(len(h) - window + 1) for h in hashes])
    starts = begins[entry_item] + entry_offset
    masks = []
    for h in hashes:
        m: dict[int, int] = {}
        for k, x in enumerate(h.tolist()):
            m[x] = m.get(x, 0) | 1 << k
        masks.append(m)
    index = Index(stride, steps, [int(x) for x in rng.integers(1, 2 ** 63, walks)],
                  [[np.sort(rng.choice(steps, per_key, replace=False)) for _ in range(per_walk)] for _ in range(walks)], [], [], math.ceil(AGREE * steps),
                  entry_item, entry_offset, [(i, h.tolist(), m) for (i, _), h, m in zip(split, hashes, masks)], similarity)
    for w in range(walks):
        walked = embed(index.symbols(flat, w), starts, steps)
        row = []
        for sample in index.samples[w]:
            k = index.key(walked, sample)
            order = np.argsort(k, kind="stable")
            seen = np.zeros(1 << FILTER_BITS, dtype=bool)
            seen[k >> np.uint64(64 - FILTER_BITS)] = True
            row.append((k[order], order, seen))
        index.tables.append(row)
        index.walked.append(walked)
    return index


def edits_inside(masks: dict[int, int], n: int, text: list[int]) -> int:
    """Fewest word edits that turn the pattern of ``n`` words into any run of ``text`` (bit-parallel)."""
    ones = (1 << n) - 1
    plus, minus, score, best, top = ones, 0, n, n, 1 << (n - 1)
    for x in text:
        eq = masks.get(x, 0)
        d = (((eq & plus) + plus) ^ plus) | eq | minus
        h_plus, h_minus = (minus | ~(d | plus)) & ones, d & plus
        if h_plus & top:
            score += 1
        elif h_minus & top:
            score -= 1
        h_plus, h_minus = (h_plus << 1) & ones, (h_minus << 1) & ones
        plus, minus = (h_minus | ~(d | h_plus)) & ones, h_plus & d
        best = min(best, score)
    return best


def align(pattern: list[int], text: list[int]) -> tuple[int, int, int]:
    """(edits, begin, end) of the run of ``text`` nearest to ``pattern``; ties: the earliest end, then the latest begin."""
    row = [(0, -j) for j in range(len(text) + 1)]  # edits, minus the begin
    for i, x in enumerate(pattern, 1):
        new = [(i, 0)]
        for j, y in enumerate(text, 1):
            new.append(min((row[j - 1][0] + (x != y), row[j - 1][1]), (row[j][0] + 1, row[j][1]), (new[j - 1][0] + 1, new[j - 1][1])))
        row = new
    edits, begin, end = min((e, b, j) for j, (e, b) in enumerate(row))
    return edits, -begin, end


def matches(block: Block, texts: list[bytes | None]) -> list[tuple[int, int, int, int, int, int]]:
    """(text number, item id, item words, edits, begin word, end word) of each item found in each text: its best place."""
    words = [words_of(t) for t in texts]
    hashes = [word_hashes(w)[:, 0] for w in words]
    out = [m for index in block.indexes for m in near_matches(index, hashes)]
    if block.short is not None:
        out += [m for k, (w, h) in enumerate(zip(words, hashes)) for m in block.short.matches(k, w, h)]
    return out


def near_matches(index: Index, hashes: list[np.ndarray]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows of ``matches`` for the items of one index, given the word hashes of the texts."""
    pad = np.zeros(index.steps, dtype=np.uint64)
    begins = np.concatenate([[0], np.cumsum([len(h) + len(pad) for h in hashes])])
    anchors = [np.arange(0, len(h), index.stride) for h in hashes]
    if not sum(map(len, anchors)):
        return []
    flat = np.concatenate([x for h in hashes for x in (h, pad)])
    owner, place = np.repeat(np.arange(len(hashes)), [len(a) for a in anchors]), np.concatenate(anchors)
    who, entry = index.candidates(flat, begins[owner] + place)
    start = place[who] - index.entry_offset[entry]
    best: dict[tuple[int, int], tuple] = {}
    for t, i, s in sorted(set(zip(owner[who].tolist(), index.entry_item[entry].tolist(), start.tolist()))):
        item, pattern, masks = index.items[i]
        n = len(pattern)
        most = int((1 - index.similarity) * n + 1e-9)
        if best.get((t, i), (n,))[0] == 0:
            continue
        low = max(0, s - most)
        near = hashes[t][low:max(0, s + n + most)].tolist()
        # a run within the edits has all but that many of the item's words
        if sum(map(masks.__contains__, near)) >= n - most and edits_inside(masks, n, near) <= most:
            edits, b, e = align(pattern, near)
            best[t, i] = min(best.get((t, i), (n,)), (edits, low + b, low + e, item, n))
    return [(t, item, n, edits, b, e) for (t, _), (edits, b, e, item, n) in best.items()]


def index_blocks(benchmark: DataFrame, similarity: float, recall: float, min_words: int, block_bytes: int, id_col: str, text_col: str) -> Iterator[Block]:
    """Indexes over blocks of the benchmark of about ``block_bytes`` of text each: the bound of what is collected and sent out."""
    src = benchmark.select(F.col(id_col).cast("long").alias("item"), text_bytes(text_col).alias("text")).where("item is not null and text is not null").distinct()
    total = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    for k in range(blocks if total else 0):
        rows = sorted((r["item"], bytes(r["text"])) for r in src.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k).collect())
        middle, long = build_index(rows, similarity, recall, min_words, LONG), build_index(rows, similarity, recall, max(LONG, min_words))
        block = Block([x for x in (middle, long) if x is not None], build_short(rows, min_words))
        if block.indexes or block.short:
            yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, recall: float = 0.97, min_words: int = 5, block_bytes: int = 4_000_000,
               id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Benchmark items inside documents: ``(doc_id, item_id, item_words, edits, similarity, begin_word, end_word)``.

    One row for each row of ``docs`` and item of which some run of words is within ``(1 - similarity) * item_words`` word edits
    of the item (words in lower case); of several such runs the nearest, then first. Candidates come from bit-sampling
    tables over CGK embeddings of item-sized windows, as many as ``recall`` needs for one window, and all are verified by exact
    edit distance, so no row is wrong. Identical passages are always found.

    The benchmark is taken in blocks of about ``block_bytes``; each block's index is sent out and all documents pass by it, without a
    shuffle. Within a block items of fewer than 12 words have an index of their own. Items of fewer than ``min_words`` words
    are found where their words stand as they are, without edits (at 0.8 similarity fewer than five words allow none). Null and
    empty items and texts match nothing; texts are looked at whole, however long; rows that repeat are each judged. Items with
    the same id and another text are different items. An empty table on either side gives no rows.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    schema = "doc_id long, item_id long, item_words int, edits int, similarity double, begin_word int, end_word int"
    names = [x.split()[0] for x in schema.split(", ")]
    out = docs.sparkSession.createDataFrame([], schema)
    for block in index_blocks(benchmark, similarity, recall, min_words, block_bytes, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32())
            for b in pieces(batches, 128):
                ids = b.column(0).to_pylist()
                rows = [(ids[t], item, n, edits, 1 - edits / n, begin, end) for t, item, n, edits, begin, end in matches(shared.value, [t.as_py() for t in b.column(1)])]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        out = out.union(src.mapInArrow(run, schema))
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, recall: float = 0.97, min_words: int = 5, block_bytes: int = 4_000_000,
               text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark item (see ``find_leaks``); all columns and names stay."""
    for block in index_blocks(benchmark, similarity, recall, min_words, block_bytes, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, at=docs.columns.index(text_col)) -> Iterator[pa.RecordBatch]:
            for b in pieces(batches, 128):
                texts = [None if t is None else t.encode() for t in b.column(at).to_pylist()]
                bad = {m[0] for m in matches(shared.value, texts)}
                yield b.filter(pa.array([i not in bad for i in range(b.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
