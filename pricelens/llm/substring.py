"""Substring dedup: a count-min prefilter over word windows, then exact groups of the windows it lets through."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.llm.common import binary_blocks, covered, materialize, mix, partitions, power_of_two, row_key, text_bytes, window_hash, word_hashes

BLOCK_BITS = 16  # cells of a sketch block: 2 ** 16, so that a cell in a block is two bytes
FLUSH = 4_000_000  # cells a task gathers before it hands on a partial sketch
BYTES_PER_WORD = 6  # only sizes the sketch
GRAM_MULT = 0xC2B2AE3D27D4EB4F


def word_matrix(text: bytes | None) -> tuple[list[bytes], np.ndarray]:
    words = text.split() if text else []
    return words, word_hashes(words)


def sketch_cells(hashes: np.ndarray, gram: int, bits: int) -> np.ndarray:
    """Cell of the word run of ``gram`` words that starts at each word."""
    return (mix(window_hash(hashes[:, 0], gram, GRAM_MULT)) >> np.uint64(64 - bits)).astype(np.int64)


def candidates(hashes: np.ndarray, window: int, gram: int, bits: int, seen_twice: np.ndarray) -> np.ndarray:
    """Starts of the windows that the sketch estimates at two or more: the minimum over the window's word runs."""
    if len(hashes) < window:
        return np.empty(0, dtype=np.int64)
    cell = sketch_cells(hashes, gram, bits)
    hit = (seen_twice[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1
    runs = window - gram + 1
    total = np.concatenate([[0], np.cumsum(hit)])
    return np.flatnonzero(total[runs:] - total[:-runs] == runs)


def build_sketch(docs: DataFrame, window: int, gram: int, bits: int) -> bytes:
    """Bitmap of the cells counted twice or more, merged from the partial sketches of all tasks.

    A partial sketch is, for each block of 2^16 cells, the sorted cells it touched (each at most twice, as a count
    of two says all): its size follows the task's words. Blocks are shuffled and summed by block.
    """
    blocks = 1 << max(0, bits - BLOCK_BITS)

    def flush(cells: list[np.ndarray]) -> pa.RecordBatch:
        c = np.sort(np.concatenate(cells))
        c = c[np.concatenate([[True, True], c[2:] != c[:-2]])[:len(c)]]
        block = c >> BLOCK_BITS
        first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        data = binary_blocks((c & (2 ** BLOCK_BITS - 1)).astype("<u2"), np.append(first, len(c)))
        return pa.RecordBatch.from_arrays([pa.array(block[first].astype(np.int32)), data], names=["block", "cells"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            for t in b.column(0):
                _, h = word_matrix(t.as_py())
                if len(h) >= window:
                    held.append(sketch_cells(h, gram, bits))
                    n += len(held[-1])
                    if n >= FLUSH:
                        yield flush(held)
                        held, n = [], 0
        if held:
            yield flush(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = defaultdict(lambda: np.zeros(2 ** BLOCK_BITS, dtype=np.uint8))
        for b in batches:
            for block, cells in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                one, times = np.unique(np.frombuffer(cells, dtype="<u2"), return_counts=True)
                sums[block][one] = np.minimum(sums[block][one] + times, 2)
        keys = list(sums)
        twice = [np.packbits(sums[k] >= 2, bitorder="little").tobytes() for k in keys]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(twice, pa.binary())], names=["block", "twice"])

    parts = docs.select("text").mapInArrow(partial, "block int, cells binary")
    merged = parts.repartition(max(partitions(docs.sparkSession), blocks // 256), "block").mapInArrow(merge, "block int, twice binary")
    out = bytearray(max(1, 1 << bits >> 3) if bits < BLOCK_BITS else (blocks << BLOCK_BITS) >> 3)
    step = 2 ** BLOCK_BITS // 8
    for r in merged.collect():
        piece = r["twice"] if bits >= BLOCK_BITS else r["twice"][:len(out)]
        out[r["block"] * step:r["block"] * step + len(piece)] = piece
    return bytes(out)


def sketch_bits(docs: DataFrame, max_bits: int) -> int:
    """log2 of the cells: at least one for each word (estimated by bytes), up to ``max_bits``."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(10, min(max_bits, power_of_two(size / BYTES_PER_WORD).bit_length() - 1))


def dedup_substrings(docs: DataFrame, window: int = 35, gram: int = 28, max_bits: int = 30,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove every word covered by a window of ``window`` words whose sequence also starts anywhere else.

    Returns ``(doc_id, n_words, n_removed, kept_sha256)``, one row per row of ``docs``. Words are runs of anything
    but ASCII blanks, unchanged; windows are judged on the input, so all copies of a passage go.

    1. Each task counts its runs of ``gram`` words in a one-row count-min sketch; the partial sketches are merged
       by cell block. A window's estimate is the minimum over the runs inside it: each such run occurs at least as
       often as the window, so the estimate is never too low and no repeated window is lost.
    2. Windows estimated at two or more are grouped exactly, by a 96-bit hash of their words (partial aggregates
       meet the hot passages). Groups of one are what the sketch overestimated.
    3. Those overestimated windows - few - are gathered by document and taken off the document's estimate.

    The sketch is sized by the corpus up to 2^``max_bits`` bits (128 MB at 30), which is the bound of what is
    broadcast. In a corpus of more than about 2^``max_bits`` words more single windows pass on to step 2; the result stays
    the same. Null, empty and blank texts have no words (the hash of the empty string). Rows with the same id and
    text are counted as two documents, each a copy of the other; a null id is an id like any other.
    """
    if not 1 <= gram <= window:
        raise ValueError("gram must be between 1 and window")
    spark: SparkSession = docs.sparkSession
    src = docs.select(row_key(F.col(id_col), F.col(text_col)).alias("rk"), F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    bits = sketch_bits(src, max_bits)
    sketch = spark.sparkContext.broadcast(build_sketch(src, window, gram, bits))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.frombuffer(sketch.value, dtype=np.uint8)
        for b in batches:
            out, size = [], 0
            for rk, t in zip(b.column(0).to_pylist(), b.column(1)):
                _, h = word_matrix(t.as_py())
                at = candidates(h, window, gram, bits, seen)
                if len(at):
                    out.append((window_hash(h[:, 0], window)[at].view(np.int64), (mix(window_hash(h[:, 1], window))[at] >> np.uint64(33)).astype(np.int32),
                                np.full(len(at), rk, dtype=np.int64)))
                    size += len(at)
                if size >= 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["h1", "h2", "rk"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["h1", "h2", "rk"])

    found = src.select("rk", "text").mapInArrow(windows, "h1 long, h2 int, rk long")
    groups = found.groupBy("h1", "h2").agg(F.min("rk").alias("rk"), F.count("*").alias("n"))
    # a single window is named by its hash, not its place: documents that share a row key get one list, and each finds its own windows in it
    over = materialize(groups.where("n = 1").groupBy("rk").agg(F.collect_list("h1").alias("over")), "substring-over")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.frombuffer(sketch.value, dtype=np.uint8)
        for b in batches:
            n_words, n_removed, sha = [], [], []
            for t, off in zip(b.column(1), b.column(2)):
                words, h = word_matrix(t.as_py())
                at = candidates(h, window, gram, bits, seen)
                if off.is_valid:
                    at = at[~np.isin(window_hash(h[:, 0], window)[at].view(np.int64), off.values.to_numpy())]
                gone = covered(at, window, len(words))
                kept = [w for w, g in zip(words, gone.tolist()) if not g] if len(at) else words
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    joined = src.join(over, "rk", "left").select("doc_id", "text", "over")
    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_sha256 string")
