"""SimHash near-dedup by deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import materialize, partitions, text_bytes, wide_key
from pricelens.llm.components import connected_components

BITS = 64
CHUNK = 1 << 15


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of one text: A-Z lower-cased, ASCII-blank separated words, word shingles with repeats."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        grams, n = [b" ".join(words)], 1
    else:
        grams, n = map(b" ".join, zip(*(words[i:] for i in range(shingle)))), len(words) - shingle + 1
    h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(seed)), dtype="<u8", count=n)
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, n, CHUNK):
        ones += np.unpackbits(h[i:i + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", id_type: str = "long") -> DataFrame:
    """``(doc_id, fp)``, one row per row of ``docs``; null and blank texts have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=["doc_id", "fp"])

    src = docs.select(F.col(id_col).cast(id_type).alias("doc_id"), text_bytes(text_col).alias("text"))
    return src.mapInArrow(run, f"doc_id {id_type}, fp long")


def segment_bounds(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of the fewest equal segments of which one must differ by at most one bit, two at least."""
    m = max(2, max_bits // 2 + 1)
    edges = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def variants(fps: DataFrame, max_bits: int) -> DataFrame:
    """One row per fingerprint and bit: ``key`` is that bit's segment with the bit blanked, tagged by the bit."""
    keys = []
    for low, width in segment_bounds(max_bits):
        seg = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))
        for i in range(width):
            keys.append(seg.bitwiseAND(F.lit(((1 << width) - 1) ^ (1 << i))).bitwiseOR(F.lit((low + i) << 32)))
    return fps.select("fp", F.explode(F.array(*keys)).alias("key"))


def links(fps: DataFrame, max_bits: int = 2, hot: int = 64) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fps(fp)`` that keep every connection of fingerprints at
    ``max_bits`` or fewer differing bits.

    A bucket holds the fingerprints with one variant in common. Buckets of one row cannot link anything and
    buckets of two give their pair from the aggregate that counts them. Those of up to ``hot`` rows are joined and
    verified. Fingerprints of larger buckets are instead expanded into all their variants with ``max_bits`` blanked
    bits: rows that share one are within the distance by construction, so each is linked to the smallest only - as
    exact, and without listing the pairs of a large group.
    """
    # dealt over all tasks, since each fingerprint becomes one row a bit; with a number of its own, which is not coalesced
    v = variants(fps.repartition(partitions(fps.sparkSession), "fp"), max_bits)
    buckets = materialize(v.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"), "simhash-buckets")
    two = buckets.where("n = 2").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b")

    # the list of buckets grows with the corpus: merged, never broadcast
    some = v.join(buckets.where(F.col("n").between(3, hot)).select("key").hint("merge"), "key")
    p, q = some.alias("p"), some.alias("q")
    near = F.bit_count(F.col("p.fp").bitwiseXOR(F.col("q.fp"))) <= max_bits
    mid = p.join(q.hint("merge"), (F.col("p.key") == F.col("q.key")) & (F.col("p.fp") < F.col("q.fp")) & near)
    mid = mid.select(F.col("p.fp").alias("a"), F.col("q.fp").alias("b"))

    big = v.join(buckets.where(F.col("n") > hot).select("key").hint("merge"), "key").select("fp").distinct()
    masks = [sum(1 << b for b in c) for c in combinations(range(BITS), max_bits)]
    masks = F.array(*[F.lit(m - (1 << BITS) if m >> (BITS - 1) else m) for m in masks])
    wide = big.select("fp", F.explode(masks).alias("mask"))
    wide = wide.select("fp", "mask", F.col("fp").bitwiseAND(F.bitwise_not("mask")).alias("rest"))
    # a window, not a join with the smallest: the optimizer does not count the rows an explode makes, and would send them all out
    # through the driver. What shares a rest differs in the blanked bits only, so a window holds 2 ** max_bits rows at most.
    star = wide.select(F.col("fp").alias("a"), F.min("fp").over(Window.partitionBy("mask", "rest")).alias("b")).where("a <> b")
    return two.union(mid).union(star).distinct()


def roots(rows: DataFrame, max_bits: int = 2, hot: int = 64) -> DataFrame:
    """``(fp, root)`` for every distinct fingerprint of ``rows(fp)``: the root names its component.

    Joins here are merged, as every side grows with the corpus.
    """
    reps = materialize(rows.select("fp").distinct(), "simhash-reps")
    found = connected_components(links(reps, max_bits, hot)).hint("merge")
    return reps.join(found, reps["fp"] == found["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = 2, hot: int = 64,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """SimHash near-duplicate groups: ``(doc_id, fp, component_id)``, one row per row of ``docs``.

    Exact copies meet in one fingerprint first (a partial aggregate), so only distinct fingerprints are indexed and
    linked. ``component_id`` is the smallest doc_id reachable over links of ``max_bits`` or fewer differing bits.
    Null, empty and blank texts have fingerprint 0 and link like any other; very long texts are hashed whole, a block of
    shingles at a time. Rows that repeat a doc_id are kept; a null doc_id is never a component's name while another is
    there. An empty table gives no rows. Other columns are not looked at.
    """
    rows = materialize(fingerprints(docs, shingle, id_col, text_col), "simhash-rows")
    low = rows.groupBy("fp").agg(F.min("doc_id").alias("low"))
    rooted = materialize(low.join(roots(rows, max_bits, hot).hint("merge"), "fp"), "simhash-roots")
    names = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.select("fp", "root").join(names.hint("merge"), "root")
    return rows.join(named.hint("merge"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id, then row key. All columns and names stay.

    Null ids come last. Rows of the same id and text are one document, of which one row stays; rows that only repeat an
    id are judged each by its own text. Rows are named by 128-bit keys of id and text. An empty table stays empty.
    """
    key = wide_key(F.col(id_col), F.col(text_col))
    ids = F.struct(F.col(id_col).cast("long").alias("id"), key["a"].alias("a"), key["b"].alias("b"))
    rows = materialize(fingerprints(docs.select(ids.alias("row"), text_col), shingle, "row", text_col, "struct<id: long, a: long, b: long>"), "simhash-rows")
    first = F.min(F.struct(F.col("doc_id.id").isNull().alias("last"), "doc_id.id", "doc_id.a", "doc_id.b")).alias("first")
    low = rows.groupBy("fp").agg(first)  # one row a fingerprint before the join, so copies do not meet in it
    best = low.join(roots(rows, max_bits).hint("merge"), "fp").groupBy("root").agg(F.min("first").alias("first"))
    stay = best.select(F.col("first.a").alias("__a"), F.col("first.b").alias("__b")).hint("merge")
    kept = docs.withColumn("__a", key["a"]).withColumn("__b", key["b"]).join(stay, ["__a", "__b"], "left_semi")
    return kept.dropDuplicates(["__a", "__b"]).select(*docs.columns)
