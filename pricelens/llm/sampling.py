"""Bounded, repeatable samples of labelled rows, and mapping of whole texts to columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import pieces


def few(rows: DataFrame, n: int, by: list[str], seed: int = 11) -> DataFrame:
    """The ``n`` rows that come first by a hash of the columns ``by``.

    A first pass counts the rows; a threshold on the hash then lets through about as many as are wanted, so what is
    sorted does not grow with the rows or tasks. Should fewer than ``n`` pass, which is most unlikely, there are so many fewer.
    """
    h = F.xxhash64(F.lit(seed), *by)
    return rows.where(h.cast("double") < share_limit(F.lit(n), F.lit(max(1, rows.count())))).orderBy(h, *by).limit(n)


def share_limit(wanted: Column, total: Column) -> Column:
    """Upper bound of a 64-bit hash (as a double) below which ``wanted`` of ``total`` rows, and some to spare, are expected."""
    enough = wanted + 8 * F.sqrt(wanted) + 40
    return enough / total * float(1 << 64) - float(1 << 63)


def sample_ids(rows: DataFrame, per_class: int, seed: int) -> DataFrame:
    """Of ``rows(doc_id, y)`` the ``per_class`` ids of every y that come first by a hash of the id, each once.

    A first pass estimates the distinct ids of every class (a sketch a task, merged); a threshold on the hash then lets through
    about as many as are wanted, so what is shuffled and ranked does not grow with the rows or tasks (see ``few``). The
    bound is ``per_class`` times the number of classes; which ids are taken does not depend on partitions.
    """
    rows = rows.select("doc_id", "y")
    h = F.xxhash64(F.col("doc_id"), F.lit(seed))
    distinct = F.hll_sketch_estimate(F.hll_sketch_agg("doc_id", 14))  # within 1 in 100
    limits = rows.groupBy("y").agg(distinct.alias("n")).select("y", share_limit(F.lit(per_class), F.greatest("n", F.lit(1))).alias("__below"))
    # one row a class, of which the caller collects per_class ids
    passed = rows.join(F.broadcast(limits), "y").where(h.cast("double") < F.col("__below")).select("doc_id", "y").distinct()
    w = Window.partitionBy("y").orderBy(h, "doc_id")
    return passed.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= per_class).drop("__r")


def map_texts(src: DataFrame, fn: Callable[[pa.RecordBatch], list[np.ndarray | list]], schema: str, rows: int = 256) -> DataFrame:
    """``fn`` over batches of at most ``rows`` rows of ``src``; returns one array per column of ``schema``."""
    names = [x.strip().split()[0] for x in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, rows):
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in fn(b)], names=names)

    return src.mapInArrow(run, schema)


def row_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the runs ``values[starts[i]:starts[i + 1]]`` along the first axis, empty runs giving zero."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[starts[1:]] - total[starts[:-1]]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
