"""Helpers shared by the operators: shared-folder tables, words, rolling window hashes."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.session import shared_path

MULT = np.uint64(0x9E3779B97F4A7C15)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = shared_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key(id_col: Column, text: Column) -> Column:
    """64-bit key of a document row, for uses that bear two documents with one key."""
    return F.xxhash64(id_col, text)


def wide_key(id_col: Column, text: Column) -> Column:
    """128-bit key of a document row, as two longs."""
    return F.struct(F.xxhash64(id_col, text).alias("a"), F.xxhash64(F.lit(1), text, id_col).alias("b"))


def text_bytes(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("binary")


def held_out(id_col: Column, modulus: int, remainder: int) -> Column:
    """True where crc32(id as text) mod ``modulus`` is ``remainder``; a null id is never held out."""
    return F.coalesce(F.crc32(id_col.cast("string")) % modulus == remainder, F.lit(False))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """(n, 2) uint64: two independent hashes of every word."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), dtype="<u8").reshape(-1, 2)


def window_hash(h: np.ndarray, length: int, mult: int | np.uint64 = MULT) -> np.ndarray:
    """Polynomial hash (mod 2^64) of every run of ``length`` consecutive values, by doubling; empty if too short."""
    n = len(h) - length + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    mult = np.uint64(mult)
    power, block, size = mult, h, 1  # block[i]: hash of h[i : i + size]; power: mult ** size
    out, done, rest = None, 0, length
    out_power = np.uint64(1)
    with np.errstate(over="ignore"):
        while True:
            if rest & 1:
                part = block[done:done + n]
                out = part.copy() if out is None else out + out_power * part
                out_power = out_power * power
                done += size
            rest >>= 1
            if not rest:
                return out
            block = block[:-size] + power * block[size:]
            power = power * power
            size *= 2


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a polynomial hash over all 64 bits (its low bits alone are weak)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Boolean per position: inside a window of ``length`` that begins at one of ``starts``."""
    d = np.zeros(n + 1, dtype=np.int32)
    np.add.at(d, starts, 1)
    np.add.at(d, np.minimum(starts + length, n), -1)
    return np.cumsum(d[:-1]) > 0


def binary_blocks(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Arrow binary array of the byte runs ``values[bounds[i]:bounds[i + 1]]``."""
    offsets = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def pieces(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def power_of_two(n: float) -> int:
    return 1 << max(0, math.ceil(math.log2(max(1.0, n))))
