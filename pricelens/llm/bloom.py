"""Bloom filters as DataFrame expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 32768  # bits of one aggregated bitmap


def positions(key: Column, size: int, hashes: int, seed: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(seed + i), key), F.lit(size)) for i in range(hashes)]


def bitmaps(keys: DataFrame, size: int, hashes: int, seed: int = 0) -> DataFrame:
    """``(block, bits)``: the bitmaps of the ``size`` bits set by ``keys(key)``, by blocks that have any."""
    at = keys.select(F.explode(F.array(*positions(F.col("key"), size, hashes, seed))).alias("p"))
    return at.groupBy(F.floor(F.col("p") / BLOCK).cast("int").alias("block")).agg(F.bitmap_construct_agg(F.col("p") % BLOCK).alias("bits"))


def one_row(keys: DataFrame, size: int, hashes: int, seed: int = 0) -> Column:
    """All blocks in order as one array, for use as a scalar subquery: ``size`` / 8 bytes."""
    return blocks_in_order(bitmaps(keys, size, hashes, seed), size)


def blocks_in_order(maps: DataFrame, size: int) -> Column:
    """``maps(block, bits)`` as one array, a scalar subquery."""
    every = maps.sparkSession.range(-(-size // BLOCK)).select(F.col("id").cast("int").alias("block"))
    full = every.join(maps, "block", "left").select(F.struct("block", F.coalesce("bits", F.lit(bytes(BLOCK // 8))).alias("bits")).alias("b"))
    return full.agg(F.transform(F.sort_array(F.collect_list("b")), lambda b: b["bits"]).alias("blocks")).scalar()


def bit(bits: Column, at: Column) -> Column:
    """Whether bit ``at`` of a binary is set."""
    byte = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (at % 8).cast("int")) == 1


def has(blocks: Column, key: Column, size: int, hashes: int, seed: int = 0) -> Column:
    """Whether all bits of ``key`` are set in the array of blocks."""
    out = F.lit(True)
    for p in positions(key, size, hashes, seed):
        out = out & bit(F.element_at(blocks, (F.floor(p / BLOCK) + 1).cast("int")), p % BLOCK)
    return out
