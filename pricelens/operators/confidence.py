"""Match confidence between two offers (UDF-01), sequence similarity (UDF-02),
confidence level (UDF-03).

Only the string similarity needs Python: ``difflib.SequenceMatcher`` (not
symmetric - argument order is baseline, other).  It runs as an Arrow-batched
pandas UDF over the *distinct* string pairs, joined back, and for pack texts only where
native bounds of the similarity leave more than one band (``ratio_bounds``); UPC, brand and
structured-pack points are native column expressions.
"""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from pricelens.functions.numeric import truthy_num

# Points per component and the level thresholds / labels.
UPC_POINTS = 40
BRAND_EXACT, BRAND_PARTIAL = 15, 10
PACK_EXACT, PACK_SAME_COUNT, PACK_SAME_MEASURE, PACK_MISMATCH = 25, 15, 10, 5
PACK_STR_HIGH, PACK_STR_MID, PACK_STR_LOW, PACK_ONE_SIDE = 20, 12, 5, 2
NAME_POINTS = 20
LEVELS = [(75, "high", "Strong Match"), (45, "medium", "Likely Match"), (25, "low", "Weak Match"),
          (None, "poor", "Poor Match")]


# What the points of a component say; five points for packs are given for unlike numbers and for unlike texts.
UPC_OUTCOMES = {UPC_POINTS: "exact"}
BRAND_OUTCOMES = {BRAND_EXACT: "exact", BRAND_PARTIAL: "partial"}
PACK_OUTCOMES = {PACK_EXACT: "exact", PACK_SAME_COUNT: "same count", PACK_SAME_MEASURE: "same measure", PACK_MISMATCH: "different",
                 PACK_STR_HIGH: "texts very similar", PACK_STR_MID: "texts partly similar", PACK_ONE_SIDE: "on one side only"}


@pandas_udf(T.DoubleType())
def seq_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity of (a, b) as difflib computes it."""
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() if x is not None and y is not None else None
                      for x, y in zip(a, b)], dtype="float64")


@pandas_udf(T.IntegerType())
def name_points(a: pd.Series, b: pd.Series) -> pd.Series:
    """round(ratio * 20) with Python's (half-even) rounding."""
    return pd.Series([round(difflib.SequenceMatcher(None, x, y).ratio() * NAME_POINTS)
                      if x is not None and y is not None else None for x, y in zip(a, b)], dtype="Int32")


def _trim(c: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"^\s+|\s+$", "")


def _norm(c: str) -> Column:
    return F.lower(_trim(c))


def ratio_bounds(a: Column, b: Column) -> tuple[Column, Column]:
    """Least and greatest similarity that two texts can have, from native counts.

    The first matching block is as long as the common beginning or end at least, and no more characters can
    match than the texts have in common, counted with repeats.  Both are written as ``difflib`` writes its ratio,
    so they compare with its figures without a rounding gap; equal texts have 1.  From 200 characters on
    ``difflib`` leaves out common characters, so that nothing is certain to match.
    """
    total = F.length(a) + F.length(b)

    def common(x: Column, y: Column) -> Column:
        n = F.least(F.length(x), F.length(y))
        same = F.filter(F.sequence(F.lit(0), n), lambda i: F.left(x, i) == F.left(y, i))
        return F.array_max(same)

    shared = F.aggregate(F.array_distinct(F.split(a, "")), F.lit(0), lambda n, c: n + F.least(
        F.length(a) - F.length(F.replace(a, c, F.lit(""))), F.length(b) - F.length(F.replace(b, c, F.lit("")))))
    low = F.when(F.length(b) < 200, F.greatest(common(a, b), common(F.reverse(a), F.reverse(b)))).otherwise(0)
    none = total == 0
    return (F.when(none, 1.0).otherwise(2.0 * low / total), F.when(none, 1.0).otherwise(2.0 * shared / total))


def pack_band(ratio: Column) -> Column:
    """Points for the similarity of two pack texts."""
    return F.when(ratio > 0.8, PACK_STR_HIGH).when(ratio > 0.5, PACK_STR_MID).otherwise(PACK_STR_LOW)


def pack_points(a: Column, b: Column) -> tuple[Column, Column]:
    """Points of a pair of pack texts, and whether the bounds left two bands, so that ``difflib`` had to decide."""
    low, high = (pack_band(x) for x in ratio_bounds(a, b))
    open_ = low != high
    ratio = seq_ratio(F.when(open_, a), F.when(open_, b))  # texts that are decided are not sent
    return F.when(open_, pack_band(ratio)).otherwise(low), open_


def with_pair_metric(df: DataFrame, a: str, b: str, out: str, udf) -> DataFrame:
    """Evaluate a pair UDF (or a function of the pair's columns) once per distinct (a, b) and join the result back.

    Rows without one of the texts have no metric; they match nothing and are dealt by a
    salt of their other columns, so that they do not meet in one task.
    """
    pairs = df.select(F.col(a).alias("_a"), F.col(b).alias("_b")).where("_a is not null and _b is not null").distinct()
    pairs = pairs.withColumn(out, udf(F.col("_a"), F.col("_b"))).withColumn("_s", F.lit(0))
    none = F.col(a).isNull() | F.col(b).isNull()
    salted = df.withColumn("_salt", F.when(none, F.pmod(F.xxhash64(*df.columns), F.lit(1 << 16)).cast("int") + 1).otherwise(0))
    on = (salted[a] == pairs["_a"]) & (salted[b] == pairs["_b"]) & (salted["_salt"] == pairs["_s"])
    return salted.join(pairs, on, "left").drop("_a", "_b", "_s", "_salt")


def confidence_level(score: Column) -> tuple[Column, Column]:
    level, label = F.lit(LEVELS[-1][1]), F.lit(LEVELS[-1][2])
    for th, lv, lb in reversed(LEVELS[:-1]):
        level = F.when(score >= th, F.lit(lv)).otherwise(level)
        label = F.when(score >= th, F.lit(lb)).otherwise(label)
    return level, label


def match_confidence(pairs: DataFrame, a: str = "a_", b: str = "b_") -> DataFrame:
    """Score every (baseline a, other b) pair.

    Expects ``{a,b}upc, {a,b}brand, {a,b}pack_size_raw, {a,b}product_name`` and
    optionally ``{a,b}pack_count, {a,b}unit_size, {a,b}unit_measure``.  Adds
    upc_points, brand_points, pack_points, name_points, score, level, label.
    """
    df = pairs
    ua, ub = _trim(f"{a}upc"), _trim(f"{b}upc")
    df = df.withColumn("upc_points", F.when((F.length(ua) > 0) & (F.length(ub) > 0) & (ua == ub),
                                            UPC_POINTS).otherwise(0))
    ba, bb = _norm(f"{a}brand"), _norm(f"{b}brand")
    df = df.withColumn("brand_points", F.when((F.length(ba) > 0) & (F.length(bb) > 0), F.when(
        ba == bb, BRAND_EXACT).when((F.instr(bb, ba) > 0) | (F.instr(ba, bb) > 0), BRAND_PARTIAL)
        .otherwise(0)).otherwise(0))
    cols = set(df.columns)
    if {f"{a}pack_count", f"{b}pack_count"} <= cols:
        ca, cb = F.col(f"{a}pack_count").cast("double"), F.col(f"{b}pack_count").cast("double")
        sa, sb = F.col(f"{a}unit_size").cast("double"), F.col(f"{b}unit_size").cast("double")
        ma, mb = _norm(f"{a}unit_measure"), _norm(f"{b}unit_measure")
        structured = (truthy_num(ca) & truthy_num(cb) & truthy_num(sa) & truthy_num(sb)
                      & (F.length(ma) > 0) & (F.length(mb) > 0))
        struct_pts = (F.when((ca == cb) & (sa == sb) & (ma == mb), PACK_EXACT)
                      .when(ca == cb, PACK_SAME_COUNT).when(ma == mb, PACK_SAME_MEASURE).otherwise(PACK_MISMATCH))
    else:
        structured, struct_pts = F.lit(False), F.lit(0)
    df = df.withColumn("_pa", _norm(f"{a}pack_size_raw")).withColumn("_pb", _norm(f"{b}pack_size_raw"))
    need_sim = ~structured & (F.length("_pa") > 0) & (F.length("_pb") > 0)
    df = df.withColumn("_psa", F.when(need_sim, F.col("_pa"))).withColumn("_psb", F.when(need_sim, F.col("_pb")))
    df = with_pair_metric(df, "_psa", "_psb", "_ppts", lambda x, y: pack_points(x, y)[0])
    df = df.withColumn("pack_points", F.when(structured, struct_pts)
                       .when(need_sim, F.col("_ppts"))
                       .when((F.length("_pa") > 0) | (F.length("_pb") > 0), PACK_ONE_SIDE).otherwise(0))
    na, nb = _norm(f"{a}product_name"), _norm(f"{b}product_name")
    both = (F.length(na) > 0) & (F.length(nb) > 0)
    df = (df.withColumn("_na", F.when(both, F.regexp_replace(na, r"[^a-z0-9\s]", "")))
            .withColumn("_nb", F.when(both, F.regexp_replace(nb, r"[^a-z0-9\s]", ""))))
    df = with_pair_metric(df, "_na", "_nb", "_npts", name_points)
    df = df.withColumn("name_points", F.coalesce(F.col("_npts"), F.lit(0)))
    total = F.col("upc_points") + F.col("brand_points") + F.col("pack_points") + F.col("name_points")
    df = df.withColumn("score", F.least(total, F.lit(100)))
    level, label = confidence_level(total)
    return (df.withColumn("level", level).withColumn("label", label)
              .drop("_pa", "_pb", "_psa", "_psb", "_ppts", "_na", "_nb", "_npts"))


def breakdown(a: str = "a_", b: str = "b_") -> Column:
    """Points, most points and outcome of each component, of rows that ``match_confidence`` has scored."""

    def part(points: str, most: int, outcomes: dict[int, str], otherwise: Column | str) -> Column:
        said = F.lit(otherwise) if isinstance(otherwise, str) else otherwise
        for n, text in outcomes.items():
            said = F.when(F.col(points) == n, text).otherwise(said)
        return F.struct(F.col(points).cast("int").alias("points"), F.lit(most).alias("max"), said.alias("outcome"))

    def both(c: str) -> Column:
        return (F.length(_norm(f"{a}{c}")) > 0) & (F.length(_norm(f"{b}{c}")) > 0)

    absent = lambda c: F.when(both(c), "mismatch").otherwise("missing")
    return F.struct(part("upc_points", UPC_POINTS, UPC_OUTCOMES, absent("upc")).alias("upc"),
                    part("brand_points", BRAND_EXACT, BRAND_OUTCOMES, absent("brand")).alias("brand"),
                    part("pack_points", PACK_EXACT, PACK_OUTCOMES, "missing").alias("pack_size"),
                    part("name_points", NAME_POINTS, {}, F.when(both("product_name"), "compared").otherwise("missing")).alias("name"))


def deal_confidence(products: DataFrame, vendors: DataFrame, baseline_slug: str, k: int = 10,
                    matches: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Confidence of every kept deal match (baseline brand/pack/name vs the match; no UPC,
    as the deal finder scores them) and the best per baseline row."""
    from pricelens.operators.deals import deal_matches
    base, m = matches or deal_matches(products, vendors, baseline_slug, k, write=True)
    pairs = (m.join(base.select("bid", F.col("product_name").alias("a_product_name"),
                                F.col("brand").alias("a_brand"), F.col("pack_size_raw").alias("a_pack_size_raw")),
                    "bid")
             .select("bid", "m_product_id", "m_vendor_name", "rank", "a_product_name", "a_brand", "a_pack_size_raw",
                     F.lit(None).cast("string").alias("a_upc"), F.col("m_product_name").alias("b_product_name"),
                     F.col("m_brand").alias("b_brand"), F.col("m_pack_size_raw").alias("b_pack_size_raw"),
                     F.lit(None).cast("string").alias("b_upc")))
    return match_confidence(pairs)


def best_confidence(scored: DataFrame) -> DataFrame:
    return scored.groupBy("bid").agg(F.max("score").alias("best_confidence"))
