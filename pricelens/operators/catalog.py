"""Legacy catalog analytics (one flat catalog table; empty means null).

AGG-15 catalog_summary, AGG-16 category_prices, AGG-17 maker_prices,
AGG-18 pallet_efficiency, AGG-19 cost_per_oz, AGG-20 availability,
AGG-21 lead_time_summary, AGG-22 lead_time_dist, AGG-23 price_histogram,
AGG-24 category_maker_matrix, AGG-25 source_breakdown, AGG-26
category_breakdown, AGG-27 export_summary, WIN-05 best_value, WIN-06 top_by,
SRT-02 sample_n.

Means of doubles are exact: each value is taken as DECIMAL(38,10), summed
exactly and divided once, so the answer does not depend on how partial sums
are combined across partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.functions.numeric import count_if, dbl, pround
from pricelens.functions.pack import parse_pack_legacy
from pricelens.plans.shapes import exact_quantile, with_scalars


def with_group_quantile(agg: DataFrame, df: DataFrame, value: str, q: float, group: list[str], out: str,
                        places: int) -> DataFrame:
    """Attach an exact per-group quantile (distributed, see ``exact_quantile``) to a
    per-group aggregate; groups match null-safely."""
    qt = exact_quantile(df, value, q, group, "_q")
    if not group:
        return with_scalars(agg, qt.select(pround("_q", places).alias(out)))
    cond = None
    for g in group:
        c = agg[g].eqNullSafe(qt[g])
        cond = c if cond is None else cond & c
    return agg.join(qt, cond, "left").select(agg["*"], pround(qt["_q"], places).alias(out))


def exact_mean(c) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return F.sum(x.cast("decimal(38,10)")).cast("double") / F.count(x)


def catalog_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_products"),
        F.count_distinct(F.coalesce("category", F.lit(""))).alias("total_categories"),
        F.count_distinct(F.coalesce("manufacturer", F.lit(""))).alias("total_manufacturers"),
        F.coalesce(pround(exact_mean("delivered_price"), 2), F.lit(0.0)).alias("avg_delivered_price"),
        F.coalesce(pround(exact_mean("price_per_unit"), 2), F.lit(0.0)).alias("avg_unit_price"),
        F.coalesce(pround(F.min("price_per_unit"), 2), F.lit(0.0)).alias("min_unit_price"),
        F.coalesce(pround(F.max("price_per_unit"), 2), F.lit(0.0)).alias("max_unit_price"),
        count_if(F.col("has_promo") == F.lit(True)).alias("total_with_promo"),
        count_if(F.col("mixed_pallet") == F.lit(True)).alias("total_mixed_pallet"))


def category_prices(df: DataFrame) -> DataFrame:
    p = df.filter(F.col("price_per_unit").isNotNull())
    g = p.groupBy("category").agg(
        F.count(F.lit(1)).alias("count"),
        pround(exact_mean("price_per_unit"), 2).alias("avg_unit_price"),
        pround(F.min("price_per_unit"), 2).alias("min_unit_price"),
        pround(F.max("price_per_unit"), 2).alias("max_unit_price"),
        pround(exact_mean("delivered_price"), 2).alias("avg_delivered"),
        pround(F.coalesce(F.sum(F.col("delivered_price").cast("decimal(38,10)")).cast("double"),
                          F.lit(0.0)), 2).alias("total_value"))
    return with_group_quantile(g, p, "price_per_unit", 0.5, ["category"], "median_unit_price", 2)


def maker_prices(df: DataFrame, sort: str = "count", limit: int | None = 30) -> DataFrame:
    p = df.filter(F.col("price_per_unit").isNotNull())
    g = p.groupBy("manufacturer").agg(
        F.count(F.lit(1)).alias("count"),
        pround(exact_mean("price_per_unit"), 2).alias("avg_unit_price"),
        pround(F.min("price_per_unit"), 2).alias("min_unit_price"),
        pround(F.max("price_per_unit"), 2).alias("max_unit_price"),
        pround(exact_mean("delivered_price"), 2).alias("avg_delivered"),
        F.count_distinct(F.coalesce("category", F.lit(""))).alias("categories"))
    if limit:
        g = g.orderBy(F.col(sort).desc_nulls_last(), F.col("manufacturer")).limit(limit)
    return g


def pallet_efficiency(df: DataFrame) -> DataFrame:
    p = df.filter(F.col("delivered_price").isNotNull() & F.col("cases_per_pallet").isNotNull())
    p = p.withColumn("cost_per_case",
                     pround(F.try_divide(dbl("delivered_price"), dbl("cases_per_pallet")), 2))
    return p.groupBy("category").agg(
        pround(F.sum("cases_per_pallet").cast("double") / F.count(F.lit(1)), 2).alias("avg_cases_per_pallet"),
        pround(exact_mean("delivered_price"), 2).alias("avg_delivered"),
        pround(exact_mean("cost_per_case"), 2).alias("avg_cost_per_case"),
        F.count(F.lit(1)).alias("product_count"))


def cost_per_oz(df: DataFrame) -> DataFrame:
    p = df.filter(F.col("price_per_oz").isNotNull())
    g = p.groupBy("category").agg(
        pround(exact_mean("price_per_oz"), 4).alias("avg_per_oz"),
        pround(F.min("price_per_oz"), 4).alias("min_per_oz"),
        pround(F.max("price_per_oz"), 4).alias("max_per_oz"),
        F.count(F.lit(1)).alias("count"))
    return with_group_quantile(g, p, "price_per_oz", 0.5, ["category"], "median_per_oz", 4)


def availability(df: DataFrame) -> DataFrame:
    """Totals (is_total) and per-category counts in one grouping-sets aggregate."""
    g = df.rollup("category").agg(
        F.count(F.lit(1)).alias("total"),
        count_if(F.col("available") == F.lit(True)).alias("available"),
        count_if(F.col("mixed_pallet") == F.lit(True)).alias("mixed_pallet"),
        count_if(F.col("has_promo") == F.lit(True)).alias("promo"),
        F.grouping("category").alias("_g"))
    tot = F.col("total").cast("double")
    return g.select(
        "category", (F.col("_g") == 1).alias("is_total"), "total", "available",
        (F.col("total") - F.col("available")).alias("unavailable"), "mixed_pallet",
        (F.col("total") - F.col("mixed_pallet")).alias("non_mixed"), "promo",
        pround(F.col("available") / tot * 100, 1).alias("avail_pct"),
        pround(F.col("mixed_pallet") / tot * 100, 1).alias("mixed_pct"))


def lead_time_summary(df: DataFrame) -> DataFrame:
    p = df.filter(F.col("lead_time_days").isNotNull())
    return p.groupBy("category").agg(
        pround(F.sum("lead_time_days").cast("double") / F.count(F.lit(1)), 1).alias("avg_lead"),
        pround(F.min("lead_time_days"), 1).alias("min_lead"),
        pround(F.max("lead_time_days"), 1).alias("max_lead"),
        F.count(F.lit(1)).alias("count"))


def lead_time_dist(df: DataFrame) -> DataFrame:
    p = df.filter(F.col("lead_time_days").isNotNull())
    return p.groupBy("category", F.col("lead_time_days").cast("int").alias("lead_time_days")).agg(
        F.count(F.lit(1)).alias("count"))


def price_histogram(df: DataFrame, bins: int = 30, col: str = "price_per_unit",
                    clip_quantile: float | None = 0.99) -> DataFrame:
    """Equal-width, right-closed bins over values up to the exact 99th percentile;
    the first edge is lowered by 0.1 % of the range; only non-empty bins.

    The clip value is an exact distributed quantile (``exact_quantile``), then min/max
    of the clipped values; each is a one-row frame attached by broadcast.
    """
    v = df.filter(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("x"))
    if clip_quantile is not None:
        q = exact_quantile(v, "x", clip_quantile, None, "_q")
        v = with_scalars(v, q).filter(F.col("x") <= F.col("_q")).drop("_q")
    mm = v.agg(F.min("x").alias("_mn"), F.max("x").alias("_mx"))
    eq = F.col("_mn") == F.col("_mx")
    adj_lo = F.when(F.col("_mn") != 0, F.col("_mn") - F.abs(F.col("_mn")) * 0.001).otherwise(F.col("_mn") - 0.001)
    adj_hi = F.when(F.col("_mx") != 0, F.col("_mx") + F.abs(F.col("_mx")) * 0.001).otherwise(F.col("_mx") + 0.001)
    mm = mm.select(F.when(eq, adj_lo).otherwise(F.col("_mn")).alias("_lo"),
                   F.when(eq, adj_hi).otherwise(F.col("_mx")).alias("_hi"), eq.alias("_eq"))
    mm = mm.withColumn("_step", (F.col("_hi") - F.col("_lo")) / F.lit(float(bins)))
    # first edge: lowered by 0.1% of the range unless the range was widened instead
    mm = mm.withColumn("_e0", F.when(F.col("_eq"), F.col("_lo"))
                       .otherwise(F.col("_lo") - (F.col("_hi") - F.col("_lo")) * 0.001))
    b = with_scalars(v, mm)
    idx = F.least(F.lit(bins), F.greatest(F.lit(1), F.ceil((F.col("x") - F.col("_lo")) / F.col("_step"))))
    counts = b.groupBy(idx.cast("int").alias("bin"), "_lo", "_hi", "_step", "_e0").agg(
        F.count(F.lit(1)).alias("count"))
    left = F.when(F.col("bin") == 1, F.col("_e0")).otherwise((F.col("bin") - 1) * F.col("_step") + F.col("_lo"))
    right = F.when(F.col("bin") == bins, F.col("_hi")).otherwise(F.col("bin") * F.col("_step") + F.col("_lo"))
    return counts.select(
        "bin", pround(left, 2).alias("bin_start"), pround(right, 2).alias("bin_end"),
        F.concat(F.lit("$"), F.format_string("%.2f", pround(left, 2)), F.lit("-$"),
                 F.format_string("%.2f", pround(right, 2))).alias("label"),
        "count")


def category_maker_matrix(df: DataFrame, n: int = 15) -> DataFrame:
    """Top-n makers by row count (ties by name), then count and mean price per
    (category, maker) cell; a cell without prices reads 0."""
    top = (df.groupBy("manufacturer").agg(F.count(F.lit(1)).alias("_n"))
             .orderBy(F.col("_n").desc(), F.col("manufacturer")).limit(n).select("manufacturer"))
    # at most n rows: bounded broadcast
    cells = df.join(F.broadcast(top), "manufacturer", "left_semi")
    return cells.groupBy("category", "manufacturer").agg(
        F.count(F.lit(1)).alias("count"),
        F.coalesce(pround(exact_mean("price_per_unit"), 2), F.lit(0.0)).alias("avg_price"))


def source_breakdown(df: DataFrame, source_col: str = "data_source",
                     default: str = "catalog") -> DataFrame:
    """Rows and share per data source; a table without the column is one source."""
    src = F.col(source_col) if source_col in df.columns else F.lit(default)
    g = df.groupBy(src.alias("source")).agg(F.count(F.lit(1)).alias("count"))
    tot = g.agg(F.sum("count").alias("_t"))
    return with_scalars(g, tot).select(
        "source", "count", pround(F.col("count") / F.col("_t").cast("double") * 100, 1).alias("pct"))


def category_breakdown(df: DataFrame) -> DataFrame:
    """Report sheet: count and % of all rows per non-empty category (is_total row = overview)."""
    g = df.groupBy(F.col("category")).agg(F.count(F.lit(1)).alias("product_count"))
    tot = df.agg(F.count(F.lit(1)).alias("_t"))
    per = with_scalars(g.filter(F.col("product_count") > 0), tot).select(
        "category", "product_count",
        pround(F.col("product_count") / F.col("_t").cast("double") * 100, 1).alias("pct_of_total"),
        F.lit(False).alias("is_total"))
    overview = df.agg(F.lit(None).cast("string").alias("category"),
                      F.count(F.lit(1)).alias("product_count"),
                      F.count_distinct(F.coalesce("category", F.lit(""))).cast("double").alias("pct_of_total"),
                      F.lit(True).alias("is_total"))
    return per.unionByName(overview)


def export_summary(df: DataFrame) -> DataFrame:
    a = df.agg(
        F.count(F.lit(1)).alias("total_products"),
        F.count_distinct(F.coalesce("category", F.lit(""))).alias("categories"),
        F.count_distinct(F.coalesce("manufacturer", F.lit(""))).alias("manufacturers"),
        pround(exact_mean("price_per_unit"), 2).alias("avg_unit_price"),
        pround(F.min("price_per_unit"), 2).alias("min_unit_price"),
        pround(F.max("price_per_unit"), 2).alias("max_unit_price"))
    out = with_group_quantile(a, df, "price_per_unit", 0.5, [], "median_unit_price", 2)
    return out.select("total_products", "categories", "manufacturers", "avg_unit_price", "median_unit_price",
                      "min_unit_price", "max_unit_price")


VALUE_COLS = ["product_id", "product", "manufacturer", "category", "price_per_unit", "price_per_oz",
              "delivered_price", "pack_size_raw", "cases_per_pallet", "lead_time_days", "available",
              "mixed_pallet"]


def best_value(df: DataFrame, limit: int | None = 30, direction: str = "desc") -> DataFrame:
    """0.6 x (1 - normalised price/oz) + 0.4 x normalised cases/pallet, min-max over
    the filtered set (+0.0001 in the denominators), 3 dp; top ``limit``."""
    v = df.filter(F.col("price_per_oz").isNotNull() & F.col("cases_per_pallet").isNotNull())
    mm = v.agg(F.min("price_per_oz").alias("_pmin"), F.max("price_per_oz").alias("_pmax"),
               F.min("cases_per_pallet").alias("_cmin"), F.max("cases_per_pallet").alias("_cmax"))
    s = with_scalars(v, mm)
    poz = F.lit(1.0) - (dbl("price_per_oz") - dbl("_pmin")) / (dbl("_pmax") - dbl("_pmin") + 0.0001)
    cpp = (dbl("cases_per_pallet") - dbl("_cmin")) / (dbl("_cmax") - dbl("_cmin") + 0.0001)
    s = s.withColumn("value_score", pround(poz * 0.6 + cpp * 0.4, 3)).select(*VALUE_COLS, "value_score")
    if limit:
        o = F.col("value_score").asc() if direction == "asc" else F.col("value_score").desc()
        s = s.orderBy(o, F.col("product_id")).limit(limit)
    return s


def top_by(df: DataFrame, metric: str = "price_per_unit", direction: str = "desc",
           limit: int = 20) -> DataFrame:
    d = parse_pack_legacy(df) if "total_weight" not in df.columns else df
    v = d.filter(F.col(metric).isNotNull())
    o = F.col(metric).asc() if direction == "asc" else F.col(metric).desc()
    return v.orderBy(o, F.col("product_id")).limit(limit).select(
        "product_id", "product", "manufacturer", "category", "delivered_price", "price_per_unit",
        "price_per_oz", "pack_size_raw", "cases_per_pallet", "total_weight")


def sample_n(df: DataFrame, n: int = 2000, seed: int = 42) -> DataFrame:
    """Scatter data: priced rows that have a total weight; when more than ``n``,
    a deterministic sample of n (smallest md5 of seed and key)."""
    d = parse_pack_legacy(df) if "total_weight" not in df.columns else df
    v = d.filter(F.col("price_per_unit").isNotNull() & F.col("total_weight").isNotNull()).select(
        "product_id", "product", "manufacturer", "category", "price_per_unit", "total_weight",
        "unit_measure", "pack_size_raw")
    return v.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col("product_id").cast("string"))), F.col("product_id")).limit(n)
