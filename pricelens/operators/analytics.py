"""Dashboard aggregates over the offer snapshot (v2 family).

AGG-01 summary, AGG-02 vendor_stats, AGG-03 vendor_counts, AGG-04 by_vendor,
AGG-05 by_category, AGG-06 by_brand, AGG-07 filter_values, AGG-08/09 data
quality, AGG-10 vendor_radar, AGG-11 vendor_leaderboard, AGG-12 insights,
AGG-14 run_totals, AGG-28 product_count.

The reference scans each vendor separately (and caps each scan at 5,000 rows);
here one grouped aggregate (``vendor_profile``) over the whole snapshot feeds
the four per-vendor reports.  Sums of prices are taken on the exact
NUMERIC(12,4) values and divided as doubles, so results do not depend on the
order partial sums are combined in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.functions.numeric import (count_if, dbl, has_text, pround, truthy_bool,
                                         truthy_num)
from pricelens.operators.filters import enabled_vendors, for_vendor
from pricelens.plans.shapes import combine_scalars, global_rank, with_scalars


def _avg_dec(sum_col, n_col):
    return F.when(n_col > 0, sum_col.cast("double") / n_col.cast("double"))


# ── AGG-28 / AGG-01 ───────────────────────────────────────────────────────
def product_count(products: DataFrame, vendors: DataFrame | None = None, slug: str | None = None
                  ) -> DataFrame:
    p = for_vendor(products, vendors, slug) if vendors is not None else products
    return p.agg(F.count(F.lit(1)).alias("product_count"))


def summary(products: DataFrame, vendors: DataFrame, runs: DataFrame, slug: str | None = None
            ) -> DataFrame:
    """KPIs; the run count is never vendor-scoped (as in the reference)."""
    p = for_vendor(products, vendors, slug)
    truthy_text = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    kp = p.agg(F.count(F.lit(1)).alias("total_products"),
               F.count_distinct(F.when(truthy_text("category"), F.col("category"))).alias("total_categories"),
               F.count_distinct(F.when(truthy_text("brand"), F.col("brand"))).alias("total_brands"),
               count_if(truthy_bool("price_changed")).alias("price_changes"))
    kv = enabled_vendors(vendors).agg(F.count(F.lit(1)).alias("total_vendors"))
    kr = runs.agg(F.count(F.lit(1)).alias("total_runs"))
    return combine_scalars(kp, kv, kr).select(
        "total_products", "total_vendors", "total_categories", "total_brands", "price_changes",
        "total_runs")


# ── AGG-02 / AGG-03 / AGG-14 ──────────────────────────────────────────────
def _counts_by_vendor(products: DataFrame) -> DataFrame:
    return products.groupBy("vendor_id").agg(F.count(F.lit(1)).alias("product_count"))


def vendor_stats(products: DataFrame, vendors: DataFrame, runs: DataFrame) -> DataFrame:
    """Every vendor with its product count and its latest run (by started_at, run_id)."""
    last = runs.groupBy("vendor_id").agg(F.max_by(
        F.struct("run_id", "status", "started_at", "products_found"),
        F.struct("started_at", "run_id")).alias("r"))
    return (vendors.join(_counts_by_vendor(products), "vendor_id", "left")
            .join(last, "vendor_id", "left")
            .select("vendor_id", "name", "slug", "scrape_method", "scrape_enabled",
                    F.coalesce("product_count", F.lit(0)).cast("bigint").alias("product_count"),
                    F.col("r.run_id").alias("last_run_id"), F.col("r.status").alias("last_run_status"),
                    F.col("r.started_at").alias("last_run_started_at"),
                    F.col("r.products_found").alias("last_run_products_found")))


def vendor_counts(products: DataFrame, vendors: DataFrame) -> DataFrame:
    """Product count per vendor plus a grand-total row (``rollup``)."""
    per = vendors.join(_counts_by_vendor(products), "vendor_id", "left").select(
        "name", "scrape_method", F.coalesce("product_count", F.lit(0)).alias("product_count"))
    r = per.rollup("name").agg(F.sum("product_count").cast("bigint").alias("product_count"),
                               F.first("scrape_method").alias("scrape_method"),
                               F.grouping("name").alias("_g"))
    return r.select(F.when(F.col("_g") == 1, F.lit("TOTAL")).otherwise(F.col("name")).alias("vendor_name"),
                    F.when(F.col("_g") == 1, F.lit(None).cast("string"))
                    .otherwise(F.col("scrape_method")).alias("scrape_method"),
                    "product_count",
                    (F.col("product_count") > 0).alias("has_data"),
                    (F.col("_g") == 1).alias("is_total"))


def run_totals(runs: DataFrame, vendors: DataFrame) -> DataFrame:
    """Per-vendor run totals (found / new / updated / price changes / errors) and a TOTAL line."""
    r = runs.join(vendors.select("vendor_id", "slug"), "vendor_id", "left")
    agg = r.rollup("slug").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("products_found").cast("bigint").alias("found"),
        F.sum("products_new").cast("bigint").alias("new"),
        F.sum("products_updated").cast("bigint").alias("updated"),
        F.sum("price_changes").cast("bigint").alias("price_changes"),
        F.sum("errors").cast("bigint").alias("errors"),
        F.grouping("slug").alias("_g"))
    return agg.select(F.when(F.col("_g") == 1, F.lit("TOTAL")).otherwise(F.col("slug")).alias("vendor"),
                      "runs", "found", "new", "updated", "price_changes", "errors")


# ── AGG-04..07 ────────────────────────────────────────────────────────────
def by_vendor(products: DataFrame, vendors: DataFrame) -> DataFrame:
    """Count and avg/min/max unit price per vendor; vendors without offers kept (count 0)."""
    g = products.groupBy("vendor_id").agg(
        F.count(F.lit(1)).alias("product_count"), F.sum("unit_price").alias("_s"),
        F.count("unit_price").alias("_n"), F.min("unit_price").alias("_mn"),
        F.max("unit_price").alias("_mx"))
    return vendors.join(g, "vendor_id", "left").select(
        F.col("name").alias("vendor"), "slug",
        F.coalesce("product_count", F.lit(0)).cast("bigint").alias("product_count"),
        pround(_avg_dec(F.col("_s"), F.col("_n")), 2).alias("avg_price"),
        pround(dbl("_mn"), 2).alias("min_price"), pround(dbl("_mx"), 2).alias("max_price"))


def _label_or(col: str, label: str):
    return F.when(F.col(col).isNull() | (F.col(col) == ""), F.lit(label)).otherwise(F.col(col))


def by_category(products: DataFrame, vendors: DataFrame | None = None, slug: str | None = None
                ) -> DataFrame:
    p = for_vendor(products, vendors, slug) if vendors is not None else products
    g = p.groupBy(_label_or("category", "Uncategorized").alias("category")).agg(
        F.count(F.lit(1)).alias("count"), F.sum("unit_price").alias("_s"),
        F.count("unit_price").alias("_n"), F.min("unit_price").alias("_mn"),
        F.max("unit_price").alias("_mx"))
    return g.select("category", "count", pround(_avg_dec(F.col("_s"), F.col("_n")), 2).alias("avg_price"),
                    pround(dbl("_mn"), 2).alias("min_price"), pround(dbl("_mx"), 2).alias("max_price"))


def by_brand(products: DataFrame, vendors: DataFrame | None = None, slug: str | None = None,
             limit: int | None = 30) -> DataFrame:
    """Top brands by offer count (ties by brand name)."""
    p = for_vendor(products, vendors, slug) if vendors is not None else products
    g = p.groupBy(_label_or("brand", "Unknown").alias("brand")).agg(
        F.count(F.lit(1)).alias("count"), F.sum("unit_price").alias("_s"),
        F.count("unit_price").alias("_n"))
    g = g.select("brand", "count", pround(_avg_dec(F.col("_s"), F.col("_n")), 2).alias("avg_price"))
    if limit:
        g = g.orderBy(F.col("count").desc(), F.col("brand")).limit(limit)
    return g


def filter_values(products: DataFrame, vendors: DataFrame | None = None, slug: str | None = None
                  ) -> DataFrame:
    """Distinct non-empty categories and brands, long form (kind, value), sorted."""
    p = for_vendor(products, vendors, slug) if vendors is not None else products
    cats = p.select(F.lit("category").alias("kind"), F.col("category").alias("value"))
    brands = p.select(F.lit("brand").alias("kind"), F.col("brand").alias("value"))
    return (cats.unionByName(brands).filter(F.col("value").isNotNull() & (F.col("value") != ""))
            .distinct())


def filter_value_lists(products: DataFrame) -> DataFrame:
    """The same as one row of two sorted arrays (API shape)."""
    fv = filter_values(products)
    return fv.groupBy().agg(
        F.array_sort(F.collect_list(F.when(F.col("kind") == "category", F.col("value")))).alias("categories"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == "brand", F.col("value")))).alias("brands"))


# ── shared per-vendor profile (AGG-08/10/11/12) ──────────────────────────
def coverage_tests() -> dict:
    """Truthiness test per coverage field (built lazily: Columns need a session)."""
    return {
    "upc": has_text("upc"),
    "pack_size_raw": has_text("pack_size_raw"),
    "structured_pack": truthy_num("pack_count") & truthy_num("unit_size"),
    "price_per_oz": truthy_num("price_per_oz"),
    "unit_price": truthy_num("unit_price"),
    "case_price": truthy_num("case_price"),
    "brand": has_text("brand"),
    "category": has_text("category"),
    "image": has_text("image_url"),
    "url": has_text("product_url"),
    "description": has_text("description"),
    "in_stock": truthy_bool("in_stock"),
    "has_promo": truthy_bool("has_promo"),
    }


COVERAGE_KEYS = ["upc", "pack_size_raw", "structured_pack", "price_per_oz", "unit_price", "case_price",
                 "brand", "category", "image", "url", "description", "in_stock", "has_promo"]

# Fixed weights of the reference's quality score (coverage pct x weight).
QUALITY_WEIGHTS = [("upc", 0.25), ("pack_size_raw", 0.15), ("unit_price", 0.20), ("brand", 0.10),
                   ("category", 0.10), ("image", 0.10), ("url", 0.10)]


def vendor_profile(products: DataFrame, vendors: DataFrame) -> DataFrame:
    """One row per vendor that has offers: counts of every coverage test, the sum of
    truthy prices, distinct truthy categories, price-change count."""
    aggs = [F.count(F.lit(1)).alias("total")]
    aggs += [count_if(cond).alias(f"n_{k}") for k, cond in coverage_tests().items()]
    aggs += [F.sum(F.when(truthy_num("unit_price"), F.col("unit_price"))).alias("price_sum"),
             count_if(truthy_bool("price_changed")).alias("n_changes"),
             F.count_distinct(F.when(F.col("category").isNotNull() & (F.col("category") != ""),
                                     F.col("category"))).alias("n_categories")]
    g = products.groupBy("vendor_id").agg(*aggs)
    v = vendors.select("vendor_id", F.col("name").alias("vendor_name"), F.col("slug").alias("vendor_slug"))
    return g.join(v, "vendor_id")


def _ratio_pct(n: str, places: int = 1):
    return pround(F.col(n).cast("double") / F.col("total").cast("double") * 100, places)


def data_quality(products: DataFrame, vendors: DataFrame, profile: DataFrame | None = None
                 ) -> DataFrame:
    prof = profile if profile is not None else vendor_profile(products, vendors)
    cols = ["vendor_name", "vendor_slug", F.col("total").alias("total_products")]
    score = None
    for k, w in QUALITY_WEIGHTS:
        term = _ratio_pct(f"n_{k}") * F.lit(w)
        score = term if score is None else score + term
    cols.append(pround(score, 1).alias("quality_score"))
    for k in COVERAGE_KEYS:
        cols += [F.col(f"n_{k}").alias(f"{k}_count"), _ratio_pct(f"n_{k}").alias(f"{k}_pct")]
    return prof.select(*cols)


def data_quality_overall(scorecard: DataFrame) -> DataFrame:
    return scorecard.agg(
        F.sum("total_products").cast("bigint").alias("total_products"),
        F.coalesce(pround(F.sum(F.col("quality_score") * F.col("total_products"))
                          / F.sum("total_products"), 1), F.lit(0.0)).alias("avg_quality_score"),
        F.count(F.lit(1)).alias("vendor_count"))


def _avg_truthy_price():
    return F.coalesce(_avg_dec(F.col("price_sum"), F.col("n_unit_price")), F.lit(0.0))


def vendor_radar(products: DataFrame, vendors: DataFrame, profile: DataFrame | None = None
                 ) -> DataFrame:
    """Six 0-100 dimensions per vendor; catalog size vs the largest vendor, price
    competitiveness inverted against the highest positive average price."""
    prof = profile if profile is not None else vendor_profile(products, vendors)
    base = prof.select(
        F.col("vendor_name").alias("vendor"), F.col("vendor_slug").alias("slug"),
        F.col("total").alias("product_count"), _avg_truthy_price().alias("avg_price"),
        _ratio_pct("n_upc").alias("upc_pct"), _ratio_pct("n_brand").alias("brand_pct"),
        _ratio_pct("n_image").alias("image_pct"), _ratio_pct("n_pack_size_raw").alias("pack_pct"),
        _ratio_pct("n_in_stock").alias("stock_pct"))
    maxes = base.agg(F.max("product_count").alias("_max_count"),
                     F.max(F.when(F.col("avg_price") > 0, F.col("avg_price"))).alias("_max_avg"))
    maxes = maxes.select(F.when(F.col("_max_count") > 0, F.col("_max_count")).otherwise(1).alias("_mc"),
                         F.coalesce("_max_avg", F.lit(1.0)).alias("_ma"))
    out = with_scalars(base, maxes)
    return out.select(
        "vendor", "slug", "product_count", "avg_price", "upc_pct", "brand_pct", "image_pct", "pack_pct",
        "stock_pct",
        pround(F.col("product_count").cast("double") / F.col("_mc").cast("double") * 100, 1)
        .alias("catalog_size"),
        F.when(F.col("_ma") > 0, pround((F.lit(1.0) - F.col("avg_price") / F.col("_ma")) * 100, 1))
        .otherwise(F.lit(50.0)).alias("price_competitiveness"))


def vendor_leaderboard(products: DataFrame, vendors: DataFrame, profile: DataFrame | None = None
                       ) -> DataFrame:
    """Composite score (catalog .25, data quality .30, stock .25, diversity .20) and rank."""
    prof = profile if profile is not None else vendor_profile(products, vendors)
    tot = F.col("total").cast("double")
    catalog = F.least(F.lit(100.0), tot / 50 * 100)
    dq = pround(F.col("n_upc") / tot * 25 + F.col("n_brand") / tot * 25 + F.col("n_image") / tot * 25
                + (F.col("n_unit_price") / tot) * 25, 1)
    stock = pround(F.col("n_in_stock") / tot * 100, 1)
    diversity = F.least(F.lit(100.0), F.col("n_categories").cast("double") / 20 * 100)
    s = prof.select(
        F.col("vendor_name").alias("vendor"), F.col("vendor_slug").alias("slug"), "vendor_id",
        F.col("total").alias("product_count"), pround(_avg_truthy_price(), 2).alias("avg_price"),
        F.col("n_categories").alias("categories"), catalog.alias("_cat"), dq.alias("data_quality"),
        stock.alias("stock_health"), diversity.alias("_div"),
        _ratio_pct("n_upc").alias("upc_pct"))
    s = s.withColumn("composite_score", pround(F.col("_cat") * 0.25 + F.col("data_quality") * 0.30
                                               + F.col("stock_health") * 0.25 + F.col("_div") * 0.20, 1))
    s = s.select("*", pround("_cat", 1).alias("catalog"), pround("_div", 1).alias("diversity"),
                 F.col("stock_health").alias("stock_pct")).drop("_cat", "_div")
    ranked = global_rank(s, [F.col("composite_score").desc(), F.col("vendor").asc(), F.col("vendor_id")],
                         "rank")
    return ranked.drop("vendor_id")


def insights(products: DataFrame, vendors: DataFrame, profile: DataFrame | None = None
             ) -> DataFrame:
    """The six insight facts as rows (fact, vendor, other_vendor, metric, metric2).

    Vendors are ordered by (product_count desc, name); "first in that order"
    breaks every tie, as the reference's stable sort does.
    """
    prof = profile if profile is not None else vendor_profile(products, vendors)
    v = prof.select(F.col("vendor_name").alias("name"), "vendor_id", F.col("total").alias("cnt"),
                    _avg_truthy_price().alias("avg"), _ratio_pct("n_upc").alias("upc"),
                    F.col("n_changes").alias("chg"), _ratio_pct("n_in_stock").alias("stock"))
    order = F.struct(-F.col("cnt"), "name", "vendor_id")
    most = lambda c: F.struct(F.coalesce(-F.col(c), F.lit(float("inf"))), order)  # noqa: E731  smallest for the largest
    inf = F.lit(float("inf"))
    a = v.agg(
        F.count(F.lit(1)).alias("n_vendors"),
        F.min_by(F.struct("name", "cnt"), order).alias("big"),
        F.min_by(F.struct("name", "upc"), most("upc")).alias("best_upc"),
        F.min_by(F.struct("name", "upc"), F.struct("upc", order)).alias("worst_upc"),
        F.min_by(F.struct("name", "avg"), F.struct(F.when(F.col("avg") > 0, F.col("avg")).otherwise(inf),
                                                   order)).alias("cheap"),
        F.min_by(F.struct("name", "avg"), most("avg")).alias("pricey"),
        F.sum("chg").cast("bigint").alias("total_changes"),
        F.min_by(F.struct("name", "chg"), most("chg")).alias("volatile"),
        F.sum(F.col("stock").cast("decimal(12,1)")).alias("_stock_sum"),
        F.min_by(F.struct("name", "stock"), most("stock")).alias("best_stock"),
        F.sum("cnt").cast("bigint").alias("total_products"))
    # the runner-up: the last of the first two, if there are two
    two = v.select("name", "cnt", order.alias("o")).orderBy("o").limit(2)
    two = two.agg(F.count(F.lit(1)).alias("n"), F.max_by(F.struct("name", "cnt"), F.col("o")).alias("s"))
    a = with_scalars(a, two.select(F.when(F.col("n") == 2, F.col("s")).alias("second")))

    def fact(name: str, vendor: str, other: str | None, metric: Column, metric2: Column) -> Column:
        return F.struct(F.lit(name).alias("fact"), F.col(f"{vendor}.name").alias("vendor"),
                        (F.col(f"{other}.name") if other else F.lit(None).cast("string")).alias("other_vendor"),
                        metric.cast("double").alias("metric"), metric2.cast("double").alias("metric2"))

    spread = pround((F.col("pricey.avg") - F.col("cheap.avg")) / F.col("cheap.avg") * 100, 1)
    facts = F.array(
        fact("largest_catalog", "big", "second", F.col("big.cnt"), F.col("big.cnt") - F.col("second.cnt")),
        fact("upc_coverage", "best_upc", "worst_upc", F.col("best_upc.upc"), F.col("worst_upc.upc")),
        F.when((F.col("n_vendors") > 1) & (F.col("cheap.avg") > 0) & (F.col("pricey.avg") > 0),
               fact("price_spread", "cheap", "pricey", spread, F.lit(None))),
        F.when(F.col("total_changes") > 0,
               fact("market_activity", "volatile", None, F.col("total_changes"), F.col("volatile.chg"))),
        fact("stock_availability", "best_stock", None,
             pround(F.col("_stock_sum").cast("double") / F.col("n_vendors"), 1), F.col("best_stock.stock")),
        fact("next_step", "worst_upc", None, F.col("total_products"), F.col("n_vendors")))
    return a.select(F.explode(F.filter(facts, lambda f: f.isNotNull())).alias("f")).select("f.*")
