"""Projections, filters and predicates over the current-offer snapshot (v2 family)
and the legacy catalog.  All are lazy ``DataFrame -> DataFrame`` functions; the
equality / range / null predicates reach the Parquet scan as pushed filters.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.functions.numeric import dbl, pround, truthy_num
from pricelens.session import shared_path


# ── vendor scope (FLT-01) ───────────────────────────────────────────────────
def vendor_ids(vendors: DataFrame, slug: str) -> DataFrame:
    return vendors.filter(F.col("slug") == F.lit(slug)).select("vendor_id")


def for_vendor(df: DataFrame, vendors: DataFrame, slug: str | None) -> DataFrame:
    """Rows of one vendor by slug; ``None``/``'all'`` means no filter.

    A semi join against the (filtered, tiny) vendor row: the planner broadcasts
    it when its size estimate is under the broadcast threshold and falls back
    to a shuffle join otherwise.  An unknown slug yields no rows.
    """
    if not slug or slug == "all":
        return df
    return df.join(vendor_ids(vendors, slug), "vendor_id", "left_semi")


# ── facets / search / flags (FLT-02..05) ───────────────────────────────────
def facet(df: DataFrame, category: str | None = None, brand: str | None = None) -> DataFrame:
    if category:
        df = df.filter(F.col("category") == F.lit(category))
    if brand:
        df = df.filter(F.col("brand") == F.lit(brand))
    return df


def search_name(df: DataFrame, term: str | None, col: str = "product_name") -> DataFrame:
    """ILIKE '%term%' on one column (the term's own % and _ stay wildcards)."""
    term = (term or "").strip()
    if not term:
        return df
    return df.filter(F.col(col).ilike(f"%{term}%"))


def search_indexed(df: DataFrame, index, term: str | None, col: str = "product_name") -> DataFrame:
    """``search_name`` by a stored ``sinks.nameindex.NameIndex`` that has the names of ``df``: the pattern is tried on
    the names that have all its trigrams, and rows are joined to the names found.  These are written to the session's
    checkpoint folder first: the planner then knows their size, and does not shuffle the rows for a few names."""
    term = (term or "").strip()
    if not term:
        return df
    path = shared_path(df.sparkSession, f"names-found-{uuid.uuid4().hex}")
    index.search(term).write.parquet(path)
    found = df.sparkSession.read.schema("lname string").parquet(path)
    return df.join(found, F.lower(F.col(col)) == F.col("lname"), "left_semi")


def search_any(df: DataFrame, pattern: str | None,
               cols=("product", "manufacturer", "description", "upc")) -> DataFrame:
    """Case-insensitive regex over several text columns (legacy search)."""
    pattern = (pattern or "").strip()
    if not pattern:
        return df
    cond = None
    for c in cols:
        m = F.coalesce(F.col(c).cast("string").rlike("(?i)" + pattern), F.lit(False))
        cond = m if cond is None else (cond | m)
    return df.filter(cond)


def where_flags(df: DataFrame, **flags) -> DataFrame:
    """Keep rows whose boolean column is true for every flag given as True."""
    for col, on in flags.items():
        if on:
            df = df.filter(F.col(col) == F.lit(True))
    return df


def where_in(df: DataFrame, col: str, values) -> DataFrame:
    values = list(values or [])
    if not values:
        return df
    return df.filter(F.col(col).isin(values))


def price_between(df: DataFrame, lo=None, hi=None, col: str = "price_per_unit") -> DataFrame:
    if lo is not None:
        df = df.filter(F.col(col).isNotNull() & (F.col(col) >= F.lit(float(lo))))
    if hi is not None:
        df = df.filter(F.col(col).isNotNull() & (F.col(col) <= F.lit(float(hi))))
    return df


def apply_filters(df: DataFrame, params: dict | None = None) -> DataFrame:
    """Legacy faceted filter: categories, makers, regex search, price range, flags."""
    p = params or {}
    df = where_in(df, "category", p.get("category"))
    df = where_in(df, "manufacturer", p.get("manufacturer"))
    df = search_any(df, p.get("search"))
    df = price_between(df, p.get("min_price"), p.get("max_price"))
    return where_flags(df, has_promo=p.get("promo_only"), mixed_pallet=p.get("mixed_pallet_only"),
                       available=p.get("available_only"))


def enabled_vendors(vendors: DataFrame) -> DataFrame:
    return vendors.filter(F.col("scrape_enabled") == F.lit(True))


def by_ids(df: DataFrame, ids: DataFrame, key: str = "product_id") -> DataFrame:
    """Rows whose key appears in another DataFrame (semi join, no driver list)."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


# ── runs (FLT-10) ─────────────────────────────────────────────────────────
def runs_with_vendor(runs: DataFrame, vendors: DataFrame) -> DataFrame:
    v = vendors.select("vendor_id", F.col("name").alias("vendor_name"), F.col("slug").alias("vendor_slug"))
    return runs.join(v, "vendor_id", "left")


def recent_runs(runs: DataFrame, vendors: DataFrame, slug: str | None = None, limit: int = 30
                ) -> DataFrame:
    """Newest runs first (started_at desc, nulls first as in Postgres; run_id breaks ties)."""
    r = for_vendor(runs, vendors, slug)
    return (runs_with_vendor(r, vendors)
            .orderBy(F.col("started_at").desc_nulls_first(), F.col("run_id").desc())
            .limit(limit))


def stuck_runs(runs: DataFrame, vendors: DataFrame) -> DataFrame:
    return runs_with_vendor(runs.filter(F.col("status") == "running"), vendors)


# ── projections (PRJ-01..04) ─────────────────────────────────────────────
def with_vendor(products: DataFrame, vendors: DataFrame) -> DataFrame:
    """Embed vendor name/slug, flattened (export shape)."""
    v = vendors.select("vendor_id", F.col("name").alias("vendor_name"), F.col("slug").alias("vendor_slug"))
    return products.join(v, "vendor_id", "left")


def price_change_detail(df: DataFrame, new: str = "unit_price", old: str = "last_price") -> DataFrame:
    """price_diff (4 dp) and price_pct_change (2 dp); null unless both prices truthy."""
    both = truthy_num(new) & truthy_num(old)
    diff = dbl(new) - dbl(old)
    return (df.withColumn("price_diff", F.when(both, pround(diff, 4)))
              .withColumn("price_pct_change", F.when(both, pround(diff / dbl(old) * 100, 2))))


def cost_per_case(df: DataFrame) -> DataFrame:
    return df.withColumn("cost_per_case",
                         pround(F.try_divide(dbl("delivered_price"), dbl("cases_per_pallet")), 2))
