"""Cross-vendor comparison, ranking and paging over the offer snapshot.

JOI-01 price_comparison, JOI-02 compare, WIN-01 best_prices, WIN-02 price_history,
WIN-03 sparklines, WIN-04 price_changes, SRT-01 page / page_count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.functions.numeric import dbl, has_text
from pricelens.operators.filters import for_vendor, price_change_detail, search_name, with_vendor
from pricelens.plans.shapes import first_per_group, global_rank, top_k_per_group

PRICE_COLS = ["unit_price", "case_price", "price_per_oz", "last_price"]


def as_double(df: DataFrame, cols=PRICE_COLS) -> DataFrame:
    """NUMERIC(12,4) prices -> double, as the reference hands them out."""
    for c in cols:
        if c in df.columns:
            df = df.withColumn(c, dbl(c))
    return df


def price_comparison(products: DataFrame, vendors: DataFrame) -> DataFrame:
    """Every offer with a non-blank UPC, with its vendor (inner join).

    No global sort: consumers page or rank it (``compare``), which keeps the
    plan free of a range-partition shuffle over the whole table.
    """
    p = products.filter(F.col("upc").isNotNull() & (F.col("upc") != ""))
    v = vendors.select("vendor_id", F.col("name").alias("vendor_name"), F.col("slug").alias("vendor_slug"))
    out = p.join(v, "vendor_id").select(
        "upc", "product_name", "brand", "category", "vendor_name", "vendor_slug", "unit_price",
        "case_price", "price_per_oz", "pack_size_raw", "in_stock", "last_seen_at", "price_changed",
        "last_price", "product_url")
    return as_double(out)


def compare(products: DataFrame, vendors: DataFrame, upc: str | Column | None = None,
            search: str | None = None, limit: int | None = 100) -> DataFrame:
    """Offers for one UPC (a value, or a scalar subquery) or a name search, cheapest first, nulls last."""
    if isinstance(upc, Column) or upc:
        p = products.filter(F.col("upc") == F.lit(upc))
    elif search and search.strip():
        p = search_name(products, search)
    else:
        raise ValueError("Provide upc or search parameter")
    out = with_vendor(p, vendors).orderBy(F.col("unit_price").asc_nulls_last(),
                                          F.col("vendor_slug").asc_nulls_last(), F.col("sku"))
    if limit:
        out = out.limit(limit)
    return as_double(out)


def best_prices(products: DataFrame) -> DataFrame:
    """Cheapest in-stock priced offer per non-blank UPC (DISTINCT ON upc).

    An aggregate (``min_by``), not a window: partial aggregation runs before the
    shuffle, so a UPC carried by every vendor costs one row per map task.
    Ties on price go to the smaller (vendor_id, sku).
    """
    p = products.filter(has_text("upc") & (F.col("upc") != "") & F.col("unit_price").isNotNull()
                        & (F.col("in_stock") == F.lit(True)))
    cols = ["product_name", "brand", "category", "vendor_id", "unit_price", "case_price",
            "price_per_oz", "pack_size_raw", "in_stock", "product_url", "last_seen_at"]
    out = first_per_group(p, ["upc"], ["unit_price", "vendor_id", "sku"], cols)
    return as_double(out)


def price_history(history: DataFrame, product_id=None) -> DataFrame:
    """Snapshots of one product (or all), oldest first."""
    h = history if product_id is None else history.filter(F.col("product_id") == F.lit(product_id))
    return as_double(h.orderBy("product_id", "captured_at", "run_seq", "run_line"))


def sparklines(history: DataFrame, ids: DataFrame | None = None, n: int = 10) -> DataFrame:
    """Last ``n`` snapshots per product, numbered oldest first (1..n).

    Flat rows (product_id, point, price, captured_at); price 0 reads as null.
    ``ids`` restricts to a set of products (semi join); ``None`` = all products.
    The per-product top-n is a ``row_number() <= n`` that Spark limits map-side.
    """
    h = history if ids is None else history.join(ids.select("product_id").distinct(), "product_id",
                                                  "left_semi")
    last = top_k_per_group(h, ["product_id"],
                           [F.col("captured_at").desc(), F.col("run_seq").desc(), F.col("run_line").desc()],
                           n, "_back")
    cnt = F.count(F.lit(1)).over(Window.partitionBy("product_id"))
    return (last.withColumn("_cnt", cnt)
            .select("product_id", (F.col("_cnt") - F.col("_back") + 1).cast("int").alias("point"),
                    F.when(dbl("unit_price") != 0, dbl("unit_price")).alias("price"),
                    "captured_at"))


def price_changes(products: DataFrame, vendors: DataFrame, slug: str | None = None,
                  limit: int | None = 50) -> DataFrame:
    """Changed offers, newest first, with the change detail."""
    p = for_vendor(products.filter(F.col("price_changed") == F.lit(True)), vendors, slug)
    p = with_vendor(p, vendors).select("product_id", "sku", "product_name", "brand", "category",
                                       "unit_price", "last_price", "price_changed", "last_seen_at",
                                       "vendor_name", "vendor_slug")
    if limit:
        p = p.orderBy(F.col("last_seen_at").desc_nulls_first(), F.col("product_id").desc()).limit(limit)
    return as_double(price_change_detail(p))


SORT_NULLS = {"asc": lambda c: F.col(c).asc_nulls_last(), "desc": lambda c: F.col(c).desc_nulls_first()}
# legacy listings sort with nulls last in both directions
SORT_NULLS_LAST = {"asc": lambda c: F.col(c).asc_nulls_last(), "desc": lambda c: F.col(c).desc_nulls_last()}


def page(df: DataFrame, sort_by: str = "product_name", sort_dir: str = "asc", page_no: int = 1,
         per_page: int = 50, key: str = "product_id", deep: bool = False, nulls_last: bool = False) -> DataFrame:
    """One page of a sorted listing (Postgres null order, or nulls last in both
    directions for the legacy listing; ``key`` makes the order total).

    Shallow pages use TakeOrdered (limit pushed into the sort).  ``deep=True``
    numbers only (sort column, key) with ``global_rank`` and fetches the page's rows by their
    keys: neither ``offset + per_page`` rows in one task nor a sort of the wide rows.
    """
    order = [(SORT_NULLS_LAST if nulls_last else SORT_NULLS)[sort_dir](sort_by), F.col(key).asc()]
    start = (page_no - 1) * per_page
    if deep:
        r = global_rank(df.select(*dict.fromkeys([sort_by, key])), order, "_row")
        # at most per_page keys: a bounded broadcast
        wanted = r.filter((F.col("_row") > start) & (F.col("_row") <= start + per_page)).select(key)
        return df.join(F.broadcast(wanted), key, "left_semi")
    return df.orderBy(*order).offset(start).limit(per_page)


def page_count(df: DataFrame, per_page: int = 50) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total")).select(
        "total", F.ceil(F.col("total") / F.lit(per_page)).cast("bigint").alias("total_pages"))


def with_vendor_flat(products: DataFrame, vendors: DataFrame) -> DataFrame:
    return as_double(with_vendor(products, vendors))
