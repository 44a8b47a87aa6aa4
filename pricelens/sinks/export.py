"""Exports and checkpoints.

SNK-01 export_products, SNK-02 deals_table / export_deals, SNK-03 report_table /
export_report, SNK-04 write_checkpoint.

Tables are shaped lazily (``*_table`` functions, checked against SQL); the
``export_*`` functions write them with Spark's CSV / Parquet writers - in
parallel, one file per partition, globally ordered across part files when an
order is requested (range partitioning by the sort key).
"""

from __future__ import annotations

import os
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.functions.numeric import dbl
from pricelens.operators.compare import as_double
from pricelens.operators.filters import facet, for_vendor, search_name, with_vendor
from pricelens.plans.shapes import top_k_per_group


def _write(df: DataFrame, path: str, fmt: str) -> str:
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)
    return path


# ── SNK-01 ───────────────────────────────────────────────────────────────
def products_table(products: DataFrame, vendors: DataFrame, slug: str | None = None,
                   category: str | None = None, search: str | None = None) -> DataFrame:
    """Filtered offers with vendor name / slug flattened in (export shape)."""
    p = search_name(facet(for_vendor(products, vendors, slug), category), search)
    return as_double(with_vendor(p, vendors))


def export_products(products: DataFrame, vendors: DataFrame, path: str, slug: str | None = None,
                    category: str | None = None, search: str | None = None, cap: int | None = None,
                    fmt: str = "csv") -> str:
    """Write the filtered catalog ordered by name (header row for CSV).  ``cap``
    reproduces the reference's 10,000-row export limit; raises on an empty result."""
    t = products_table(products, vendors, slug, category, search)
    if t.isEmpty():  # asked before the sort, so that one row is enough
        raise ValueError("No data to export")
    t = t.orderBy(F.col("product_name").asc_nulls_last(), "product_id")
    if cap:
        t = t.limit(cap)
    return _write(t, path, fmt)


# ── SNK-02 ───────────────────────────────────────────────────────────────
# Display headers: fixed values.
DEAL_HEADERS = [("baseline_product", "Baseline Product"), ("baseline_sku", "Baseline SKU"),
                ("baseline_price", "Baseline Price"), ("brand", "Brand"), ("category", "Category"),
                ("best_other_price", "Best Other Price"), ("best_other_vendor", "Best Other Vendor"),
                ("best_savings_abs", "Savings ($)"), ("best_savings_pct", "Savings (%)"),
                ("vendor_count", "# Vendors"), ("baseline_url", "Baseline URL")]


def deals_table(deals: DataFrame, offers: DataFrame, max_vendors: int = 5) -> DataFrame:
    """One wide row per deal: the 11 deal columns with display headers, then
    (vendor, price, diff) for the first ``max_vendors`` competing offers in price order.

    ``offers``: (bid, vendor_name, unit_price, diff_vs_baseline, rank).  At most
    ``max_vendors`` offers per deal are gathered (bounded), then spread by position.
    """
    top = top_k_per_group(offers, ["bid"], [F.col("rank")], max_vendors, "_pos")
    packed = top.groupBy("bid").agg(F.array_sort(F.collect_list(F.struct(
        "_pos", "vendor_name", "unit_price", "diff_vs_baseline"))).alias("_v"))
    d = deals.join(packed, "bid", "left")
    cols = [F.col(c).alias(h) for c, h in DEAL_HEADERS]
    for i in range(max_vendors):
        v = F.get(F.col("_v"), i)
        cols += [v.getField("vendor_name").alias(f"Vendor {i + 1}"),
                 v.getField("unit_price").alias(f"Vendor {i + 1} Price"),
                 v.getField("diff_vs_baseline").alias(f"Vendor {i + 1} Diff")]
    return d.select(*cols)


def export_deals(deals: DataFrame, offers: DataFrame, path: str, max_vendors: int = 5) -> str:
    if deals.isEmpty():  # every deal has a row, so offers need not be read for this
        raise ValueError("No deals found for export")
    return _write(deals_table(deals, offers, max_vendors), path, "csv")


# ── SNK-03 ───────────────────────────────────────────────────────────────
# Display headers and their columns: fixed values.
REPORT_COLUMNS = [("Category", "category"), ("Manufacturer", "manufacturer"), ("Product", "product"),
                  ("Description", "description"), ("UPC", "upc"), ("Delivered Price", "delivered_price"),
                  ("Case Price", "delivered_case_price"), ("Price/Unit", "price_per_unit"),
                  ("Price/Oz", "price_per_oz"), ("Pack Size", "pack_size_raw"), ("Pack Count", "pack_count"),
                  ("Unit Size", "unit_size"), ("Unit", "unit_measure"), ("Total Weight", "total_weight"),
                  ("Cases/Pallet", "cases_per_pallet"), ("Lead Time (days)", "lead_time_days"),
                  ("Mixed Pallet", "mixed_pallet"), ("Available", "available"), ("Promo", "has_promo")]
REPORT_NUMERIC = {"delivered_price", "delivered_case_price", "price_per_unit", "price_per_oz", "pack_count",
                  "unit_size", "total_weight", "cases_per_pallet", "lead_time_days"}
REPORT_FLAGS = {"mixed_pallet", "available", "has_promo"}


def report_table(catalog: DataFrame) -> DataFrame:
    """The catalog report: fixed columns with display headers, numbers typed,
    Yes/No flags (pack fields parsed when absent)."""
    from pricelens.functions.pack import parse_pack_legacy
    d = catalog if "total_weight" in catalog.columns else parse_pack_legacy(catalog)
    cols = []
    for header, c in REPORT_COLUMNS:
        src = F.col(c) if c in d.columns else F.lit(None)
        if c in REPORT_NUMERIC:
            src = dbl(src) if c in d.columns else F.lit(None).cast("double")
        elif c in REPORT_FLAGS:
            src = F.when(src.cast("boolean"), F.lit("Yes")).otherwise(F.lit("No"))
        else:
            src = src.cast("string")
        cols.append(src.alias(header))
    return d.select(*cols, "product_id")


def export_report(catalog: DataFrame, path: str, sort_by: str = "Category", ascending: bool = True) -> str:
    t = report_table(catalog)
    o = F.col(sort_by).asc_nulls_last() if ascending else F.col(sort_by).desc_nulls_last()
    return _write(t.orderBy(o, "product_id").drop("product_id"), path, "csv")


# ── SNK-04 ───────────────────────────────────────────────────────────────
def write_checkpoint(df: DataFrame, root: str, version: str | None = None) -> str:
    """Overwrite-safe progress snapshot: each call writes a new version folder
    (never the folder being read), returns its path."""
    v = version or time.strftime("%Y%m%dT%H%M%S") + f"-{time.time_ns() % 10**9:09d}"
    return _write(df, os.path.join(root, f"v={v}"), "parquet")
