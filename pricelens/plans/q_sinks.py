"""Registered queries: export tables (the writers are unit-tested round trips)."""

from __future__ import annotations

from pricelens.operators import deals as D
from pricelens.plans.q_catalog import _legacy_pack_sql
from pricelens.plans.q_deals import _deals_sql
from pricelens.plans.registry import BASELINE, CATEGORY, SEARCH, VENDOR, V, query
from pricelens.sinks import export as X


@query("snk_products_table", f"""
SELECT p.product_id, p.vendor_id, p.sku, p.upc, p.product_name, p.brand, p.category, p.pack_size_raw, p.pack_count,
       p.unit_size, p.unit_measure, p.cases_per_pallet, p.lead_time_days, p.in_stock, p.mixed_pallet, p.has_promo,
       p.image_url, p.product_url, p.description, p.first_seen_at, p.last_seen_at, p.price_changed,
       CAST(p.unit_price AS DOUBLE) AS unit_price, CAST(p.case_price AS DOUBLE) AS case_price,
       CAST(p.price_per_oz AS DOUBLE) AS price_per_oz, CAST(p.last_price AS DOUBLE) AS last_price,
       v.name AS vendor_name, v.slug AS vendor_slug
FROM products p LEFT JOIN vendors v USING (vendor_id)
WHERE v.slug = '{VENDOR}' AND p.category = '{CATEGORY}' AND p.product_name ILIKE '%{SEARCH}%'""")
def q_products_table(spark, sf):
    v = V(spark, sf)
    return X.products_table(v["products"], v["vendors"], VENDOR, CATEGORY, SEARCH)


_VENDOR_COLS = ",\n".join(
    f"max(CASE WHEN pos = {i} THEN vendor_name END) AS \"Vendor {i}\", "
    f"max(CASE WHEN pos = {i} THEN unit_price END) AS \"Vendor {i} Price\", "
    f"max(CASE WHEN pos = {i} THEN diff END) AS \"Vendor {i} Diff\"" for i in range(1, 6))


@query("snk_deals_table", _deals_sql("LIMIT 25") + f""",
dealoffers AS (SELECT r.bid, m_vendor_name AS vendor_name, CAST(m_unit_price AS DOUBLE) AS unit_price,
                  CAST(round(TRY_CAST(CAST(m_unit_price AS DOUBLE) - CAST(b.unit_price AS DOUBLE) AS DECIMAL(28,10)), 2) AS DOUBLE) AS diff,
                  row_number() OVER (PARTITION BY r.bid ORDER BY rank) AS pos
           FROM ranked r JOIN kw b ON r.bid = b.bid WHERE rank <= 10 AND CAST(m_unit_price AS DOUBLE) > 0),
wide AS (SELECT bid, {_VENDOR_COLS} FROM dealoffers WHERE pos <= 5 GROUP BY bid)
SELECT baseline_product AS "Baseline Product", baseline_sku AS "Baseline SKU", baseline_price AS "Baseline Price",
       brand AS "Brand", category AS "Category", best_other_price AS "Best Other Price",
       best_other_vendor AS "Best Other Vendor", best_savings_abs AS "Savings ($)", best_savings_pct AS "Savings (%)",
       vendor_count AS "# Vendors", baseline_url AS "Baseline URL", wide.* EXCLUDE (bid)
FROM deals LEFT JOIN wide USING (bid)""", views=["products", "vendors"])
def q_deals_table(spark, sf):
    v = V(spark, sf)
    m = D.deal_matches(v["products"], v["vendors"], BASELINE, 10, write=True)
    deals = D.top_deals(v["products"], v["vendors"], BASELINE, limit=25, matches=m)
    offers = D.deal_offers(v["products"], v["vendors"], BASELINE, 10, matches=m)
    offers = offers.join(v["vendors"].selectExpr("slug AS vendor_slug", "name AS vendor_name"), "vendor_slug")
    return X.deals_table(deals, offers, 5)


@query("snk_report_table", f"""
SELECT category AS "Category", manufacturer AS "Manufacturer", product AS "Product", description AS "Description",
       upc AS "UPC", CAST(delivered_price AS DOUBLE) AS "Delivered Price", CAST(NULL AS DOUBLE) AS "Case Price",
       CAST(price_per_unit AS DOUBLE) AS "Price/Unit", CAST(price_per_oz AS DOUBLE) AS "Price/Oz",
       pack_size_raw AS "Pack Size", pack_count AS "Pack Count", unit_size AS "Unit Size", unit_measure AS "Unit",
       pack_count * unit_size AS "Total Weight", CAST(cases_per_pallet AS DOUBLE) AS "Cases/Pallet",
       CAST(lead_time_days AS DOUBLE) AS "Lead Time (days)",
       CASE WHEN mixed_pallet THEN 'Yes' ELSE 'No' END AS "Mixed Pallet",
       CASE WHEN available THEN 'Yes' ELSE 'No' END AS "Available",
       CASE WHEN has_promo THEN 'Yes' ELSE 'No' END AS "Promo", product_id
FROM (SELECT *, {_legacy_pack_sql()} FROM catalog) t""")
def q_report_table(spark, sf):
    return X.report_table(V(spark, sf)["catalog"])
