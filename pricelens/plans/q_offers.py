"""Registered queries: filters, projections, comparison, ranking, dashboard aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelens.operators import analytics as A
from pricelens.operators import compare as C
from pricelens.operators import filters as FL
from pricelens.plans.registry import BASELINE, BRAND, CATEGORY, SEARCH, VENDOR, R, V, query, stored_names

DBL = "CAST({0} AS DOUBLE) AS {0}"
PC = ", ".join(DBL.format(c) for c in ["unit_price", "case_price", "price_per_oz", "last_price"])
PRODUCT_COLS_NO_PRICE = ("product_id, vendor_id, sku, upc, product_name, brand, category, pack_size_raw, "
                         "pack_count, unit_size, unit_measure, cases_per_pallet, lead_time_days, in_stock, "
                         "mixed_pallet, has_promo, image_url, product_url, description, first_seen_at, "
                         "last_seen_at, price_changed")


# ── filters / projections ────────────────────────────────────────────────
@query("flt_for_vendor", f"""
SELECT {PRODUCT_COLS_NO_PRICE}, {PC} FROM products
WHERE vendor_id IN (SELECT vendor_id FROM vendors WHERE slug = '{VENDOR}')""")
def q_for_vendor(spark, sf):
    v = V(spark, sf)
    return C.as_double(FL.for_vendor(v["products"], v["vendors"], VENDOR))


@query("flt_facet", f"""
SELECT {PRODUCT_COLS_NO_PRICE}, {PC} FROM products WHERE category = '{CATEGORY}' AND brand = '{BRAND}'""")
def q_facet(spark, sf):
    v = V(spark, sf)
    return C.as_double(FL.facet(v["products"], CATEGORY, BRAND))


@query("flt_search_name", f"""
SELECT {PRODUCT_COLS_NO_PRICE}, {PC} FROM products WHERE product_name ILIKE '%{SEARCH}%'""")
def q_search_name(spark, sf):
    v = V(spark, sf)
    return C.as_double(FL.search_name(v["products"], SEARCH))


@query("flt_search_indexed", f"""
SELECT {PRODUCT_COLS_NO_PRICE}, {PC} FROM products WHERE product_name ILIKE '%{SEARCH}%'""")
def q_search_indexed(spark, sf):
    """The same rows by a stored name index, brought up to date from the offers in two loads."""
    v = V(spark, sf)
    return C.as_double(FL.search_indexed(v["products"], stored_names(spark, v["products"]), SEARCH))


@query("flt_flags", f"""
SELECT {PRODUCT_COLS_NO_PRICE}, {PC} FROM products WHERE in_stock AND price_changed""")
def q_flags(spark, sf):
    v = V(spark, sf)
    return C.as_double(FL.where_flags(v["products"], in_stock=True, price_changed=True))


@query("flt_enabled_vendors", """
SELECT vendor_id, name, slug, scrape_method, scrape_enabled, nation, region FROM vendors WHERE scrape_enabled""")
def q_enabled(spark, sf):
    return FL.enabled_vendors(V(spark, sf)["vendors"])


@query("flt_recent_runs", """
SELECT r.*, v.name AS vendor_name, v.slug AS vendor_slug
FROM scrape_runs r LEFT JOIN vendors v USING (vendor_id)
ORDER BY started_at DESC NULLS FIRST, run_id DESC LIMIT 30""")
def q_recent_runs(spark, sf):
    v = V(spark, sf)
    return FL.recent_runs(v["scrape_runs"], v["vendors"], None, 30)


@query("flt_stuck_runs", """
SELECT r.*, v.name AS vendor_name, v.slug AS vendor_slug
FROM scrape_runs r LEFT JOIN vendors v USING (vendor_id) WHERE status = 'running'""")
def q_stuck_runs(spark, sf):
    v = V(spark, sf)
    return FL.stuck_runs(v["scrape_runs"], v["vendors"])


@query("prj_with_vendor", f"""
SELECT p.{PRODUCT_COLS_NO_PRICE.replace(', ', ', p.')}, {PC.replace('CAST(', 'CAST(p.')},
       v.name AS vendor_name, v.slug AS vendor_slug
FROM products p LEFT JOIN vendors v USING (vendor_id)""")
def q_with_vendor(spark, sf):
    v = V(spark, sf)
    return C.with_vendor_flat(v["products"], v["vendors"])


@query("prj_price_change_detail", f"""
SELECT product_id, CAST(unit_price AS DOUBLE) AS unit_price, CAST(last_price AS DOUBLE) AS last_price,
  CASE WHEN unit_price <> 0 AND last_price <> 0 THEN {R('CAST(unit_price AS DOUBLE) - CAST(last_price AS DOUBLE)', 4)} END AS price_diff,
  CASE WHEN unit_price <> 0 AND last_price <> 0 THEN {R('(CAST(unit_price AS DOUBLE) - CAST(last_price AS DOUBLE)) / CAST(last_price AS DOUBLE) * 100', 2)} END AS price_pct_change
FROM products""")
def q_price_change_detail(spark, sf):
    p = V(spark, sf)["products"].select("product_id", "unit_price", "last_price")
    return C.as_double(FL.price_change_detail(p))


# ── comparison / ranking ─────────────────────────────────────────────────
@query("joi_price_comparison", """
SELECT upc, product_name, brand, category, v.name AS vendor_name, v.slug AS vendor_slug,
       CAST(unit_price AS DOUBLE) AS unit_price, CAST(case_price AS DOUBLE) AS case_price,
       CAST(price_per_oz AS DOUBLE) AS price_per_oz, pack_size_raw, in_stock, last_seen_at, price_changed,
       CAST(last_price AS DOUBLE) AS last_price, product_url
FROM products p JOIN vendors v ON p.vendor_id = v.vendor_id
WHERE upc IS NOT NULL AND upc <> ''""")
def q_price_comparison(spark, sf):
    v = V(spark, sf)
    return C.price_comparison(v["products"], v["vendors"])


@query("joi_compare_search", f"""
SELECT p.{PRODUCT_COLS_NO_PRICE.replace(', ', ', p.')}, {PC.replace('CAST(', 'CAST(p.')},
       v.name AS vendor_name, v.slug AS vendor_slug
FROM products p LEFT JOIN vendors v USING (vendor_id)
WHERE product_name ILIKE '%{SEARCH}%'
ORDER BY p.unit_price ASC NULLS LAST, v.slug ASC NULLS LAST, p.sku LIMIT 100""")
def q_compare(spark, sf):
    v = V(spark, sf)
    return C.compare(v["products"], v["vendors"], search=SEARCH, limit=100)


@query("joi_compare_upc", f"""
SELECT p.{PRODUCT_COLS_NO_PRICE.replace(', ', ', p.')}, {PC.replace('CAST(', 'CAST(p.')},
       v.name AS vendor_name, v.slug AS vendor_slug
FROM products p LEFT JOIN vendors v USING (vendor_id)
WHERE p.upc = (SELECT upc FROM products WHERE upc <> '' GROUP BY upc ORDER BY count(*) DESC, upc LIMIT 1)""")
def q_compare_upc(spark, sf):
    """All offers of the UPC that most offers have."""
    v = V(spark, sf)
    shared = v["products"].filter("upc <> ''").groupBy("upc").count().orderBy(F.col("count").desc(), "upc").limit(1)
    return C.compare(v["products"], v["vendors"], upc=shared.select("upc").scalar(), limit=None)


@query("win_best_prices", """
SELECT upc, product_name, brand, category, vendor_id, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(case_price AS DOUBLE) AS case_price, CAST(price_per_oz AS DOUBLE) AS price_per_oz,
       pack_size_raw, in_stock, product_url, last_seen_at
FROM (SELECT *, row_number() OVER (PARTITION BY upc ORDER BY unit_price, vendor_id, sku) AS rn
      FROM products WHERE upc IS NOT NULL AND upc <> '' AND unit_price IS NOT NULL AND in_stock = true) t
WHERE rn = 1""")
def q_best_prices(spark, sf):
    return C.best_prices(V(spark, sf)["products"])


@query("win_price_history", """
SELECT product_id, run_id, CAST(unit_price AS DOUBLE) AS unit_price, CAST(case_price AS DOUBLE) AS case_price,
       in_stock, captured_at, run_seq, run_line
FROM product_history""")
def q_price_history(spark, sf):
    return C.price_history(V(spark, sf)["product_history"])


@query("win_sparklines", """
SELECT product_id, CAST(cnt - back + 1 AS INTEGER) AS point,
       CASE WHEN unit_price <> 0 THEN CAST(unit_price AS DOUBLE) END AS price, captured_at
FROM (SELECT *, count(*) OVER (PARTITION BY product_id) AS cnt FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY captured_at DESC, run_seq DESC, run_line DESC) AS back
  FROM product_history) a WHERE back <= 10) b""")
def q_sparklines(spark, sf):
    return C.sparklines(V(spark, sf)["product_history"], None, 10)


@query("win_price_changes", f"""
SELECT product_id, sku, product_name, brand, category, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(last_price AS DOUBLE) AS last_price, price_changed, last_seen_at, vendor_name, vendor_slug,
  CASE WHEN unit_price <> 0 AND last_price <> 0 THEN {R('CAST(unit_price AS DOUBLE) - CAST(last_price AS DOUBLE)', 4)} END AS price_diff,
  CASE WHEN unit_price <> 0 AND last_price <> 0 THEN {R('(CAST(unit_price AS DOUBLE) - CAST(last_price AS DOUBLE)) / CAST(last_price AS DOUBLE) * 100', 2)} END AS price_pct_change
FROM (SELECT p.*, v.name AS vendor_name, v.slug AS vendor_slug FROM products p LEFT JOIN vendors v USING (vendor_id)
      WHERE price_changed ORDER BY last_seen_at DESC NULLS FIRST, product_id DESC LIMIT 50) t""")
def q_price_changes(spark, sf):
    v = V(spark, sf)
    return C.price_changes(v["products"], v["vendors"], None, 50)


@query("srt_page", f"""
SELECT {PRODUCT_COLS_NO_PRICE}, {PC} FROM products
ORDER BY unit_price DESC NULLS FIRST, product_id LIMIT 50 OFFSET 100""")
def q_page(spark, sf):
    return C.as_double(C.page(V(spark, sf)["products"], "unit_price", "desc", 3, 50))


@query("srt_page_deep", f"""
SELECT {PRODUCT_COLS_NO_PRICE}, {PC} FROM products
ORDER BY product_name ASC NULLS LAST, product_id LIMIT 50 OFFSET 5000""")
def q_page_deep(spark, sf):
    return C.as_double(C.page(V(spark, sf)["products"], "product_name", "asc", 101, 50, deep=True))


@query("srt_page_count", """
SELECT count(*) AS total, CAST(ceil(count(*) / 50.0) AS BIGINT) AS total_pages FROM products""")
def q_page_count(spark, sf):
    return C.page_count(V(spark, sf)["products"], 50)


# ── dashboard aggregates ─────────────────────────────────────────────────
@query("agg_product_count", "SELECT count(*) AS product_count FROM products")
def q_product_count(spark, sf):
    return A.product_count(V(spark, sf)["products"])


@query("agg_summary", """
SELECT * FROM
 (SELECT count(*) AS total_products,
         count(DISTINCT CASE WHEN category IS NOT NULL AND category <> '' THEN category END) AS total_categories,
         count(DISTINCT CASE WHEN brand IS NOT NULL AND brand <> '' THEN brand END) AS total_brands,
         CAST(sum(CASE WHEN price_changed THEN 1 ELSE 0 END) AS BIGINT) AS price_changes FROM products) a,
 (SELECT count(*) AS total_vendors FROM vendors WHERE scrape_enabled) b,
 (SELECT count(*) AS total_runs FROM scrape_runs) c""")
def q_summary(spark, sf):
    v = V(spark, sf)
    return A.summary(v["products"], v["vendors"], v["scrape_runs"])


@query("agg_summary_vendor", f"""
SELECT * FROM
 (SELECT count(*) AS total_products,
         count(DISTINCT CASE WHEN category IS NOT NULL AND category <> '' THEN category END) AS total_categories,
         count(DISTINCT CASE WHEN brand IS NOT NULL AND brand <> '' THEN brand END) AS total_brands,
         CAST(sum(CASE WHEN price_changed THEN 1 ELSE 0 END) AS BIGINT) AS price_changes FROM products
  WHERE vendor_id IN (SELECT vendor_id FROM vendors WHERE slug = '{VENDOR}')) a,
 (SELECT count(*) AS total_vendors FROM vendors WHERE scrape_enabled) b,
 (SELECT count(*) AS total_runs FROM scrape_runs) c""")
def q_summary_vendor(spark, sf):
    v = V(spark, sf)
    return A.summary(v["products"], v["vendors"], v["scrape_runs"], VENDOR)


@query("agg_vendor_stats", """
WITH pc AS (SELECT vendor_id, count(*) AS product_count FROM products GROUP BY vendor_id),
lr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vendor_id ORDER BY started_at DESC, run_id DESC) AS rn
                      FROM scrape_runs) t WHERE rn = 1)
SELECT v.vendor_id, v.name, v.slug, v.scrape_method, v.scrape_enabled,
       CAST(coalesce(pc.product_count, 0) AS BIGINT) AS product_count,
       lr.run_id AS last_run_id, lr.status AS last_run_status, lr.started_at AS last_run_started_at,
       lr.products_found AS last_run_products_found
FROM vendors v LEFT JOIN pc USING (vendor_id) LEFT JOIN lr USING (vendor_id)""")
def q_vendor_stats(spark, sf):
    v = V(spark, sf)
    return A.vendor_stats(v["products"], v["vendors"], v["scrape_runs"])


@query("agg_vendor_counts", """
WITH per AS (SELECT v.name, v.scrape_method, coalesce(c.n, 0) AS product_count
             FROM vendors v LEFT JOIN (SELECT vendor_id, count(*) AS n FROM products GROUP BY vendor_id) c USING (vendor_id))
SELECT name AS vendor_name, scrape_method, CAST(product_count AS BIGINT) AS product_count,
       product_count > 0 AS has_data, false AS is_total FROM per
UNION ALL
SELECT 'TOTAL', NULL, CAST(sum(product_count) AS BIGINT), sum(product_count) > 0, true FROM per""")
def q_vendor_counts(spark, sf):
    v = V(spark, sf)
    return A.vendor_counts(v["products"], v["vendors"])


@query("agg_run_totals", """
WITH r AS (SELECT s.*, v.slug FROM scrape_runs s LEFT JOIN vendors v USING (vendor_id))
SELECT slug AS vendor, count(*) AS runs, CAST(sum(products_found) AS BIGINT) AS found,
       CAST(sum(products_new) AS BIGINT) AS new, CAST(sum(products_updated) AS BIGINT) AS updated,
       CAST(sum(price_changes) AS BIGINT) AS price_changes, CAST(sum(errors) AS BIGINT) AS errors
FROM r GROUP BY slug
UNION ALL
SELECT 'TOTAL', count(*), CAST(sum(products_found) AS BIGINT), CAST(sum(products_new) AS BIGINT),
       CAST(sum(products_updated) AS BIGINT), CAST(sum(price_changes) AS BIGINT), CAST(sum(errors) AS BIGINT) FROM r""")
def q_run_totals(spark, sf):
    v = V(spark, sf)
    return A.run_totals(v["scrape_runs"], v["vendors"])


AVG_DEC = "CAST(sum({0}) AS DOUBLE) / count({0})"


@query("agg_by_vendor", f"""
SELECT v.name AS vendor, v.slug, CAST(coalesce(g.product_count, 0) AS BIGINT) AS product_count,
       {R('g.s / g.n', 2)} AS avg_price, {R('g.mn', 2)} AS min_price, {R('g.mx', 2)} AS max_price
FROM vendors v LEFT JOIN (
  SELECT vendor_id, count(*) AS product_count, CAST(sum(unit_price) AS DOUBLE) AS s,
         CAST(count(unit_price) AS DOUBLE) AS n, CAST(min(unit_price) AS DOUBLE) AS mn, CAST(max(unit_price) AS DOUBLE) AS mx
  FROM products GROUP BY vendor_id) g USING (vendor_id)""")
def q_by_vendor(spark, sf):
    v = V(spark, sf)
    return A.by_vendor(v["products"], v["vendors"])


@query("agg_by_category", f"""
SELECT category, count AS count, {R('s / n', 2)} AS avg_price, {R('mn', 2)} AS min_price, {R('mx', 2)} AS max_price
FROM (SELECT CASE WHEN category IS NULL OR category = '' THEN 'Uncategorized' ELSE category END AS category,
             count(*) AS count, CAST(sum(unit_price) AS DOUBLE) AS s, CAST(count(unit_price) AS DOUBLE) AS n,
             CAST(min(unit_price) AS DOUBLE) AS mn, CAST(max(unit_price) AS DOUBLE) AS mx
      FROM products GROUP BY 1) g""")
def q_by_category(spark, sf):
    return A.by_category(V(spark, sf)["products"])


@query("agg_by_brand", f"""
SELECT brand, count, {R('s / n', 2)} AS avg_price
FROM (SELECT CASE WHEN brand IS NULL OR brand = '' THEN 'Unknown' ELSE brand END AS brand,
             count(*) AS count, CAST(sum(unit_price) AS DOUBLE) AS s, CAST(count(unit_price) AS DOUBLE) AS n
      FROM products GROUP BY 1) g ORDER BY count DESC, brand LIMIT 30""")
def q_by_brand(spark, sf):
    return A.by_brand(V(spark, sf)["products"], limit=30)


@query("agg_filter_values", """
SELECT DISTINCT * FROM (SELECT 'category' AS kind, category AS value FROM products
                        UNION ALL SELECT 'brand', brand FROM products) t
WHERE value IS NOT NULL AND value <> ''""")
def q_filter_values(spark, sf):
    return A.filter_values(V(spark, sf)["products"])


def _profile_sql() -> str:
    ht = "CAST(sum(CASE WHEN length(trim({0})) > 0 THEN 1 ELSE 0 END) AS BIGINT)"
    tn = "CAST(sum(CASE WHEN {0} IS NOT NULL AND CAST({0} AS DOUBLE) <> 0 THEN 1 ELSE 0 END) AS BIGINT)"
    tb = "CAST(sum(CASE WHEN {0} THEN 1 ELSE 0 END) AS BIGINT)"
    parts = [
        "count(*) AS total",
        ht.format("upc") + " AS n_upc",
        ht.format("pack_size_raw") + " AS n_pack_size_raw",
        "CAST(sum(CASE WHEN coalesce(pack_count, 0) <> 0 AND coalesce(unit_size, 0) <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_structured_pack",
        tn.format("price_per_oz") + " AS n_price_per_oz",
        tn.format("unit_price") + " AS n_unit_price",
        tn.format("case_price") + " AS n_case_price",
        ht.format("brand") + " AS n_brand",
        ht.format("category") + " AS n_category",
        ht.format("image_url") + " AS n_image",
        ht.format("product_url") + " AS n_url",
        ht.format("description") + " AS n_description",
        tb.format("in_stock") + " AS n_in_stock",
        tb.format("has_promo") + " AS n_has_promo",
        "sum(CASE WHEN unit_price <> 0 THEN unit_price END) AS price_sum",
        tb.format("price_changed") + " AS n_changes",
        "count(DISTINCT CASE WHEN category IS NOT NULL AND category <> '' THEN category END) AS n_categories",
    ]
    return ("prof AS (SELECT g.*, v.name AS vendor_name, v.slug AS vendor_slug FROM (SELECT vendor_id, "
            + ", ".join(parts) + " FROM products GROUP BY vendor_id) g JOIN vendors v USING (vendor_id))")


COV = ["upc", "pack_size_raw", "structured_pack", "price_per_oz", "unit_price", "case_price", "brand",
       "category", "image", "url", "description", "in_stock", "has_promo"]


def _pct(n: str) -> str:
    return R(f"CAST({n} AS DOUBLE) / CAST(total AS DOUBLE) * 100", 1)


def _dq_sql() -> str:
    score = " + ".join(f"{_pct('n_' + k)} * {w}" for k, w in A.QUALITY_WEIGHTS)
    cov = ", ".join(f"n_{k} AS {k}_count, {_pct('n_' + k)} AS {k}_pct" for k in COV)
    return (f"SELECT vendor_name, vendor_slug, total AS total_products, {R(score, 1)} AS quality_score, {cov} "
            "FROM prof")


@query("agg_data_quality", f"WITH {_profile_sql()} {_dq_sql()}", views=["products", "vendors"])
def q_data_quality(spark, sf):
    v = V(spark, sf)
    return A.data_quality(v["products"], v["vendors"])


@query("agg_data_quality_overall", f"""WITH {_profile_sql()}, dq AS ({_dq_sql()})
SELECT CAST(sum(total_products) AS BIGINT) AS total_products,
       coalesce({R('sum(quality_score * total_products) / sum(total_products)', 1)}, 0.0) AS avg_quality_score,
       count(*) AS vendor_count FROM dq""", views=["products", "vendors"])
def q_data_quality_overall(spark, sf):
    v = V(spark, sf)
    return A.data_quality_overall(A.data_quality(v["products"], v["vendors"]))


_AVG_T = "coalesce(CASE WHEN n_unit_price > 0 THEN CAST(price_sum AS DOUBLE) / CAST(n_unit_price AS DOUBLE) END, 0.0)"


@query("agg_vendor_radar", f"""WITH {_profile_sql()},
b AS (SELECT vendor_name AS vendor, vendor_slug AS slug, total AS product_count, {_AVG_T} AS avg_price,
             {_pct('n_upc')} AS upc_pct, {_pct('n_brand')} AS brand_pct, {_pct('n_image')} AS image_pct,
             {_pct('n_pack_size_raw')} AS pack_pct, {_pct('n_in_stock')} AS stock_pct FROM prof),
m AS (SELECT CASE WHEN max(product_count) > 0 THEN max(product_count) ELSE 1 END AS mc,
             coalesce(max(CASE WHEN avg_price > 0 THEN avg_price END), 1.0) AS ma FROM b)
SELECT b.*, {R('CAST(product_count AS DOUBLE) / CAST(mc AS DOUBLE) * 100', 1)} AS catalog_size,
       CASE WHEN ma > 0 THEN {R('(1.0 - avg_price / ma) * 100', 1)} ELSE 50.0 END AS price_competitiveness
FROM b, m""", views=["products", "vendors"])
def q_vendor_radar(spark, sf):
    v = V(spark, sf)
    return A.vendor_radar(v["products"], v["vendors"])


@query("agg_vendor_leaderboard", f"""WITH {_profile_sql()},
s AS (SELECT vendor_name AS vendor, vendor_slug AS slug, vendor_id, total AS product_count,
             {R(_AVG_T, 2)} AS avg_price, n_categories AS categories,
             least(100.0, CAST(total AS DOUBLE) / 50 * 100) AS cat,
             {R('n_upc / CAST(total AS DOUBLE) * 25 + n_brand / CAST(total AS DOUBLE) * 25 + n_image / CAST(total AS DOUBLE) * 25 + (n_unit_price / CAST(total AS DOUBLE)) * 25', 1)} AS data_quality,
             {R('n_in_stock / CAST(total AS DOUBLE) * 100', 1)} AS stock_health,
             least(100.0, CAST(n_categories AS DOUBLE) / 20 * 100) AS div,
             {_pct('n_upc')} AS upc_pct FROM prof),
c AS (SELECT *, {R('cat * 0.25 + data_quality * 0.30 + stock_health * 0.25 + div * 0.20', 1)} AS composite_score FROM s)
SELECT vendor, slug, product_count, avg_price, categories, data_quality, stock_health, upc_pct, composite_score,
       {R('cat', 1)} AS catalog, {R('div', 1)} AS diversity, stock_health AS stock_pct,
       row_number() OVER (ORDER BY composite_score DESC, vendor, vendor_id) AS rank
FROM c""", views=["products", "vendors"])
def q_vendor_leaderboard(spark, sf):
    v = V(spark, sf)
    return A.vendor_leaderboard(v["products"], v["vendors"])


@query("agg_insights", f"""WITH {_profile_sql()},
v0 AS (SELECT vendor_name AS name, vendor_id, total AS cnt, {_AVG_T} AS avg, {_pct('n_upc')} AS upc,
              n_changes AS chg, {_pct('n_in_stock')} AS stock FROM prof),
v AS (SELECT *, row_number() OVER (ORDER BY cnt DESC, name, vendor_id) AS ord FROM v0),
a AS (SELECT
  (SELECT count(*) FROM v) AS n_vendors,
  (SELECT name FROM v WHERE ord = 1) AS big_name, (SELECT cnt FROM v WHERE ord = 1) AS big_cnt,
  (SELECT name FROM v WHERE ord = 2) AS sec_name, (SELECT cnt FROM v WHERE ord = 2) AS sec_cnt,
  (SELECT name FROM v ORDER BY upc DESC, ord LIMIT 1) AS bu_name, (SELECT upc FROM v ORDER BY upc DESC, ord LIMIT 1) AS bu,
  (SELECT name FROM v ORDER BY upc, ord LIMIT 1) AS wu_name, (SELECT upc FROM v ORDER BY upc, ord LIMIT 1) AS wu,
  (SELECT name FROM v ORDER BY CASE WHEN avg > 0 THEN avg ELSE 'inf'::DOUBLE END, ord LIMIT 1) AS ch_name,
  (SELECT avg FROM v ORDER BY CASE WHEN avg > 0 THEN avg ELSE 'inf'::DOUBLE END, ord LIMIT 1) AS ch_avg,
  (SELECT name FROM v ORDER BY avg DESC, ord LIMIT 1) AS pr_name, (SELECT avg FROM v ORDER BY avg DESC, ord LIMIT 1) AS pr_avg,
  (SELECT CAST(sum(chg) AS BIGINT) FROM v) AS total_changes,
  (SELECT name FROM v ORDER BY chg DESC, ord LIMIT 1) AS vo_name, (SELECT chg FROM v ORDER BY chg DESC, ord LIMIT 1) AS vo,
  (SELECT CAST(sum(CAST(stock AS DECIMAL(12,1))) AS DOUBLE) FROM v) AS stock_sum,
  (SELECT name FROM v ORDER BY stock DESC, ord LIMIT 1) AS bs_name, (SELECT stock FROM v ORDER BY stock DESC, ord LIMIT 1) AS bs,
  (SELECT CAST(sum(cnt) AS BIGINT) FROM v) AS total_products)
SELECT 'largest_catalog' AS fact, big_name AS vendor, sec_name AS other_vendor, CAST(big_cnt AS DOUBLE) AS metric,
       CAST(big_cnt - sec_cnt AS DOUBLE) AS metric2 FROM a
UNION ALL SELECT 'upc_coverage', bu_name, wu_name, bu, wu FROM a
UNION ALL SELECT 'price_spread', ch_name, pr_name, {R('(pr_avg - ch_avg) / ch_avg * 100', 1)}, NULL FROM a
  WHERE n_vendors > 1 AND ch_avg > 0 AND pr_avg > 0
UNION ALL SELECT 'market_activity', vo_name, NULL, CAST(total_changes AS DOUBLE), CAST(vo AS DOUBLE) FROM a WHERE total_changes > 0
UNION ALL SELECT 'stock_availability', bs_name, NULL, {R('stock_sum / n_vendors', 1)}, bs FROM a
UNION ALL SELECT 'next_step', wu_name, NULL, CAST(total_products AS DOUBLE), CAST(n_vendors AS DOUBLE) FROM a""",
       views=["products", "vendors"])
def q_insights(spark, sf):
    v = V(spark, sf)
    return A.insights(v["products"], v["vendors"])




@query("agg_filter_value_lists", """
SELECT list_sort(list(DISTINCT category) FILTER (WHERE category IS NOT NULL AND category <> '')) AS categories,
       list_sort(list(DISTINCT brand) FILTER (WHERE brand IS NOT NULL AND brand <> '')) AS brands
FROM products""")
def q_filter_value_lists(spark, sf):
    return A.filter_value_lists(V(spark, sf)["products"])
