"""Registered queries: keyword extraction / join, deals, savings, price matrix."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelens.functions.numeric import dbl
from pricelens.operators import deals as D
from pricelens.operators import matching as M
from pricelens.plans.q_catalog import _norm_name_sql, unit_price_sql
from pricelens.plans.registry import BASELINE, R, V, query, stored_names

PFX = M.MATCH_PREFIX
MATRIX_SEARCH = "oz"


def _kw_ctes(extra_where: str = "") -> str:
    return f"""
base AS (SELECT p.*, p.product_id AS bid FROM products p
         WHERE vendor_id IN (SELECT vendor_id FROM vendors WHERE slug = '{BASELINE}')
           AND unit_price IS NOT NULL AND CAST(unit_price AS DOUBLE) > 0 {extra_where}),
kw0 AS (SELECT *, CASE WHEN starts_with(coalesce(description, ''), '{PFX}')
          THEN substr(regexp_replace(replace(coalesce(description, ''), '{PFX}', ''), '^\\s+|\\s+$', '', 'g'), 1, 80)
          ELSE coalesce(product_name, '') END AS search_name FROM base),
kw1 AS (SELECT *, list_slice(list_filter(regexp_split_to_array(regexp_replace(regexp_replace(search_name,
          '[^a-zA-Z0-9\\s]', '', 'g'), '^\\s+|\\s+$', '', 'g'), '\\s+'), lambda w: length(w) > 2), 1, 4) AS kw4 FROM kw0),
kw AS (SELECT *, list_slice(kw4, 1, 3) AS keywords FROM kw1 WHERE length(search_name) >= 5 AND len(kw4) >= 2),
offers AS (SELECT p.*, v.slug AS vendor_slug, v.name AS vendor_name FROM products p JOIN vendors v USING (vendor_id)
           WHERE unit_price IS NOT NULL),
pairs AS (SELECT k.bid, o.product_id AS m_product_id, o.vendor_id AS m_vendor_id, o.vendor_slug AS m_vendor_slug,
                 o.vendor_name AS m_vendor_name, o.sku AS m_sku, o.unit_price AS m_unit_price, o.product_name AS m_product_name,
                 o.case_price AS m_case_price, o.pack_size_raw AS m_pack_size_raw, o.image_url AS m_image_url,
                 o.product_url AS m_product_url, o.in_stock AS m_in_stock
          FROM kw k JOIN offers o ON o.vendor_id <> k.vendor_id
           AND contains(lower(o.product_name), lower(k.keywords[1]))
           AND contains(lower(o.product_name), lower(k.keywords[2]))
           AND (len(k.keywords) < 3 OR contains(lower(o.product_name), lower(k.keywords[3])))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY bid ORDER BY m_unit_price, m_vendor_slug, m_sku) AS rank
           FROM pairs WHERE CAST(m_unit_price AS DOUBLE) > 0)"""


@query("joi_match_keywords", f"""
SELECT product_id, search_name, CASE WHEN ok THEN kw4[1] END AS kw1, CASE WHEN ok THEN kw4[2] END AS kw2,
       CASE WHEN ok AND len(kw4) >= 3 THEN kw4[3] END AS kw3
FROM (SELECT *, length(search_name) >= 5 AND len(kw4) >= 2 AS ok FROM (
  SELECT *, list_slice(list_filter(regexp_split_to_array(regexp_replace(regexp_replace(search_name,
            '[^a-zA-Z0-9\\s]', '', 'g'), '^\\s+|\\s+$', '', 'g'), '\\s+'), lambda w: length(w) > 2), 1, 4) AS kw4
  FROM (SELECT product_id, CASE WHEN starts_with(coalesce(description, ''), '{PFX}')
          THEN substr(regexp_replace(replace(coalesce(description, ''), '{PFX}', ''), '^\\s+|\\s+$', '', 'g'), 1, 80)
          ELSE coalesce(product_name, '') END AS search_name FROM products) a) b) c""")
def q_match_keywords(spark, sf):
    p = M.match_keywords(V(spark, sf)["products"])
    return p.select("product_id", "search_name", F.get("keywords", 0).alias("kw1"),
                    F.get("keywords", 1).alias("kw2"), F.get("keywords", 2).alias("kw3"))


@query("joi_keyword_join", f"""WITH {_kw_ctes()}
SELECT bid, m_product_id, m_vendor_slug, m_sku, CAST(m_unit_price AS DOUBLE) AS m_unit_price, rank
FROM ranked WHERE rank <= 10""", views=["products", "vendors"])
def q_keyword_join(spark, sf):
    v = V(spark, sf)
    _, m = D.deal_matches(v["products"], v["vendors"], BASELINE, 10)
    return m.select("bid", "m_product_id", "m_vendor_slug", "m_sku", dbl("m_unit_price").alias("m_unit_price"),
                    "rank")


@query("joi_keyword_join_indexed", f"""WITH {_kw_ctes()}
SELECT bid, m_product_id, m_vendor_slug, m_sku, CAST(m_unit_price AS DOUBLE) AS m_unit_price, rank
FROM ranked WHERE rank <= 10""", views=["products", "vendors"])
def q_keyword_join_indexed(spark, sf):
    """``joi_keyword_join`` over the stored name index."""
    v = V(spark, sf)
    _, m = D.deal_matches(v["products"], v["vendors"], BASELINE, 10, index=stored_names(spark, v["products"]), write=True)
    return m.select("bid", "m_product_id", "m_vendor_slug", "m_sku", dbl("m_unit_price").alias("m_unit_price"),
                    "rank")


_DNU = unit_price_sql(price="unit_price", ppo=None, pc=None, us=None, um=None, raw="pack_size")


@query("joi_deal_offers", f"""WITH {_kw_ctes()}
SELECT *, {_DNU['price_per_oz']} AS norm_price_per_oz, {_DNU['normalization']} AS normalization FROM (SELECT r.bid, m_product_id AS product_id, m_vendor_slug AS vendor_slug, m_sku AS sku,
       CAST(m_unit_price AS DOUBLE) AS unit_price, rank, m_product_name AS product_name,
       CASE WHEN CAST(m_case_price AS DOUBLE) <> 0 THEN CAST(m_case_price AS DOUBLE) END AS case_price,
       m_pack_size_raw AS pack_size, m_image_url AS image_url, m_product_url AS product_url, m_in_stock AS in_stock,
       {R('CAST(m_unit_price AS DOUBLE) - CAST(b.unit_price AS DOUBLE)', 2)} AS diff_vs_baseline,
       {R(R('CAST(m_unit_price AS DOUBLE) - CAST(b.unit_price AS DOUBLE)', 2) + ' / CAST(b.unit_price AS DOUBLE) * 100', 1)} AS pct_vs_baseline
FROM ranked r JOIN kw b ON r.bid = b.bid WHERE rank <= 10) t""",
       views=["products", "vendors"])
def q_deal_offers(spark, sf):
    v = V(spark, sf)
    return D.deal_offers(v["products"], v["vendors"], BASELINE, 10)


def _deals_sql(limit: str) -> str:
    return f"""WITH {_kw_ctes()},
kept AS (SELECT * FROM ranked WHERE rank <= 10 AND CAST(m_unit_price AS DOUBLE) > 0),
best AS (SELECT bid, count(*) AS vendor_count, min(rank) AS r FROM kept GROUP BY bid),
d AS (SELECT k.bid, k.product_name AS baseline_product, k.sku AS baseline_sku, CAST(k.unit_price AS DOUBLE) AS baseline_price,
             k.image_url AS baseline_image, k.product_url AS baseline_url, k.in_stock AS baseline_in_stock, k.brand, k.category,
             CAST(m.m_unit_price AS DOUBLE) AS best_other_price, m.m_vendor_name AS best_other_vendor,
             m.m_vendor_slug AS best_other_vendor_slug,
             {R('CAST(k.unit_price AS DOUBLE) - CAST(m.m_unit_price AS DOUBLE)', 2)} AS best_savings_abs,
             k.pack_size_raw AS baseline_pack_size, b.vendor_count
      FROM kw k JOIN best b ON k.bid = b.bid JOIN kept m ON m.bid = b.bid AND m.rank = b.r),
deals AS (SELECT *, {R('best_savings_abs / baseline_price * 100', 1)} AS best_savings_pct FROM d
          ORDER BY best_savings_pct DESC, baseline_product ASC NULLS LAST, bid {limit})"""


@query("joi_top_deals", _deals_sql("LIMIT 25") + "\nSELECT * FROM deals", views=["products", "vendors"])
def q_top_deals(spark, sf):
    v = V(spark, sf)
    return D.top_deals(v["products"], v["vendors"], BASELINE, limit=25)


@query("joi_all_deals", _deals_sql("") + "\nSELECT * FROM deals", views=["products", "vendors"])
def q_all_deals(spark, sf):
    v = V(spark, sf)
    return D.top_deals(v["products"], v["vendors"], BASELINE, limit=None)


@query("joi_deal_summary", _deals_sql("LIMIT 25") + f"""
SELECT count(*) AS total_compared, CAST(sum(CASE WHEN best_savings_abs > 0 THEN 1 ELSE 0 END) AS BIGINT) AS cheaper_elsewhere,
       CAST(sum(CASE WHEN best_savings_abs < 0 THEN 1 ELSE 0 END) AS BIGINT) AS more_expensive_elsewhere,
       coalesce({R('CAST(sum(CASE WHEN best_savings_abs > 0 THEN CAST(best_savings_pct AS DECIMAL(12,1)) END) AS DOUBLE) / sum(CASE WHEN best_savings_abs > 0 THEN 1 END)', 1)}, 0.0) AS avg_savings_pct
FROM deals""", views=["products", "vendors"])
def q_deal_summary(spark, sf):
    v = V(spark, sf)
    return D.deal_summary(D.top_deals(v["products"], v["vendors"], BASELINE, limit=25))


@query("joi_deal_totals", _deals_sql("") + f"""
SELECT count(*) AS total_compared, count(*) FILTER (best_savings_abs > 0) AS cheaper_elsewhere,
       count(*) FILTER (best_savings_abs < 0) AS more_expensive_elsewhere,
       coalesce({R('CAST(sum(CASE WHEN best_savings_abs > 0 THEN CAST(best_savings_pct AS DECIMAL(12,1)) END) AS DOUBLE) / sum(CASE WHEN best_savings_abs > 0 THEN 1 END)', 1)}, 0.0) AS avg_savings_pct
FROM deals""", views=["products", "vendors"])
def q_deal_totals(spark, sf):
    """The summary before the report's limit."""
    v = V(spark, sf)
    return D.deal_summary(D.top_deals(v["products"], v["vendors"], BASELINE, limit=None))


def _savings_ctes(extra_where: str = "") -> str:
    return _kw_ctes(extra_where) + f""",
bo AS (SELECT bid, min(CASE WHEN CAST(m_unit_price AS DOUBLE) <> 0 THEN m_unit_price END) AS best_other
       FROM pairs GROUP BY bid),
rows AS (SELECT b.bid, b.category, b.unit_price AS bp, bo.bid IS NOT NULL AS compared,
                CASE WHEN bo.bid IS NOT NULL AND coalesce(bo.best_other, b.unit_price) < b.unit_price
                     THEN b.unit_price - coalesce(bo.best_other, b.unit_price) END AS saving
         FROM base b LEFT JOIN bo ON b.bid = bo.bid)"""


@query("joi_savings_summary", f"""WITH {_savings_ctes()}
SELECT {R('coalesce(CAST(sum(saving) AS DOUBLE), 0.0)', 2)} AS total_savings,
       CAST(sum(CASE WHEN compared THEN 1 ELSE 0 END) AS BIGINT) AS products_compared,
       CAST(sum(CASE WHEN saving IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS products_with_savings,
       {R('coalesce(CAST(sum(bp) AS DOUBLE), 0.0)', 2)} AS total_baseline_spend,
       CASE WHEN coalesce(CAST(sum(bp) AS DOUBLE), 0.0) > 0
            THEN {R('coalesce(CAST(sum(saving) AS DOUBLE), 0.0) / CAST(sum(bp) AS DOUBLE) * 100', 1)} ELSE 0.0 END AS savings_pct,
       '{BASELINE}' AS baseline_vendor FROM rows""", views=["products", "vendors"])
def q_savings_summary(spark, sf):
    v = V(spark, sf)
    return D.savings_summary(v["products"], v["vendors"], BASELINE)


@query("joi_category_savings", f"""WITH {_savings_ctes('AND category IS NOT NULL')}
SELECT category, products_compared, products_with_savings, {R('s', 2)} AS total_savings, {R('sp', 2)} AS total_baseline_spend,
       CASE WHEN sp > 0 THEN {R('s / sp * 100', 1)} ELSE 0.0 END AS savings_pct
FROM (SELECT CASE WHEN category IS NULL OR category = '' THEN 'Uncategorized' ELSE category END AS category,
             count(*) AS products_compared, CAST(sum(CASE WHEN saving IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS products_with_savings,
             coalesce(CAST(sum(saving) AS DOUBLE), 0.0) AS s, CAST(sum(bp) AS DOUBLE) AS sp
      FROM rows WHERE compared GROUP BY 1) g
ORDER BY total_savings DESC, category LIMIT 15""", views=["products", "vendors"])
def q_category_savings(spark, sf):
    v = V(spark, sf)
    return D.category_savings(v["products"], v["vendors"], BASELINE)


_NU = unit_price_sql(price="price", ppo=None, pc=None, us=None, um=None, raw="pack_size_raw")
_NK = _norm_name_sql("product_name")
_MATRIX = f"""
o AS (SELECT p.*, v.slug AS vendor_slug, v.name AS vendor_name FROM products p JOIN vendors v USING (vendor_id)
      WHERE product_name ILIKE '%{MATRIX_SEARCH}%'),
g0 AS (SELECT *, CASE WHEN upc IS NOT NULL AND upc <> '' THEN 'upc:' || upc WHEN {_NK} <> '' THEN {_NK}
                 ELSE coalesce(sku, CAST(product_id AS VARCHAR)) END AS group_key FROM o),
disp AS (SELECT group_key, product_name AS display_name, brand AS group_brand, category AS group_category, upc AS group_upc
         FROM (SELECT *, row_number() OVER (PARTITION BY group_key ORDER BY product_name, product_id) AS rn FROM g0) t WHERE rn = 1),
chosen AS (SELECT *, CAST(unit_price AS DOUBLE) AS price FROM (SELECT *, row_number() OVER (PARTITION BY group_key, vendor_slug
           ORDER BY product_name DESC, product_id DESC) AS rn FROM g0) t WHERE rn = 1),
g1 AS (SELECT group_key, count(*) AS vendor_count, min(price) AS best_price, max(price) AS worst_price,
              {R('CAST(sum(unit_price) AS DOUBLE) / count(unit_price)', 2)} AS avg_price,
              max(CASE WHEN vendor_slug = '{BASELINE}' THEN price END) AS bl FROM chosen GROUP BY group_key),
g AS (SELECT g1.*, bl AS baseline_price, CASE WHEN bl IS NOT NULL THEN '{BASELINE}' ELSE 'none' END AS baseline_source,
             {R('worst_price - best_price', 2)} AS max_savings, disp.* EXCLUDE (group_key)
      FROM g1 JOIN disp USING (group_key))"""


@query("joi_price_matrix", f"""WITH {_MATRIX}
SELECT group_key, display_name, group_brand, group_category, group_upc, vendor_count, baseline_price, baseline_source,
       best_price, worst_price, avg_price, max_savings, vendor_slug, vendor_name, product_name, sku, upc,
       price AS unit_price, CASE WHEN coalesce(CAST(case_price AS DOUBLE), 0.0) <> 0 THEN CAST(case_price AS DOUBLE) END AS case_price,
       pack_size_raw AS pack_size, in_stock, image_url, product_url, description,
       vendor_slug = '{BASELINE}' AND baseline_source <> 'manual' AS is_baseline,
       coalesce(price = best_price, false) AS is_best, coalesce(price = worst_price, false) AS is_worst,
       CASE WHEN price IS NOT NULL AND baseline_price IS NOT NULL THEN {R('price - baseline_price', 2)} END AS diff_vs_baseline,
       CASE WHEN price IS NOT NULL AND baseline_price IS NOT NULL AND baseline_price <> 0
            THEN {R(R('price - baseline_price', 2) + ' / baseline_price * 100', 2)} END AS pct_vs_baseline,
       CASE WHEN price IS NOT NULL AND best_price IS NOT NULL THEN {R('price - best_price', 2)} END AS diff_vs_best,
       {_NU['price_per_oz']} AS norm_price_per_oz, {_NU['price_per_unit']} AS norm_price_per_unit, {_NU['normalization']} AS normalization
FROM chosen JOIN g USING (group_key)""", views=["products", "vendors"])
def q_price_matrix(spark, sf):
    v = V(spark, sf)
    return D.price_matrix(v["products"], v["vendors"], MATRIX_SEARCH, BASELINE, limit=None).drop("baseline_product")


@query("joi_matrix_groups", f"""WITH {_MATRIX}
SELECT group_key, vendor_count, best_price, worst_price, avg_price, max_savings, baseline_price, baseline_source,
       display_name FROM g ORDER BY lower(display_name) ASC NULLS LAST, group_key LIMIT 50""",
       views=["products", "vendors"])
def q_matrix_groups(spark, sf):
    v = V(spark, sf)
    m = D.price_matrix(v["products"], v["vendors"], MATRIX_SEARCH, BASELINE, limit=50)
    return m.select("group_key", "vendor_count", "best_price", "worst_price", "avg_price", "max_savings",
                    "baseline_price", "baseline_source", "display_name").distinct()


@query("joi_matrix_totals", f"""WITH {_MATRIX}
SELECT count(DISTINCT group_key) AS total_groups, count(DISTINCT vendor_slug) AS vendors_found FROM chosen""", views=["products", "vendors"])
def q_matrix_totals(spark, sf):
    """Groups and vendors before the report's limit."""
    v = V(spark, sf)
    return D.matrix_totals(D.price_matrix(v["products"], v["vendors"], MATRIX_SEARCH, BASELINE, limit=None))


@query("joi_vendors_in", f"""
SELECT DISTINCT v.slug AS vendor_slug, v.name AS vendor_name FROM products p JOIN vendors v USING (vendor_id)
WHERE product_name ILIKE '%ring%' AND length(trim(v.slug)) > 0""")
def q_vendors_in(spark, sf):
    v = V(spark, sf)
    return D.vendors_in(D.matrix_offers(v["products"], v["vendors"], "ring"))
