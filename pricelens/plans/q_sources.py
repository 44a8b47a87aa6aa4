"""Registered queries: page extraction, text cleaning, record hygiene, look-up terms."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pricelens.functions.numeric import dbl
from pricelens.operators import lookup as L
from pricelens.plans.fixtures import raw_table
from pricelens.plans.registry import BASELINE, VENDOR, V, query
from pricelens.sources import feeds as SF
from pricelens.sources import pages as PG
from pricelens.sources import records as RC


def _html_text_sql(x: str) -> str:
    t = f"regexp_replace({x}, '<[^>]+>', '', 'g')"
    for a, b in PG.ENTITIES:
        b_sql = b.replace("'", "''")
        t = f"replace({t}, '{a}', '{b_sql}')"
    return f"regexp_replace({t}, '^\\s+|\\s+$', '', 'g')"


_H1 = _html_text_sql("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")
_GT = "regexp_extract(regexp_extract(html, '(?is)<iframe[^>]*externalIframeNutrition[^>]*>', 0), 'GTIN=(\\d+)', 1)"


@query("src_extract_pages", f"""
SELECT page_id, url, coalesce(upc, 'page-' || slug) AS sku, upc, name AS product_name, CAST(NULL AS VARCHAR) AS brand,
       CAST(NULL AS VARCHAR) AS description, '' AS pack_size_raw, url AS product_url,
       CAST(NULL AS VARCHAR) AS image_url, true AS in_stock
FROM (SELECT page_id, url, {_H1} AS name,
             regexp_extract(regexp_replace(url, '/+$', ''), '([^/]*)$', 1) AS slug,
             CASE WHEN {_GT} <> '' THEN coalesce(nullif(regexp_replace({_GT}, '^0+', ''), ''), {_GT}) END AS upc
      FROM pages) t WHERE length(coalesce(name, '')) >= 2""")
def q_extract_pages(spark, sf):
    return PG.extract_product_pages(raw_table(spark, sf, "pages"))


_LINKS = """
SELECT page_id, url, unnest(generate_series(1, len(h))) AS pos, unnest(h) AS href, unnest(t) AS raw_text
FROM (SELECT page_id, url, regexp_extract_all(html, '(?is)<a[^>]*href="([^"]*)"[^>]*>(.*?)</a>', 1) AS h,
             regexp_extract_all(html, '(?is)<a[^>]*href="([^"]*)"[^>]*>(.*?)</a>', 2) AS t FROM pages) s"""


@query("src_page_links", f"""
SELECT page_id, url, CAST(pos AS INTEGER) AS pos, href, {_html_text_sql('raw_text')} AS text FROM ({_LINKS}) l""")
def q_page_links(spark, sf):
    return PG.page_links(raw_table(spark, sf, "pages"))


def _slug_sql(x: str) -> str:
    return f"substr(regexp_replace(regexp_replace(lower({x}), '^\\s+|\\s+$', '', 'g'), '[^a-z0-9]+', '-', 'g'), 1, 50)"


@query("src_derive_sku", f"""
SELECT page_id, pos, href, text,
       coalesce(nullif(regexp_extract(coalesce(href, ''), '/products?/([^/?#]+)', 1), ''),
                nullif(regexp_extract(coalesce(href, ''), '/(\\d{{4,}})', 1), ''),
                nullif(regexp_extract(coalesce(href, ''), 'id=(\\d+)', 1), ''),
                CASE WHEN length(regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g')) > 0
                     THEN 'site-' || {_slug_sql('text')} END) AS sku
FROM (SELECT page_id, CAST(pos AS INTEGER) AS pos, href, {_html_text_sql('raw_text')} AS text FROM ({_LINKS}) l) x""")
def q_derive_sku(spark, sf):
    links = PG.page_links(raw_table(spark, sf, "pages")).select("page_id", "pos", "href", "text")
    return PG.derive_sku(links, url="href", name="text", prefix="site", hash_fallback=False)


_PRICE_TEXT_SQL = """CASE WHEN event_id % 7 = 0 THEN 'n/a'
  WHEN event_id % 2 = 0 THEN '$' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || ',' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') || '/ea'
  WHEN event_id % 3 = 0 THEN 'Now ' || CAST(value AS VARCHAR) || chr(10) || '$9.99 was'
  ELSE props END"""


@query("src_with_price", f"""
SELECT event_id, t, CASE WHEN m <> '' THEN TRY_CAST(replace(m, ',', '') AS DOUBLE) END AS unit_price
FROM (SELECT event_id, t, regexp_extract(regexp_replace(coalesce(t, ''), '[\\n ]', ' ', 'g'), '\\$?([\\d,]+\\.?\\d*)', 1) AS m
      FROM (SELECT event_id, {_PRICE_TEXT_SQL} AS t FROM events) a) b""")
def q_with_price(spark, sf):
    e = raw_table(spark, sf, "events")
    t = (F.when(F.col("event_id") % 7 == 0, F.lit("n/a"))
         .when(F.col("event_id") % 2 == 0,
               F.concat(F.lit("$"), F.floor("value").cast("bigint").cast("string"), F.lit(","),
                        F.lpad((F.col("event_id") % 1000).cast("string"), 3, "0"), F.lit("/ea")))
         .when(F.col("event_id") % 3 == 0, F.concat(F.lit("Now "), F.col("value").cast("string"), F.lit("\n$9.99 was")))
         .otherwise(F.col("props")))
    return PG.with_price(e.select("event_id", t.alias("t")), "t")


_RAW_NAME_SQL = """product_name || CASE product_id % 3 WHEN 0 THEN ' current price $' || CAST(unit_price AS VARCHAR)
  WHEN 1 THEN chr(10) || '$' || CAST(unit_price AS VARCHAR) || ' each' ELSE '  $12.50 ' END"""


@query("src_clean_names", f"""
SELECT product_id, raw, pack_size_raw,
  CASE WHEN length(regexp_replace(coalesce(pack_size_raw, ''), '^\\s+|\\s+$', '', 'g')) > 0
       THEN n || ' (' || regexp_replace(pack_size_raw, '^\\s+|\\s+$', '', 'g') || ')' ELSE n END AS product_name
FROM (SELECT product_id, raw, pack_size_raw,
        regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw, 'current price \\$[\\d,.]+', '', 'g'),
          '(?s)\\n\\s*\\$.*$', ''), '^\\s+|\\s+$', '', 'g'), '\\s*\\$[\\d,.]+\\s*$', ''), '^\\s+|\\s+$', '', 'g') AS n
      FROM (SELECT product_id, {_RAW_NAME_SQL} AS raw, pack_size_raw FROM products) a) b""")
def q_clean_names(spark, sf):
    p = V(spark, sf)["products"]
    raw = F.concat(F.col("product_name"),
                   F.when(F.col("product_id") % 3 == 0, F.concat(F.lit(" current price $"), F.col("unit_price").cast("string")))
                   .when(F.col("product_id") % 3 == 1, F.concat(F.lit("\n$"), F.col("unit_price").cast("string"), F.lit(" each")))
                   .otherwise(F.lit("  $12.50 ")))
    d = p.select("product_id", raw.alias("raw"), "pack_size_raw").withColumn("product_name", F.col("raw"))
    return PG.clean_names(d, "product_name", pack="pack_size_raw")


@query("src_clean_brand", """
SELECT product_id, brand AS raw_brand, coalesce(trim(regexp_replace(brand, '-EP$', '')), '') AS brand FROM products""")
def q_clean_brand(spark, sf):
    p = V(spark, sf)["products"].select("product_id", F.col("brand").alias("raw_brand"), "brand")
    return PG.clean_brand(p)


_OBS = ("vendor_id, sku, captured_at, run_seq, run_line, CAST(unit_price AS DOUBLE) AS unit_price, "
        "CAST(case_price AS DOUBLE) AS case_price, in_stock, has_promo, mixed_pallet, run_id")


@query("src_dedup_first", f"""
SELECT {_OBS} FROM (SELECT *, row_number() OVER (PARTITION BY vendor_id, sku ORDER BY captured_at, run_seq, run_line, case_price) AS rn
                    FROM observations) t WHERE rn = 1""")
def q_dedup_first(spark, sf):
    d = RC.dedup_first(V(spark, sf)["observations"], ["vendor_id", "sku"],
                       ["captured_at", "run_seq", "run_line", "case_price"])
    return d.withColumn("unit_price", dbl("unit_price")).withColumn("case_price", dbl("case_price"))


@query("src_cap_per_vendor", """
SELECT product_id, vendor_id, sku, product_name FROM (
  SELECT *, row_number() OVER (PARTITION BY vendor_id ORDER BY product_id) AS rn FROM products) t WHERE rn <= 100""")
def q_cap_per_vendor(spark, sf):
    p = V(spark, sf)["products"].select("product_id", "vendor_id", "sku", "product_name")
    return RC.cap_per_vendor(p, 100, [F.col("product_id")])


@query("src_split_valid", """
WITH r AS (SELECT nullif(upc, '') AS sku, CASE WHEN product_id % 23 = 0 THEN 'ab' ELSE product END AS product_name FROM catalog),
t AS (SELECT CASE WHEN NOT coalesce(length(trim(sku)) > 0, false) THEN 'missing sku'
                  WHEN NOT coalesce(length(regexp_replace(product_name, '^\\s+|\\s+$', '', 'g')) >= 3, false) THEN 'name missing or too short'
             END AS reason FROM r)
SELECT coalesce(reason, 'ok') AS outcome, count(*) AS n FROM t GROUP BY 1""")
def q_split_valid(spark, sf):
    c = V(spark, sf)["catalog"]
    r = c.select(F.nullif(F.col("upc"), F.lit("")).alias("sku"),
                 F.when(F.col("product_id") % 23 == 0, F.lit("ab")).otherwise(F.col("product")).alias("product_name"))
    good, errors = RC.split_valid(r)
    return (good.select(F.lit("ok").alias("outcome")).unionByName(errors.select(F.col("reason").alias("outcome")))
            .groupBy("outcome").agg(F.count(F.lit(1)).alias("n")))


@query("src_primary_category", """
SELECT product_id, sc AS sub_category, CASE WHEN coalesce(sc, '') <> '' THEN trim(split_part(sc, ',', 1)) ELSE 'Unknown' END AS category
FROM (SELECT product_id, CASE WHEN product_id % 5 = 0 THEN NULL ELSE category || ', ' || manufacturer END AS sc FROM catalog) t""")
def q_primary_category(spark, sf):
    c = V(spark, sf)["catalog"]
    d = c.select("product_id", F.when(F.col("product_id") % 5 == 0, F.lit(None).cast("string"))
                 .otherwise(F.concat(F.col("category"), F.lit(", "), F.col("manufacturer"))).alias("sub_category"))
    return SF.primary_category(d)


@query("joi_lookup_terms", f"""
SELECT name_key, product_name, product_id, sku, brand, category, CAST(unit_price AS DOUBLE) AS unit_price, vendor_id
FROM (SELECT *, row_number() OVER (PARTITION BY name_key ORDER BY product_name, product_id) AS rn
      FROM (SELECT *, lower(regexp_replace(product_name, '^\\s+|\\s+$', '', 'g')) AS name_key FROM products
            WHERE vendor_id NOT IN (SELECT vendor_id FROM vendors WHERE slug = '{BASELINE}')) a
      WHERE length(name_key) > 5) b WHERE rn = 1""")
def q_lookup_terms(spark, sf):
    v = V(spark, sf)
    return L.lookup_terms(v["products"], v["vendors"], BASELINE, None).withColumn("unit_price", dbl("unit_price"))


@query("joi_lookup_sample", f"""
SELECT name_key, product_name, product_id, sku, brand, category, CAST(unit_price AS DOUBLE) AS unit_price, vendor_id
FROM (SELECT *, row_number() OVER (PARTITION BY name_key ORDER BY product_name, product_id) AS rn
      FROM (SELECT *, lower(regexp_replace(product_name, '^\\s+|\\s+$', '', 'g')) AS name_key FROM products
            WHERE vendor_id NOT IN (SELECT vendor_id FROM vendors WHERE slug = '{BASELINE}')) a
      WHERE length(name_key) > 5) b WHERE rn = 1 ORDER BY md5('42|' || name_key), name_key LIMIT 100""")
def q_lookup_sample(spark, sf):
    v = V(spark, sf)
    return L.lookup_terms(v["products"], v["vendors"], BASELINE, 100).withColumn("unit_price", dbl("unit_price"))


@query("joi_build_queries", """
SELECT product_id, product_name, brand,
  substr(regexp_replace(regexp_replace(CASE WHEN coalesce(brand, '') <> '' AND strpos(lower(q), lower(brand)) = 0
                                        THEN brand || ' ' || q ELSE q END, '\\s+', ' ', 'g'), '^\\s+|\\s+$', '', 'g'), 1, 120) AS search_query
FROM (SELECT product_id, product_name, brand,
        regexp_replace(regexp_replace(coalesce(product_name, ''), '^\\s+|\\s+$', '', 'g'), '(?i)^\\d+(\\.\\d+)?\\s*(oz|lb|lbs|gal|ct|pk|pc|count)\\s+', '') AS q
      FROM (SELECT product_id, CASE WHEN product_id % 2 = 0 THEN '12 oz ' || product_name ELSE product_name END AS product_name,
                   CASE WHEN product_id % 3 = 0 THEN split_part(product_name, ' ', 1) ELSE brand END AS brand FROM products) s) t""")
def q_build_queries(spark, sf):
    p = V(spark, sf)["products"]
    d = p.select("product_id",
                 F.when(F.col("product_id") % 2 == 0, F.concat(F.lit("12 oz "), F.col("product_name")))
                 .otherwise(F.col("product_name")).alias("product_name"),
                 F.when(F.col("product_id") % 3 == 0, F.split_part(F.col("product_name"), F.lit(" "), F.lit(1)))
                 .otherwise(F.col("brand")).alias("brand"))
    return L.build_queries(d)


@query("joi_attribute_match", f"""
WITH t AS (SELECT sku AS term_id, product_name AS tname, brand AS tbrand, category AS tcat FROM products
           WHERE vendor_id IN (SELECT vendor_id FROM vendors WHERE slug = '{VENDOR}')),
r AS (SELECT sku AS term_id, product_name AS title, CAST(unit_price AS DOUBLE) AS unit_price FROM products
      WHERE vendor_id IN (SELECT vendor_id FROM vendors WHERE slug = '{BASELINE}'))
SELECT r.term_id, r.title, r.unit_price, r.title AS product_name,
  CASE WHEN coalesce(tbrand, '') <> '' THEN tbrand
       WHEN len(string_split_regex(regexp_replace(coalesce(title, ''), '^\\s+|\\s+$', '', 'g'), '\\s+')) >= 2
            AND string_split_regex(regexp_replace(coalesce(title, ''), '^\\s+|\\s+$', '', 'g'), '\\s+')[1] <> ''
       THEN string_split_regex(regexp_replace(coalesce(title, ''), '^\\s+|\\s+$', '', 'g'), '\\s+')[1] ELSE '' END AS brand,
  coalesce(tcat, '') AS category, 'Amazon match for: ' || substr(coalesce(tname, ''), 1, 200) AS description
FROM r JOIN t USING (term_id)""")
def q_attribute_match(spark, sf):
    v = V(spark, sf)
    from pricelens.operators.filters import for_vendor
    terms = for_vendor(v["products"], v["vendors"], VENDOR).select(F.col("sku").alias("term_id"), "product_name",
                                                                    "brand", "category")
    res = for_vendor(v["products"], v["vendors"], BASELINE).select(
        F.col("sku").alias("term_id"), F.col("product_name").alias("title"), dbl("unit_price").alias("unit_price"))
    return L.attribute_match(res, terms)


@query("joi_choose_result", """
WITH r AS (SELECT CAST(vendor_id AS VARCHAR) || '-' || sku AS term_id, captured_at, CAST(unit_price AS DOUBLE) AS unit_price,
                  row_number() OVER (PARTITION BY vendor_id, sku ORDER BY captured_at, run_seq, run_line, case_price) AS rank
           FROM observations)
SELECT term_id, captured_at, unit_price, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY term_id ORDER BY NOT (rank <= 3 AND coalesce(unit_price <> 0, false)), rank) AS k
  FROM r) t WHERE k = 1""")
def q_choose_result(spark, sf):
    o = V(spark, sf)["observations"]
    w = Window.partitionBy("vendor_id", "sku").orderBy("captured_at", "run_seq", "run_line", "case_price")
    r = o.select(F.concat(F.col("vendor_id").cast("string"), F.lit("-"), F.col("sku")).alias("term_id"),
                 "captured_at", dbl("unit_price").alias("unit_price"), F.row_number().over(w).alias("rank"))
    return L.choose_result(r).select("term_id", "captured_at", "unit_price", F.col("rank").cast("bigint").alias("rank"))
