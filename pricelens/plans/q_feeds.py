"""Registered queries: feed files written from the tables to the shared folder, then read and mapped.

A feed's fields are SQL expressions over the item view.  Spark evaluates them to write the
files; the oracle states the mapped result over the same expressions, without files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.plans.fixtures import raw_table
from pricelens.plans.registry import V, query
from pricelens.session import shared_path
from pricelens.sinks import export as X
from pricelens.sources import feeds as SF
from pricelens.sources import pages as PG

AISLES, PAGE = 7, 50
BASE = "https://shop.example.com"

#: Fields of a marketplace product record.
RECORD = {
    "id": "item_id", "name": "product_name", "upc": "upc",
    "description_short": """CASE WHEN item_id % 10 = 0 THEN 'two' || chr(10) || 'lines' WHEN item_id % 10 = 1 THEN NULL
        ELSE 'a "short", ' || product_name END""",
    "brand_name": "brand", "case_per_pallet": "CAST(cases_per_pallet AS STRING)", "pack_size": "pack_size_raw",
    "slug": "'p-' || CAST(item_id AS STRING)",
    "min_pallet_quantity": "CASE item_id % 4 WHEN 0 THEN '1,200' WHEN 1 THEN '12' WHEN 2 THEN '2.9' END",
    "is_available": "CASE item_id % 3 WHEN 0 THEN true WHEN 1 THEN false END",
    "lead_time_days": "CAST(lead_time_days AS STRING) || '.0'", "for_mixed_pallet": "item_id % 5 = 0",
    "has_promo": "CASE WHEN item_id % 7 <> 0 THEN item_id % 2 = 0 END",
    "delivered_price": "CASE WHEN item_id % 6 = 0 THEN 'call' ELSE '1,' || lpad(CAST(item_id % 1000 AS STRING), 3, '0') || '.50' END",
    "delivered_case_price": "CAST(item_id % 90 AS STRING) || '.25'",
    "per_unit_delivered_price": "CASE WHEN item_id % 8 = 0 THEN '' ELSE CAST(item_id % 40 AS STRING) || '.75' END",
    "per_oz_delivered_price": "'0.' || lpad(CAST(item_id % 100 AS STRING), 2, '0')",
    "plp_image_url": "nullif(image_url, '')", "image_url": "CASE WHEN item_id % 2 = 0 THEN image_url END",
    "main_category": "'Food'", "sub_category": "coalesce(category, '') || ', other'",
}
AISLE = f"id % {AISLES}"
PAGE_NO = f"CAST(floor(floor(id / {AISLES}) / {PAGE}) AS INT) + 1"


def _select(fields: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {c}" for c, e in fields.items())


def _path(spark: SparkSession, name: str) -> str:
    return shared_path(spark, f"feed-{name}-{uuid.uuid4().hex}")


def _records(spark: SparkSession, sf: str) -> DataFrame:
    return V(spark, sf)["items"].selectExpr(*[f"{e} AS {c}" for c, e in RECORD.items()])


_FEED = f"feed AS (SELECT {_select(RECORD)} FROM items),\npaged AS (SELECT *, {AISLE} AS aisle, {PAGE_NO} AS page_no FROM feed)"


def product_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The records as API pages, one page a line, read back."""
    rec = _records(spark, sf)
    paged = rec.select(F.expr(AISLE).alias("aisle"), F.expr(PAGE_NO).alias("page_no"), F.struct(*rec.columns).alias("r"))
    pages = paged.groupBy("aisle", "page_no").agg(F.sort_array(F.collect_list("r")).alias("results"))  # PAGE records each
    totals = paged.groupBy("aisle").agg(F.count("*").cast("int").alias("count"), F.max("page_no").alias("last"))
    link = F.when(F.col("page_no") < F.col("last"), F.concat(F.lit("?page="), (F.col("page_no") + 1).cast("string")))
    path = _path(spark, "pages")
    pages.join(totals, "aisle").select("count", link.alias("next"), "results").write.json(path)
    return SF.read_product_pages(spark, path, multi_line=False)


@query("src_read_product_pages", f"""WITH {_FEED}
SELECT CAST(count(*) OVER (PARTITION BY aisle) AS INTEGER) AS declared_count,
       CASE WHEN page_no < max(page_no) OVER (PARTITION BY aisle) THEN '?page=' || CAST(page_no + 1 AS VARCHAR) END AS next_page,
       CAST(row_number() OVER (PARTITION BY aisle, page_no ORDER BY id) - 1 AS INTEGER) AS pos_in_page, {", ".join(RECORD)}
FROM paged""")
def q_read_product_pages(spark, sf):
    return product_pages(spark, sf).drop("source_file")


@query("src_audit_pages", f"""WITH {_FEED},
got AS (SELECT aisle, page_no, max(n) AS declared_count, count(*) AS rows
        FROM (SELECT *, count(*) OVER (PARTITION BY aisle) AS n FROM paged) t
        WHERE (aisle * 3 + page_no) % 4 <> 0 GROUP BY aisle, page_no),
g AS (SELECT aisle, max(declared_count) AS declared_count, sum(rows) AS rows_received FROM got GROUP BY aisle),
want AS (SELECT aisle, unnest(generate_series(1, CAST(ceil(declared_count / {PAGE}.0) AS BIGINT))) AS page_no FROM g),
miss AS (SELECT aisle, string_agg(CAST(page_no AS VARCHAR), ',' ORDER BY page_no) AS missing_pages
         FROM want ANTI JOIN got USING (aisle, page_no) GROUP BY aisle)
SELECT aisle, CAST(declared_count AS INTEGER) AS declared_count, CAST(rows_received AS BIGINT) AS rows_received,
       CAST(ceil(declared_count / {PAGE}.0) AS INTEGER) AS expected_pages, rows_received >= declared_count AS complete,
       coalesce(missing_pages, '') AS missing_pages
FROM g LEFT JOIN miss USING (aisle)""")
def q_audit_pages(spark, sf):
    got = product_pages(spark, sf).select(F.expr(AISLE).alias("aisle"), F.expr(PAGE_NO).alias("page_no"), "declared_count")
    got = got.groupBy("aisle", "page_no").agg(F.max("declared_count").alias("declared_count"), F.count("*").alias("rows"))
    audit = SF.audit_pages(got.where("(aisle * 3 + page_no) % 4 <> 0"), PAGE, "aisle")
    return audit.withColumn("missing_pages", F.array_join(F.col("missing_pages").cast("array<string>"), ","))


def _num(c: str) -> str:
    return f"TRY_CAST(replace(trim({c}), ',', '') AS DOUBLE)"


def _int(c: str) -> str:
    return f"CAST(trunc(TRY_CAST(trim({c}) AS DOUBLE)) AS INTEGER)"


_BRAND = "coalesce(trim(regexp_replace(brand_name, '-EP$', '')), '')"


@query("src_standardize_marketplace", f"""WITH {_FEED}
SELECT CAST(id AS VARCHAR) AS sku, coalesce(upc, '') AS upc, name AS product_name, {_BRAND} AS brand,
       coalesce(description_short, '') AS description, 'aisle ' || CAST(aisle AS VARCHAR) AS category, sub_category,
       {_num('per_unit_delivered_price')} AS unit_price, {_num('delivered_case_price')} AS case_price,
       {_num('per_oz_delivered_price')} AS price_per_oz, {_num('delivered_price')} AS bulk_price,
       coalesce(pack_size, '') AS pack_size_raw, {_int('case_per_pallet')} AS cases_per_pallet,
       {_int('min_pallet_quantity')} AS min_order_qty, {_int('lead_time_days')} AS lead_time_days,
       coalesce(is_available, true) AS in_stock, for_mixed_pallet AS mixed_pallet, coalesce(has_promo, false) AS has_promo,
       '{BASE}/product/' || slug AS product_url, coalesce(plp_image_url, '') AS image_url
FROM paged""")
def q_standardize_marketplace(spark, sf):
    aisle = F.concat(F.lit("aisle "), F.expr(AISLE).cast("string"))
    return SF.standardize_marketplace(product_pages(spark, sf), BASE, aisle)


def _yes(c: str) -> str:
    return f"CASE WHEN coalesce({c}, false) THEN 'Yes' ELSE 'No' END"


_LEGACY = f"""SELECT 'aisle ' || CAST(aisle AS VARCHAR) AS category, 'Food' AS food_type, {_BRAND} AS manufacturer, name AS product,
       coalesce(description_short, '') AS description, coalesce(upc, '') AS upc, delivered_price, delivered_case_price,
       per_unit_delivered_price AS price_per_unit, per_oz_delivered_price AS price_per_oz, coalesce(pack_size, '') AS pack_size_raw,
       case_per_pallet AS cases_per_pallet, coalesce(lead_time_days, '') AS lead_time_days,
       coalesce(min_pallet_quantity, '') AS min_pallet_qty, {_yes('for_mixed_pallet')} AS mixed_pallet,
       {_yes('is_available')} AS available, {_yes('has_promo')} AS has_promo, main_category, sub_category,
       CAST(id AS VARCHAR) AS product_id, '{BASE}/product/' || slug AS product_url
FROM paged"""


@query("src_standardize_legacy", f"WITH {_FEED}\n{_LEGACY}")
def q_standardize_legacy(spark, sf):
    aisle = F.concat(F.lit("aisle "), F.expr(AISLE).cast("string"))
    return SF.standardize_legacy(product_pages(spark, sf), BASE, aisle, F.lit("Food"))


_CSV_COLS = ", ".join(
    f"TRY_CAST(trim({c}) AS DOUBLE) AS {c}" if c in SF.LEGACY_NUMERIC
    else f"{c} = 'Yes' AS {c}" if c in SF.LEGACY_FLAGS
    else f"CAST({c} AS BIGINT) AS {c}" if c == "product_id"
    else f"nullif({c}, '') AS {c}" for c in SF.LEGACY_COLUMNS)


@query("src_read_catalog_csv", f"WITH {_FEED},\nlegacy AS ({_LEGACY})\nSELECT {_CSV_COLS} FROM legacy")
def q_read_catalog_csv(spark, sf):
    aisle = F.concat(F.lit("aisle "), F.expr(AISLE).cast("string"))
    path = _path(spark, "catalog")
    SF.standardize_legacy(_records(spark, sf), BASE, aisle, F.lit("Food")).write.option("escape", '"').csv(path, header=True)
    return SF.read_catalog_csv(spark, path)


# ── taxonomy ─────────────────────────────────────────────────────────────
_FOOD = "'ECONOMY', 'LARGE', 'MEDIUM'"
_CATEGORY_TREE = f"""SELECT DISTINCT 'shop_by_category' AS "group", CASE WHEN p_type IN ({_FOOD}) THEN 'Food' ELSE 'Non-Food' END AS parent,
       p_type AS child FROM part WHERE p_type <> 'SMALL'"""


def taxonomy(spark: SparkSession, sf: str) -> DataFrame:
    """Part types and nations as a two-level tree in one JSON file, read back.  The tree is as small as those two lists."""
    food = F.when(F.expr(f"p_type IN ({_FOOD})"), "Food").otherwise("Non-Food")
    kinds = raw_table(spark, sf, "part").where("p_type <> 'SMALL'").select(
        F.lit("shop_by_category").alias("group"), food.alias("name"), F.col("p_type").alias("child")).distinct()
    places = raw_table(spark, sf, "region").join(raw_table(spark, sf, "nation"), F.expr("r_regionkey = n_regionkey"), "left").select(
        F.lit("shop_by_region").alias("group"), F.col("r_name").alias("name"), F.when(F.col("r_name") != "ASIA", F.col("n_name")).alias("child"))
    parents = kinds.union(places).groupBy("group", "name").agg(F.array_sort(F.collect_list("child")).alias("child"))
    groups = parents.groupBy("group").agg(F.array_sort(F.collect_list(F.struct("name", "child"))).alias("parents"))
    tree = groups.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("group", "parents")))).alias("m"))
    path = _path(spark, "taxonomy")
    tree.select(F.to_json("m").alias("value")).coalesce(1).write.text(path)
    return SF.read_taxonomy(spark, path)


@query("src_read_taxonomy", f"""{_CATEGORY_TREE}
UNION ALL SELECT DISTINCT 'shop_by_region', r_name, CASE WHEN r_name <> 'ASIA' THEN n_name END
FROM region LEFT JOIN nation ON r_regionkey = n_regionkey""", views=[])
def q_read_taxonomy(spark, sf):
    return taxonomy(spark, sf)


@query("src_tag_food_type", f"""
SELECT item_id, category, CASE WHEN category IN ({_FOOD}) THEN 'Food' WHEN category <> 'SMALL' THEN 'Non-Food' ELSE 'Unknown' END AS food_type
FROM items""")
def q_tag_food_type(spark, sf):
    return SF.tag_food_type(V(spark, sf)["items"].select("item_id", "category"), taxonomy(spark, sf))


# ── storefront ───────────────────────────────────────────────────────────
STORE = {
    "id": "item_id", "title": "product_name", "handle": "'h-' || CAST(item_id AS STRING)", "vendor": "brand", "product_type": "category",
    "body_html": "CASE WHEN item_id % 6 <> 0 THEN '<p>' || product_name || ' <b>' || coalesce(category, '') || '</b></p>' END",
    "price": "CASE item_id % 9 WHEN 0 THEN '' WHEN 1 THEN 'ask' ELSE CAST(item_id % 50 AS STRING) || '.50' END",
    "sku": "CASE WHEN item_id % 2 = 0 THEN '' ELSE 'V' || CAST(item_id AS STRING) END",
    "available": "CASE item_id % 3 WHEN 0 THEN true WHEN 1 THEN false END", "src": "image_url",
    "has_variant": "item_id % 5 <> 0", "has_image": "item_id % 4 <> 0",
}


@query("src_standardize_storefront", f"""WITH store AS (SELECT {_select(STORE)} FROM items)
SELECT CASE WHEN has_variant AND sku <> '' THEN sku ELSE CAST(id AS VARCHAR) END AS sku, title AS product_name,
       coalesce(vendor, 'House') AS brand,
       substr(regexp_replace(regexp_replace(coalesce(body_html, ''), '<[^>]+>', ' ', 'g'), '^\\s+|\\s+$', '', 'g'), 1, 500) AS description,
       coalesce(product_type, '') AS category, CASE WHEN has_variant THEN TRY_CAST(price AS DOUBLE) END AS unit_price,
       'https://store.example.com/products/' || handle AS product_url, CASE WHEN has_image THEN src ELSE '' END AS image_url,
       NOT has_variant OR coalesce(available, true) AS in_stock
FROM store""")
def q_standardize_storefront(spark, sf):
    s = V(spark, sf)["items"].selectExpr(*[f"{e} AS {c}" for c, e in STORE.items()])
    variants = F.when(F.col("has_variant"), F.array(F.struct("price", "sku", "available"),
                                                    F.struct(F.lit("9.99").alias("price"), F.lit("other").alias("sku"), F.lit(True).alias("available"))))
    variants = F.coalesce(variants, F.array().cast("array<struct<price:string,sku:string,available:boolean>>"))
    images = F.when(F.col("has_image"), F.array(F.struct("src"))).otherwise(F.array().cast("array<struct<src:string>>"))
    product = F.struct("id", "title", "handle", "vendor", "product_type", "body_html", variants.alias("variants"), images.alias("images"))
    path = _path(spark, "store")
    s.groupBy(F.floor(F.col("id") / 100).alias("page")).agg(F.collect_list(product).alias("products")).select("products").write.json(path)
    return SF.standardize_storefront(SF.read_storefront(spark, path, multi_line=False), "House", "https://store.example.com/")


# ── pages made of items ──────────────────────────────────────────────────
#: Shop 0 has linked tiles, shop 1 tiles with an id or none, shop 2 no rule.
TILE = {
    "item_id": "item_id", "page": "CAST(floor(item_id / 20) AS BIGINT)", "shop": "CAST(floor(item_id / 20) AS BIGINT) % 3", "product_name": "product_name",
    "price_text": "'$1,' || lpad(CAST(item_id % 1000 AS STRING), 3, '0') || '.50/ea'",
}
_RULES = """SELECT * FROM VALUES
  ('shop-0.example.com', '(?s)<div class="tile"(.*?)</div>', '<h3>(.*?)</h3>', 'class="price">([^<]*)<', 'href="([^"]*)"', 'src="([^"]*)"',
   'https://shop-0.example.com', 'shop0', CAST(NULL AS STRING), 'Sold out'),
  ('shop-1.example.com', '(?s)<li(.*?)</li>', '<b>(.*?)</b>', '<i>(.*?)</i>', CAST(NULL AS STRING), CAST(NULL AS STRING),
   'https://shop-1.example.com', 'shop1', 'data-product-id="([^"]*)"', CAST(NULL AS STRING))
  AS t(site, tile, name, price, link, image, base_url, sku_prefix, attr, sold_out)"""
_TILE_HTML = """CASE shop WHEN 1 THEN '<li' || CASE WHEN item_id % 2 = 0 THEN ' data-product-id="D' || CAST(item_id AS STRING) || '"' ELSE '' END
         || '><b>' || product_name || '</b><i>' || CASE WHEN item_id % 3 = 0 THEN 'soon' ELSE price_text END || '</i></li>'
    ELSE '<div class="tile"><h3>' || product_name || ' current price $1.25</h3><span class="price">' || price_text || '</span><a href="/products/'
         || CAST(item_id AS STRING) || '-x?a=1&amp;b=2">more</a>' || CASE WHEN item_id % 4 = 0 THEN '' ELSE '<img src="/i/' || CAST(item_id AS STRING) || '.jpg">' END
         || CASE WHEN item_id % 6 = 0 THEN '<em>Sold out</em>' ELSE '' END || '</div>' END"""


@query("src_extract_tiles", f"""WITH t AS (SELECT {_select(TILE)} FROM items)
SELECT page AS page_id, 'https://shop-' || CAST(shop AS VARCHAR) || '.example.com/c/' || CAST(page AS VARCHAR) AS url,
       'shop-' || CAST(shop AS VARCHAR) || '.example.com' AS site,
       CAST(row_number() OVER (PARTITION BY page ORDER BY item_id) AS INTEGER) AS tile_pos, product_name,
       CASE WHEN shop = 0 OR item_id % 3 <> 0 THEN 1000.5 + item_id % 1000 END::DOUBLE AS unit_price,
       CASE shop WHEN 0 THEN 'https://shop-0.example.com/products/' || CAST(item_id AS VARCHAR) || '-x?a=1&b=2' ELSE '' END AS product_url,
       CASE WHEN shop = 0 AND item_id % 4 <> 0 THEN 'https://shop-0.example.com/i/' || CAST(item_id AS VARCHAR) || '.jpg' ELSE '' END AS image_url,
       CASE WHEN shop = 0 THEN CAST(item_id AS VARCHAR) || '-x' WHEN item_id % 2 = 0 THEN 'D' || CAST(item_id AS VARCHAR)
            ELSE 'shop1-' || substr(regexp_replace(lower(product_name), '[^a-z0-9]+', '-', 'g'), 1, 50) END AS sku,
       shop = 1 OR item_id % 6 <> 0 AS in_stock
FROM t WHERE shop < 2""")
def q_extract_tiles(spark, sf):
    t = V(spark, sf)["items"].selectExpr(*[f"{e} AS {c}" for c, e in TILE.items()]).withColumn("html", F.expr(_TILE_HTML))
    tiles = F.transform(F.array_sort(F.collect_list(F.struct("item_id", "html"))), lambda x: x["html"])  # 20 a page
    pages = t.groupBy("page", "shop").agg(F.array_join(tiles, "\n").alias("html"))
    url = F.concat(F.lit("https://shop-"), F.col("shop").cast("string"), F.lit(".example.com/c/"), F.col("page").cast("string"))
    return PG.extract_tiles(pages.select(F.col("page").alias("page_id"), url.alias("url"), "html"), spark.sql(_RULES))


_LD = """'<html><h1>' || product_name || '</h1><script type="application/ld+json">{"@type":"'
    || CASE WHEN item_id % 5 = 0 THEN 'Organization' ELSE 'Product' END || '","name":"' || product_name || ' pack","description":" About '
    || product_name || ' ","packSizes":' || CASE WHEN item_id % 2 = 0 THEN '["8 oz"]' ELSE '[["16 oz","32 oz"]]' END
    || ',"image":["https://i.example.com/' || CAST(item_id AS STRING) || '.jpg"]}</script>'
    || CASE WHEN item_id % 3 = 0 THEN '<iframe class="externalIframeNutrition" src="https://n.example.com/x?GTIN=000' || CAST(item_id AS STRING) || '"></iframe>' ELSE '' END
    || '</html>'"""


@query("src_extract_pages_jsonld", """
WITH t AS (SELECT *, item_id % 5 <> 0 AS ld, CASE WHEN item_id % 3 = 0 THEN CASE WHEN item_id = 0 THEN '0000' ELSE CAST(item_id AS VARCHAR) END END AS gtin FROM items)
SELECT item_id AS page_id, 'https://b.example.com/r/' || CAST(item_id AS VARCHAR) || '/' AS url, coalesce(gtin, 'b-' || CAST(item_id AS VARCHAR)) AS sku,
       gtin AS upc, 'House ' || product_name || CASE WHEN ld THEN ' pack' ELSE '' END AS product_name, 'House' AS brand,
       CASE WHEN ld THEN 'Pack size: ' || CASE WHEN item_id % 2 = 0 THEN '8 oz' ELSE '16 oz' END || ' | About ' || product_name END AS description,
       CASE WHEN NOT ld THEN '' WHEN item_id % 2 = 0 THEN '8 oz' ELSE '16 oz' END AS pack_size_raw,
       'https://b.example.com/r/' || CAST(item_id AS VARCHAR) || '/' AS product_url,
       CASE WHEN ld THEN 'https://i.example.com/' || CAST(item_id AS VARCHAR) || '.jpg' END AS image_url, true AS in_stock
FROM t""")
def q_extract_pages_jsonld(spark, sf):
    pages = V(spark, sf)["items"].select(F.col("item_id").alias("page_id"),
                                         F.concat(F.lit("https://b.example.com/r/"), F.col("item_id").cast("string"), F.lit("/")).alias("url"),
                                         F.expr(_LD).alias("html"))
    return PG.extract_product_pages(pages, brand="House", sku_prefix="b")


# ── checkpoint ───────────────────────────────────────────────────────────
@query("snk_checkpoint", """
SELECT item_id, product_name, brand, category, upc, pack_size_raw, cases_per_pallet, lead_time_days, image_url FROM items""")
def q_checkpoint(spark, sf):
    items = V(spark, sf)["items"].select("item_id", "product_name", "brand", "category", "upc", "pack_size_raw", "cases_per_pallet",
                                         "lead_time_days", "image_url")
    return spark.read.parquet(X.write_checkpoint(items, _path(spark, "progress")))
