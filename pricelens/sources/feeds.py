"""Feed readers and record standardisation (jobs over whole feeds).

SRC-01 read_catalog_csv, SRC-02 read_product_pages, SRC-03 audit_pages,
SRC-04 read_taxonomy, SRC-05 tag_food_type, SRC-06 standardize_marketplace,
SRC-07 standardize_legacy, SRC-08 standardize_storefront, SRC-19 primary_category.

Every reader takes an explicit schema (no inference pass over the data), and
every mapping is a single ``select`` so Catalyst prunes unused feed fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.functions.numeric import to_int, to_number

# Column names of the feeds and of the legacy catalog: fixed values, as the files have them.
LEGACY_NUMERIC = ["delivered_price", "delivered_case_price", "price_per_unit", "price_per_oz",
                  "cases_per_pallet", "lead_time_days", "min_pallet_qty"]
LEGACY_FLAGS = ["mixed_pallet", "available", "has_promo"]
LEGACY_COLUMNS = ["category", "food_type", "manufacturer", "product", "description", "upc",
                  "delivered_price", "delivered_case_price", "price_per_unit", "price_per_oz", "pack_size_raw",
                  "cases_per_pallet", "lead_time_days", "min_pallet_qty", "mixed_pallet", "available",
                  "has_promo", "main_category", "sub_category", "product_id", "product_url"]

# Field names of the feed's records: fixed values.
PRODUCT_RECORD = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("upc", T.StringType()), T.StructField("description_short", T.StringType()),
    T.StructField("brand_name", T.StringType()), T.StructField("case_per_pallet", T.StringType()),
    T.StructField("pack_size", T.StringType()), T.StructField("slug", T.StringType()),
    T.StructField("min_pallet_quantity", T.StringType()), T.StructField("is_available", T.BooleanType()),
    T.StructField("lead_time_days", T.StringType()), T.StructField("for_mixed_pallet", T.BooleanType()),
    T.StructField("has_promo", T.BooleanType()), T.StructField("delivered_price", T.StringType()),
    T.StructField("delivered_case_price", T.StringType()),
    T.StructField("per_unit_delivered_price", T.StringType()),
    T.StructField("per_oz_delivered_price", T.StringType()), T.StructField("plp_image_url", T.StringType()),
    T.StructField("image_url", T.StringType()), T.StructField("main_category", T.StringType()),
    T.StructField("sub_category", T.StringType()),
])
PRODUCT_PAGE = T.StructType([
    T.StructField("count", T.IntegerType()), T.StructField("next", T.StringType()),
    T.StructField("previous", T.StringType()), T.StructField("results", T.ArrayType(PRODUCT_RECORD)),
])
STOREFRONT = T.StructType([T.StructField("products", T.ArrayType(T.StructType([
    T.StructField("id", T.LongType()), T.StructField("title", T.StringType()),
    T.StructField("handle", T.StringType()), T.StructField("vendor", T.StringType()),
    T.StructField("product_type", T.StringType()), T.StructField("body_html", T.StringType()),
    T.StructField("variants", T.ArrayType(T.StructType([
        T.StructField("price", T.StringType()), T.StructField("sku", T.StringType()),
        T.StructField("available", T.BooleanType())]))),
    T.StructField("images", T.ArrayType(T.StructType([T.StructField("src", T.StringType())]))),
])))])
TAXONOMY = T.MapType(T.StringType(), T.ArrayType(T.StructType([
    T.StructField("name", T.StringType()), T.StructField("child", T.ArrayType(T.StringType()))])))


def _blank_null(c: Column) -> Column:
    return F.when(F.trim(c) == "", F.lit(None)).otherwise(c)


# ── SRC-01 ───────────────────────────────────────────────────────────────
def read_catalog_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Legacy catalog CSV: every column read as text, the 7 numeric columns coerced
    (unparsable -> null), Yes/No flags -> boolean, empty text -> null.

    Values may hold line breaks; a file is then one task.  Pass ``multi_line=False`` for
    large files without any, which are then split over tasks."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in LEGACY_COLUMNS])
    raw = spark.read.csv(path, header=True, schema=schema, multiLine=multi_line, escape='"')
    cols = []
    for c in LEGACY_COLUMNS:
        if c in LEGACY_NUMERIC:
            cols.append(F.trim(F.col(c)).try_cast("double").alias(c))
        elif c in LEGACY_FLAGS:
            cols.append(F.when(F.col(c) == "Yes", True).when(F.col(c) == "No", False).alias(c))
        elif c == "product_id":
            cols.append(F.trim(F.col(c)).try_cast("double").try_cast("bigint").alias(c))
        else:
            cols.append(_blank_null(F.col(c)).alias(c))
    return raw.select(*cols)


# ── SRC-02 / SRC-03 ──────────────────────────────────────────────────────
def read_product_pages(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Many saved API pages ({count, next, previous, results[]}) -> one row per product,
    with the page's declared count, next link and source file.

    One page a file, or with ``multi_line=False`` one page a line (files are then split)."""
    pages = spark.read.schema(PRODUCT_PAGE).json(path, multiLine=multi_line).select(
        "*", F.col("_metadata.file_path").alias("source_file"))
    return pages.select("source_file", F.col("count").alias("declared_count"), F.col("next").alias("next_page"),
                        F.posexplode("results").alias("pos_in_page", "r")).select(
        "source_file", "declared_count", "next_page", "pos_in_page", "r.*")


def audit_pages(received: DataFrame, page_size: int, key: str = "category") -> DataFrame:
    """Per feed key: declared count vs rows received, expected pages ceil(count/size),
    and one row per page that has to be requested again.

    ``received``: (key, page_no, declared_count, rows) - one row per fetched page.
    """
    g = received.groupBy(key).agg(F.max("declared_count").alias("declared_count"),
                                  F.sum("rows").cast("bigint").alias("rows_received"))
    g = g.withColumn("expected_pages", F.ceil(F.col("declared_count") / F.lit(page_size)).cast("int"))
    pages = g.select(key, F.explode(F.sequence(F.lit(1), F.greatest("expected_pages", F.lit(1))))
                     .alias("page_no"), "expected_pages")
    missing = pages.filter(F.col("expected_pages") > 0).join(
        received.select(key, "page_no"), [key, "page_no"], "left_anti")
    summary = g.withColumn("complete", F.col("rows_received") >= F.col("declared_count"))
    return summary.join(missing.groupBy(key).agg(F.array_sort(F.collect_list("page_no")).alias("missing_pages")),
                        key, "left").withColumn("missing_pages",
                                                F.coalesce("missing_pages", F.array().cast("array<int>")))


# ── SRC-04 / SRC-05 ──────────────────────────────────────────────────────
def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """{group: [{name, child[]}]} -> (group, parent, child) rows (child null for a leaf parent)."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", TAXONOMY).alias("m"))
    groups = raw.select(F.explode("m").alias("group", "parents"))
    parents = groups.select("group", F.explode("parents").alias("p"))
    return parents.select("group", F.col("p.name").alias("parent"), F.explode_outer("p.child").alias("child"))


def tag_food_type(df: DataFrame, taxonomy: DataFrame, col: str = "category", group: str = "shop_by_category",
                  food_parent: str = "Food", default: str = "Unknown") -> DataFrame:
    """Label each row's category Food / Non-Food from the taxonomy's category tree."""
    lookup = (taxonomy.filter(F.col("group") == group).filter(F.col("child").isNotNull())
              .select(F.col("child").alias("_cat"),
                      F.when(F.col("parent") == food_parent, F.lit("Food")).otherwise(F.lit("Non-Food"))
                      .alias("_ft")).dropDuplicates(["_cat"]))
    out = df.join(lookup, df[col] == lookup["_cat"], "left")
    return out.withColumn("food_type", F.coalesce("_ft", F.lit(default))).drop("_cat", "_ft")


# ── SRC-06 / SRC-07 ──────────────────────────────────────────────────────
def clean_brand_col(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.trim(F.regexp_replace(col, "-EP$", "")), F.lit(""))


def standardize_marketplace(df: DataFrame, base_url: str, category: Column | str = "category",
                            compat: bool = False) -> DataFrame:
    """Marketplace product record -> common product schema.

    Default mapping: unit_price <- per-unit delivered price, bulk_price <- pallet
    (delivered) price, image <- plp_image_url.  ``compat=True`` reproduces the
    original feed's mapping (pallet price as unit_price, unit price as bulk_price,
    image from ``image_url``).
    """
    cat = F.col(category) if isinstance(category, str) else category
    unit_src, bulk_src = ("delivered_price", "per_unit_delivered_price") if compat else \
        ("per_unit_delivered_price", "delivered_price")
    image = F.coalesce(F.col("image_url") if compat else F.col("plp_image_url"), F.lit(""))
    return df.select(
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("sku"),
        F.coalesce("upc", F.lit("")).alias("upc"), F.coalesce("name", F.lit("")).alias("product_name"),
        clean_brand_col("brand_name").alias("brand"),
        F.coalesce("description_short", F.lit("")).alias("description"), cat.alias("category"),
        F.coalesce("sub_category", F.lit("")).alias("sub_category"),
        to_number(unit_src).alias("unit_price"), to_number("delivered_case_price").alias("case_price"),
        to_number("per_oz_delivered_price").alias("price_per_oz"), to_number(bulk_src).alias("bulk_price"),
        F.coalesce("pack_size", F.lit("")).alias("pack_size_raw"),
        to_int("case_per_pallet").alias("cases_per_pallet"), to_int("min_pallet_quantity").alias("min_order_qty"),
        to_int("lead_time_days").alias("lead_time_days"),
        F.coalesce("is_available", F.lit(True)).alias("in_stock"),
        F.coalesce("for_mixed_pallet", F.lit(False)).alias("mixed_pallet"),
        F.coalesce("has_promo", F.lit(False)).alias("has_promo"),
        F.concat(F.lit(base_url.rstrip("/") + "/product/"), F.coalesce("slug", F.lit(""))).alias("product_url"),
        image.alias("image_url"))


def _yes_no(c: str) -> Column:
    return F.when(F.coalesce(F.col(c), F.lit(False)), F.lit("Yes")).otherwise(F.lit("No"))


def standardize_legacy(df: DataFrame, base_url: str, category: Column | str = "category",
                       food_type: Column | str = "food_type") -> DataFrame:
    """Marketplace product record -> the 21-column legacy catalog row (Yes/No flags)."""
    cat = F.col(category) if isinstance(category, str) else category
    ft = F.col(food_type) if isinstance(food_type, str) else food_type
    s = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return df.select(
        cat.alias("category"), ft.alias("food_type"), clean_brand_col("brand_name").alias("manufacturer"),
        s("name").alias("product"), s("description_short").alias("description"), s("upc").alias("upc"),
        s("delivered_price").alias("delivered_price"), s("delivered_case_price").alias("delivered_case_price"),
        s("per_unit_delivered_price").alias("price_per_unit"), s("per_oz_delivered_price").alias("price_per_oz"),
        s("pack_size").alias("pack_size_raw"), s("case_per_pallet").alias("cases_per_pallet"),
        s("lead_time_days").alias("lead_time_days"), s("min_pallet_quantity").alias("min_pallet_qty"),
        _yes_no("for_mixed_pallet").alias("mixed_pallet"), _yes_no("is_available").alias("available"),
        _yes_no("has_promo").alias("has_promo"), s("main_category").alias("main_category"),
        s("sub_category").alias("sub_category"), s("id").alias("product_id"),
        F.concat(F.lit(base_url.rstrip("/") + "/product/"), s("slug")).alias("product_url"))


def primary_category(df: DataFrame, col: str = "sub_category", out: str = "category") -> DataFrame:
    """SRC-19: first comma-separated sub-category, trimmed; empty -> 'Unknown'."""
    first = F.trim(F.substring_index(F.col(col), ",", 1))
    return df.withColumn(out, F.when(F.coalesce(F.col(col), F.lit("")) != "", first).otherwise(F.lit("Unknown")))


# ── SRC-08 ───────────────────────────────────────────────────────────────
def read_storefront(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Storefront pages ({products[]}) -> one row per product; ``multi_line=False``: one page a line."""
    return spark.read.schema(STOREFRONT).json(path, multiLine=multi_line).select(F.explode("products").alias("p")) \
        .select("p.*")


def standardize_storefront(df: DataFrame, vendor_brand: str, store_url: str,
                           max_description: int | None = 500) -> DataFrame:
    """Storefront product -> common schema: first variant's price / sku / stock, first
    image, description without tags (``max_description`` characters, None: all), URL from the handle."""
    v0 = F.get(F.col("variants"), 0)
    price_text = v0.getField("price")
    desc = F.regexp_replace(F.regexp_replace(F.coalesce("body_html", F.lit("")), "<[^>]+>", " "), r"^\s+|\s+$", "")
    desc = desc if max_description is None else F.substring(desc, 1, max_description)
    vsku = F.coalesce(v0.getField("sku"), F.lit(""))
    return df.select(
        F.when(vsku != "", vsku).otherwise(F.coalesce(F.col("id").cast("string"), F.lit(""))).alias("sku"),
        F.coalesce("title", F.lit("")).alias("product_name"),
        F.coalesce("vendor", F.lit(vendor_brand)).alias("brand"), desc.alias("description"),
        F.coalesce("product_type", F.lit("")).alias("category"),
        F.when(F.coalesce(price_text, F.lit("")) != "", F.trim(price_text).try_cast("double")).alias("unit_price"),
        F.concat(F.lit(store_url.rstrip("/") + "/products/"), F.coalesce("handle", F.lit(""))).alias("product_url"),
        F.coalesce(F.get(F.col("images"), 0).getField("src"), F.lit("")).alias("image_url"),
        F.when(v0.isNull(), F.lit(True)).otherwise(F.coalesce(v0.getField("available"), F.lit(True)))
        .alias("in_stock"))
