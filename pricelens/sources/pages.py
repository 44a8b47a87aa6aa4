"""Saved web pages -> product rows; text cleaning shared by every collector.

SRC-09 extract_product_pages, SRC-10 extract_tiles / page_links, SRC-11
derive_sku, SRC-12 with_price, SRC-13 clean_names, SRC-14 clean_brand.

Pages are parsed with ``regexp_extract(_all)`` and ``get_json_object`` inside
the executors - one pass over the page table, no per-page Python.  The rule
table of ``extract_tiles`` is a small DataFrame (one row per configured site)
joined to the pages, so new sites are data, not code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.sources.feeds import clean_brand_col

# URL patterns that carry a product id, tried in order.
SKU_URL_PATTERNS = [r"/products?/([^/?#]+)", r"/(\d{4,})", r"id=(\d+)"]
PRICE_PATTERN = r"\$?([\d,]+\.?\d*)"
# Basic HTML entities decoded in page text, '&amp;' last.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def html_text(c: Column) -> Column:
    """Inner text of an HTML fragment: tags removed, basic entities decoded, trimmed."""
    t = F.regexp_replace(c, "<[^>]+>", "")
    for a, b in ENTITIES:
        t = F.replace(t, F.lit(a), F.lit(b))
    return _strip(t)


def slugify(c: Column, n: int | None = 50) -> Column:
    """Lower-case letters and digits joined by dashes, the first ``n`` characters (None: all)."""
    slug = F.regexp_replace(_strip(F.lower(c)), "[^a-z0-9]+", "-")
    return slug if n is None else F.substring(slug, 1, n)


# ── SRC-11 ───────────────────────────────────────────────────────────────
def sku_col(url: Column, patterns=SKU_URL_PATTERNS, attr: Column | None = None, name: Column | None = None,
            prefix: str | None = None, hash_fallback: bool = True) -> Column:
    """First URL pattern that matches, else an attribute id, else prefix + name slug
    (<= 50 chars), else a stable hash of the name (``pmod(xxhash64(name), 1e8)``)."""
    cands = [F.nullif(F.regexp_extract(F.coalesce(url, F.lit("")), p, 1), F.lit("")) for p in patterns]
    if attr is not None:
        cands.append(F.nullif(attr, F.lit("")))
    if name is not None:
        slug = slugify(name)
        has_name = F.length(_strip(F.coalesce(name, F.lit("")))) > 0
        cands.append(F.when(has_name, F.concat(F.lit(f"{prefix}-" if prefix else ""), slug)))
        if hash_fallback:
            cands.append(F.when(name.isNotNull(), F.concat(F.lit(f"{prefix}-" if prefix else ""),
                                                           F.pmod(F.xxhash64(name), F.lit(10 ** 8)).cast("string"))))
    return F.coalesce(*cands)


def derive_sku(df: DataFrame, url: str = "product_url", patterns=SKU_URL_PATTERNS, prefix: str | None = None,
               name: str | None = "product_name", attr: str | None = None, hash_fallback: bool = True,
               out: str = "sku") -> DataFrame:
    return df.withColumn(out, sku_col(F.col(url), patterns, F.col(attr) if attr else None,
                                      F.col(name) if name else None, prefix, hash_fallback))


# ── SRC-12 / SRC-13 / SRC-14 ────────────────────────────────────────────
def price_col(c) -> Column:
    """First dollar amount in a text ('$12.99', '12.99/ea', '$1,234.50'); else null."""
    col = F.col(c) if isinstance(c, str) else c
    t = F.regexp_replace(F.coalesce(col, F.lit("")), "[\n\u00a0]", " ")
    m = F.regexp_extract(t, PRICE_PATTERN, 1)
    return F.when(m != "", F.replace(m, F.lit(","), F.lit("")).try_cast("double"))


def with_price(df: DataFrame, col: str, out: str = "unit_price") -> DataFrame:
    return df.withColumn(out, price_col(col))


def clean_name_col(c, pack: Column | None = None) -> Column:
    """Strip leaked price text ("current price $X", "\\n$X...", trailing "$X"), trim,
    and append the pack text in parentheses when given."""
    col = F.col(c) if isinstance(c, str) else c
    # The patterns of leaked price text are fixed values.
    n = F.regexp_replace(col, r"current price \$[\d,.]+", "")
    n = F.regexp_replace(n, r"(?s)\n\s*\$.*$", "")
    n = _strip(F.regexp_replace(_strip(n), r"\s*\$[\d,.]+\s*$", ""))
    if pack is not None:
        n = F.when(F.length(_strip(F.coalesce(pack, F.lit("")))) > 0,
                   F.concat(n, F.lit(" ("), _strip(pack), F.lit(")"))).otherwise(n)
    return n


def absolute_url(c, base_url: str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col.isNull() | (col == ""), col).when(col.startswith("http"), col) \
        .otherwise(F.concat(F.lit(base_url.rstrip("/")), col))


def clean_names(df: DataFrame, name: str = "product_name", pack: str | None = None,
                url_cols=(), base_url: str = "") -> DataFrame:
    out = df.withColumn(name, clean_name_col(name, F.col(pack) if pack else None))
    for u in url_cols:
        out = out.withColumn(u, absolute_url(u, base_url))
    return out


def clean_brand(df: DataFrame, col: str = "brand") -> DataFrame:
    return df.withColumn(col, clean_brand_col(col))


# ── SRC-09 ───────────────────────────────────────────────────────────────
LD_JSON = r'(?is)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'


def extract_product_pages(pages: DataFrame, brand: str = "", sku_prefix: str = "page",
                          url: str = "url", html: str = "html", max_description: int | None = 450) -> DataFrame:
    """Product-detail pages -> product rows.

    Name, description, first pack size and first image come from the first JSON-LD
    block of ``@type`` Product; the name falls back to the page's <h1>.  A GTIN in a
    nutrition frame URL becomes the UPC and SKU (leading zeros stripped), else the
    SKU is ``prefix-<last URL segment>``.  Pages without a name of >= 2 chars drop.
    Of the description ``max_description`` characters are taken (None: all).
    """
    blocks = F.regexp_extract_all(F.col(html), F.lit(LD_JSON), 1)
    product_ld = F.get(F.filter(blocks, lambda b: F.get_json_object(b, "$.@type") == "Product"), 0)
    p = pages.withColumn("_ld", product_ld)
    ld = lambda path: F.get_json_object(F.col("_ld"), path)
    h1 = html_text(F.regexp_extract(F.col(html), r"(?is)<h1[^>]*>(.*?)</h1>", 1))
    name = F.coalesce(F.nullif(_strip(F.coalesce(ld("$.name"), F.lit(""))), F.lit("")), h1)
    first_pack = ld("$.packSizes[0]")
    pack = F.when(first_pack.startswith("["), ld("$.packSizes[0][0]")).otherwise(first_pack)
    gtin_src = F.regexp_extract(F.col(html), r"(?is)<iframe[^>]*externalIframeNutrition[^>]*>", 0)
    gtin_raw = F.regexp_extract(gtin_src, r"GTIN=(\d+)", 1)
    gtin = F.when(gtin_raw != "", F.coalesce(F.nullif(F.regexp_replace(gtin_raw, "^0+", ""), F.lit("")), gtin_raw))
    slug = F.substring_index(F.regexp_replace(F.col(url), "/+$", ""), "/", -1)
    desc = _strip(F.coalesce(ld("$.description"), F.lit("")))
    parts = F.concat_ws(" | ", F.when(F.coalesce(pack, F.lit("")) != "", F.concat(F.lit("Pack size: "), pack)),
                        F.when(desc != "", desc if max_description is None else F.substring(desc, 1, max_description)))
    p = p.select(
        "*", name.alias("_name"), gtin.alias("upc"),
        F.coalesce(gtin, F.concat(F.lit(f"{sku_prefix}-"), slug)).alias("sku"),
        F.when(parts != "", parts).alias("description"),
        F.nullif(F.coalesce(ld("$.image[0]"), F.lit("")), F.lit("")).alias("image_url"),
        F.coalesce(pack, F.lit("")).alias("pack_size_raw"))
    p = p.filter(F.length(F.coalesce("_name", F.lit(""))) >= 2)
    pname = F.concat(F.lit(f"{brand} "), F.col("_name")) if brand else F.col("_name")
    return p.select(*[c for c in pages.columns if c != html], "sku", "upc", pname.alias("product_name"),
                    F.lit(brand or None).cast("string").alias("brand"), "description", "pack_size_raw",
                    F.col(url).alias("product_url"), "image_url", F.lit(True).alias("in_stock"))


# ── SRC-10 ───────────────────────────────────────────────────────────────
LINK = r'(?is)<a[^>]*href="([^"]*)"[^>]*>(.*?)</a>'


def page_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """Every <a href> of every page with its text, in page order."""
    hrefs = F.regexp_extract_all(F.col(html), F.lit(LINK), 1)
    texts = F.regexp_extract_all(F.col(html), F.lit(LINK), 2)
    z = pages.select(*[c for c in pages.columns if c != html], F.posexplode(F.arrays_zip(hrefs.alias("h"),
                                                                                          texts.alias("t"))))
    return z.select(*[c for c in pages.columns if c != html], (F.col("pos") + 1).alias("pos"),
                    F.col("col.h").alias("href"), html_text(F.col("col.t")).alias("text"))


def extract_tiles(pages: DataFrame, rules: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Config-driven listing extraction.

    ``rules`` has one row per site: ``site`` (host), ``tile`` (regex whose group 1 is
    one product tile), and per-field regexes ``name``, ``price``, ``link``, ``image``
    (group 1 each; null = field absent), ``base_url`` and ``sku_prefix``.  Each page
    takes its site's rule (join on host), tiles are exploded in page order, fields
    extracted, SKU derived from the link (SRC-11) and names cleaned (SRC-13).

    Two more rule columns may be there: ``attr``, whose group 1 is the tile's product id and
    the SKU where the link has none, and ``sold_out``, which marks a tile without stock.
    Without that every tile counts as in stock.
    """
    host = F.regexp_extract(F.col(url), r"^[a-z]+://([^/:?#]+)", 1)
    j = pages.withColumn("site", host).join(rules, "site")
    tiles = j.select("*", F.posexplode(F.regexp_extract_all(F.col(html), F.col("tile"), F.lit(1)))
                     .alias("tile_pos", "_t"))
    # per-site patterns are data: regexp_extract with a pattern column
    fld = lambda r: F.when(F.col(r).isNotNull(), F.call_function("regexp_extract", F.col("_t"), F.col(r),
                                                                  F.lit(1)))
    t = tiles.select(*[c for c in pages.columns if c != html], "site", (F.col("tile_pos") + 1).alias("tile_pos"),
                     html_text(fld("name")).alias("_raw_name"), fld("price").alias("_price_text"),
                     fld("link").alias("_link"), fld("image").alias("_img"), "base_url", "sku_prefix",
                     (fld("attr") if "attr" in rules.columns else F.lit(None).cast("string")).alias("_attr"),
                     (~F.coalesce(F.regexp_like(F.col("_t"), F.col("sold_out")), F.lit(False))
                      if "sold_out" in rules.columns else F.lit(True)).alias("in_stock"))
    link = F.replace(F.col("_link"), F.lit("&amp;"), F.lit("&"))
    abs_link = F.when(F.coalesce(link, F.lit("")) == "", F.lit("")).when(link.startswith("http"), link) \
        .otherwise(F.concat(F.col("base_url"), link))
    img = F.when(F.coalesce("_img", F.lit("")) == "", F.lit("")).when(F.col("_img").startswith("http"), F.col("_img")) \
        .otherwise(F.concat(F.col("base_url"), F.col("_img")))
    name = clean_name_col(F.col("_raw_name"))
    slug_sku = F.when(F.length(name) > 0, F.concat(F.col("sku_prefix"), F.lit("-"), slugify(name)))
    url_sku = F.coalesce(*[F.nullif(F.regexp_extract(F.coalesce(link, F.lit("")), p, 1), F.lit(""))
                           for p in SKU_URL_PATTERNS])
    out = t.select(*[c for c in pages.columns if c != html], "site", "tile_pos", name.alias("product_name"),
                   price_col(F.col("_price_text")).alias("unit_price"), abs_link.alias("product_url"),
                   img.alias("image_url"), F.coalesce(url_sku, F.nullif("_attr", F.lit("")), slug_sku).alias("sku"), "in_stock")
    return out.filter(F.length(F.col("product_name")) > 0)
