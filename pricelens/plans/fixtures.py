"""The catalog model on the driver's tables (test data, not engine code).

The driver's parquet tables are TPC-H-like.  These seven views turn them into
the vendor / product / price-history model the operators work on.  The same
SQL text runs in Spark and in DuckDB; for the DuckDB oracle the views are
inlined as CTEs (``oracle_with``), for Spark they are temp views over the
parquet scans, so Catalyst prunes and pushes filters through them.  The snapshot of
offers (``products``) has a Spark text of its own, ``SPARK_VIEWS``, with the same rows.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

RAW_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
              "events", "documents", "embeddings", "pages", "benchmark", "labels",
              "conversations"]

VIEWS: dict[str, str] = {}

VIEWS["vendors"] = """
SELECT s_suppkey AS vendor_id, s_name AS name, lower(replace(s_name, '#', '-')) AS slug,
       CASE s_suppkey % 3 WHEN 0 THEN 'playwright' WHEN 1 THEN 'api' ELSE 'manual' END AS scrape_method,
       s_suppkey % 5 <> 4 AS scrape_enabled, n_name AS nation, r_name AS region
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
"""

VIEWS["items"] = """
SELECT p_partkey AS item_id,
       p_name || ' ' || lower(p_type) || ' ' || CAST(p_size AS STRING) || ' oz' AS product_name,
       CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN p_brand || '-EP' ELSE p_brand END AS brand,
       CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_type END AS category,
       CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE lpad(CAST(p_partkey AS STRING), 12, '0') END AS upc,
       CASE p_partkey % 8
         WHEN 0 THEN NULL
         WHEN 1 THEN CAST(p_partkey % 24 + 1 AS STRING) || '/' || CAST(p_size AS STRING) || ' oz'
         WHEN 2 THEN CAST(p_partkey % 24 + 1 AS STRING) || '/' || CAST(p_size AS STRING) || ' lb'
         WHEN 3 THEN CAST(p_partkey % 24 + 1 AS STRING) || '/4/' || CAST(p_size AS STRING) || ' oz'
         WHEN 4 THEN CAST(p_size AS STRING) || ' oz'
         WHEN 5 THEN CAST(p_partkey % 24 + 1 AS STRING) || ' x ' || CAST(p_size AS STRING) || ' fl oz'
         WHEN 6 THEN 'each'
         ELSE CAST(p_partkey % 24 + 1 AS STRING) || '/' || CAST(p_size AS STRING) || '.5 oz' END AS pack_size_raw,
       CASE WHEN p_partkey % 3 = 0 THEN CAST(p_partkey % 24 + 1 AS DOUBLE) END AS pack_count,
       CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS DOUBLE) END AS unit_size,
       CASE WHEN p_partkey % 6 = 0 THEN 'oz' WHEN p_partkey % 6 = 3 THEN 'lb' END AS unit_measure,
       CASE WHEN p_partkey % 9 = 0 THEN CAST(p_retailprice / 1000 AS DECIMAL(12,4)) END AS price_per_oz,
       CAST(40 + p_partkey % 100 AS INT) AS cases_per_pallet,
       CASE WHEN p_partkey % 10 = 9 THEN NULL ELSE CAST(p_partkey % 28 + 1 AS INT) END AS lead_time_days,
       CASE WHEN p_partkey % 6 = 5 THEN '' ELSE 'https://img.example.com/' || CAST(p_partkey AS STRING) || '.jpg' END AS image_url,
       p_retailprice
FROM part
"""

VIEWS["observations"] = """
SELECT l_suppkey AS vendor_id, CAST(l_partkey AS STRING) AS sku, l_shipdate AS captured_at,
       l_orderkey AS run_seq, l_linenumber AS run_line,
       CASE WHEN l_orderkey % 37 = 0 THEN NULL
            WHEN l_orderkey % 41 = 0 THEN CAST(0 AS DECIMAL(12,4))
            WHEN l_partkey % 4 = 0 THEN CAST(p_retailprice AS DECIMAL(12,4))
            ELSE CAST(l_extendedprice AS DECIMAL(12,4)) END AS unit_price,
       CAST(p_retailprice * 10 AS DECIMAL(12,4)) AS case_price,
       l_linestatus = 'O' AS in_stock, l_discount >= 0.05 AS has_promo, l_returnflag = 'R' AS mixed_pallet,
       l_suppkey * 1000000 + year(l_shipdate) * 100 + month(l_shipdate) AS run_id
FROM lineitem JOIN part ON l_partkey = p_partkey
"""

VIEWS["products"] = """
WITH o AS (
  SELECT *, lag(unit_price) OVER w AS prev_price,
         min(captured_at) OVER (PARTITION BY vendor_id, sku) AS first_seen_at,
         row_number() OVER (PARTITION BY vendor_id, sku ORDER BY captured_at DESC, run_seq DESC, run_line DESC, case_price DESC) AS rn
  FROM observations
  WINDOW w AS (PARTITION BY vendor_id, sku ORDER BY captured_at, run_seq, run_line, case_price)),
c AS (SELECT *, unit_price IS NOT NULL AND prev_price IS NOT NULL AND unit_price <> prev_price AS changed FROM o),
h AS (SELECT *, row_number() OVER (PARTITION BY vendor_id, sku ORDER BY captured_at DESC, run_seq DESC, run_line DESC, case_price DESC) AS crn
      FROM c WHERE changed),
p AS (SELECT vendor_id, sku, prev_price AS last_price FROM h WHERE crn = 1)
SELECT c.vendor_id * 1000000 + item_id AS product_id, c.vendor_id, c.sku, upc, product_name, brand, category,
       c.unit_price, c.case_price, price_per_oz, pack_size_raw, pack_count, unit_size, unit_measure,
       cases_per_pallet, lead_time_days, c.in_stock, c.mixed_pallet, c.has_promo, image_url,
       CASE WHEN item_id % 12 <> 11 THEN 'https://shop.example.com/products/' || c.sku END AS product_url,
       CASE WHEN c.vendor_id = 0 AND item_id % 2 = 0 THEN 'Amazon match for: ' || product_name WHEN item_id % 4 = 1 THEN 'item ' || c.sku END AS description,
       first_seen_at, c.captured_at AS last_seen_at, p.last_price, c.changed AS price_changed
FROM c JOIN items ON c.sku = CAST(item_id AS STRING) LEFT JOIN p ON c.vendor_id = p.vendor_id AND c.sku = p.sku
WHERE c.rn = 1
"""

VIEWS["product_history"] = """
SELECT vendor_id * 1000000 + CAST(sku AS BIGINT) AS product_id, run_id, unit_price, case_price, in_stock, captured_at, run_seq, run_line
FROM observations
"""

VIEWS["catalog"] = """
SELECT item_id AS product_id, coalesce(category, '') AS category, coalesce(brand, '') AS manufacturer, product_name AS product,
       'desc ' || product_name AS description, coalesce(upc, '') AS upc,
       CASE WHEN item_id % 17 = 0 THEN NULL ELSE p_retailprice * cases_per_pallet END AS delivered_price,
       CASE WHEN item_id % 19 = 0 THEN NULL ELSE p_retailprice / 100 END AS price_per_unit,
       CASE WHEN item_id % 9 = 0 THEN NULL ELSE p_retailprice / 1000 + (item_id % 50) END AS price_per_oz,
       pack_size_raw, cases_per_pallet, lead_time_days,
       item_id % 3 = 0 AS mixed_pallet, item_id % 4 <> 0 AS available, item_id % 6 = 0 AS has_promo
FROM items
"""

VIEWS["scrape_runs"] = """
WITH o AS (
  SELECT *, lag(unit_price) OVER w AS prev_price, row_number() OVER w AS seq
  FROM observations
  WINDOW w AS (PARTITION BY vendor_id, sku ORDER BY captured_at, run_seq, run_line, case_price))
SELECT run_id, vendor_id,
       CASE WHEN run_id % 29 = 0 THEN 'failed' WHEN run_id % 31 = 0 THEN 'running'
            WHEN sum(CASE WHEN unit_price IS NULL THEN 1 ELSE 0 END) = 0 THEN 'completed' ELSE 'partial' END AS status,
       CAST(count(*) AS BIGINT) AS products_found,
       CAST(sum(CASE WHEN seq = 1 THEN 1 ELSE 0 END) AS BIGINT) AS products_new,
       CAST(sum(CASE WHEN unit_price <> prev_price THEN 1 ELSE 0 END) AS BIGINT) AS products_updated,
       CAST(sum(CASE WHEN unit_price <> prev_price THEN 1 ELSE 0 END) AS BIGINT) AS price_changes,
       CAST(sum(CASE WHEN unit_price IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS errors,
       min(captured_at) AS started_at, max(captured_at) AS completed_at
FROM o GROUP BY run_id, vendor_id
"""

# The same rows as VIEWS["products"] with one shuffle and one sort of the line items: dealt by part, they meet the part's
# price, their window by (vendor, part), its aggregate and the part's texts in one stage.  No part table is broadcast.  ``at`` grows with
# the window's order; of rows equal in it the first is the largest, as the row_number of the reverse order has it. It is a struct, which no
# hash map of an aggregate can hold: the aggregate goes through the rows as the window has sorted them and keeps one offer at a time.
SPARK_VIEWS: dict[str, str] = {"products": """
WITH prices AS (SELECT p_partkey, p_retailprice FROM part),
l AS (
  SELECT /*+ SHUFFLE_HASH(prices) */ l_suppkey AS vendor_id, p_partkey AS part_id, l_shipdate AS captured_at,
         l_orderkey AS run_seq, l_linenumber AS run_line,
         CASE WHEN l_orderkey % 37 = 0 THEN NULL
              WHEN l_orderkey % 41 = 0 THEN CAST(0 AS DECIMAL(12,4))
              WHEN l_partkey % 4 = 0 THEN CAST(p_retailprice AS DECIMAL(12,4))
              ELSE CAST(l_extendedprice AS DECIMAL(12,4)) END AS unit_price,
         CAST(p_retailprice * 10 AS DECIMAL(12,4)) AS case_price,
         l_linestatus = 'O' AS in_stock, l_discount >= 0.05 AS has_promo, l_returnflag = 'R' AS mixed_pallet
  FROM lineitem JOIN prices ON l_partkey = p_partkey),
o AS (
  SELECT *, lag(unit_price) OVER w AS prev_price,
         struct(rank() OVER w AS place, -row_number() OVER w AS back) AS at
  FROM l
  WINDOW w AS (PARTITION BY vendor_id, part_id ORDER BY captured_at, run_seq, run_line, case_price)),
c AS (SELECT *, unit_price IS NOT NULL AND prev_price IS NOT NULL AND unit_price <> prev_price AS changed FROM o),
p AS (
  SELECT vendor_id, part_id, min(captured_at) AS first_seen_at, max_by(captured_at, at) AS last_seen_at,
         max_by(unit_price, at) AS unit_price, max_by(case_price, at) AS case_price, max_by(in_stock, at) AS in_stock,
         max_by(mixed_pallet, at) AS mixed_pallet, max_by(has_promo, at) AS has_promo, max_by(changed, at) AS price_changed,
         CASE WHEN vendor_id IS NOT NULL THEN max_by(prev_price, at) FILTER (WHERE changed) END AS last_price
  FROM c GROUP BY vendor_id, part_id)
SELECT /*+ SHUFFLE_HASH(items) */ p.vendor_id * 1000000 + item_id AS product_id, p.vendor_id, CAST(part_id AS STRING) AS sku, upc, product_name, brand, category,
       p.unit_price, p.case_price, price_per_oz, pack_size_raw, pack_count, unit_size, unit_measure,
       cases_per_pallet, lead_time_days, p.in_stock, p.mixed_pallet, p.has_promo, image_url,
       CASE WHEN item_id % 12 <> 11 THEN 'https://shop.example.com/products/' || CAST(part_id AS STRING) END AS product_url,
       CASE WHEN p.vendor_id = 0 AND item_id % 2 = 0 THEN 'Amazon match for: ' || product_name WHEN item_id % 4 = 1 THEN 'item ' || CAST(part_id AS STRING) END AS description,
       first_seen_at, last_seen_at, p.last_price, p.price_changed
FROM p JOIN items ON part_id = item_id
"""}

VIEW_ORDER = ["vendors", "items", "observations", "products", "product_history", "catalog",
              "scrape_runs"]
VIEW_DEPS = {
    "vendors": [], "items": [], "observations": [],
    "products": ["observations", "items"], "product_history": ["observations"],
    "catalog": ["items"], "scrape_runs": ["observations"],
}


_RAW: dict = {}
_VIEWS: dict = {}


def _key(spark: SparkSession, sf_dir: str):
    return (id(spark), os.path.abspath(sf_dir) if "://" not in sf_dir else sf_dir)


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table as a DataFrame (footer read once per session and folder)."""
    k = _key(spark, sf_dir) + (name,)
    if k not in _RAW:
        _RAW[k] = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return _RAW[k]


def register_tables(spark: SparkSession, sf_dir: str, names=None) -> None:
    for t in names or RAW_TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p) or "://" in sf_dir:
            raw_table(spark, sf_dir, t).createOrReplaceTempView(t)


class FixtureViews:
    """Lazily built fixture views of one data folder (a view is analysed once and
    reused; every execution still scans the parquet files in full)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getitem__(self, name: str) -> DataFrame:
        k = _key(self.spark, self.sf_dir) + (name,)
        if k not in _VIEWS:
            for dep in VIEW_DEPS[name]:
                self[dep].createOrReplaceTempView(dep)
            sql = SPARK_VIEWS.get(name, VIEWS[name])
            register_tables(self.spark, self.sf_dir, [t for t in RAW_TABLES if t in sql])
            _VIEWS[k] = self.spark.sql(sql)
        return _VIEWS[k]


def register_views(spark: SparkSession, sf_dir: str) -> FixtureViews:
    """The fixture views of ``sf_dir`` (a mapping name -> DataFrame, built on demand)."""
    return FixtureViews(spark, sf_dir)


def _closure(names) -> list[str]:
    need: set[str] = set()
    stack = list(names)
    while stack:
        n = stack.pop()
        if n not in need:
            need.add(n)
            stack.extend(VIEW_DEPS[n])
    return [v for v in VIEW_ORDER if v in need]


def oracle_with(sql: str, views=None) -> str:
    """Prefix a query with the fixture views it needs, as CTEs (DuckDB text)."""
    if views is None:
        views = [v for v in VIEW_ORDER if v in sql]
    ctes = ",\n".join(f"{v} AS ({VIEWS[v].strip()})" for v in _closure(views))
    body = sql.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def materialize_views(spark: SparkSession, sf_dir: str, out_dir: str, names=None) -> None:
    """Write the fixture views of ``sf_dir`` as parquet tables under ``out_dir`` (a shared
    folder on a cluster) and serve later lookups from them - the way the snapshot is a
    maintained table that dashboards read, instead of a view re-derived per query."""
    fv = FixtureViews(spark, sf_dir)
    for n in names or VIEW_ORDER:
        path = os.path.join(out_dir, n)
        fv[n].write.mode("overwrite").parquet(path)
        _VIEWS[_key(spark, sf_dir) + (n,)] = spark.read.parquet(path)
