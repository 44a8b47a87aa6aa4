"""Registered queries: snapshot fold, upsert, history, change detection, merges,
run statistics, market pulse, quota."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pricelens.functions.numeric import dbl
from pricelens.operators import state as S
from pricelens.plans.registry import R, V, query
from pricelens.session import shared_path
from pricelens.sinks.append import append_by_date, read_by_date
from pricelens.streaming.jobs import current_snapshot, upsert_batch

CUTOFF = "1997-01-01"  # upsert split point: current = loads before, batch = loads after
SNAP_COLS_SQL = ("vendor_id, sku, CAST(unit_price AS DOUBLE) AS unit_price, CAST(last_price AS DOUBLE) AS last_price, "
                 "price_changed, first_seen_at, last_seen_at")


def _snap_cols(df):
    return df.select("vendor_id", "sku", dbl("unit_price").alias("unit_price"), dbl("last_price").alias("last_price"),
                     "price_changed", "first_seen_at", "last_seen_at")


@query("ups_snapshot", f"""
SELECT {SNAP_COLS_SQL}, CAST(case_price AS DOUBLE) AS case_price, in_stock, has_promo, mixed_pallet FROM products""")
def q_snapshot(spark, sf):
    obs = V(spark, sf)["observations"].drop("run_id")
    s = S.snapshot(obs)
    return s.select("vendor_id", "sku", dbl("unit_price").alias("unit_price"), dbl("last_price").alias("last_price"),
                    "price_changed", "first_seen_at", "last_seen_at", dbl("case_price").alias("case_price"), "in_stock",
                    "has_promo", "mixed_pallet")


def _split(spark, sf):
    obs = V(spark, sf)["observations"].drop("run_id")
    before = obs.filter(F.col("captured_at") < F.lit(CUTOFF).cast("timestamp_ntz"))
    after = obs.filter(F.col("captured_at") >= F.lit(CUTOFF).cast("timestamp_ntz"))
    return S.snapshot(before), after


@query("ups_upsert", f"SELECT {SNAP_COLS_SQL} FROM products")
def q_upsert(spark, sf):
    current, batch = _split(spark, sf)
    new, _ = S.upsert(current, batch)
    return _snap_cols(new)


@query("ups_upsert_buckets", f"SELECT {SNAP_COLS_SQL} FROM products")
def q_upsert_buckets(spark, sf):
    """The snapshot kept in hash buckets: the loads before the cutoff, the batch after it, and the batch once more."""
    obs = V(spark, sf)["observations"].drop("run_id")
    after = F.col("captured_at") >= F.lit(CUTOFF).cast("timestamp_ntz")
    root = shared_path(spark, f"snapshot-{uuid.uuid4().hex}")
    for batch_id, batch in enumerate((obs.filter(~after), obs.filter(after))):
        upsert_batch(spark, batch, batch_id, root)
    upsert_batch(spark, obs.filter(after), 1, root)
    return _snap_cols(current_snapshot(spark, root))


@query("ups_upsert_outcomes", f"""
WITH o AS (SELECT *, row_number() OVER w AS seq, lag(unit_price) OVER w AS prev FROM observations
           WINDOW w AS (PARTITION BY vendor_id, sku ORDER BY captured_at, run_seq, run_line, case_price))
SELECT action, count(*) AS n FROM (
  SELECT CASE WHEN seq = 1 THEN 'new' WHEN unit_price IS NOT NULL AND prev IS NOT NULL AND unit_price <> prev
              THEN 'updated' ELSE 'unchanged' END AS action
  FROM o WHERE captured_at >= TIMESTAMP '{CUTOFF}') t GROUP BY action""")
def q_upsert_outcomes(spark, sf):
    current, batch = _split(spark, sf)
    _, outcomes = S.upsert(current, batch)
    return outcomes.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query("ups_history_rows", """
SELECT product_id, run_id, CAST(unit_price AS DOUBLE) AS unit_price, CAST(case_price AS DOUBLE) AS case_price,
       CASE WHEN run_line = 1 THEN CAST(case_price AS DOUBLE) * 40 END AS bulk_price, in_stock, captured_at
FROM product_history WHERE product_id % 5 <> 0""")
def q_history_rows(spark, sf):
    obs = V(spark, sf)["observations"]
    b = obs.withColumn("product_id", F.col("vendor_id") * 1000000 + F.col("sku").cast("bigint"))
    b = b.withColumn("bulk_price", F.when(F.col("run_line") == 1, dbl("case_price") * 40))
    # rows of every fifth product lose their sku and must be left out
    b = b.withColumn("sku", F.when(F.col("product_id") % 5 != 0, F.col("sku")).otherwise(F.lit("")))
    h = S.history_rows(b, "run_id")
    return h.withColumn("unit_price", dbl("unit_price")).withColumn("case_price", dbl("case_price"))


@query("ups_history_append", """
SELECT product_id, run_id, CAST(unit_price AS DOUBLE) AS unit_price, CAST(case_price AS DOUBLE) AS case_price, in_stock, captured_at,
       CAST(date_trunc('month', captured_at) AS DATE) AS day, CASE WHEN captured_at < TIMESTAMP '1997-01-01' THEN 'first' ELSE 'second' END AS load
FROM product_history""")
def q_history_append(spark, sf):
    """The history as a table by month: two loads appended, the second one twice."""
    obs = V(spark, sf)["observations"].withColumn("product_id", F.col("vendor_id") * 1000000 + F.col("sku").cast("bigint"))
    after = F.col("captured_at") >= F.lit(CUTOFF).cast("timestamp_ntz")
    root = shared_path(spark, f"history-{uuid.uuid4().hex}")
    for load, batch in (("first", obs.filter(~after)), ("second", obs.filter(after)), ("second", obs.filter(after))):
        h = S.history_rows(batch, "run_id").drop("bulk_price")
        append_by_date(h.withColumn("unit_price", dbl("unit_price")).withColumn("case_price", dbl("case_price")), root, "captured_at", load, unit="month")
    return read_by_date(spark, root)


@query("ups_detect_changes", """
SELECT o.vendor_id, o.sku, o.run_seq, o.run_line, CAST(o.unit_price AS DOUBLE) AS unit_price,
       CAST(p.unit_price AS DOUBLE) AS old_price,
       coalesce(o.unit_price IS NOT NULL AND p.unit_price IS NOT NULL AND CAST(o.unit_price AS DOUBLE) <> CAST(p.unit_price AS DOUBLE), false) AS price_changed
FROM observations o LEFT JOIN products p ON o.vendor_id = p.vendor_id AND o.sku = p.sku""")
def q_detect_changes(spark, sf):
    v = V(spark, sf)
    b = v["observations"].select("vendor_id", "sku", "run_seq", "run_line", "unit_price")
    d = S.detect_changes(v["products"], b)
    return d.select("vendor_id", "sku", "run_seq", "run_line", dbl("unit_price").alias("unit_price"),
                    dbl("old_price").alias("old_price"), "price_changed")


@query("set_merge_keep_last", f"""
SELECT product_id, product, category,
       CASE WHEN product_id % 3 = 0 THEN {R('price_per_unit * 1.1', 2)} ELSE price_per_unit END AS price_per_unit
FROM catalog""")
def q_merge_keep_last(spark, sf):
    c = V(spark, sf)["catalog"].select("product_id", "product", "category", "price_per_unit")
    from pricelens.functions.numeric import pround
    new = c.filter(F.col("product_id") % 3 == 0).withColumn("price_per_unit", pround(F.col("price_per_unit") * 1.1, 2))
    return S.merge_keep_last(c, new, "product_id")


@query("set_merge_upload", """
WITH c AS (SELECT product_id, product, manufacturer, category, price_per_unit FROM catalog),
u AS (SELECT product, manufacturer, category, price_per_unit, product_id AS upload_row FROM catalog WHERE category = 'SMALL')
SELECT product_id, product, manufacturer, category, price_per_unit, 'catalog' AS data_source, '2026-03-05' AS upload_date FROM c
UNION ALL
SELECT (SELECT max(product_id) FROM c) + row_number() OVER (ORDER BY upload_row), product, manufacturer, category, price_per_unit,
       'upload:small.csv', '2026-12-01' FROM u""")
def q_merge_upload(spark, sf):
    c = V(spark, sf)["catalog"].select("product_id", "product", "manufacturer", "category", "price_per_unit")
    up = c.filter(F.col("category") == "SMALL").select("product", "manufacturer", "category", "price_per_unit",
                                                        F.col("product_id").alias("upload_row"))
    m = S.merge_upload(c, up, "small.csv", "2026-12-01", order=[F.col("upload_row")])
    return m.drop("upload_row")


@query("set_market_pulse", f"""
WITH v AS (SELECT vendor_id, name AS vendor FROM vendors),
ch AS (SELECT p.*, v.vendor FROM (SELECT * FROM products WHERE price_changed AND CAST(last_price AS DOUBLE) > 0 AND CAST(unit_price AS DOUBLE) > 0 ORDER BY last_seen_at DESC NULLS FIRST, product_id DESC LIMIT 20) p
       LEFT JOIN v USING (vendor_id)),
c2 AS (SELECT *, coalesce(CAST(last_price AS DOUBLE), 0.0) AS old, coalesce(CAST(unit_price AS DOUBLE), 0.0) AS new FROM ch),
e1 AS (SELECT 'price_change' AS type,
              CASE WHEN new - old < 0 THEN 'Price drop: ' ELSE 'Price increase: ' END || substr(coalesce(product_name, ''), 1, 50) AS title,
              coalesce(vendor, '') AS vendor, last_seen_at AS timestamp,
              CASE WHEN new - old < 0 THEN 'positive' ELSE 'negative' END AS severity,
              {R('abs(new - old)', 2)} AS amount, {R('abs(' + R('(new - old) / old * 100', 1) + ')', 1)} AS pct,
              CAST(NULL AS BIGINT) AS products_found, CAST(NULL AS BIGINT) AS products_new, CAST(NULL AS BIGINT) AS price_changes,
              0 AS t, product_id AS id
       FROM c2),
r AS (SELECT s.*, v.vendor FROM (SELECT * FROM scrape_runs ORDER BY started_at DESC NULLS FIRST, run_id DESC LIMIT 10) s LEFT JOIN v USING (vendor_id)),
e2 AS (SELECT 'scrape_complete', 'Scrape completed: ' || coalesce(vendor, 'Unknown'), coalesce(vendor, 'Unknown'), started_at, 'info',
              CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(products_found AS BIGINT), CAST(products_new AS BIGINT), CAST(price_changes AS BIGINT), 1, run_id FROM r)
SELECT type, title, vendor, timestamp, severity, amount, pct, products_found, products_new, price_changes FROM (SELECT * FROM e1 UNION ALL SELECT * FROM e2) u
ORDER BY timestamp DESC NULLS LAST, t, id DESC LIMIT 20""")
def q_market_pulse(spark, sf):
    v = V(spark, sf)
    return S.market_pulse(v["products"], v["scrape_runs"], v["vendors"], 20, 10)


@query("agg_run_stats", """
SELECT run_id, vendor_id, status, products_found, products_new, products_updated, price_changes, errors, started_at,
       completed_at, date_diff('second', started_at, completed_at) AS duration_secs FROM scrape_runs""")
def q_run_stats(spark, sf):
    obs = V(spark, sf)["observations"]
    # fixture rule for runs that failed or are still running (see the scrape_runs view)
    override = (F.when(F.col("run_id") % 29 == 0, F.lit("failed"))
                .when(F.col("run_id") % 31 == 0, F.lit("running")))
    return S.run_stats(obs, status_override=override)


@query("agg_run_errors", """
SELECT run_id, vendor_id, sku, 'missing price' AS error, captured_at AS at FROM observations WHERE unit_price IS NULL""")
def q_run_errors(spark, sf):
    return S.run_errors(V(spark, sf)["observations"])


UPLOAD_COLS = ["product_id", "product", "manufacturer", "category", "price_per_unit", "lead_time_days", "upc"]


def _upload(spark, sf):
    """The SMALL part of the catalog as an upload would bring it: other headers, all text, some numbers bad."""
    c = V(spark, sf)["catalog"].filter(F.col("category") == "SMALL")
    bad = F.when(F.col("product_id") % 3 == 0, F.lit("N/A"))
    return c.select(F.col("product").alias("Item Name"), F.col("manufacturer").alias(" Brand"),
                    F.coalesce(bad, F.col("price_per_unit").cast("decimal(18,4)").cast("string")).alias("Unit Price"),
                    F.col("lead_time_days").cast("string").alias("Lead Time"), F.col("category").alias("Cat"),
                    F.col("product_id").cast("string").alias("upload_row"))


@query("src_align_upload", """
SELECT product, manufacturer, category, CASE WHEN product_id % 3 <> 0 THEN CAST(CAST(price_per_unit AS DECIMAL(18,4)) AS DOUBLE) END AS price_per_unit,
       lead_time_days, CAST(NULL AS VARCHAR) AS upc, CAST(NULL AS BIGINT) AS product_id FROM catalog WHERE category = 'SMALL'""")
def q_align_upload(spark, sf):
    from pricelens.sources.records import align_upload
    return align_upload(_upload(spark, sf), V(spark, sf)["catalog"].select(*UPLOAD_COLS).schema)


@query("set_upload_audit", """
SELECT 'small.csv' AS filename, '2026-12-01' AS timestamp, count(*) FILTER (category = 'SMALL') AS rows_added,
       ['category', 'lead_time_days', 'manufacturer', 'price_per_unit', 'product', 'product_id', 'upc'] AS columns_matched,
       [] AS columns_missing, count(*) + count(*) FILTER (category = 'SMALL') AS total_after FROM catalog""")
def q_upload_audit(spark, sf):
    from pricelens.sources.records import align_upload
    c = V(spark, sf)["catalog"].select(*UPLOAD_COLS)
    return S.upload_audit(c, align_upload(_upload(spark, sf), c.schema), "small.csv", "2026-12-01")


@query("set_upload_log", """
SELECT c.category || '.csv' AS filename, '2026-12-0' || d AS timestamp, count(*) AS rows_added,
       (SELECT count(*) FROM catalog) + count(*) AS total_after, DATE '2026-12-01' + CAST(d - 1 AS INTEGER) AS day
FROM catalog c, range(1, 3) t(d) WHERE c.category IN ('SMALL', 'LARGE') GROUP BY c.category, d""")
def q_upload_log(spark, sf):
    """Audit rows of four uploads appended to the log table, one of them twice."""
    from pricelens.sources.records import align_upload
    c = V(spark, sf)["catalog"].select(*UPLOAD_COLS)
    root = shared_path(spark, f"uploads-{uuid.uuid4().hex}")
    for name, at in [("SMALL", 1), ("LARGE", 1), ("SMALL", 2), ("LARGE", 2), ("LARGE", 2)]:
        up = align_upload(V(spark, sf)["catalog"].filter(F.col("category") == name).select("product", "category"), c.schema)
        S.log_upload(S.upload_audit(c, up, f"{name}.csv", f"2026-12-0{at}"), root)
    return read_by_date(spark, root).select("filename", "timestamp", "rows_added", "total_after", "day")


@query("str_quota_batch", """
SELECT event_id, event_type AS action, user_id, CAST(ts AS DATE) AS day, ts, rn <= 2 AS allowed,
       CAST(least(rn, 2) AS INTEGER) AS count_today
FROM (SELECT *, row_number() OVER (PARTITION BY event_type, user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn FROM events) t""")
def q_quota(spark, sf):
    from pricelens.plans.fixtures import register_tables
    register_tables(spark, sf, ["events"])
    return S.quota(spark.table("events"), 2)


@query("agg_source_breakdown_merged", f"""
WITH c AS (SELECT product_id, product, manufacturer, category, price_per_unit FROM catalog),
m AS (SELECT 'catalog' AS source FROM c
      UNION ALL SELECT 'upload:small.csv' FROM catalog WHERE category = 'SMALL')
SELECT source, count(*) AS count,
       {R("count(*) / CAST((SELECT count(*) FROM m) AS DOUBLE) * 100", 1)} AS pct FROM m GROUP BY source""")
def q_source_breakdown_merged(spark, sf):
    from pricelens.operators.catalog import source_breakdown
    c = V(spark, sf)["catalog"].select("product_id", "product", "manufacturer", "category", "price_per_unit")
    up = c.filter(F.col("category") == "SMALL").select("product", "manufacturer", "category", "price_per_unit",
                                                        F.col("product_id").alias("upload_row"))
    return source_breakdown(S.merge_upload(c, up, "small.csv", "2026-12-01", order=[F.col("upload_row")]))
