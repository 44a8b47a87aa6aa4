"""Registered queries: the streaming jobs run to completion (availableNow) on the
driver tables, checked against the batch definitions."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from pricelens.functions.numeric import dbl
from pricelens.plans.fixtures import VIEWS, raw_table, register_tables
from pricelens.plans.registry import query
from pricelens.session import shared_path
from pricelens.streaming import jobs as J


def _run_dir(spark, tag: str) -> str:
    return shared_path(spark, f"stream-{tag}-{uuid.uuid4().hex[:12]}")


def _table_glob(sf: str, name: str) -> str:
    """A file stream source lists a directory or a glob; the driver's tables are single
    files, so they are named through a one-file glob."""
    return os.path.join(sf, f"{name}.parque[t]")


def _observation_stream(spark, sf):
    """lineitem as a file stream joined to the static part table -> observations."""
    li = raw_table(spark, sf, "lineitem")
    s = (spark.readStream.schema(li.schema).option("maxFilesPerTrigger", 16)
         .parquet(_table_glob(sf, "lineitem")))
    name = f"_lineitem_stream_{uuid.uuid4().hex[:8]}"
    s.createOrReplaceTempView(name)
    register_tables(spark, sf, ["part"])
    return spark.sql(VIEWS["observations"].replace("FROM lineitem", f"FROM {name}")).drop("run_id")


def _run_upsert_stream(spark, sf) -> str:
    root = _run_dir(spark, "upsert")
    q = J.stream_upsert(spark, _observation_stream(spark, sf), os.path.join(root, "snapshot"),
                        os.path.join(root, "_checkpoint"))
    q.awaitTermination()
    return os.path.join(root, "snapshot")


@query("str_stream_upsert", """
SELECT vendor_id, sku, CAST(unit_price AS DOUBLE) AS unit_price, CAST(last_price AS DOUBLE) AS last_price,
       price_changed, first_seen_at, last_seen_at FROM products""")
def q_stream_upsert(spark, sf):
    snap = J.current_snapshot(spark, _run_upsert_stream(spark, sf))
    return snap.select("vendor_id", "sku", dbl("unit_price").alias("unit_price"), dbl("last_price").alias("last_price"),
                       "price_changed", "first_seen_at", "last_seen_at")


@query("str_stream_pulse", """
WITH o AS (SELECT *, lag(unit_price) OVER (PARTITION BY vendor_id, sku ORDER BY captured_at, run_seq, run_line, case_price) AS prev
           FROM observations),
e AS (SELECT vendor_id, sku, captured_at, run_seq, run_line, CAST(prev AS DOUBLE) AS old, CAST(unit_price AS DOUBLE) AS new
      FROM o WHERE unit_price IS NOT NULL AND prev IS NOT NULL AND unit_price <> prev)
SELECT vendor_id, sku, captured_at, run_seq, run_line, 'price_change' AS type,
       CASE WHEN new - old < 0 THEN 'positive' ELSE 'negative' END AS severity,
       CAST(round(TRY_CAST(abs(new - old) AS DECIMAL(28,10)), 2) AS DOUBLE) AS amount,
       CAST(round(TRY_CAST((new - old) / old * 100 AS DECIMAL(28,10)), 1) AS DOUBLE) AS pct
FROM e WHERE old > 0 AND new > 0""")
def q_stream_pulse(spark, sf):
    snap_root = _run_upsert_stream(spark, sf)
    root = _run_dir(spark, "pulse")
    events = spark.readStream.schema(J.EVENT_SCHEMA).parquet(os.path.join(snap_root, "_events", "*"))
    return J.run_to_table(spark, J.stream_pulse(events), os.path.join(root, "out"),
                          os.path.join(root, "_checkpoint"))


@query("str_stream_quota", """
SELECT event_id, event_type AS action, user_id, CAST(ts AS DATE) AS day, ts, rn <= 2 AS allowed,
       CAST(least(rn, 2) AS INTEGER) AS count_today
FROM (SELECT *, row_number() OVER (PARTITION BY event_type, user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn FROM events) t""")
def q_stream_quota(spark, sf):
    ev = raw_table(spark, sf, "events")
    root = _run_dir(spark, "quota")
    s = spark.readStream.schema(ev.schema).parquet(_table_glob(sf, "events"))
    J.stream_quota(spark, s, os.path.join(root, "quota"), os.path.join(root, "_checkpoint"), 2).awaitTermination()
    return J.quota_rows(spark, os.path.join(root, "quota")).drop("late")


@query("str_stream_quota_late", """
WITH m AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM events WHERE event_id % 20 <> 0),
e AS (SELECT event_id, event_type AS action, user_id, CAST(ts AS DATE) AS day, ts, event_id % 20 = 0 AS second,
             event_id % 20 = 0 AND CAST(ts AS DATE) + INTERVAL 1 DAY <= mark AS late FROM events, m),
r AS (SELECT *, row_number() OVER (PARTITION BY action, user_id, day, late ORDER BY second, ts, event_id) AS rn FROM e)
SELECT event_id, action, user_id, day, ts, NOT late AND rn <= 2 AS allowed,
       CASE WHEN NOT late THEN CAST(least(rn, 2) AS INTEGER) END AS count_today, late FROM r""")
def q_stream_quota_late(spark, sf):
    """Two runs of one stream: every twentieth request arrives after all others, late if its day is over by then."""
    ev = raw_table(spark, sf, "events")
    root = _run_dir(spark, "quota")
    for second in (False, True):
        part = ev.filter((F.col("event_id") % 20 == 0) == F.lit(second))
        part.write.parquet(os.path.join(root, "in", f"part={int(second)}"))
        s = spark.readStream.schema(ev.schema).parquet(os.path.join(root, "in", "part=*"))
        J.stream_quota(spark, s, os.path.join(root, "quota"), os.path.join(root, "_checkpoint"), 2).awaitTermination()
    return J.quota_rows(spark, os.path.join(root, "quota"))
