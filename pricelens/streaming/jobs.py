"""Structured Streaming forms of the stateful paths.

STR-01 stream_upsert  - micro-batches of observations folded into the touched hash buckets
                        of the snapshot with ``foreachBatch`` + the batch upsert (UPS-01);
                        change events appended for the pulse feed.
STR-02 stream_quota   - per (action, user, day) request counts in hash buckets, folded
                        per micro-batch by native ranks, expired by event time.
STR-03 stream_pulse   - price-change events deduplicated within a watermark
                        (``dropDuplicatesWithinWatermark``) and shaped as feed items.

Every job writes under a caller-given folder (on a cluster: the shared folder
named by ``spark.checkpoint.dir``) and keeps its own checkpoint, so a restarted
job resumes where it stopped; a replayed micro-batch rewrites the same version.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.functions.numeric import dbl, pround
from pricelens.operators.state import KEY, OBS_ORDER, has_sku, snapshot, upsert
from pricelens.plans.shapes import lag_by_key, top_k_per_group
from pricelens.sinks.buckets import BucketTable

# ── STR-01 ───────────────────────────────────────────────────────────────
EVENT_SCHEMA = ("vendor_id bigint, sku string, captured_at timestamp_ntz, run_seq bigint, run_line int, "
                "old_price decimal(12,4), new_price decimal(12,4), batch_id bigint")


BUCKETS = 16  # of a state table; about its size / 128 MB on a cluster


def upsert_batch(spark: SparkSession, batch: DataFrame, batch_id: int, root: str,
                 key=KEY, order=OBS_ORDER, source: str = "", buckets: int = BUCKETS) -> None:
    """One micro-batch: fold into the buckets of the snapshot that its keys are in, write those
    aside, append change events, then commit.

    ``source`` names the stream's checkpoint.  A batch that the log has already is not
    folded again; a batch of a new checkpoint gets a version after all others.
    """
    batch = batch.persist()
    lagged = None
    try:
        table = BucketTable(spark, root, key, buckets)
        change = table.begin(batch.filter(has_sku()), snapshot(batch.limit(0), key, order).schema, source, batch_id)
        if change is None:
            return
        lagged = lag_by_key(batch.filter(has_sku()), key, order, ["unit_price"]).persist()  # for the snapshot and the events
        change.write(upsert(change.current, batch, key, order, lagged=lagged)[0])
        # change events of this batch (price moved vs the previous observation of the key)
        cur = change.current.select(*key, F.col("unit_price").alias("_cur"))
        x = (lagged.join(cur, key, "left")
             .withColumn("old_price", F.when(F.col("has_prev"), F.col("prev_unit_price")).otherwise(F.col("_cur")))
             .filter(F.col("unit_price").isNotNull() & F.col("old_price").isNotNull()
                     & (F.col("unit_price") != F.col("old_price")))
             .select(*key, "captured_at", "run_seq", "run_line", "old_price", F.col("unit_price").alias("new_price"))
             .withColumn("batch_id", F.lit(batch_id)))
        x.write.mode("overwrite").parquet(os.path.join(root, "_events", f"part-{change.version:012d}"))
        change.commit()
    finally:
        if lagged is not None:
            lagged.unpersist()
        batch.unpersist()


def stream_upsert(spark: SparkSession, observations: DataFrame, root: str, checkpoint: str,
                  available_now: bool = True):
    """Start the snapshot-maintenance stream; returns the StreamingQuery."""
    w = (observations.writeStream.foreachBatch(lambda df, bid: upsert_batch(spark, df, bid, root, source=checkpoint))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def current_snapshot(spark: SparkSession, root: str, key=KEY, buckets: int = BUCKETS) -> DataFrame:
    return BucketTable(spark, root, key, buckets).current()


# ── STR-02 ───────────────────────────────────────────────────────────────
QUOTA_KEY = ["action", "user_id", "day"]
QUOTA_STATE = "action string, user_id long, day date, n int"
QUOTA_OUT = ("event_id long, action string, user_id long, day date, ts timestamp_ntz, allowed boolean, "
             "count_today int, late boolean, version long")


def quota_batch(spark: SparkSession, events: DataFrame, batch_id: int, root: str, max_per_day: int = 5, action: str = "event_type",
                user: str = "user_id", ts: str = "ts", delay: dt.timedelta = dt.timedelta(hours=1), source: str = "", buckets: int = BUCKETS) -> None:
    """One micro-batch of requests against the day's counts of its (action, user, day) keys.

    Requests are ranked natively in (ts, id) order; only the first ``max_per_day`` of a key can
    be allowed, so only those (a map-side limited rank) are joined to the key's count so far, and a hot
    user is never gathered in one task.  The newest time of the batches before, less ``delay``,
    is the watermark: a request of a day that ended before it is late - denied, marked, without a
    count - and counts of such days are dropped from the buckets that are rewritten.
    """
    e = events.select("event_id", F.col(action).alias("action"), F.col(user).cast("long").alias("user_id"), F.to_date(F.col(ts)).alias("day"),
                      F.col(ts).cast("timestamp_ntz").alias("ts")).persist()
    try:
        table = BucketTable(spark, root, QUOTA_KEY, buckets)
        change = table.begin(e, T.StructType.fromDDL(QUOTA_STATE), source, batch_id, time="ts")
        if change is None:
            return

        def over(mark: dt.datetime | None) -> Column:
            return F.lit(False) if mark is None else F.date_add("day", 1).cast("timestamp_ntz") <= F.lit(mark - delay)

        e = e.withColumn("late", F.coalesce(over(change.before.mark), F.lit(False)))
        first = top_k_per_group(e.filter(~F.col("late")), QUOTA_KEY, ["ts", "event_id"], max_per_day, "rn")
        so_far = change.current.select(*[F.col(c).alias(f"_{c}") for c in QUOTA_KEY], "n")
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in QUOTA_KEY]
        first = (first.join(so_far, same[0] & same[1] & same[2], "left").withColumn("count", (F.coalesce("n", F.lit(0)) + F.col("rn")).cast("int"))
                 .filter(F.col("count") <= max_per_day).select("event_id", *QUOTA_KEY, "count"))
        allowed = first.select("event_id", F.col("count").alias("_count"))
        rows = e.join(allowed, "event_id", "left").select(
            "event_id", *QUOTA_KEY, "ts", F.col("_count").isNotNull().alias("allowed"),
            F.when(~F.col("late"), F.coalesce("_count", F.lit(max_per_day))).alias("count_today"), "late")
        rows.write.mode("overwrite").parquet(os.path.join(root, "_out", f"version={change.version}"))
        counts = change.current.unionByName(first.select(*QUOTA_KEY, F.col("count").alias("n")))
        change.write(counts.groupBy(*QUOTA_KEY).agg(F.max("n").alias("n")).filter(~F.coalesce(over(change.mark), F.lit(False))))
        change.commit()
    finally:
        e.unpersist()


def stream_quota(spark: SparkSession, events: DataFrame, root: str, checkpoint: str, max_per_day: int = 5, available_now: bool = True, **columns):
    """Streaming daily quota: counts by (action, user, day) in hash buckets, folded per micro-batch
    (``quota_batch``); returns the StreamingQuery.  ``quota_rows`` reads the answers."""
    w = (events.writeStream.foreachBatch(lambda df, bid: quota_batch(df.sparkSession, df, bid, root, max_per_day, source=checkpoint, **columns))
         .option("checkpointLocation", checkpoint))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()


def quota_rows(spark: SparkSession, root: str, buckets: int = BUCKETS) -> DataFrame:
    """Every request of the committed batches: allowed or not, the day's count after it, late or not."""
    version = BucketTable(spark, root, QUOTA_KEY, buckets).head().version
    rows = spark.read.schema(QUOTA_OUT).parquet(os.path.join(root, "_out"))
    return rows.filter(F.col("version") <= version).drop("version")


# ── STR-03 ───────────────────────────────────────────────────────────────
def stream_pulse(change_events: DataFrame, delay: str = "7 days") -> DataFrame:
    """Change events -> pulse items (both prices > 0), duplicates within the watermark dropped."""
    e = (change_events.withColumn("_wts", F.col("captured_at").cast("timestamp")).withWatermark("_wts", delay)
         .dropDuplicatesWithinWatermark(["vendor_id", "sku", "captured_at", "run_seq", "run_line"]))
    old, new = dbl("old_price"), dbl("new_price")
    e = e.filter((old > 0) & (new > 0))
    diff = new - old
    return e.select("vendor_id", "sku", "captured_at", "run_seq", "run_line",
                    F.lit("price_change").alias("type"),
                    F.when(diff < 0, F.lit("positive")).otherwise(F.lit("negative")).alias("severity"),
                    pround(F.abs(diff), 2).alias("amount"), pround(diff / old * 100, 1).alias("pct"))


def late_rows(query) -> int:
    """Rows that a stream's stateful operators dropped because they came after the watermark."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def run_to_table(spark: SparkSession, stream_df: DataFrame, out: str, checkpoint: str,
                 mode: str = "append", on_late: Callable[[int], None] | None = None) -> DataFrame:
    """Drive a streaming DataFrame to completion (availableNow) into parquet; read it back.
    ``on_late`` is told the number of rows dropped as late."""
    q = (stream_df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
         .outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination()
    if on_late is not None:
        on_late(late_rows(q))
    return spark.read.parquet(out)
