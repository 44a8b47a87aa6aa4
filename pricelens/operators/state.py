"""Current-offer state: snapshot fold, upsert, history, change detection, merges,
run statistics, market pulse and the daily quota.

UPS-01 upsert, UPS-02 snapshot, UPS-03 history_rows, UPS-04 detect_changes,
SET-01 merge_keep_last, SET-02 merge_upload, SET-03 upload_audit,
SET-04 market_pulse, AGG-13 run_stats, STR-02 quota (batch form).

The reference keeps state with three round trips per product; here a batch of
observations folds into the snapshot with one shuffle on (vendor_id, sku).
Rule N22: ``last_price`` changes only when the price changes, so it survives
later unchanged loads; ``price_changed`` describes the latest load only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.functions.numeric import count_if, dbl, pround
from pricelens.plans.shapes import (combine_scalars, global_rank, lag_by_key, last_per_group, top_k_per_group,
                                     with_scalars)
from pricelens.sinks.append import append_by_date

KEY = ["vendor_id", "sku"]
OBS_ORDER = ["captured_at", "run_seq", "run_line", "case_price"]


def _ord(cols, desc=False):
    return [F.col(c).desc() if desc else F.col(c).asc() for c in cols]


def has_sku(sku: str = "sku") -> Column:
    """Rows with an empty or missing sku are never stored."""
    return F.coalesce(F.length(sku) > 0, F.lit(False))


def with_change_flags(obs: DataFrame, key=KEY, order=OBS_ORDER, price: str = "unit_price") -> DataFrame:
    """Per observation: previous price in arrival order, whether there was a previous
    observation, and whether the price changed (both prices present and different).
    The predecessor comes from ``lag_by_key`` (dealt by key and month, skew-safe)."""
    o = lag_by_key(obs, key, order, [price]).withColumnRenamed(f"prev_{price}", "prev_price")
    return o.withColumn("changed", F.col(price).isNotNull() & F.col("prev_price").isNotNull()
                        & (F.col(price) != F.col("prev_price")))


def snapshot(obs: DataFrame, key=KEY, order=OBS_ORDER, price: str = "unit_price") -> DataFrame:
    """UPS-02: the snapshot every observation folded in arrival order produces.

    Latest row / first seen / latest change are aggregates (``max_by`` / ``min``),
    so only the ``lag`` above needs the key's rows side by side.
    """
    c = with_change_flags(obs, key, order, price)
    okey = F.struct(*[F.col(x) for x in order])
    cols = [x for x in obs.columns if x not in key]
    agg = c.groupBy(*key).agg(
        F.max_by(F.struct(*[F.col(x) for x in cols], F.col("changed")), okey).alias("_l"),
        F.min("captured_at").alias("first_seen_at"),
        F.max_by(F.col("prev_price"), F.when(F.col("changed"), okey)).alias("last_price"))
    return agg.select(*key, *[F.col(f"_l.{x}").alias(x) for x in cols],
                      F.col("_l.captured_at").alias("last_seen_at"), "first_seen_at", "last_price",
                      F.col("_l.changed").alias("price_changed"))


def upsert(current: DataFrame, batch: DataFrame, key=KEY, order=OBS_ORDER, price: str = "unit_price",
           now: Column | None = None, lagged: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """UPS-01: fold a batch into the current snapshot.

    Returns (new_snapshot, outcomes).  Batch rows without a sku (null or empty) are skipped.  A key
    seen twice in the batch folds in arrival order.  Columns the batch carries
    override the stored ones; columns it lacks survive.  ``first_seen_at`` is kept,
    ``last_seen_at`` moves to ``now`` (default: the row's captured_at).
    ``lagged``: ``lag_by_key`` of the batch rows that have a sku, if the caller has it.
    """
    b = batch.filter(has_sku())
    skipped = batch.filter(~has_sku()).select(*key, F.lit("skipped").alias("action"),
                                                          F.lit(False).alias("price_changed"))
    cur = current.select(*key, F.col(price).alias("_cur_price"), F.col("last_price").alias("_cur_last"),
                         F.col("first_seen_at").alias("_cur_first"), F.lit(True).alias("_exists"))
    seen = now if now is not None else F.col("captured_at")
    # predecessor inside the batch (skew-safe lag); a key's first batch row compares with the stored price
    x = ((lag_by_key(b, key, order, [price]) if lagged is None else lagged).join(cur, key, "left")
         .withColumn("_prev", F.when(F.col("has_prev"), F.col(f"prev_{price}")).otherwise(F.col("_cur_price")))
         .withColumn("changed", F.col(price).isNotNull() & F.col("_prev").isNotNull()
                     & (F.col(price) != F.col("_prev")))
         .withColumn("_seen", seen))
    outcomes = x.select(*key, F.when(F.col("_exists").isNull() & ~F.col("has_prev"), F.lit("new"))
                        .when(F.col("changed"), F.lit("updated")).otherwise(F.lit("unchanged")).alias("action"),
                        F.col("changed").alias("price_changed")).unionByName(skipped)
    okey = F.struct(*[F.col(c) for c in order])
    bcols = [c for c in batch.columns if c not in key]
    folded = x.groupBy(*key).agg(
        F.max_by(F.struct(*[F.col(c) for c in bcols], F.col("changed"), F.col("_seen")), okey).alias("_l"),
        F.max_by(F.col("_prev"), F.when(F.col("changed"), okey)).alias("_new_last"),
        F.min("_seen").alias("_first_batch"))
    folded = folded.select(*key, *[F.col(f"_l.{c}").alias(c) for c in bcols],
                           F.col("_l.changed").alias("price_changed"), F.col("_l._seen").alias("last_seen_at"),
                           "_new_last", "_first_batch")
    keep = [c for c in current.columns if c not in key and c not in bcols
            and c not in ("price_changed", "last_seen_at", "last_price", "first_seen_at")]
    merged = current.select(*key, *keep, "last_price", "first_seen_at", "last_seen_at", "price_changed",
                            *[c for c in bcols if c in current.columns]).alias("c").join(
        folded.alias("f"), key, "full_outer")
    in_batch = F.col("f._first_batch").isNotNull()
    out_cols = [*key]
    out_cols += [F.col(f"c.{c}").alias(c) for c in keep]
    out_cols += [F.when(in_batch, F.col(f"f.{c}")).otherwise(F.col(f"c.{c}")).alias(c) for c in bcols
                 if c in current.columns]
    out_cols += [F.col(f"f.{c}").alias(c) for c in bcols if c not in current.columns]
    out_cols += [
        F.when(in_batch, F.coalesce(F.col("f._new_last"), F.col("c.last_price"))).otherwise(F.col("c.last_price"))
        .alias("last_price"),
        F.coalesce(F.col("c.first_seen_at"), F.col("f._first_batch")).alias("first_seen_at"),
        F.when(in_batch, F.col("f.last_seen_at")).otherwise(F.col("c.last_seen_at")).alias("last_seen_at"),
        F.when(in_batch, F.col("f.price_changed")).otherwise(F.col("c.price_changed")).alias("price_changed"),
    ]
    return merged.select(*out_cols), outcomes


def history_rows(batch: DataFrame, run_id: Column | str | None) -> DataFrame:
    """UPS-03: one price/stock snapshot per saved (sku present) row, when a run id is given;
    ``bulk_price`` is null where the feed has none."""
    if run_id is None:
        return batch.limit(0).select(F.lit(None).cast("bigint").alias("product_id"))
    rid = F.col(run_id) if isinstance(run_id, str) else run_id
    b = batch.filter(has_sku())
    bulk = F.col("bulk_price") if "bulk_price" in batch.columns else F.lit(None).cast("double").alias("bulk_price")
    return b.select(F.col("product_id"), rid.alias("run_id"), "unit_price", "case_price", bulk,
                    F.coalesce(F.col("in_stock"), F.lit(True)).alias("in_stock"), "captured_at")


def detect_changes(current: DataFrame, batch: DataFrame, key=KEY, price: str = "unit_price") -> DataFrame:
    """UPS-04: per batch row, did the price move vs the stored one (numeric compare,
    unparsable numbers count as unchanged)."""
    cur = current.select(*key, F.col(price).alias("old_price"))
    j = batch.join(cur, key, "left")
    new_n = F.col(price).cast("string").try_cast("double")
    old_n = F.col("old_price").cast("string").try_cast("double")
    return j.withColumn("price_changed", F.coalesce(new_n.isNotNull() & old_n.isNotNull() & (new_n != old_n),
                                                    F.lit(False)))


# ── merges (SET-01..03) ──────────────────────────────────────────────────
def merge_keep_last(existing: DataFrame, new: DataFrame, key: str = "product_id",
                    order: str | None = None) -> DataFrame:
    """Append and keep the last row per key: new rows win; within a side, the
    larger ``order`` value wins (append order has to be explicit on a cluster)."""
    e = existing.withColumn("_src", F.lit(0))
    n = new.withColumn("_src", F.lit(1))
    u = e.unionByName(n, allowMissingColumns=True)
    okey = ["_src"] + ([order] if order else [])
    cols = [c for c in u.columns if c not in (key, "_src")]
    return last_per_group(u, [key], okey, cols)


def merge_upload(catalog: DataFrame, upload: DataFrame, source: str, at: str,
                 order: list | None = None, default_source: str = "catalog",
                 default_date: str = "2026-03-05") -> DataFrame:
    """SET-02: append an upload with provenance; uploaded rows get ids max+1, max+2, ...
    in upload order (a distributed rank, no single-partition window).  Uploaded values take
    the catalog's types; what does not parse becomes null."""
    types = {f.name: f.dataType for f in catalog.schema.fields}
    upload = upload.select(*[F.col(f.name).try_cast(types[f.name]).alias(f.name) if types.get(f.name, f.dataType) != f.dataType
                             else F.col(f.name) for f in upload.schema.fields])
    base = catalog
    if "data_source" not in base.columns:
        base = base.withColumn("data_source", F.lit(default_source)).withColumn("upload_date", F.lit(default_date))
    mx = catalog.agg(F.coalesce(F.max(F.col("product_id").cast("bigint")), F.lit(0)).alias("_max"))
    order = order or [F.col(c) for c in upload.columns]
    up = global_rank(upload.drop("product_id") if "product_id" in upload.columns else upload, order, "_r")
    up = with_scalars(up, mx)
    up = (up.withColumn("product_id", F.col("_max") + F.col("_r")).drop("_max", "_r")
          .withColumn("data_source", F.lit("upload:" + source)).withColumn("upload_date", F.lit(at)))
    return base.unionByName(up, allowMissingColumns=True)


def upload_audit(catalog: DataFrame, upload: DataFrame, filename: str, at: str) -> DataFrame:
    """SET-03: one log row: rows added, matched / missing columns, total after."""
    ours, theirs = set(catalog.columns), set(upload.columns)
    spark = catalog.sparkSession
    added = upload.agg(F.count(F.lit(1)).alias("rows_added"))
    before = catalog.agg(F.count(F.lit(1)).alias("_before"))
    meta = spark.createDataFrame([(filename, at, sorted(ours & theirs), sorted(ours - theirs))],
                                 "filename string, timestamp string, columns_matched array<string>, "
                                 "columns_missing array<string>")
    return combine_scalars(meta, added, before).select(
        "filename", "timestamp", "rows_added", "columns_matched", "columns_missing",
        (F.col("_before") + F.col("rows_added")).alias("total_after"))


def log_upload(audit: DataFrame, root: str) -> None:
    """SET-03: append audit rows to the upload log, by date; the same file at the same time is logged once."""
    append_by_date(audit, root, "timestamp", F.sha2(F.concat_ws("|", "filename", "timestamp"), 256))


# ── runs (AGG-13) ────────────────────────────────────────────────────────
def run_stats(obs: DataFrame, run_key=("run_id", "vendor_id"), key=KEY, order=OBS_ORDER,
              status_override: Column | None = None) -> DataFrame:
    """Per run: found, new (first sighting of the key), updated / price changes
    (price differs from the key's previous observation), errors (no price),
    status completed / partial (or an override such as failed/running), duration."""
    o = lag_by_key(obs, key, order, ["unit_price"]).withColumnRenamed("prev_unit_price", "prev_price")
    moved = F.coalesce(F.col("unit_price") != F.col("prev_price"), F.lit(False))
    g = o.groupBy(*run_key).agg(
        F.count(F.lit(1)).alias("products_found"),
        count_if(~F.col("has_prev")).alias("products_new"),
        count_if(moved).alias("products_updated"),
        count_if(moved).alias("price_changes"),
        count_if(F.col("unit_price").isNull()).alias("errors"),
        F.min("captured_at").alias("started_at"), F.max("captured_at").alias("completed_at"))
    status = F.when(F.col("errors") == 0, F.lit("completed")).otherwise(F.lit("partial"))
    if status_override is not None:
        status = F.coalesce(status_override, status)
    return g.select(*run_key, status.alias("status"), "products_found", "products_new", "products_updated",
                    "price_changes", "errors", "started_at", "completed_at",
                    (F.unix_timestamp(F.col("completed_at").cast("timestamp"))
                     - F.unix_timestamp(F.col("started_at").cast("timestamp"))).alias("duration_secs"))


def run_errors(obs: DataFrame, run_key=("run_id", "vendor_id")) -> DataFrame:
    """The error list behind a run's error count: one row per observation without a price."""
    return obs.filter(F.col("unit_price").isNull()).select(
        *run_key, "sku", F.lit("missing price").alias("error"), F.col("captured_at").alias("at"))


# ── market pulse (SET-04) ────────────────────────────────────────────────
def market_pulse(products: DataFrame, runs: DataFrame, vendors: DataFrame, limit: int = 20,
                 n_runs: int = 10, title_chars: int | None = 50) -> DataFrame:
    """Newest price-change events (both prices > 0) and newest runs, one feed, newest first.

    Unpriced changes are left out before the newest ``limit`` are taken.  Runs carry the
    figures of their detail line.  ``title_chars`` of the product name are shown (None: all).
    """
    v = vendors.select("vendor_id", F.col("name").alias("vendor"))
    old, new = F.coalesce(dbl("last_price"), F.lit(0.0)), F.coalesce(dbl("unit_price"), F.lit(0.0))
    ch = (products.filter((F.col("price_changed") == F.lit(True)) & (old > 0) & (new > 0))
          .orderBy(F.col("last_seen_at").desc_nulls_first(), F.col("product_id").desc()).limit(limit)
          .join(v, "vendor_id", "left"))
    name = F.coalesce("product_name", F.lit(""))
    diff = new - old
    ev1 = ch.select(
        F.lit("price_change").alias("type"),
        F.concat(F.when(diff < 0, F.lit("Price drop: ")).otherwise(F.lit("Price increase: ")),
                 name if title_chars is None else F.substring(name, 1, title_chars)).alias("title"),
        F.coalesce("vendor", F.lit("")).alias("vendor"), F.col("last_seen_at").alias("timestamp"),
        F.when(diff < 0, F.lit("positive")).otherwise(F.lit("negative")).alias("severity"),
        pround(F.abs(diff), 2).alias("amount"), pround(F.abs(pround(diff / old * 100, 1)), 1).alias("pct"),
        *[F.lit(None).cast("bigint").alias(c) for c in ("products_found", "products_new", "price_changes")], F.lit(0).alias("_t"),
        F.col("product_id").alias("_id"))
    r = (runs.orderBy(F.col("started_at").desc_nulls_first(), F.col("run_id").desc()).limit(n_runs)
         .join(v, "vendor_id", "left"))
    ev2 = r.select(
        F.lit("scrape_complete").alias("type"),
        F.concat(F.lit("Scrape completed: "), F.coalesce("vendor", F.lit("Unknown"))).alias("title"),
        F.coalesce("vendor", F.lit("Unknown")).alias("vendor"), F.col("started_at").alias("timestamp"),
        F.lit("info").alias("severity"), F.lit(None).cast("double").alias("amount"),
        F.lit(None).cast("double").alias("pct"), *[F.col(c).cast("bigint").alias(c) for c in ("products_found", "products_new", "price_changes")],
        F.lit(1).alias("_t"), F.col("run_id").alias("_id"))
    return (ev1.unionByName(ev2)
            .orderBy(F.col("timestamp").desc_nulls_last(), "_t", F.col("_id").desc()).limit(limit)
            .drop("_t", "_id"))


# ── daily quota (STR-02, batch form) ─────────────────────────────────────
def quota(events: DataFrame, max_per_day: int = 5, action: str = "event_type", user: str = "user_id",
          ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """Per (action, user, day) requests in (ts, id) order: the first ``max_per_day`` are
    allowed and count 1..max; denied ones do not increment (count stays at max).

    The first-k per group is a ``row_number() <= k`` (map-side limited), joined
    back on the request id - a hot user never lands whole in one task.
    """
    e = events.withColumn("day", F.to_date(F.col(ts)))
    firsts = top_k_per_group(e.select(tie, action, user, "day", ts), [action, user, "day"],
                             [F.col(ts), F.col(tie)], max_per_day, "_rn").select(tie, "_rn")
    out = e.join(firsts, tie, "left")
    return out.select(tie, F.col(action).alias("action"), F.col(user).alias("user_id"), "day", ts,
                      F.col("_rn").isNotNull().alias("allowed"),
                      F.coalesce(F.col("_rn"), F.lit(max_per_day)).cast("int").alias("count_today"))

