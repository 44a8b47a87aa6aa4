"""Micro-fixture tests for parsers, rounding, matching, confidence, state and plan shape."""

from __future__ import annotations

import difflib
import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricelens.functions.numeric import pround, to_int, to_number
from pricelens.functions.pack import (normalize_name, normalize_unit_price, parse_pack_legacy,
                                      split_pack)
from pricelens.operators import catalog as K
from pricelens.operators import confidence as CF
from pricelens.operators import matching as M
from pricelens.operators import state as S
from pricelens.plans.shapes import global_rank, top_k_per_group
from tests.conftest import SF_SMALL


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_rounding_is_half_up_on_decimal_text(spark):
    df = spark.createDataFrame([(2.675,), (0.125,), (1.005,), (-2.5,), (None,)], "x double")
    got = [r[0] for r in df.select(pround("x", 2)).collect()]
    assert got == [2.68, 0.13, 1.01, -2.5, None]


def test_to_number_and_to_int(spark):
    df = spark.createDataFrame([("1,234.50",), (" 12 ",), ("free",), ("",), (None,), ("1,200",), ("7.9",)],
                               "t string")
    got = rows(df.select("t", to_number("t").alias("n"), to_int("t").alias("i")), "n", "i")
    assert got == [(1234.5, None), (12.0, 12), (None, None), (None, None), (None, None), (1200.0, None),
                   (7.9, 7)]


PACKS = ["10/5 oz", "12/18.2 oz", "4/12/1 oz", "24/0.97 oz", "16/1.2 oz", None, "", "each",
         "12 x 8 fl oz", "6-2 lb", "10.5/5 oz", "0/5 oz", "24×12oz"]


def test_legacy_pack_parse(spark):
    df = spark.createDataFrame([(p,) for p in PACKS], "pack_size_raw string")
    got = {r["pack_size_raw"]: (r["pack_count"], r["unit_size"], r["unit_measure"])
           for r in parse_pack_legacy(df).collect()}
    assert got["10/5 oz"] == (10.0, 5.0, "oz")
    assert got["4/12/1 oz"] == (4.0, 12.0, "/1 oz")
    assert got["24/0.97 oz"] == (24.0, 0.97, "oz")
    assert got["10.5/5 oz"] == (10.5, 5.0, "oz")
    assert got["0/5 oz"] == (0.0, 5.0, "oz")
    for p in (None, "", "each", "12 x 8 fl oz", "6-2 lb", "24×12oz"):
        assert got[p] == (None, None, None)


def test_split_pack(spark):
    df = spark.createDataFrame([("10/5 oz",), ("4/12/1 oz",), ("each",), (None,), (" 6/28 oz ",)],
                               "pack_size_raw string")
    got = rows(split_pack(df), "pack_count_text", "pack_rest")
    assert got == [("10", "5 oz"), ("4", "12/1 oz"), ("", "each"), ("", ""), ("6", "28 oz")]


def test_unit_price_normalisation(spark):
    schema = ("unit_price double, price_per_oz double, pack_count double, unit_size double, "
              "unit_measure string, pack_size_raw string")
    data = [
        (24.0, None, None, None, None, "4/12/1 oz"),      # parsed 12 x 1 oz
        (10.0, None, None, None, None, "12 x 8 fl oz"),   # parsed fl oz
        (10.0, None, None, None, None, "2 lb"),           # simple, lb -> oz
        (10.0, None, None, None, None, "each"),           # nothing to parse
        (None, 0.5, 6.0, 2.0, "lb", "6/2 lb"),            # no price -> none
        (12.0, None, 6.0, 2.0, "LB ", "x"),               # structured lb wins
        (12.0, 0.5, 6.0, 2.0, "ct", "6/2 oz"),            # vendor value; per-unit from structure
        (12.0, 0.5, 6.0, 2.0, "oz", None),                # structured oz beats vendor value
    ]
    df = normalize_unit_price(spark.createDataFrame(data, schema))
    got = rows(df, "norm_price_per_oz", "norm_price_per_unit", "normalization", "normalized_label")
    assert got[0] == (2.0, 2.0, "parsed", "$2.0000/oz (parsed)")
    assert got[1] == (0.1042, 0.8333, "parsed", "$0.1042/oz (parsed)")
    assert got[2] == (0.3125, None, "parsed_simple", "$0.3125/oz")
    assert got[3] == (None, None, "none", None)
    assert got[4] == (None, None, "none", None)
    assert got[5] == (0.0625, 2.0, "computed", "$0.0625/oz (6x2.0lb)")
    assert got[6] == (0.5, 2.0, "vendor_provided", "$0.5000/oz")
    assert got[7] == (1.0, 2.0, "computed", "$1.0000/oz (6x2.0oz)")


def test_normalize_name(spark):
    df = spark.createDataFrame([("Tide Pods 42 ct Laundry",), ("Coca-Cola 12oz",), ("  Rice  Flour ",), (None,)],
                               "product_name string")
    assert [r[0] for r in normalize_name(df).select("name_key").collect()] == \
        ["tide pods", "cocacola", "rice flour", ""]


def test_keywords(spark):
    pfx = M.MATCH_PREFIX
    data = [("Soap", None), ("Big soap bar", None), ("Half-and-half Creamer 32 oz", None),
            ("ignored", pfx + " " + "word " * 30), ("x", "no prefix here"), ("A to Z", None)]
    df = M.match_keywords(spark.createDataFrame(data, "product_name string, description string"))
    got = [r["keywords"] for r in df.collect()]
    assert got[0] is None                                  # shorter than 5 characters
    assert got[1] == ["Big", "soap", "bar"]
    assert got[2] == ["Halfandhalf", "Creamer"]            # punctuation removed inside words
    assert got[3] == ["word", "word", "word"]              # prefix text, cut to 80 chars
    assert got[5] is None                                  # one usable word only


def test_seq_ratio_matches_difflib_and_is_not_symmetric(spark):
    pairs = [("tide", "diet"), ("diet", "tide"), ("12/8 oz", "12/8 oz"), ("4/12/1 oz", "12 x 1 oz"),
             ("a" * 250 + "b", "b" + "a" * 250)]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(CF.seq_ratio("a", "b")).collect()]
    want = [difflib.SequenceMatcher(None, a, b).ratio() for a, b in pairs]
    assert got == pytest.approx(want)
    assert got[0] == 0.25 and got[1] == 0.5


def test_match_confidence_points(spark):
    schema = ("a_upc string, b_upc string, a_brand string, b_brand string, a_pack_size_raw string, "
              "b_pack_size_raw string, a_product_name string, b_product_name string")
    data = [("0001", "0001", "Acme", "acme", "12/8 oz", "12/8 oz", "Acme Beans", "acme beans"),
            ("", "0001", "Acme", "Acme Foods", "12/8 oz", None, "Beans", "Rice"),
            (None, None, None, "x", None, None, None, "Rice")]
    df = CF.match_confidence(spark.createDataFrame(data, schema)).orderBy("a_product_name")
    got = {r["a_product_name"]: (r["upc_points"], r["brand_points"], r["pack_points"], r["name_points"],
                                 r["score"], r["level"]) for r in df.collect()}
    assert got["Acme Beans"] == (40, 15, 20, 20, 95, "high")
    rb = round(difflib.SequenceMatcher(None, "beans", "rice").ratio() * 20)
    assert got["Beans"] == (0, 10, 2, rb, 12 + rb, "poor")
    assert got[None] == (0, 0, 0, 0, 0, "poor")


def test_structured_pack_points(spark):
    schema = ("a_pack_count double, b_pack_count double, a_unit_size double, b_unit_size double, "
              "a_unit_measure string, b_unit_measure string, a_upc string, b_upc string, a_brand string, "
              "b_brand string, a_pack_size_raw string, b_pack_size_raw string, a_product_name string, "
              "b_product_name string, k int")
    base = (None, None, None, None, None, None, None, None, 0)
    data = [(12.0, 12.0, 8.0, 8.0, "oz", "OZ") + base[:-1] + (1,),
            (12.0, 12.0, 8.0, 6.0, "oz", "oz") + base[:-1] + (2,),
            (12.0, 6.0, 8.0, 6.0, "oz", "oz") + base[:-1] + (3,),
            (12.0, 6.0, 8.0, 6.0, "oz", "lb") + base[:-1] + (4,)]
    got = rows(CF.match_confidence(spark.createDataFrame(data, schema)).orderBy("k"), "pack_points")
    assert got == [(25,), (15,), (10,), (5,)]


def test_histogram_right_closed_bins(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "price_per_unit double")
    got = rows(K.price_histogram(df, bins=3, clip_quantile=None).orderBy("bin"), "bin", "bin_start", "bin_end",
               "count")
    assert got == [(1, 0.99, 4.0, 3), (3, 7.0, 10.0, 1)]
    eq = spark.createDataFrame([(5.0,), (5.0,)], "price_per_unit double")
    assert rows(K.price_histogram(eq, bins=2, clip_quantile=None), "bin", "count") == [(1, 2)]


def keyword_join_bruteforce(baseline, offers, k=10,
                            offer_cols=("product_id", "vendor_id", "vendor_slug", "sku", "unit_price")):
    """Every baseline row against every offer (nested loop)."""
    b = baseline.select("bid", F.col("vendor_id").alias("b_vendor_id"),
                        F.transform("keywords", lambda w: F.lower(w)).alias("lkw"))
    o = offers.select(F.lower("product_name").alias("lname"), *offer_cols)
    m = b.crossJoin(o).filter(M._contains_all(F.col("lname"), F.col("lkw"))
                              & (F.col("vendor_id") != F.col("b_vendor_id")))
    m = m.select("bid", *[F.col(c).alias(f"m_{c}") for c in offer_cols])
    order = [F.col("m_unit_price").asc_nulls_last(), F.col("m_vendor_slug").asc_nulls_last(),
             F.col("m_sku").asc_nulls_last()]
    return top_k_per_group(m, ["bid"], order, k or 10 ** 9, "rank")


def test_keyword_join_equals_bruteforce(spark):
    from pricelens.operators.deals import _offers, baseline_rows
    from pricelens.plans.fixtures import register_views

    v = register_views(spark, SF_SMALL)
    base = M.match_keywords(baseline_rows(v["products"], v["vendors"], "supplier-000000000"))
    base = base.filter(F.col("keywords").isNotNull()).select("bid", "vendor_id", "keywords")
    offers = _offers(v["products"], v["vendors"])
    fast = M.keyword_join(base, offers, None)
    slow = keyword_join_bruteforce(base, offers, None)
    cols = ["bid", "m_product_id", "rank"]
    assert sorted(rows(fast, *cols)) == sorted(rows(slow, *cols))
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_top_k_is_limited_map_side(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    out = top_k_per_group(df, ["g"], [F.col("id").desc()], 2)
    assert sorted(rows(out, "g", "id")) == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]
    out.collect()
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_global_rank_total_order(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("x"), (F.col("id") % 3).alias("y"))
    r = global_rank(df, [F.col("y"), F.col("x")], "rank", num_partitions=7)
    got = sorted(rows(r, "rank", "y", "x"))
    assert [g[0] for g in got] == list(range(1, 5001))
    assert [(g[1], g[2]) for g in got] == sorted((g[1], g[2]) for g in got)


def _obs(spark, data):
    from decimal import Decimal
    data = [r[:5] + tuple(None if x is None else Decimal(x) for x in r[5:]) for r in data]
    return spark.createDataFrame(data, "vendor_id bigint, sku string, captured_at timestamp_ntz, run_seq bigint, "
                                       "run_line int, unit_price decimal(12,4), case_price decimal(12,4)")


def test_upsert_outcomes_and_last_price(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    cur = S.snapshot(_obs(spark, [(1, "a", t(1), 1, 1, 10, 1), (1, "a", t(2), 2, 1, 12, 1),
                                  (1, "b", t(1), 1, 2, 5, 1), (1, "c", t(1), 1, 3, 7, 1)]))
    batch = _obs(spark, [(1, "a", t(3), 3, 1, 12, 1),    # unchanged: last_price 10 survives
                         (1, "b", t(3), 3, 2, 6, 1),     # changed
                         (1, "b", t(4), 4, 2, 6, 1),     # same key twice: second load unchanged
                         (1, "d", t(3), 3, 3, 3, 1),     # new
                         (1, None, t(3), 3, 4, 3, 1),    # skipped
                         (1, "c", t(3), 3, 5, None, 1)])  # price -> null: unchanged
    snap, out = S.upsert(cur, batch)
    acts = sorted(rows(out, "sku", "action"), key=str)
    assert acts == sorted([("a", "unchanged"), ("b", "updated"), ("b", "unchanged"), ("d", "new"),
                           (None, "skipped"), ("c", "unchanged")], key=str)
    s = {r["sku"]: (float(r["unit_price"]) if r["unit_price"] is not None else None,
                    float(r["last_price"]) if r["last_price"] is not None else None, r["price_changed"],
                    r["first_seen_at"]) for r in snap.collect()}
    assert s["a"] == (12.0, 10.0, False, t(1))
    assert s["b"] == (6.0, 5.0, False, t(1))
    assert s["c"] == (None, None, False, t(1))
    assert s["d"] == (3.0, None, False, t(3))


def test_rows_without_a_sku_are_never_stored(spark):
    t = dt.datetime(2024, 1, 1)
    batch = _obs(spark, [(1, "", t, 1, 1, 3, 1), (1, None, t, 1, 2, 3, 1), (1, "a", t, 1, 3, 3, 1)])
    snap, out = S.upsert(S.snapshot(batch.limit(0)), batch)
    assert [r["sku"] for r in snap.collect()] == ["a"]
    assert sorted(r["action"] for r in out.collect()) == ["new", "skipped", "skipped"]
    h = S.history_rows(batch.withColumn("product_id", F.lit(1)).withColumn("in_stock", F.lit(None).cast("boolean")), F.lit(7)).collect()
    assert len(h) == 1 and h[0]["bulk_price"] is None and h[0]["in_stock"] is True


def test_building_state_and_deal_plans_starts_no_job(spark):
    import __spark_entry__ as E

    qs, names = E.queries(), ["ups_snapshot", "ups_upsert", "agg_run_stats", "joi_top_deals", "joi_savings_summary", "joi_keyword_join", "agg_category_prices"]
    for n in names:  # parquet footers are read once
        qs[n](spark, SF_SMALL)
    spark.sparkContext.setJobGroup("plans-only", "")
    try:
        for n in names:
            qs[n](spark, SF_SMALL)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("plans-only")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_unpriced_offers_never_displace_a_priced_one(spark):
    from decimal import Decimal

    from pricelens.operators import deals as D

    row = lambda i, v, price: (i, v, f"s{i}", "Big Soap Bar", None, None if price is None else Decimal(price), None, None, None, "cat", "b", None, None, True)
    data = [row(1, 1, 10)] + [row(100 + i, 2, 0) for i in range(12)] + [row(200, 3, 4), row(201, 3, None)]
    p = spark.createDataFrame(data, "product_id long, vendor_id long, sku string, product_name string, description string, unit_price decimal(12,4), "
                                    "case_price decimal(12,4), pack_size_raw string, upc string, category string, brand string, image_url string, "
                                    "product_url string, in_stock boolean")
    v = spark.createDataFrame([(1, "base", "Base"), (2, "free", "Free"), (3, "shop", "Shop")], "vendor_id long, slug string, name string")
    d = D.top_deals(p, v, "base").collect()
    assert [(r["best_other_price"], r["vendor_count"], r["best_savings_abs"]) for r in d] == [(4.0, 1, 6.0)]
    assert D.top_deals(p, v, "base", sort_by="confidence").first()["best_confidence"] > 0
    assert [(r["vendor_slug"], r["unit_price"]) for r in D.deal_offers(p, v, "base").collect()] == [("shop", 4.0)]
    s = D.savings_summary(p, v, "base").first()
    assert (s["total_savings"], s["products_compared"]) == (6.0, 1)
    assert tuple(D.deal_summary(D.top_deals(p, v, "nobody")).first()) == (0, 0, 0, 0.0)


def test_quota_denied_requests_do_not_count(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    ev = spark.createDataFrame([(1, t(1), 7, "scrape"), (2, t(2), 7, "scrape"), (3, t(3), 7, "scrape"),
                                (4, t(4), 8, "scrape"), (5, t(5), 7, "view")],
                               "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string")
    got = sorted(rows(S.quota(ev, 2), "event_id", "allowed", "count_today"))
    assert got == [(1, True, 1), (2, True, 2), (3, False, 2), (4, True, 1), (5, True, 1)]


def test_best_prices_plan_has_no_window(spark):
    from pricelens.operators.compare import best_prices
    from pricelens.plans.fixtures import register_views

    p = register_views(spark, SF_SMALL)["products"]
    plan = best_prices(p)._jdf.queryExecution().optimizedPlan().toString()
    # the only windows are the snapshot fold's; the per-UPC pick is an aggregate
    assert "min_by" in plan


def test_upload_audit(spark):
    cat = spark.createDataFrame([(1, "a", 2.0)], "product_id long, product string, price_per_unit double")
    up = spark.createDataFrame([("b", "x"), ("c", "y")], "product string, extra string")
    row = S.upload_audit(cat, up, "f.csv", "2026-12-01").first()
    assert row["rows_added"] == 2 and row["total_after"] == 3
    assert row["columns_matched"] == ["product"] and row["columns_missing"] == ["price_per_unit", "product_id"]


@pytest.mark.parametrize("hot_share,bins", [(1000, 4096), (3, 7), (3, 1), (1, 4)])
def test_lag_by_key_matches_window_with_a_hot_key(spark, hot_share, bins):
    from pyspark.sql import Window
    from pricelens.plans.shapes import lag_by_key

    # half of all rows: one key, most of them in a small part of its range; keys, places and values may be null
    hot = spark.range(6000).select(F.lit(1).alias("k"), F.when(F.col("id") > 5990, F.col("id") * 1000).when(F.col("id") > 0, F.floor(F.col("id") / 2)).alias("t"),
                                   F.col("id").alias("u"), (F.col("id") % 5).alias("v"))
    cold = spark.range(300).select(F.when(F.col("id") % 30 > 0, F.col("id") % 30 + 2).alias("k"), F.col("id").alias("t"), F.col("id").alias("u"),
                                   F.when(F.col("id") % 7 > 0, F.col("id")).alias("v"))
    df = hot.unionByName(cold)
    w = Window.partitionBy("k").orderBy("t", "u")
    want = df.select("k", "t", "u", F.lag("v").over(w).alias("prev_v"), (F.row_number().over(w) > 1).alias("has_prev"))
    got = lag_by_key(df, ["k"], ["t", "u"], ["v"], hot_share=hot_share, bins=bins)
    cols = ("k", "t", "u", "prev_v", "has_prev")
    assert sorted(rows(got, *cols), key=str) == sorted(rows(want, *cols), key=str)


def test_lag_by_key_keeps_a_hot_month_even(spark):
    from pricelens.plans.shapes import lag_by_key

    start = F.lit("2024-03-01").cast("timestamp")
    hot = spark.range(40000).select(F.lit(1).alias("k"), F.timestamp_seconds(F.unix_timestamp(start) + F.col("id") * 60).alias("t"), F.col("id").alias("v"))
    cold = spark.range(40000).select(F.col("id") + 2, F.timestamp_seconds(F.unix_timestamp(start) - F.col("id") * 3600), F.col("id"))
    got = lag_by_key(hot.union(cold), ["k"], ["t"], ["v"], bins=256).withColumn("p", F.spark_partition_id())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)  # small partitions would be put together again
    try:
        sizes = sorted(r["count"] for r in got.where("k = 1").groupBy("p").count().collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(sizes) == 40000 and sizes[-1] < 2 * 40000 / n + 512


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.99, 1.0])
def test_exact_quantile_equals_percentile(spark, q):
    from pricelens.plans.shapes import exact_quantile

    x = F.col("id")
    v = F.when(x % 11 == 0, None).when(x % 5 == 0, 0.0).when(x % 3 == 0, -(x % 97) / 7.0).when(x % 7 == 0, 1e300 / (x + 1)).otherwise(F.pow(F.lit(1.01), x % 500) + x * 1e-12)
    df = spark.range(5000).select((x % 4).alias("g"), v.cast("double").alias("v")).union(spark.createDataFrame([(9, 2.5), (10, None), (11, 1.0), (11, float("inf"))], "g long, v double"))
    want = df.where("v is not null").groupBy("g").agg(F.expr(f"percentile(v, {q})").alias("w"))
    both = exact_quantile(df, "v", q, ["g"], "q").join(want, "g", "full").collect()
    assert len(both) == 6 and all(r["q"] == r["w"] or abs(r["q"] - r["w"]) <= 1e-12 * abs(r["w"]) for r in both)
    whole = df.where("g < 4")
    assert exact_quantile(whole, "v", q).first()[0] == pytest.approx(whole.agg(F.expr(f"percentile(v, {q})")).first()[0], rel=1e-12)
    assert exact_quantile(df.limit(0), "v", q).first()[0] is None


def test_scalar_attach_is_not_a_cross_join(spark):
    from pricelens.plans.shapes import with_scalars

    df = spark.range(100).select(F.col("id").cast("double").alias("x"))
    out = with_scalars(df, df.agg(F.min("x").alias("mn"), F.max("x").alias("mx")))
    assert out.filter("x = 3").select("mn", "mx").first() == (0.0, 99.0)
    out.write.format("noop").mode("overwrite").save()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_ratio_bounds_hold_and_pack_points_are_difflibs(spark):
    import difflib
    import random

    from pricelens.operators import confidence as CF
    rnd = random.Random(2)
    texts = ["", "6/5 lb", "12 ct", "6/5 LB CASE", "4x1 gal", *("".join(rnd.choice("ab1/ x") for _ in range(rnd.randint(0, 12))) for _ in range(60)), "ab " * 80, "ab " * 79 + "b"]
    pairs = [(a, b) for a in texts for b in rnd.sample(texts, 12)] + [(t, t) for t in texts]
    df = spark.createDataFrame(pairs, "a string, b string")
    low, high = CF.ratio_bounds(F.col("a"), F.col("b"))
    points, verified = CF.pack_points(F.col("a"), F.col("b"))
    seen = 0
    for r in df.select("a", "b", low.alias("low"), high.alias("high"), points.alias("p"), verified.alias("v")).collect():
        ratio = difflib.SequenceMatcher(None, r["a"], r["b"]).ratio()
        assert r["low"] <= ratio <= r["high"]
        assert r["p"] == (20 if ratio > 0.8 else 12 if ratio > 0.5 else 5)
        seen += r["v"]
    assert 0 < seen < 0.6 * len(pairs)


def test_upc_is_trimmed_only(spark):
    from pricelens.operators import confidence as CF
    cols = ["upc", "brand", "pack_size_raw", "product_name"]
    df = spark.createDataFrame([(" ab1", "", "", "", "ab1 ", "", "", ""), ("ab1", "", "", "", "AB1", "", "", "")],
                               ", ".join(f"{s}_{c} string" for s in "ab" for c in cols))
    assert sorted(r["upc_points"] for r in CF.match_confidence(df).collect()) == [0, 40]


@pytest.mark.parametrize("sort_by", ["savings_pct", "confidence"])
def test_deal_details_are_whole(spark, sort_by):
    """Deals as ``top_deals`` gives them; each offer scored as difflib scores it, the best of them the deal's."""
    import difflib
    import re

    from pricelens.operators import deals as D
    from pricelens.plans.registry import BASELINE, V

    v = V(spark, SF_SMALL)
    got = {r["bid"]: r for r in D.deal_details(v["products"], v["vendors"], BASELINE, limit=20, sort_by=sort_by).collect()}
    want = D.top_deals(v["products"], v["vendors"], BASELINE, limit=20, sort_by=sort_by).collect()
    assert len(got) == len(want) > 10
    brands = {r["product_id"]: r["brand"] for r in v["products"].select("product_id", "brand").collect()}
    clean = lambda t: re.sub(r"[^a-z0-9\s]", "", (t or "").strip().lower())
    for w in want:
        r = got[w["bid"]]
        assert all(r[c] == w[c] for c in w.__fields__)
        offers = r["all_vendors"]
        assert [o["rank"] for o in offers] == list(range(1, w["vendor_count"] + 1))
        assert offers[0]["unit_price"] == r["best_other_price"] and offers[0]["vendor_name"] == r["best_other_vendor"]
        assert r["best_confidence"] == max(o["score"] for o in offers)
        for o in offers:
            b = o["breakdown"]
            assert b["upc"] == (0, 40, "missing") and b["name"]["max"] == 20 and b["pack_size"]["max"] == 25
            assert b["name"]["points"] == round(difflib.SequenceMatcher(None, clean(r["baseline_product"]), clean(o["product_name"])).ratio() * 20)
            same = (r["brand"] or "").strip().lower(), (brands[o["product_id"]] or "").strip().lower()
            assert (b["brand"]["outcome"] == "exact") == (same[0] == same[1] != "")
            assert o["score"] == min(100, sum(b[c]["points"] for c in ("upc", "brand", "pack_size", "name")))
