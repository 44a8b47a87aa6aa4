"""File readers / writers round trips and multi-micro-batch streaming."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from pricelens.operators import state as S
from pricelens.plans.fixtures import raw_table, register_views
from pricelens.sinks import export as X
from pricelens.sources import feeds as SF
from pricelens.sources import pages as PG
from pricelens.sources import records as RC
from pricelens.streaming import jobs as J
from tests.conftest import SF_SMALL


def test_catalog_csv_coerces_numbers_and_flags(spark, tmp_path):
    p = tmp_path / "cat.csv"
    head = ",".join(SF.LEGACY_COLUMNS)
    row1 = ["Snacks", "Food", "Acme", "Chips", "", "0123", "1200.5", "", "9.5", "0.3", "12/8 oz", "60", "3", "1",
            "Yes", "No", "Yes", "Food", "Snacks, Chips", "17", "https://x/p/1"]
    row2 = ["Snacks", "Food", "", "Dip", "d", "", "n/a", "5", "", "", "", "x", "", "", "No", "Yes", "No", "", "", "18",
            ""]
    import csv
    with open(p, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(head.split(","))
        w.writerow(row1)
        w.writerow(row2)
    rows = SF.read_catalog_csv(spark, str(p)).orderBy("product_id").collect()
    assert rows[0]["delivered_price"] == 1200.5 and rows[0]["mixed_pallet"] is True
    assert rows[0]["description"] is None and rows[0]["product_id"] == 17
    assert rows[1]["delivered_price"] is None and rows[1]["cases_per_pallet"] is None
    assert rows[1]["available"] is True and rows[1]["manufacturer"] is None


def _page(count, nxt, results):
    return {"count": count, "next": nxt, "previous": None, "results": results}


def test_product_pages_marketplace_mapping_and_audit(spark, tmp_path):
    rec = {"id": 7, "name": "Beans", "upc": "", "brand_name": "Acme-EP", "case_per_pallet": "60",
           "pack_size": "12/8 oz", "slug": "beans", "min_pallet_quantity": "1,200", "is_available": True,
           "lead_time_days": "3.0", "for_mixed_pallet": False, "has_promo": True, "delivered_price": "1,200.00",
           "delivered_case_price": "20", "per_unit_delivered_price": "1.67", "per_oz_delivered_price": "0.21",
           "plp_image_url": "https://img/b.jpg", "main_category": "Food", "sub_category": "Canned, Beans"}
    d = tmp_path / "pages"
    d.mkdir()
    (d / "p1.json").write_text(json.dumps(_page(450, "next", [rec, dict(rec, id=8)]), indent=1))
    (d / "p3.json").write_text(json.dumps(_page(450, None, [dict(rec, id=9)]), indent=1))
    recs = SF.read_product_pages(spark, str(d))
    assert recs.count() == 3
    m = SF.standardize_marketplace(recs, "https://shop.example", category=F.lit("Canned")).orderBy("sku").collect()
    assert m[0]["sku"] == "7" and m[0]["brand"] == "Acme" and m[0]["unit_price"] == 1.67
    assert m[0]["bulk_price"] == 1200.0 and m[0]["min_order_qty"] is None and m[0]["lead_time_days"] == 3
    assert m[0]["image_url"] == "https://img/b.jpg" and m[0]["product_url"] == "https://shop.example/product/beans"
    c = SF.standardize_marketplace(recs, "https://shop.example", category=F.lit("Canned"), compat=True).first()
    assert c["unit_price"] == 1200.0 and c["image_url"] == ""
    leg = SF.standardize_legacy(recs, "https://shop.example", F.lit("Canned"), F.lit("Food")).first()
    assert leg["manufacturer"] == "Acme" and leg["has_promo"] == "Yes" and leg["price_per_unit"] == "1.67"
    got = spark.createDataFrame([("Canned", 1, 450, 200), ("Canned", 3, 450, 50), ("Dry", 1, 10, 10)],
                                "category string, page_no int, declared_count int, rows int")
    a = {r["category"]: r for r in SF.audit_pages(got, 200).collect()}
    assert a["Canned"]["expected_pages"] == 3 and a["Canned"]["missing_pages"] == [2]
    assert a["Canned"]["complete"] is False and a["Dry"]["missing_pages"] == []


def test_taxonomy_and_food_tagging(spark, tmp_path):
    tax = {"shop_by_category": [{"name": "Food", "child": ["Snacks", "Canned Goods"]},
                                {"name": "Non-Food", "child": ["Household"]}],
           "shop_by_business": [{"name": "Office", "child": []}]}
    p = tmp_path / "tax.json"
    p.write_text(json.dumps(tax))
    t = SF.read_taxonomy(spark, str(p))
    assert t.count() == 4
    df = spark.createDataFrame([("Snacks",), ("Household",), ("Other",)], "category string")
    got = dict((r[0], r[1]) for r in SF.tag_food_type(df, t).select("category", "food_type").collect())
    assert got == {"Snacks": "Food", "Household": "Non-Food", "Other": "Unknown"}


def test_storefront_mapping(spark, tmp_path):
    feed = {"products": [
        {"id": 1, "title": "Tea", "handle": "tea", "vendor": None, "product_type": "Drinks",
         "body_html": "<p>Green <b>tea</b></p>", "variants": [{"price": "4.50", "sku": "", "available": False}],
         "images": [{"src": "https://i/t.jpg"}]},
        {"id": 2, "title": "Mug", "handle": "mug", "vendor": "Acme", "product_type": "",
         "body_html": None, "variants": [], "images": []}]}
    p = tmp_path / "store.json"
    p.write_text(json.dumps(feed))
    got = SF.standardize_storefront(SF.read_storefront(spark, str(p)), "House", "https://store.example") \
        .orderBy("product_name").collect()
    mug, tea = got
    assert tea["sku"] == "1" and tea["unit_price"] == 4.5 and tea["in_stock"] is False
    assert tea["description"] == "Green  tea" and tea["brand"] == "House"
    assert mug["unit_price"] is None and mug["in_stock"] is True and mug["image_url"] == ""


def test_product_page_jsonld_and_gtin(spark):
    ld = {"@type": "Product", "name": "Penne", "description": "Pasta", "packSizes": [["16 oz", "32 oz"]],
          "image": ["https://i/p.jpg"]}
    html1 = ('<html><script type="application/ld+json">{"@type": "Organization"}</script>'
             f'<script type="application/ld+json">{json.dumps(ld)}</script>'
             '<iframe class="externalIframeNutrition" src="https://n/x?GTIN=000761"></iframe></html>')
    html2 = '<html><h1>Rigatoni &amp; Co</h1><script type="application/ld+json">{broken</script></html>'
    html3 = '<html><h1>x</h1></html>'
    pages = spark.createDataFrame([(1, "https://b.example/pasta/penne/", html1), (2, "https://b.example/r", html2),
                                   (3, "https://b.example/x", html3)], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in PG.extract_product_pages(pages, brand="Brand", sku_prefix="brand").collect()}
    assert set(got) == {1, 2}
    assert got[1]["sku"] == "761" and got[1]["upc"] == "761" and got[1]["product_name"] == "Brand Penne"
    assert got[1]["description"] == "Pack size: 16 oz | Pasta" and got[1]["image_url"] == "https://i/p.jpg"
    assert got[2]["sku"] == "brand-r" and got[2]["product_name"] == "Brand Rigatoni & Co"


def test_tiles_rule_table(spark):
    html = ('<div class="tile"><h3>Cola 12pk</h3><span class="price">$5.99</span><a href="/products/cola-12">x</a>'
            '<img src="/i/c.jpg"></div><div class="tile"><h3>Lime current price $1.25</h3>'
            '<span class="price">1,001.50/ea</span><a href="/shop?id=123">y</a></div>')
    pages = spark.createDataFrame([(1, "https://shop.example/c/drinks", html)], "page_id long, url string, html string")
    rules = spark.createDataFrame([("shop.example", r'(?s)<div class="tile">(.*?)</div>', r"<h3>(.*?)</h3>",
                                    r'class="price">([^<]*)<', r'href="([^"]*)"', r'src="([^"]*)"',
                                    "https://shop.example", "shop")],
                                  "site string, tile string, name string, price string, link string, image string, "
                                  "base_url string, sku_prefix string")
    got = PG.extract_tiles(pages, rules).orderBy("tile_pos").collect()
    assert [(r["product_name"], r["unit_price"], r["sku"]) for r in got] == \
        [("Cola 12pk", 5.99, "cola-12"), ("Lime", 1001.5, "123")]
    assert got[0]["image_url"] == "https://shop.example/i/c.jpg" and got[1]["image_url"] == ""


def test_sku_fallbacks_and_price_text(spark):
    df = spark.createDataFrame([("https://c.example/item.product.100.html", "A"), ("/p/12345", "B"),
                                ("/x", "Big Soup!"), (None, None)], "u string, n string")
    got = [r[0] for r in PG.derive_sku(df, url="u", name="n", prefix="c",
                                       patterns=[r"\.product\.(\d+)\.html", r"/(\d{4,})\.html", r"/(\d{4,})"])
           .select("sku").collect()]
    assert got == ["100", "12345", "c-big-soup-", None]
    t = spark.createDataFrame([("$12.99",), ("12.99/ea",), ("$1,234.50",), ("",), ("free",), ("$12.99\n$10",),
                               (" $3",)], "t string")
    assert [r[0] for r in t.select(PG.price_col("t")).collect()] == [12.99, 12.99, 1234.5, None, None, 12.99, 3.0]


def test_align_upload(spark):
    up = spark.createDataFrame([("Beans", "Acme", "1.5", "x")], "`Item Name` string, Brand string, `Unit Price` string, extra string")
    got = RC.align_upload(up, ["product", "manufacturer", "price_per_unit", "upc"])
    assert got.columns == ["product", "manufacturer", "price_per_unit", "upc"]
    assert tuple(got.first()) == ("Beans", "Acme", 1.5, None)
    bad = spark.createDataFrame([("Beans", "N/A", " 3 ")], "name string, `Unit Price` string, leadtime string")
    schema = spark.createDataFrame([], "product string, price_per_unit double, lead_time_days int, cases_per_pallet int").schema
    got = RC.align_upload(bad, schema)
    assert tuple(got.first()) == ("Beans", None, 3, None) and got.schema.simpleString() == schema.simpleString()
    merged = S.merge_upload(spark.createDataFrame([(7, "x", 1.0)], "product_id long, product string, price_per_unit double"),
                            spark.createDataFrame([("y", "N/A"), ("z", "2.5")], "product string, price_per_unit string"), "f.csv", "2026-12-01")
    assert sorted((r["product_id"], r["product"], r["price_per_unit"]) for r in merged.collect()) == [(7, "x", 1.0), (8, "y", None), (9, "z", 2.5)]
    only_text = spark.createDataFrame([(1, "Soap")], "qty int, label string")
    assert RC.align_upload(only_text, ["product"]).first()[0] == "Soap"
    with pytest.raises(ValueError):
        RC.align_upload(spark.createDataFrame([(1,)], "qty int"), ["product"])


def test_exports_round_trip(spark, tmp_path):
    v = register_views(spark, SF_SMALL)
    out = X.export_products(v["products"], v["vendors"], str(tmp_path / "p"), slug="supplier-000000003")
    back = spark.read.csv(out, header=True)
    assert back.count() == v["products"].filter("vendor_id = 3").count()
    names = [r[0] for r in back.select("product_name").collect()]
    assert names == sorted(names)
    with pytest.raises(ValueError):
        X.export_products(v["products"], v["vendors"], str(tmp_path / "e"), slug="no-such-vendor")
    rep = X.export_report(v["catalog"], str(tmp_path / "r"))
    assert "Price/Unit" in spark.read.csv(rep, header=True).columns
    p1 = X.write_checkpoint(v["catalog"], str(tmp_path / "ck"))
    p2 = X.write_checkpoint(v["catalog"], str(tmp_path / "ck"))
    assert p1 != p2 and spark.read.parquet(p2).count() == v["catalog"].count()


def test_stream_quota_over_many_batches_equals_batch(spark, tmp_path):
    ev = raw_table(spark, SF_SMALL, "events")
    days = [r[0] for r in ev.select(F.to_date("ts")).distinct().orderBy(1).collect()]
    src = tmp_path / "events"
    for i in range(4):  # files of some days each, in time order
        ev.filter(F.to_date("ts").isin(days[i * len(days) // 4:(i + 1) * len(days) // 4])).coalesce(1).write.parquet(str(src / f"d{i}"))
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(str(src / "*"))
    J.stream_quota(spark, stream, str(tmp_path / "q"), str(tmp_path / "ck"), 2).awaitTermination()
    out = J.quota_rows(spark, str(tmp_path / "q"))
    got = sorted((r[0], r[1], r[2]) for r in out.select("event_id", "allowed", "count_today").collect())
    want = sorted((r[0], r[1], r[2]) for r in S.quota(ev, 2).select("event_id", "allowed", "count_today").collect())
    assert got == want and out.filter("late").count() == 0


QUOTA_EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string"


def test_stream_quota_marks_late_requests(spark, tmp_path):
    for i, day in enumerate([1, 5, 6, 1, 7]):  # the fourth file is of a day that is over
        spark.createDataFrame([(i, dt.datetime(2024, 1, day, 3), 7, "scrape")], QUOTA_EVENTS).coalesce(1).write.parquet(str(tmp_path / "ev" / f"f{i}"))
    stream = spark.readStream.schema(QUOTA_EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "ev" / "*"))
    J.stream_quota(spark, stream, str(tmp_path / "q"), str(tmp_path / "ck"), 2).awaitTermination()
    got = sorted((r["event_id"], r["allowed"], r["count_today"], r["late"]) for r in J.quota_rows(spark, str(tmp_path / "q")).collect())
    assert got == [(0, True, 1, False), (1, True, 1, False), (2, True, 1, False), (3, False, None, True), (4, True, 1, False)]


def test_quota_counts_go_on_over_batches_and_replays(spark, tmp_path):
    """Files of one day out of order, null users, a batch repeated, and one that was written but not committed."""
    at = lambda h: dt.datetime(2024, 1, 1, h)
    batches = [[(1, at(9), 7, "a"), (2, at(8), 7, "a"), (3, at(9), None, "a")], [(4, at(1), 7, "a"), (5, at(2), 7, "a"), (6, at(2), None, "a"), (7, at(3), 8, "a")]]
    frames = [spark.createDataFrame(b, QUOTA_EVENTS) for b in batches]
    root = str(tmp_path / "q")
    J.quota_batch(spark, frames[0], 0, root, 3)
    J.quota_batch(spark, frames[0], 0, root, 3)
    first = J.quota_rows(spark, root).count()
    commit, J.BucketTable.begin = J.BucketTable.begin, _begin_without_commit(J.BucketTable.begin)
    try:
        with pytest.raises(RuntimeError, match="crash"):
            J.quota_batch(spark, frames[1], 1, root, 3)
    finally:
        J.BucketTable.begin = commit
    assert first == 3 and J.quota_rows(spark, root).count() == 3
    J.quota_batch(spark, frames[1], 1, root, 3)
    got = {r["event_id"]: (r["allowed"], r["count_today"]) for r in J.quota_rows(spark, root).collect()}
    assert got == {2: (True, 1), 1: (True, 2), 3: (True, 1), 4: (True, 3), 5: (False, 3), 6: (True, 2), 7: (True, 1)}


def _begin_without_commit(begin):
    def wrapped(*a, **k):
        change = begin(*a, **k)

        def crash():
            raise RuntimeError("crash")
        change.commit = crash
        return change
    return wrapped


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    """A batch on one bucket leaves the files of the others; a replay, and a crash before the commit, change nothing."""
    obs = register_views(spark, SF_SMALL)["observations"].drop("run_id")
    root = str(tmp_path / "snap")
    table = J.BucketTable(spark, root, S.KEY, 8)
    key = obs.select(*S.KEY).orderBy(*S.KEY).first()
    one = obs.filter((F.col("vendor_id") == key[0]) & (F.col("sku") == key[1]))
    last = one.agg(F.max("captured_at")).first()[0]
    later = one.limit(1).withColumn("captured_at", F.lit(last + dt.timedelta(days=1))).withColumn("unit_price", F.lit(1.23).cast("decimal(12,4)"))
    J.upsert_batch(spark, obs, 0, root, buckets=8)
    before, rows = table.head().paths, sorted(map(str, table.current().collect()))
    begin, J.BucketTable.begin = J.BucketTable.begin, _begin_without_commit(J.BucketTable.begin)
    try:
        with pytest.raises(RuntimeError, match="crash"):
            J.upsert_batch(spark, later, 1, root, buckets=8)
    finally:
        J.BucketTable.begin = begin
    assert table.head().paths == before and sorted(map(str, table.current().collect())) == rows
    J.upsert_batch(spark, later, 1, root, buckets=8)
    after = table.head().paths
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1
    moved = table.current().filter((F.col("vendor_id") == key[0]) & (F.col("sku") == key[1])).first()
    assert float(moved["unit_price"]) == 1.23 and table.current().count() == len(rows)
    J.upsert_batch(spark, later, 1, root, buckets=8)
    assert table.head().paths == after
    with pytest.raises(ValueError, match="8 buckets"):
        J.current_snapshot(spark, root, buckets=16)


def test_appends_are_idempotent_and_days_are_pruned(spark, tmp_path):
    from pricelens.sinks.append import append_by_date, read_by_date
    rows = spark.createDataFrame([(i, dt.datetime(2024, 1, 1 + i % 3, 5)) for i in range(30)], "x int, captured_at timestamp_ntz")
    root = str(tmp_path / "h")
    append_by_date(rows.filter("x < 20"), root, "captured_at", "run-1")
    append_by_date(rows.filter("x >= 20"), root, "captured_at", "run-2")
    append_by_date(rows.filter("x >= 20"), root, "captured_at", "run-2")
    assert sorted(r["x"] for r in read_by_date(spark, root).collect()) == list(range(30))
    day = read_by_date(spark, root, "2024-01-02", "2024-01-02")
    assert sorted(r["x"] for r in day.collect()) == [i for i in range(30) if i % 3 == 1]
    plan = day._jdf.queryExecution().executedPlan().toString()
    months = str(tmp_path / "m")
    append_by_date(rows, months, "captured_at", "run-1", unit="month")
    got = read_by_date(spark, months, "2024-01-02", "2024-01-02", at="captured_at", unit="month")
    assert sorted(r["x"] for r in got.collect()) == [i for i in range(30) if i % 3 == 1]
    assert "PartitionFilters" in plan and "day" in plan.split("PartitionFilters")[1].split("]")[0]


def test_upsert_batches_are_applied_once_and_read_errors_are_errors(spark, tmp_path):
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException

    obs = register_views(spark, SF_SMALL)["observations"].drop("run_id").filter("vendor_id < 3")
    root = str(tmp_path / "snap")
    half = [obs.filter("run_line <= 2"), obs.filter("run_line > 2")]
    J.upsert_batch(spark, half[0], 0, root, source="a")
    J.upsert_batch(spark, half[0], 0, root, source="a")      # replayed
    J.upsert_batch(spark, half[1], 0, root, source="b")      # a new checkpoint begins at 0 again
    log = spark.read.parquet(os.path.join(root, "_log")).select("version", "source").distinct().orderBy("version").collect()
    assert [(r["version"], r["source"]) for r in log] == [(0, "a"), (1, "b")]
    assert J.current_snapshot(spark, root).count() == S.snapshot(obs).count()
    part = next(p for p in os.listdir(os.path.join(root, "_log")) if p.startswith("part-"))
    with open(os.path.join(root, "_log", part), "wb") as f:
        f.write(b"broken")
    with pytest.raises((PySparkException, Py4JJavaError)):
        J.upsert_batch(spark, half[1], 1, root, source="b")


def test_stream_upsert_over_many_batches_equals_snapshot(spark, tmp_path):
    obs = register_views(spark, SF_SMALL)["observations"].drop("run_id")
    years = [r[0] for r in obs.select(F.year("captured_at")).distinct().orderBy(1).collect()]
    src = tmp_path / "obs"
    for y in years:
        obs.filter(F.year("captured_at") == y).coalesce(1).write.parquet(str(src / f"y{y}"))
    stream = spark.readStream.schema(obs.schema).option("maxFilesPerTrigger", 1).parquet(str(src / "*"))
    root = str(tmp_path / "snap")
    J.stream_upsert(spark, stream, root, str(tmp_path / "ck")).awaitTermination()
    cols = ["vendor_id", "sku", "unit_price", "last_price", "price_changed", "first_seen_at", "last_seen_at"]
    got = sorted(tuple(r) for r in J.current_snapshot(spark, root).select(*cols).collect())
    want = sorted(tuple(r) for r in S.snapshot(obs).select(*cols).collect())
    assert got == want
    assert spark.read.parquet(os.path.join(root, "_log")).select("version").distinct().count() == len(years)


def test_stream_pulse_drops_replayed_events(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    ev = spark.createDataFrame([(1, "a", t, 1, 1, 10, 12, 0), (1, "a", t, 1, 1, 10, 12, 1), (1, "b", t, 1, 2, 0, 5, 1)],
                               "vendor_id long, sku string, captured_at timestamp_ntz, run_seq long, run_line int, "
                               "old_price int, new_price int, batch_id long")
    d = tmp_path / "ev"
    ev.write.parquet(str(d / "part-0"))
    stream = spark.readStream.schema(ev.schema).parquet(str(d / "*"))
    out = J.run_to_table(spark, J.stream_pulse(stream), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert [(r["sku"], r["severity"], r["amount"], r["pct"]) for r in out.collect()] == [("a", "negative", 2.0, 20.0)]
