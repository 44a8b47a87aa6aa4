"""The deal reports read the catalog a fixed number of times, and vendors of the baseline do not multiply its matches."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pricelens.operators import confidence as CF
from pricelens.operators import deals as D
from pricelens.operators import matching as M
from tests.test_units import keyword_join_bruteforce

SCHEMA = ("product_id long, vendor_id long, sku string, product_name string, description string, unit_price decimal(12,4), "
          "case_price decimal(12,4), pack_size_raw string, upc string, category string, brand string, image_url string, "
          "product_url string, in_stock boolean")
NAMES = ["Blue Ring Large", "Blue Ring Larger 4 oz", "Hot Spring Water", "Hot Spring Water 2 oz"]


@pytest.fixture(scope="module")
def catalog(spark):
    """Twelve vendors, the first six under one slug; in some names they are the cheapest, with many offers."""
    data = [(v * 1000 + i, v, f"s{v}-{i}", NAMES[i % 4], None, Decimal(1 + (v * 7 + i * 5) % 23) / 4, None, "4 oz", None, "c", "b", None, None, True)
            for v in range(12) for i in range(24)]
    vendors = [(v, "base" if v < 6 else f"shop-{v}", f"Vendor {v}") for v in range(12)]
    return spark.createDataFrame(data, SCHEMA).repartition(4), spark.createDataFrame(vendors, "vendor_id long, slug string, name string")


@pytest.mark.parametrize("write", [False, True])
@pytest.mark.parametrize("k", [1, 3, 40])
def test_kept_offers_are_the_best_at_other_vendors(spark, catalog, k, write):
    products, vendors = catalog
    base = M.match_keywords(D.baseline_rows(products, vendors, "base"))
    offers = D._offers(products, vendors).withColumn("vendor_slug", F.col("vendor_name"))  # a total order
    cols = ["bid", "m_product_id", "rank"]
    fast = M.keyword_join(base, offers, k, write=write).select(*cols)
    slow = keyword_join_bruteforce(base, offers, k).select(*cols)
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect()))


def test_lowest_price_leaves_the_own_vendor_out(spark, catalog):
    products, vendors = catalog
    base = M.match_keywords(D.baseline_rows(products, vendors, "base"))
    offers = D._offers(products, vendors)
    slow = keyword_join_bruteforce(base, offers, None).groupBy("bid").agg(F.min("m_unit_price").alias("low"))
    fast = M.keyword_best_price(base, offers).select("bid", "best_other")
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect()))


def test_scores_read_the_catalog_twice(spark, catalog):
    """Once for the rows of the baseline vendor and once for the offers; before, every use of the matches read it again."""
    products, vendors = catalog
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    read = products.mapInArrow(counted, products.schema)
    n = products.count()
    scored = CF.deal_confidence(read, vendors, "base", 3)
    assert scored.count() > 0 and seen.value <= 2 * n
    seen.value = 0
    assert D.top_deals(read, vendors, "base", sort_by="confidence").count() == 25 and seen.value <= 2 * n


@pytest.mark.parametrize("sort_by", ["name", "savings", "baseline_price"])
@pytest.mark.parametrize("manual", [None, 2.5])
def test_limited_matrix_is_the_head_of_the_whole(spark, catalog, sort_by, manual):
    products, vendors = catalog
    made = lambda limit: D.price_matrix(products, vendors, "", "shop-7", manual, sort_by=sort_by, limit=limit)
    whole = [r.asDict() for r in made(None).drop("baseline_product").collect()]
    order = {"name": lambda r: r["display_name"].lower(), "savings": lambda r: -(r["max_savings"] or 0.0),
             "baseline_price": lambda r: float("inf") if r["baseline_price"] is None else r["baseline_price"]}[sort_by]
    first = [k for _, k in sorted({(order(r), r["group_key"]) for r in whole})][:2]
    got = [r.asDict() for r in made(2).drop("baseline_product").collect()]
    assert sorted(map(str, got)) == sorted(str(r) for r in whole if r["group_key"] in first) and len(got) > 2


def test_limited_matrix_leaves_groups_out_before_it_deals_their_texts(spark, catalog):
    """The filter to the groups shown lies below the first aggregate that carries an offer's texts."""
    products, vendors = catalog
    plan = D.price_matrix(products, vendors, "oz", "base", limit=2)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    texts = max(i for i, x in enumerate(plan) if "Aggregate" in x and "product_url" in x)
    assert any("LeftSemi" in x for x in plan[texts:]) and not any("LeftSemi" in x for x in plan[:texts])


def test_whole_matrix_deals_its_texts_once(spark, catalog):
    """One exchange carries the offers' texts; before, they were dealt by vendor (unless that was broadcast), by group and vendor, and by group."""
    products, vendors = catalog
    m = D.price_matrix(products, vendors, "oz", "base", limit=None)
    plan = m._jdf.queryExecution().executedPlan().toString().splitlines()
    dealt = [x for x in plan if "Exchange hashpartitioning(" in x]
    assert len(dealt) == 1 and "hashpartitioning(group_key" in dealt[0]
    below = plan[plan.index(dealt[0]) + 1:]
    assert any("Sort [group_key" in x for x in below)  # else equal texts do not stand together in the files
    assert m.count() > 0


@pytest.mark.parametrize("vendors_sent,group_offers", [(0, 1 << 17), (1 << 19, 8), (0, 8), (1 << 19, 0)])
def test_whole_matrix_of_large_groups_and_many_vendors(spark, catalog, monkeypatch, vendors_sent, group_offers):
    """The same rows whatever is sent out and whichever groups are large; keys may be null or come twice."""
    products, vendors = catalog
    odd = [(v * 1000 + 100 + i, v, None, n, None, None if i == 1 else Decimal(v + i), None, "4 oz", u, None, None, None, None, None)
           for v in (0, 3, 7, 99) for i, (n, u) in enumerate([("Odd one oz", "77"), ("Odd two oz", "77"), ("!", ""), ("", "8")])]
    odd.append((None, 5, None, "!!", None, Decimal(3), None, None, None, None, None, None, None, None))  # its group key is null
    products = products.unionByName(spark.createDataFrame([*odd, *odd], SCHEMA))
    vendors = vendors.unionByName(vendors.limit(2)).unionByName(spark.createDataFrame([(7, None, "No slug")], vendors.schema))
    rows = lambda: sorted(map(str, D.price_matrix(products, vendors, "", "base", limit=None).collect()))
    want = rows()
    assert any("group_key=None" in r for r in want) and any("group_key='upc:77'" in r for r in want)
    monkeypatch.setattr(D, "VENDORS_SENT", vendors_sent)
    monkeypatch.setattr(D, "GROUP_OFFERS", group_offers)
    assert rows() == want
    limited = sorted(map(str, D.price_matrix(products, vendors, "", "base", limit=10_000).collect()))
    assert limited == [r for r in want if "group_key=None" not in r]  # a limit never had the group without a key


def test_indexed_search_does_not_shuffle_the_rows_for_a_few_names(spark, catalog, tmp_path):
    from pricelens.operators.filters import search_indexed
    from pricelens.sinks.nameindex import NameIndex

    products, _ = catalog
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    index = NameIndex(spark, str(tmp_path), 8)
    index.update(products.mapInArrow(counted, products.schema), "a")
    assert seen.value == products.count()  # before: once for the postings and once for the names
    out = search_indexed(products, index, "spring")
    assert "BroadcastHashJoin" in out._jdf.queryExecution().sparkPlan().toString()
    assert out.count() == products.where("product_name ilike '%spring%'").count() > 0
