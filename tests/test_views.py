"""The Spark text of the snapshot view against the text that the oracles use, on rows of its own."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricelens.plans import fixtures as FX
from pricelens.plans.registry import V
from tests.conftest import canon_rows


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Repeated parts and line items, equal order keys, null keys and values, parts and vendors that are not there."""
    d = str(tmp_path_factory.mktemp("views"))
    part = [(p, f"ring {p}", "Brand#4" if p % 2 else None, "MEDIUM", p, None if p == 5 else 900.0 + p) for p in range(1, 13)]
    part += [part[0], (2, "second price", "Brand#5", "LARGE", 3, 7.5), (None, "no key", None, None, None, 1.0)]
    day = lambda n: None if n % 13 == 0 else dt.datetime(2020, 1, 1 + n % 9)
    items = [(n % 45, None if n % 17 == 0 else n % 14, None if n % 11 == 0 else n % 3, n % 4, None if n % 19 == 0 else float(n % 7),
              0.05 if n % 2 else 0.0, "R" if n % 3 else "N", "O" if n % 5 else "F", day(n)) for n in range(600)]
    spark.createDataFrame(part, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").coalesce(1).write.parquet(f"{d}/part.parquet")
    spark.createDataFrame(items + items[:200], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_discount double, "
                          "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").coalesce(1).write.parquet(f"{d}/lineitem.parquet")
    return d


def test_snapshot_has_the_rows_of_its_sql(spark, tables):
    got = V(spark, tables)["products"]
    for name in ("items", "observations"):
        V(spark, tables)[name].createOrReplaceTempView(name)
    want = spark.sql(FX.VIEWS["products"])
    assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    # of rows equal in the window's order and unlike in a price any may come first, so the figures taken from them are left out
    sure = [c for c in got.columns if c not in ("unit_price", "in_stock", "mixed_pallet", "has_promo", "last_price", "price_changed")]
    rows = lambda df, cols: canon_rows(cols, [tuple(r) for r in df.select(*cols).collect()])
    assert rows(got, sure) == rows(want, sure) and got.count() > 30


def test_snapshot_shuffles_line_items_once_and_broadcasts_no_part(spark, tables):
    plan = V(spark, tables)["products"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(l_partkey") == 1
    assert "BroadcastExchange" not in plan and plan.count("Exchange") == 3


def test_snapshot_holds_one_offer_at_a_time(spark, tables):
    """The aggregate takes the window's order as it is: no hash map of all offers of a task, no second sort of them."""
    v = V(spark, tables)
    for df in (v["products"], v["products"].groupBy("vendor_id").agg(F.count("unit_price"), F.count_if("in_stock"))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortAggregate(key=[vendor_id") == 2
        assert not [x for x in plan.splitlines() if "HashAggregate" in x and "part_id" in x] and plan.count(" Sort [") == 1
