"""The stored name index: searches against the scan, updates against a rebuild, repeated and broken-off loads."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from pricelens.operators import filters as FL
from pricelens.operators import matching as M
from pricelens.sinks.nameindex import NameIndex, term_grams

NAMES = ["Spring Water 12oz", "spring water 12OZ", "Ring Bologna", "100% Juice", "100 Juice", "ab", "A", "", None, "a_b c", "Crème Brûlée Ring",
         "ΣΊΣΥΦΟΣ oil", "straße ring", "İstanbul mix", "string_ring%", "x" * 5000 + " ring", "back\\slash"]


@pytest.fixture()
def offers(spark):
    rows = [(i, n) for i, n in enumerate(NAMES)] + [(100 + i, n) for i, n in enumerate(NAMES[:3])]
    return spark.createDataFrame(rows, "product_id long, product_name string")


def postings(index):
    return sorted((r["tri"], r["lname"]) for r in index.postings().distinct().collect())


def test_search_gives_the_rows_of_the_scan(spark, offers, tmp_path):
    index = NameIndex(spark, str(tmp_path), buckets=8)
    index.update(offers, "a")
    for term in ["ring", "RING", "Spring W", "0% j", "100_juice", "ab", "a", "_", "%", "crème", "ΣΟΣ", "σίσ", "ring%b", "xxxx ring", "İst", "none such", "  ring ", "", None,
                 "the quick brown fox jumps over the lazy dog and runs on and on through the whole long winter night"]:
        want = sorted(r["product_id"] for r in FL.search_name(offers, term).collect())
        assert sorted(r["product_id"] for r in FL.search_indexed(offers, index, term).collect()) == want, term
    assert FL.search_indexed(offers, index, "ring").columns == offers.columns


def test_search_reads_the_buckets_of_its_trigrams_only(spark, offers, tmp_path):
    index = NameIndex(spark, str(tmp_path), buckets=64)
    index.update(offers, "a")
    assert term_grams("Ring") == ["ing", "rin"] and term_grams("ri") == term_grams("r%ng") == term_grams("Ünï") == []
    files = index.postings(["ing", "rin"]).select(F.input_file_name().alias("f")).distinct().collect()
    assert {os.path.dirname(os.path.dirname(r["f"])).rsplit("=")[-1] for r in files} <= {
        str(r["b"]) for r in spark.createDataFrame([("ing",), ("rin",)], "tri string").select(index._bucket(F.col("tri")).alias("b")).collect()}
    plan = index.search("ring")._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters:")[1].split("DataFilters")[0].split("PushedFilters")[0]


def test_updates_equal_a_rebuild_and_leave_files_alone(spark, offers, tmp_path):
    whole, parts = NameIndex(spark, str(tmp_path / "w"), 8), NameIndex(spark, str(tmp_path / "p"), 8)
    whole.update(offers, "all")
    parts.update(offers.where("product_id < 6"), "one")
    before = {f: os.stat(f).st_mtime_ns for f in map(str, (tmp_path / "p").rglob("*.parquet"))}
    parts.update(offers, "two")
    parts.update(offers, "three")  # nothing is new
    assert postings(parts) == postings(whole)
    assert sorted(r["lname"] for r in parts.names().collect()) == sorted(r["lname"] for r in whole.names().collect())
    assert all(os.stat(f).st_mtime_ns == t for f, t in before.items())
    assert parts.postings().count() == len(postings(whole))


def test_repeated_and_broken_off_loads(spark, offers, tmp_path, monkeypatch):
    index, whole = NameIndex(spark, str(tmp_path / "i"), 8), NameIndex(spark, str(tmp_path / "w"), 8)
    whole.update(offers, "all")
    index.update(offers.where("product_id < 3"), "one")
    write = NameIndex._replace

    def crash(rows, path, by):
        if path.endswith("names"):
            raise RuntimeError("lost")
        write(rows, path, by)

    monkeypatch.setattr(NameIndex, "_replace", staticmethod(crash))
    with pytest.raises(RuntimeError):
        index.update(offers, "two")
    monkeypatch.setattr(NameIndex, "_replace", staticmethod(write))
    index.update(offers, "two")
    index.update(offers, "two")
    assert index.postings().count() == len(postings(whole)) and postings(index) == postings(whole)
    assert sorted(r["lname"] for r in index.names().collect()) == sorted(r["lname"] for r in whole.names().collect())


def test_keyword_matches_over_the_index(spark, offers, tmp_path):
    """Also with names that no offer has any more, and with postings that another load left twice."""
    index = NameIndex(spark, str(tmp_path), 8)
    index.update(spark.createDataFrame([("old spring water",), ("ring",)], "product_name string"), "old")
    index.update(offers, "new")
    again = index.postings().withColumn("bucket", index._bucket(F.col("tri"))).withColumn("load", F.lit("broken"))
    index._replace(again, index.posting_path, ["bucket", "load"])
    sets = spark.createDataFrame([(1, "ring water"), (1, "ring"), (2, "juice 100"), (2, "absent")], "b_vendor_id int, kws string")
    names = offers.select(F.lower("product_name").alias("lname")).where("lname is not null")
    want = M.name_matches(sets, names).collect()
    got = [r for r in M.name_matches(sets, names, index=index).collect() if r["lname"] not in ("old spring water", "ring")]
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(want) > 5


def test_empty_tables(spark, offers, tmp_path):
    index = NameIndex(spark, str(tmp_path), 8)
    assert index.search("ring").count() == 0 and index.search("r").count() == 0
    index.update(offers.limit(0), "none")
    assert index.search("ring").count() == 0 and FL.search_indexed(offers.limit(0), index, "ring").count() == 0
