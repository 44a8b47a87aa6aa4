"""Registered queries: match confidence (rows-only where difflib similarity is involved)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelens.operators import confidence as CF
from pricelens.operators import deals as D
from pricelens.plans.q_catalog import unit_price_sql
from pricelens.plans.q_deals import _deals_sql
from pricelens.plans.registry import BASELINE, V, query
from pricelens.session import ensure_checkpoint_dir

_BNU = unit_price_sql(price="price", ppo=None, pc=None, us=None, um=None, raw="pack")


@query("udf_confidence_level", """
SELECT product_id, CAST(product_id % 101 AS INTEGER) AS score,
       CASE WHEN product_id % 101 >= 75 THEN 'high' WHEN product_id % 101 >= 45 THEN 'medium'
            WHEN product_id % 101 >= 25 THEN 'low' ELSE 'poor' END AS level,
       CASE WHEN product_id % 101 >= 75 THEN 'Strong Match' WHEN product_id % 101 >= 45 THEN 'Likely Match'
            WHEN product_id % 101 >= 25 THEN 'Weak Match' ELSE 'Poor Match' END AS label
FROM products""")
def q_confidence_level(spark, sf):
    p = V(spark, sf)["products"].select("product_id", (F.col("product_id") % 101).cast("int").alias("score"))
    level, label = CF.confidence_level(F.col("score"))
    return p.withColumn("level", level).withColumn("label", label)


@query("udf_match_confidence")
def q_match_confidence(spark, sf):
    v = V(spark, sf)
    s = CF.deal_confidence(v["products"], v["vendors"], BASELINE, 10)
    return s.select("bid", "m_product_id", "upc_points", "brand_points", "pack_points", "name_points", "score",
                    "level")


_PAIRS = """p AS (SELECT a.product_id, a.vendor_id, a.sku, a.upc, a.brand, a.product_id % 4 AS n, a.product_id % 3 AS size,
  CASE a.product_id % 5 WHEN 0 THEN '' WHEN 1 THEN ' OZ' WHEN 2 THEN 'oz' ELSE 'lb' END AS measure FROM products a),
x AS (SELECT o.product_id, b.n AS bn, b.size AS bs, lower(trim(b.measure)) AS bm, o.n, o.size, lower(trim(o.measure)) AS m,
  trim(coalesce(b.upc, '')) AS bu, trim(coalesce(o.upc, '')) AS u, lower(trim(coalesce(b.brand, ''))) AS bb, lower(trim(coalesce(o.brand, ''))) AS br
  FROM p o JOIN p b ON o.sku = b.sku AND b.vendor_id = (SELECT min(vendor_id) FROM p c WHERE c.sku = b.sku))"""


@query("udf_native_points", f"""WITH {_PAIRS}
SELECT product_id, CASE WHEN u <> '' AND u = bu THEN 40 ELSE 0 END AS upc_points,
  CASE WHEN bb = '' OR br = '' THEN 0 WHEN bb = br THEN 15 WHEN contains(br, bb) OR contains(bb, br) THEN 10 ELSE 0 END AS brand_points,
  CASE WHEN bn = 0 OR n = 0 OR bs = 0 OR size = 0 OR bm = '' OR m = '' THEN 0 WHEN bn = n AND bs = size AND bm = m THEN 25
       WHEN bn = n THEN 15 WHEN bm = m THEN 10 ELSE 5 END AS pack_points FROM x""")
def q_native_points(spark, sf):
    """UPC, brand and structured-pack points of every offer against the item's offer of the first vendor."""
    p = V(spark, sf)["products"]
    measure = F.when(F.col("product_id") % 5 == 0, "").when(F.col("product_id") % 5 == 1, " OZ").when(F.col("product_id") % 5 == 2, "oz").otherwise("lb")
    p = p.select("product_id", "vendor_id", "sku", "upc", "brand", (F.col("product_id") % 4).alias("pack_count"),
                 (F.col("product_id") % 3).alias("unit_size"), measure.alias("unit_measure"))
    cols = ["upc", "brand", "pack_count", "unit_size", "unit_measure"]
    base = p.groupBy("sku").agg(F.min_by(F.struct(*cols), "vendor_id").alias("a")).select("sku", *[F.col(f"a.{c}").alias(f"a_{c}") for c in cols])
    pairs = p.join(base, "sku").select("product_id", *[f"a_{c}" for c in cols], *[F.col(c).alias(f"b_{c}") for c in cols],
                                       *[F.lit("").alias(f"{s}_{c}") for s in "ab" for c in ("pack_size_raw", "product_name")])
    return CF.match_confidence(pairs).select("product_id", "upc_points", "brand_points", "pack_points")


@query("udf_pack_points")
def q_pack_points(spark, sf):
    """Pack-text points of the distinct pairs of ``udf_seq_ratio``: how many pairs get each, and for how many the bounds had to be verified."""
    p = V(spark, sf)["products"]
    base = p.filter(F.col("vendor_id") == 0).select("sku", F.col("pack_size_raw").alias("a"))
    pairs = p.select("sku", F.col("pack_size_raw").alias("b")).join(base, "sku").select("a", "b").where("a is not null and b is not null").distinct()
    points, verified = CF.pack_points(F.col("a"), F.col("b"))
    return pairs.select(points.alias("points"), verified.alias("verified")).groupBy("points").agg(
        F.count(F.lit(1)).alias("pairs"), F.sum(F.col("verified").cast("int")).alias("verified"))


@query("udf_seq_ratio")
def q_seq_ratio(spark, sf):
    """Pack-string similarity between every offer and the same item's baseline-vendor offer."""
    p = V(spark, sf)["products"]
    base = p.filter(F.col("vendor_id") == 0).select("sku", F.col("pack_size_raw").alias("a"))
    pairs = p.select("product_id", "sku", F.col("pack_size_raw").alias("b")).join(base, "sku")
    return CF.with_pair_metric(pairs, "a", "b", "ratio", CF.seq_ratio)


@query("joi_top_deals_confidence")
def q_top_deals_confidence(spark, sf):
    v = V(spark, sf)
    return D.top_deals(v["products"], v["vendors"], BASELINE, limit=25, sort_by="confidence")


@query("joi_deal_details")
def q_deal_details(spark, sf):
    """Every deal of the baseline vendor, whole: normalised baseline price, best confidence, and all kept offers with theirs."""
    v = V(spark, sf)
    return D.deal_details(v["products"], v["vendors"], BASELINE, limit=None)


@query("joi_deal_baselines", _deals_sql("") + f"""
SELECT * EXCLUDE (price, pack), {_BNU['price_per_oz']} AS baseline_norm_price_per_oz, {_BNU['normalization']} AS baseline_normalization
FROM (SELECT bid, baseline_price, baseline_pack_size, vendor_count, baseline_price AS price, baseline_pack_size AS pack FROM deals) t""",
       views=["products", "vendors"])
def q_deal_baselines(spark, sf):
    """The part of the deals' details that SQL can say: the normalised baseline price, and how many offers were kept."""
    v = V(spark, sf)
    d = D.deal_details(v["products"], v["vendors"], BASELINE, limit=None)
    return d.select("bid", "baseline_price", "baseline_pack_size", F.size("all_vendors").cast("bigint").alias("vendor_count"),
                    "baseline_norm_price_per_oz", "baseline_normalization")


@query("joi_matrix_confidence")
def q_matrix_confidence(spark, sf):
    """Price-matrix offers scored against the group's baseline offer (vendor name in the brand slot)."""
    v = V(spark, sf)
    m = D.price_matrix(v["products"], v["vendors"], "oz", BASELINE, limit=None)
    m = m.filter(F.col("baseline_product").isNotNull() & (F.col("vendor_slug") != BASELINE))
    pairs = m.select("group_key", "vendor_slug",
                     F.col("baseline_product.product_name").alias("a_product_name"),
                     F.col("baseline_product.vendor_name").alias("a_brand"),
                     F.col("baseline_product.upc").alias("a_upc"),
                     F.col("baseline_product.pack_size_raw").alias("a_pack_size_raw"),
                     F.col("product_name").alias("b_product_name"), F.col("vendor_name").alias("b_brand"),
                     F.col("upc").alias("b_upc"), F.col("pack_size").alias("b_pack_size_raw"))
    ensure_checkpoint_dir(spark)
    pairs = pairs.checkpoint()  # scores read the pairs several times; the matrix is made once
    return CF.match_confidence(pairs).select("group_key", "vendor_slug", "upc_points", "brand_points",
                                             "pack_points", "name_points", "score", "level")
