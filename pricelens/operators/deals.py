"""Deal finding against a baseline vendor, savings roll-ups, and the price matrix.

JOI-08 top_deals, JOI-09 deal_summary, JOI-10 savings_summary, JOI-11
category_savings, JOI-05/06/07 price matrix.  The reference loops over baseline
rows issuing one query each (and caps the baseline at 500 rows); here the
baseline is one DataFrame and the keyword join (``matching.keyword_join``)
finds every row's matches in one plan.

Money sums use the exact NUMERIC(12,4) values (decimal sums) and are cast to
double once, then rounded with the engine's rounding rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.functions.numeric import dbl, has_text, pround
from pricelens.functions.pack import normalize_name_col, normalize_unit_price
from pricelens.operators.filters import facet, search_name, vendor_ids
from pricelens.operators.matching import keyword_best_price, keyword_join, match_keywords
from pricelens.session import ensure_checkpoint_dir


def _offers(products: DataFrame, vendors: DataFrame) -> DataFrame:
    v = vendors.select("vendor_id", F.col("slug").alias("vendor_slug"), F.col("name").alias("vendor_name"))
    return products.filter(F.col("unit_price").isNotNull()).join(v, "vendor_id")


def baseline_rows(products: DataFrame, vendors: DataFrame, baseline_slug: str,
                  category: str | None = None, brand: str | None = None,
                  require_category: bool = False, cap: int | None = None) -> DataFrame:
    """Priced rows of the baseline vendor with a usable keyword set (bid = product_id).

    ``cap`` reproduces the reference's 500-row baseline cap (ordered by name);
    the default is the whole baseline.
    """
    # a predicate, not a semi-join: the costly keyword filter of the callers would be pushed below that, onto all offers
    ids = vendor_ids(vendors, baseline_slug).agg(F.collect_set("vendor_id").alias("ids")).scalar()
    b = products.filter(F.array_contains(ids, F.col("vendor_id")))
    b = facet(b.filter(F.col("unit_price").isNotNull()), category, brand)
    if require_category:
        b = b.filter(F.col("category").isNotNull())
    if cap:
        b = b.orderBy(F.col("product_name").asc_nulls_last(), "product_id").limit(cap)
    return b.withColumn("bid", F.col("product_id"))


def deal_matches(products: DataFrame, vendors: DataFrame, baseline_slug: str, k: int = 10,
                 category: str | None = None, brand: str | None = None,
                 require_category: bool = False, index=None, write: bool = False) -> tuple[DataFrame, DataFrame]:
    """(usable baseline rows, their top-k matches) for a baseline vendor.

    Only offers with a price above zero are ranked, so an unpriced one never takes a place.
    Pass the pair as ``matches`` to the reports below to plan it once for several of them.
    ``index``: a stored name index that has the names of ``products`` (see ``matching.name_matches``).
    ``write``: both, and the offers kept of each name, are written once to the session's checkpoint folder, so that
    what is made of them reads a few rows per baseline row and not the catalog again.
    """
    base = baseline_rows(products, vendors, baseline_slug, category, brand, require_category)
    base = base.filter(dbl("unit_price") > 0)
    base = match_keywords(base).filter(F.col("keywords").isNotNull())
    if write:
        ensure_checkpoint_dir(products.sparkSession)
        base = base.checkpoint()
    offers = _offers(products, vendors).filter(dbl("unit_price") > 0)
    m = keyword_join(base.select("bid", "vendor_id", "keywords"), offers, k,
                     offer_cols=("product_id", "vendor_id", "vendor_slug", "vendor_name", "sku",
                                 "unit_price", "product_name", "pack_size_raw", "case_price", "brand",
                                 "image_url", "product_url", "in_stock"), index=index, write=write)
    return base, m.checkpoint() if write else m


def deal_offers(products: DataFrame, vendors: DataFrame, baseline_slug: str, k: int = 10,
                matches: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Every kept match with its details, its normalised price and its price difference vs
    the baseline (flat all_vendors list)."""
    base, m = matches or deal_matches(products, vendors, baseline_slug, k, write=True)
    j = m.join(base.select("bid", F.col("unit_price").alias("bp")), "bid")
    diff = pround(dbl("m_unit_price") - dbl("bp"), 2)
    case = dbl("m_case_price")
    j = j.select("bid", F.col("m_product_id").alias("product_id"), F.col("m_vendor_slug").alias("vendor_slug"),
                 F.col("m_sku").alias("sku"), dbl("m_unit_price").alias("unit_price"), "rank",
                 F.col("m_product_name").alias("product_name"), F.when(case != 0, case).alias("case_price"),
                 F.col("m_pack_size_raw").alias("pack_size"), F.col("m_image_url").alias("image_url"),
                 F.col("m_product_url").alias("product_url"), F.col("m_in_stock").alias("in_stock"),
                 diff.alias("diff_vs_baseline"),
                 pround(diff / dbl("bp") * 100, 1).alias("pct_vs_baseline"))
    keep = j.columns
    n = normalize_unit_price(j, prefix="norm_", price="unit_price", price_per_oz=None, pack_count=None,
                             unit_size=None, unit_measure=None, pack_size_raw="pack_size")
    return n.select(*keep, "norm_price_per_oz", "normalization")


SORT_KEYS = {"savings_abs": "best_savings_abs", "price": "baseline_price",
             "confidence": "best_confidence", "savings_pct": "best_savings_pct"}


def top_deals(products: DataFrame, vendors: DataFrame, baseline_slug: str,
              category: str | None = None, brand: str | None = None, limit: int | None = 25,
              sort_by: str = "savings_pct", k: int = 10, confidence: DataFrame | None = None,
              matches: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Baseline products with at least one positive-priced match at another vendor:
    best other offer, savings (abs 2 dp, % 1 dp from the rounded abs), vendor count.

    ``confidence`` - optional (bid, best_confidence) frame (see confidence.py); taken from the
    matches when the order asks for it.
    """
    scores = confidence is None and sort_by == "confidence"
    base, m = matches or deal_matches(products, vendors, baseline_slug, k, category, brand, write=scores)
    if scores:
        from pricelens.operators.confidence import best_confidence, deal_confidence
        confidence = best_confidence(deal_confidence(products, vendors, baseline_slug, k, matches=(base, m)))
    best = m.groupBy("bid").agg(
        F.count(F.lit(1)).alias("vendor_count"),
        F.min_by(F.struct("m_unit_price", "m_vendor_name", "m_vendor_slug"), F.col("rank")).alias("b"))
    d = base.join(best, "bid")
    bp = dbl("unit_price")
    d = d.select(
        "bid", F.col("product_name").alias("baseline_product"), F.col("sku").alias("baseline_sku"),
        bp.alias("baseline_price"), F.col("image_url").alias("baseline_image"),
        F.col("product_url").alias("baseline_url"), F.col("in_stock").alias("baseline_in_stock"),
        "brand", "category", dbl("b.m_unit_price").alias("best_other_price"),
        F.col("b.m_vendor_name").alias("best_other_vendor"),
        F.col("b.m_vendor_slug").alias("best_other_vendor_slug"),
        pround(bp - dbl("b.m_unit_price"), 2).alias("best_savings_abs"),
        F.col("pack_size_raw").alias("baseline_pack_size"), "vendor_count")
    d = d.withColumn("best_savings_pct", pround(F.col("best_savings_abs") / F.col("baseline_price") * 100, 1))
    if confidence is not None:
        d = d.join(confidence, "bid", "left").withColumn(
            "best_confidence", F.coalesce("best_confidence", F.lit(0)))
    if limit:
        key = SORT_KEYS.get(sort_by, "best_savings_pct")
        o = F.col(key).asc() if sort_by == "price" else F.col(key).desc()
        d = d.orderBy(o, F.col("baseline_product").asc_nulls_last(), F.col("bid")).limit(limit)
    return d


def deal_details(products: DataFrame, vendors: DataFrame, baseline_slug: str,
                 category: str | None = None, brand: str | None = None, limit: int | None = 25,
                 sort_by: str = "savings_pct", k: int = 10, index=None) -> DataFrame:
    """``top_deals`` with what the finder shows of each: the normalised baseline price
    (``baseline_norm_price_per_oz``, ``baseline_normalization``), ``best_confidence``, and ``all_vendors``, the at most
    ``k`` kept offers by rank with their differences, normalised prices, confidence and its breakdown.

    The matches are written once, to the session's checkpoint folder; unless the order is by confidence only the
    offers of deals that stay are scored.
    """
    from pricelens.operators.confidence import best_confidence, breakdown, deal_confidence
    base, m = deal_matches(products, vendors, baseline_slug, k, category, brand, index=index, write=True)
    found = {"limit": limit, "sort_by": sort_by, "k": k}
    if sort_by == "confidence":
        scored = deal_confidence(products, vendors, baseline_slug, k, matches=(base, m)).checkpoint()  # texts are compared once
        deals = top_deals(products, vendors, baseline_slug, **found, confidence=best_confidence(scored), matches=(base, m)).drop("best_confidence")
        kept = m
    else:
        deals = top_deals(products, vendors, baseline_slug, **found, matches=(base, m))
        kept = m.join(deals.select("bid"), "bid", "left_semi") if limit else m
        scored = deal_confidence(products, vendors, baseline_slug, k, matches=(base, kept))
    score = scored.select("bid", "rank", F.col("m_vendor_name").alias("vendor_name"), "score", "level", "label", breakdown().alias("breakdown"))
    offers = deal_offers(products, vendors, baseline_slug, k, matches=(base, kept)).join(score, ["bid", "rank"])
    shown = F.struct("rank", "vendor_name", *[c for c in offers.columns if c not in ("bid", "rank", "vendor_name")])
    lists = offers.groupBy("bid").agg(F.max("score").alias("best_confidence"), F.sort_array(F.collect_list(shown)).alias("all_vendors"))
    out = normalize_unit_price(deals, prefix="baseline_norm_", price="baseline_price", price_per_oz=None, pack_count=None,
                               unit_size=None, unit_measure=None, pack_size_raw="baseline_pack_size")
    out = out.select(*deals.columns, "baseline_norm_price_per_oz", F.col("normalization").alias("baseline_normalization"))
    return out.join(lists, "bid")


def deal_summary(deals: DataFrame) -> DataFrame:
    cheaper = F.col("best_savings_abs") > 0
    return deals.agg(
        F.count(F.lit(1)).alias("total_compared"),
        F.count_if(cheaper).alias("cheaper_elsewhere"),
        F.count_if(F.col("best_savings_abs") < 0).alias("more_expensive_elsewhere"),
        F.coalesce(pround(F.sum(F.when(cheaper, F.col("best_savings_pct").cast("decimal(12,1)"))).cast("double")
                          / F.sum(F.when(cheaper, 1)), 1), F.lit(0.0)).alias("avg_savings_pct"))


def _savings_rows(products, vendors, baseline_slug, require_category, index=None):
    base = baseline_rows(products, vendors, baseline_slug, require_category=require_category)
    base = base.filter(dbl("unit_price") > 0)
    kw = match_keywords(base).filter(F.col("keywords").isNotNull())
    best = keyword_best_price(kw.select("bid", "vendor_id", "keywords"), _offers(products, vendors), index=index)
    # a row is compared when it had any match (best_other may still be null: all zero prices)
    rows = base.join(best, "bid", "left")
    bp = F.col("unit_price")
    best_p = F.coalesce(F.col("best_other"), bp)
    saving = F.when(F.col("_matched") & (best_p < bp), bp - best_p)
    return rows.select("bid", "category", bp.alias("bp"), F.coalesce("_matched", F.lit(False)).alias("compared"),
                       saving.alias("saving"))


def savings_summary(products: DataFrame, vendors: DataFrame, baseline_slug: str, index=None) -> DataFrame:
    """Total savings vs the cheapest priced match; spend over every priced baseline row."""
    r = _savings_rows(products, vendors, baseline_slug, False, index)
    a = r.agg(F.sum("saving").alias("_s"), F.sum("bp").alias("_spend"),
              F.sum(F.when(F.col("compared"), 1).otherwise(0)).cast("bigint").alias("products_compared"),
              F.sum(F.when(F.col("saving").isNotNull(), 1).otherwise(0)).cast("bigint")
              .alias("products_with_savings"))
    s, sp = F.coalesce(dbl("_s"), F.lit(0.0)), F.coalesce(dbl("_spend"), F.lit(0.0))
    return a.select(pround(s, 2).alias("total_savings"), "products_compared", "products_with_savings",
                    pround(sp, 2).alias("total_baseline_spend"),
                    F.when(sp > 0, pround(s / sp * 100, 1)).otherwise(F.lit(0.0)).alias("savings_pct"),
                    F.lit(baseline_slug).alias("baseline_vendor"))


def category_savings(products: DataFrame, vendors: DataFrame, baseline_slug: str,
                     limit: int | None = 15) -> DataFrame:
    """Savings per baseline category over compared rows only; top ``limit`` by savings."""
    r = _savings_rows(products, vendors, baseline_slug, True).filter(F.col("compared"))
    cat = F.when(F.col("category").isNull() | (F.col("category") == ""), F.lit("Uncategorized")) \
        .otherwise(F.col("category"))
    g = r.groupBy(cat.alias("category")).agg(
        F.count(F.lit(1)).alias("products_compared"),
        F.sum(F.when(F.col("saving").isNotNull(), 1).otherwise(0)).cast("bigint").alias("products_with_savings"),
        F.sum("saving").alias("_s"), F.sum("bp").alias("_spend"))
    s, sp = F.coalesce(dbl("_s"), F.lit(0.0)), dbl("_spend")
    out = g.select("category", "products_compared", "products_with_savings",
                   pround(s, 2).alias("total_savings"), pround(sp, 2).alias("total_baseline_spend"),
                   F.when(sp > 0, pround(s / sp * 100, 1)).otherwise(F.lit(0.0)).alias("savings_pct"))
    if limit:
        out = out.orderBy(F.col("total_savings").desc(), F.col("category")).limit(limit)
    return out


# ── price matrix (JOI-05..07) ────────────────────────────────────────────
def matrix_offers(products: DataFrame, vendors: DataFrame, search: str,
                  category: str | None = None, brand: str | None = None) -> DataFrame:
    p = facet(search_name(products, search), category, brand)
    v = vendors.select("vendor_id", F.col("slug").alias("vendor_slug"), F.col("name").alias("vendor_name"))
    return p.join(v, "vendor_id")


def matrix_groups(offers: DataFrame) -> DataFrame:
    """JOI-05: group key = 'upc:'+upc when upc is truthy, else the normalised name,
    else the sku (or id).  Adds ``group_key``."""
    name_key = normalize_name_col("product_name")
    key = (F.when(F.col("upc").isNotNull() & (F.col("upc") != ""), F.concat(F.lit("upc:"), F.col("upc")))
           .when(name_key != "", name_key)
           .otherwise(F.coalesce(F.col("sku"), F.col("product_id").cast("string"))))
    return offers.withColumn("group_key", key)


def vendors_in(offers: DataFrame) -> DataFrame:
    """JOI-07: distinct vendors present in a matrix result."""
    return offers.filter(has_text("vendor_slug")).select("vendor_slug", "vendor_name").dropDuplicates(
        ["vendor_slug"])


def _first_groups(offers: DataFrame, baseline_slug: str, manual_price: float | None, sort_by: str, limit: int) -> DataFrame:
    """(group_key) of the first ``limit`` groups of a matrix, from the columns its order needs."""
    if sort_by in ("savings", "baseline_price"):
        per = offers.groupBy("group_key", "vendor_slug").agg(
            F.max(F.struct("product_name", "product_id", dbl("unit_price").alias("price"))).getField("price").alias("price"))
        g = per.groupBy("group_key")
        if sort_by == "savings":
            g = g.agg(pround(F.max("price") - F.min("price"), 2).alias("_o"))
            o_ = F.coalesce(F.col("_o"), F.lit(0.0)).desc()
        else:
            own = F.lit(None if manual_price is None else float(manual_price)).cast("double")
            g = g.agg(F.coalesce(own, F.max(F.when(F.col("vendor_slug") == F.lit(baseline_slug), F.col("price")))).alias("_o"))
            o_ = F.coalesce(F.col("_o"), F.lit(float("inf"))).asc()
    else:
        g = offers.groupBy("group_key").agg(F.min(F.struct("product_name", "product_id")).getField("product_name").alias("_o"))
        o_ = F.lower("_o").asc_nulls_last()
    return g.orderBy(o_, F.col("group_key")).limit(limit).select("group_key")


#: Vendors that are sent to every task; more are joined by a shuffle of the offers.
VENDORS_SENT = 1 << 19
#: Offers of a group that may meet in one task before one is chosen for each vendor.
GROUP_OFFERS = 1 << 17

_SHOWN = ["product_name", "product_id", "vendor_name", "sku", "upc", "unit_price", "case_price", "pack_size_raw",
          "in_stock", "image_url", "product_url", "description"]


def _by_group(offers: DataFrame) -> DataFrame:
    """The offers' columns that the matrix needs, dealt by group; sorted before, so that equal texts stand together when written."""
    cols = ["group_key", "vendor_id", "brand", "category", *[c for c in _SHOWN if c != "vendor_name"]]
    s = offers.select(*cols).sortWithinPartitions("group_key", "sku", "vendor_id")
    # the row number keeps the optimizer from leaving out the sort, whose order nothing later asks for
    s = s.withColumn("_n", F.monotonically_increasing_id()).filter(F.col("_n") >= 0).drop("_n")
    return s.repartition(int(offers.sparkSession.conf.get("spark.sql.shuffle.partitions")), "group_key")


def _per_vendor(offers: DataFrame) -> DataFrame:
    """One row per group and vendor.

    One pass over the offers: the vendor's last offer in (product_name, product_id) order is its matrix entry, its first
    offer is a candidate for the group's display fields (the group's first offer overall). Both structs begin with that
    order, so nothing has to be carried beside them.
    """
    per = offers.groupBy("group_key", "vendor_slug").agg(
        F.max(F.struct(*_SHOWN)).alias("_last"),
        F.min(F.struct("product_name", "product_id", "brand", "category", "upc")).alias("_first"))
    return per.select("group_key", "vendor_slug", *[F.col(f"_last.{c}").alias(c) for c in _SHOWN], "_first")


def price_matrix(products: DataFrame, vendors: DataFrame, search: str, baseline_slug: str,
                 manual_price: float | None = None, category: str | None = None,
                 brand: str | None = None, sort_by: str = "name", limit: int | None = 50) -> DataFrame:
    """JOI-06, flat: one row per (group, vendor) with the group's figures repeated.

    Per group and vendor the offer last in name order wins; the group's display
    fields come from its first offer in name order.  Group-level figures are
    window aggregates over the chosen offers (one row per vendor per group).

    Without a limit the texts are dealt once, by group, sorted before that, so that what a group's offers have in common
    stands together and takes little room in the files of the shuffle. A group is then one task's; groups of over
    ``GROUP_OFFERS`` offers, found by a count that runs while the plan is built, are dealt by group and vendor first.
    """
    if limit:
        o = matrix_groups(matrix_offers(products, vendors, search, category, brand))
        # at most ``limit`` keys: a bounded broadcast; the other groups are left out before their texts are dealt
        top = _first_groups(o, baseline_slug, manual_price, sort_by, limit)
        per = _per_vendor(o.join(F.broadcast(top), "group_key", "left_semi"))
    else:
        o = matrix_groups(facet(search_name(products, search), category, brand))
        v = vendors.select("vendor_id", F.col("slug").alias("vendor_slug"), F.col("name").alias("vendor_name"))
        if v.limit(VENDORS_SENT + 1).count() <= VENDORS_SENT:
            v = F.broadcast(v)  # at most ``VENDORS_SENT`` rows: the offers need not be dealt by vendor
        counts = o.groupBy(F.col("group_key").alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
        large = [r["_key"] for r in counts.filter(F.col("_n") > GROUP_OFFERS).select("_key").collect()]
        if large:
            keys = F.broadcast(o.sparkSession.createDataFrame([(k,) for k in large], "_key string"))
            same = F.col("group_key").eqNullSafe(F.col("_key"))
            per = _per_vendor(_by_group(o.join(keys, same, "left_anti")).join(v, "vendor_id"))
            per = per.unionByName(_per_vendor(o.join(keys, same, "left_semi").join(v, "vendor_id")))
        else:
            per = _per_vendor(_by_group(o).join(v, "vendor_id"))
    # Group-level figures as window aggregates over the per-vendor rows: after the
    # per-vendor pick a group holds at most one row per vendor, so a group is bounded
    # by the vendor count even when one UPC carries a third of all offers.
    wg = Window.partitionBy("group_key")
    chosen = per.withColumn("price", dbl("unit_price"))
    bl_row = F.col("vendor_slug") == F.lit(baseline_slug)
    g = chosen.select(
        "*",
        F.min("_first").over(wg).alias("_d"),
        F.count(F.lit(1)).over(wg).alias("vendor_count"),
        F.min("price").over(wg).alias("best_price"), F.max("price").over(wg).alias("worst_price"),
        F.sum("unit_price").over(wg).alias("_sum"), F.count("unit_price").over(wg).alias("_n"),
        F.max(F.when(bl_row, F.col("price"))).over(wg).alias("_bl_price"),
        F.max(F.when(bl_row, F.struct("product_name", "vendor_name", "upc", "pack_size_raw"))).over(wg)
        .alias("baseline_product"))
    g = g.select("*", F.col("_d.product_name").alias("display_name"), F.col("_d.brand").alias("group_brand"),
                 F.col("_d.category").alias("group_category"), F.col("_d.upc").alias("group_upc")).drop("_d", "_first")
    if manual_price is not None:
        g = g.withColumn("baseline_price", F.lit(float(manual_price))).withColumn(
            "baseline_source", F.lit("manual"))
    else:
        g = (g.withColumn("baseline_price", F.col("_bl_price"))
             .withColumn("baseline_source", F.when(F.col("_bl_price").isNotNull(), F.lit(baseline_slug))
                         .otherwise(F.lit("none"))))
    r = (g.withColumn("avg_price", pround(F.col("_sum").cast("double") / F.col("_n"), 2))
         .withColumn("max_savings", pround(F.col("worst_price") - F.col("best_price"), 2))
         .drop("_sum", "_n", "_bl_price"))
    bl = F.col("baseline_price")
    diff = F.when(F.col("price").isNotNull() & bl.isNotNull(), pround(F.col("price") - bl, 2))
    r = normalize_unit_price(r, prefix="_norm_", price="price", price_per_oz=None, pack_count=None,
                             unit_size=None, unit_measure=None, pack_size_raw="pack_size_raw")
    return r.select(
        "group_key", "display_name", "group_brand", "group_category", "group_upc", "vendor_count",
        "baseline_price", "baseline_source", "best_price", "worst_price", "avg_price", "max_savings",
        "vendor_slug", "vendor_name", "product_name", "sku", "upc", F.col("price").alias("unit_price"),
        F.when(F.coalesce(dbl("case_price"), F.lit(0.0)) != 0, dbl("case_price")).alias("case_price"),
        F.col("pack_size_raw").alias("pack_size"), "in_stock", "image_url", "product_url", "description",
        ((F.col("vendor_slug") == F.lit(baseline_slug)) & (F.col("baseline_source") != "manual")).alias("is_baseline"),
        F.coalesce(F.col("price") == F.col("best_price"), F.lit(False)).alias("is_best"),
        F.coalesce(F.col("price") == F.col("worst_price"), F.lit(False)).alias("is_worst"),
        diff.alias("diff_vs_baseline"),
        F.when(F.col("price").isNotNull() & bl.isNotNull() & (bl != 0), pround(diff / bl * 100, 2))
        .alias("pct_vs_baseline"),
        F.when(F.col("price").isNotNull() & F.col("best_price").isNotNull(),
               pround(F.col("price") - F.col("best_price"), 2)).alias("diff_vs_best"),
        F.col("_norm_price_per_oz").alias("norm_price_per_oz"),
        F.col("_norm_price_per_unit").alias("norm_price_per_unit"), "normalization", "baseline_product")


def matrix_totals(matrix: DataFrame) -> DataFrame:
    """Groups and vendors of a matrix; over one without a limit these are the totals before it."""
    return matrix.agg(F.count_distinct("group_key").alias("total_groups"),
                      F.count_distinct("vendor_slug").alias("vendors_found"))

