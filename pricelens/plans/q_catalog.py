"""Registered queries: legacy catalog family, pack parsers, legacy filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelens.functions import numeric as N
from pricelens.functions import pack as P
from pricelens.operators import catalog as K
from pricelens.operators import filters as FL
from pricelens.plans.registry import BASELINE, R, V, query

CAT_COLS = ("product_id, category, manufacturer, product, description, upc, delivered_price, price_per_unit, "
            "price_per_oz, pack_size_raw, cases_per_pallet, lead_time_days, mixed_pallet, available, has_promo")


def EM(c: str) -> str:
    """exact mean (matches operators.catalog.exact_mean)."""
    return f"(CAST(sum(CAST({c} AS DECIMAL(38,10))) AS DOUBLE) / count({c}))"


# ── legacy filters ───────────────────────────────────────────────────────
@query("flt_search_any", f"""
SELECT {CAT_COLS} FROM catalog
WHERE coalesce(regexp_matches(product, 'ring|bolt', 'i'), false) OR coalesce(regexp_matches(manufacturer, 'ring|bolt', 'i'), false)
   OR coalesce(regexp_matches(description, 'ring|bolt', 'i'), false) OR coalesce(regexp_matches(upc, 'ring|bolt', 'i'), false)""")
def q_search_any(spark, sf):
    return FL.search_any(V(spark, sf)["catalog"], "ring|bolt")


@query("flt_where_in", f"""
SELECT {CAT_COLS} FROM catalog WHERE category IN ('MEDIUM', 'SMALL') AND manufacturer IN ('Brand#4', 'Brand#2', '')""")
def q_where_in(spark, sf):
    c = V(spark, sf)["catalog"]
    return FL.where_in(FL.where_in(c, "category", ["MEDIUM", "SMALL"]), "manufacturer", ["Brand#4", "Brand#2", ""])


@query("flt_price_between", f"""
SELECT {CAT_COLS} FROM catalog WHERE price_per_unit IS NOT NULL AND price_per_unit >= 9.2 AND price_per_unit <= 9.6""")
def q_price_between(spark, sf):
    return FL.price_between(V(spark, sf)["catalog"], 9.2, 9.6)


@query("flt_apply_filters", f"""
SELECT {CAT_COLS} FROM catalog
WHERE category IN ('MEDIUM', 'SMALL', 'LARGE')
  AND (coalesce(regexp_matches(product, 'ring|bolt|gear', 'i'), false) OR coalesce(regexp_matches(manufacturer, 'ring|bolt|gear', 'i'), false)
       OR coalesce(regexp_matches(description, 'ring|bolt|gear', 'i'), false) OR coalesce(regexp_matches(upc, 'ring|bolt|gear', 'i'), false))
  AND price_per_unit IS NOT NULL AND price_per_unit >= 9.5 AND available""")
def q_apply_filters(spark, sf):
    return FL.apply_filters(V(spark, sf)["catalog"], {"category": ["MEDIUM", "SMALL", "LARGE"],
                                                      "search": "ring|bolt|gear", "min_price": 9.5,
                                                      "available_only": True})


@query("flt_by_ids", f"""
SELECT {CAT_COLS} FROM catalog WHERE product_id IN (SELECT CAST(sku AS BIGINT) FROM products
  WHERE vendor_id IN (SELECT vendor_id FROM vendors WHERE slug = '{BASELINE}'))""")
def q_by_ids(spark, sf):
    v = V(spark, sf)
    ids = FL.for_vendor(v["products"], v["vendors"], BASELINE).select(F.col("sku").cast("bigint").alias("product_id"))
    return FL.by_ids(v["catalog"], ids)


@query("prj_cost_per_case", f"""
SELECT product_id, delivered_price, cases_per_pallet,
       {R('CAST(delivered_price AS DOUBLE) / CAST(cases_per_pallet AS DOUBLE)', 2)} AS cost_per_case FROM catalog""")
def q_cost_per_case(spark, sf):
    return FL.cost_per_case(V(spark, sf)["catalog"].select("product_id", "delivered_price", "cases_per_pallet"))


# ── pack parsers ─────────────────────────────────────────────────────────
def _legacy_pack_sql(c: str = "pack_size_raw") -> str:
    raw = f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
    up = f"regexp_replace(substr({raw}, strpos({raw}, '/') + 1), '^\\s+|\\s+$', '', 'g')"
    has = f"({c} IS NOT NULL AND strpos({raw}, '/') > 0)"
    cnt = f"TRY_CAST(regexp_replace(split_part({raw}, '/', 1), '^\\s+|\\s+$', '', 'g') AS DOUBLE)"
    m = f"regexp_matches({up}, '^([\\d.]+)\\s*(.*)')"
    size = f"CASE WHEN {m} THEN TRY_CAST(regexp_extract({up}, '^([\\d.]+)\\s*(.*)', 1) AS DOUBLE) END"
    meas = (f"CASE WHEN {m} THEN regexp_replace(regexp_extract({up}, '^([\\d.]+)\\s*(.*)', 2), '^\\s+|\\s+$', '', 'g') "
            f"ELSE {up} END")
    return (f"CASE WHEN {has} THEN {cnt} END AS pack_count, CASE WHEN {has} THEN {size} END AS unit_size, "
            f"CASE WHEN {has} THEN {meas} END AS unit_measure")


@query("scl_parse_pack_legacy", f"""
SELECT product_id, pack_size_raw, pack_count, unit_size, unit_measure, pack_count * unit_size AS total_weight
FROM (SELECT product_id, pack_size_raw, {_legacy_pack_sql()} FROM catalog) t""")
def q_parse_pack_legacy(spark, sf):
    return P.parse_pack_legacy(V(spark, sf)["catalog"].select("product_id", "pack_size_raw"))


@query("scl_split_pack", """
SELECT product_id, pack_size_raw,
  CASE WHEN regexp_matches(r, '^(\\d+)/(.+)$') THEN regexp_extract(r, '^(\\d+)/(.+)$', 1) ELSE '' END AS pack_count_text,
  CASE WHEN regexp_matches(r, '^(\\d+)/(.+)$') THEN regexp_replace(regexp_extract(r, '^(\\d+)/(.+)$', 2), '^\\s+|\\s+$', '', 'g') ELSE r END AS pack_rest
FROM (SELECT product_id, pack_size_raw, regexp_replace(coalesce(pack_size_raw, ''), '^\\s+|\\s+$', '', 'g') AS r FROM catalog) t""")
def q_split_pack(spark, sf):
    return P.split_pack(V(spark, sf)["catalog"].select("product_id", "pack_size_raw"))


def _norm_name_sql(c: str) -> str:
    n = f"regexp_replace(lower(coalesce({c}, '')), '^\\s+|\\s+$', '', 'g')"
    n = f"regexp_replace({n}, '(?i)\\s*\\d+\\s*(oz|lb|kg|g|ml|l|ct|pk|pack|count|each|ea|pc|pcs)\\b.*$', '')"
    n = f"regexp_replace({n}, '[^a-z0-9\\s]', '', 'g')"
    return f"regexp_replace(regexp_replace({n}, '\\s+', ' ', 'g'), '^\\s+|\\s+$', '', 'g')"


@query("scl_normalize_name", f"""
SELECT product_id, product_name, {_norm_name_sql('product_name')} AS name_key FROM products""")
def q_normalize_name(spark, sf):
    return P.normalize_name(V(spark, sf)["products"].select("product_id", "product_name"))


@query("scl_to_number", """
SELECT product_id, t, TRY_CAST(replace(trim(t), ',', '') AS DOUBLE) AS num,
       TRY_CAST(trunc(TRY_CAST(trim(t) AS DOUBLE)) AS INTEGER) AS int_value
FROM (SELECT product_id, CAST(cases_per_pallet AS VARCHAR) || CASE WHEN product_id % 3 = 0 THEN ',' || lpad(CAST(product_id % 1000 AS VARCHAR), 3, '0')
                  WHEN product_id % 3 = 1 THEN '.' || CAST(product_id % 10 AS VARCHAR) ELSE 'x' END AS t FROM catalog) s""")
def q_to_number(spark, sf):
    c = V(spark, sf)["catalog"]
    t = F.concat(F.col("cases_per_pallet").cast("string"),
                 F.when(F.col("product_id") % 3 == 0,
                        F.concat(F.lit(","), F.lpad((F.col("product_id") % 1000).cast("string"), 3, "0")))
                 .when(F.col("product_id") % 3 == 1, F.concat(F.lit("."), (F.col("product_id") % 10).cast("string")))
                 .otherwise(F.lit("x")))
    return c.select("product_id", t.alias("t")).select("product_id", "t", N.to_number("t").alias("num"),
                                                        N.to_int("t").alias("int_value"))


def unit_price_sql(price="unit_price", ppo="price_per_oz", pc="pack_count", us="unit_size",
                   um="unit_measure", raw="pack_size_raw") -> dict[str, str]:
    """DuckDB text of SCL-01 (independent of the Spark expression)."""
    p = f"CAST({price} AS DOUBLE)"
    vp = f"coalesce(CAST({ppo} AS DOUBLE) <> 0, false)" if ppo else "false"
    vpv = R(f"CAST({ppo} AS DOUBLE)", 4) if ppo else "NULL"
    if pc:
        meas = f"lower(regexp_replace(coalesce({um}, ''), '^\\s+|\\s+$', '', 'g'))" if um else "''"
        have = f"(coalesce({pc} <> 0, false) AND coalesce({us} <> 0, false))"
        total = f"(CASE WHEN {have} AND {pc} > 0 AND {us} > 0 THEN {pc} * {us} END)"
        ok = f"(coalesce({total} > 0, false))"
        is_oz = f"({meas} IN ('oz', 'fl oz', 'floz'))"
        is_lb = f"({meas} IN ('lb', 'lbs'))"
        comp = (f"(CASE WHEN {ok} AND {is_oz} THEN {R(f'{p} / {total}', 4)} "
                f"WHEN {ok} AND {is_lb} THEN {R(f'{p} / ({total} * 16)', 4)} END)")
        clabel = (f"(CASE WHEN {ok} AND {is_oz} THEN '$' || printf('%.4f', {comp}) || '/oz (' || printf('%.0f', {pc}) || 'x' || CAST(CAST({us} AS DOUBLE) AS VARCHAR) || {meas} || ')' "
                  f"WHEN {ok} AND {is_lb} THEN '$' || printf('%.4f', {comp}) || '/oz (' || printf('%.0f', {pc}) || 'x' || CAST(CAST({us} AS DOUBLE) AS VARCHAR) || 'lb)' END)")
        sunit = f"(CASE WHEN {ok} AND {pc} > 0 THEN {R(f'{p} / {pc}', 4)} END)"
        computed = f"({ok} AND ({is_oz} OR {is_lb}))"
    else:
        comp = clabel = sunit = "NULL"
        computed = "false"
    rw = f"coalesce({raw}, '')" if raw else "''"
    P1 = "(?i)(\\d+)\\s*[/x×-]\\s*(\\d+(?:\\.\\d+)?)\\s*(oz|fl\\s*oz|lb)"
    P2 = "(?i)(\\d+(?:\\.\\d+)?)\\s*(oz|fl\\s*oz|lb)"
    m1 = f"regexp_matches({rw}, '{P1}')"
    cnt = f"TRY_CAST(regexp_extract({rw}, '{P1}', 1) AS DOUBLE)"
    size = f"TRY_CAST(regexp_extract({rw}, '{P1}', 2) AS DOUBLE)"
    me1 = f"lower(regexp_extract({rw}, '{P1}', 3))"
    tot1 = f"(CASE WHEN contains({me1}, 'lb') THEN {cnt} * {size} * 16 ELSE {cnt} * {size} END)"
    parsed = f"({m1} AND coalesce({tot1} > 0, false))"
    m2 = f"regexp_matches({rw}, '{P2}')"
    size2 = f"TRY_CAST(regexp_extract({rw}, '{P2}', 1) AS DOUBLE)"
    me2 = f"lower(regexp_extract({rw}, '{P2}', 2))"
    tot2 = f"(CASE WHEN contains({me2}, 'lb') THEN {size2} * 16 ELSE {size2} END)"
    simple = f"({m2} AND coalesce({tot2} > 0, false))"
    tp = f"(NOT {computed} AND NOT {vp} AND length({rw}) > 0)"
    hp = f"({p} IS NOT NULL)"
    return {
        "price_per_oz": (f"CASE WHEN {hp} THEN (CASE WHEN {computed} THEN {comp} WHEN {vp} THEN {vpv} "
                         f"WHEN {tp} AND {parsed} THEN {R(f'{p} / {tot1}', 4)} "
                         f"WHEN {tp} AND {simple} THEN {R(f'{p} / {tot2}', 4)} END) END"),
        "price_per_unit": (f"CASE WHEN {hp} THEN (CASE WHEN {tp} AND {parsed} THEN {R(f'{p} / {cnt}', 4)} "
                           f"ELSE {sunit} END) END"),
        "price_per_case_unit": f"CASE WHEN {hp} THEN {sunit} END",
        "normalization": (f"CASE WHEN {hp} THEN (CASE WHEN {computed} THEN 'computed' WHEN {vp} THEN 'vendor_provided' "
                          f"WHEN {tp} AND {parsed} THEN 'parsed' WHEN {tp} AND {simple} THEN 'parsed_simple' "
                          f"ELSE 'none' END) ELSE 'none' END"),
        "normalized_label": (f"CASE WHEN {hp} THEN (CASE WHEN {computed} THEN {clabel} "
                             f"WHEN {vp} THEN '$' || printf('%.4f', {vpv}) || '/oz' "
                             f"WHEN {tp} AND {parsed} THEN '$' || printf('%.4f', {R(f'{p} / {tot1}', 4)}) || '/oz (parsed)' "
                             f"WHEN {tp} AND {simple} THEN '$' || printf('%.4f', {R(f'{p} / {tot2}', 4)}) || '/oz' END) END"),
    }


_U = unit_price_sql()


@query("scl_normalize_unit_price", f"""
SELECT product_id, CAST(unit_price AS DOUBLE) AS unit_price, pack_size_raw,
       {_U['price_per_oz']} AS norm_price_per_oz, {_U['price_per_unit']} AS norm_price_per_unit,
       {_U['price_per_case_unit']} AS norm_price_per_case_unit, {_U['normalization']} AS normalization,
       {_U['normalized_label']} AS normalized_label
FROM products""")
def q_normalize_unit_price(spark, sf):
    p = V(spark, sf)["products"].select("product_id", F.col("unit_price").cast("double").alias("unit_price"),
                                        "pack_size_raw", "price_per_oz", "pack_count", "unit_size",
                                        "unit_measure")
    return P.normalize_unit_price(p).drop("price_per_oz", "pack_count", "unit_size", "unit_measure")


# ── legacy aggregates ────────────────────────────────────────────────────
@query("agg_catalog_summary", f"""
SELECT count(*) AS total_products, count(DISTINCT coalesce(category, '')) AS total_categories,
       count(DISTINCT coalesce(manufacturer, '')) AS total_manufacturers,
       coalesce({R(EM('delivered_price'), 2)}, 0.0) AS avg_delivered_price,
       coalesce({R(EM('price_per_unit'), 2)}, 0.0) AS avg_unit_price,
       coalesce({R('min(price_per_unit)', 2)}, 0.0) AS min_unit_price,
       coalesce({R('max(price_per_unit)', 2)}, 0.0) AS max_unit_price,
       CAST(sum(CASE WHEN has_promo THEN 1 ELSE 0 END) AS BIGINT) AS total_with_promo,
       CAST(sum(CASE WHEN mixed_pallet THEN 1 ELSE 0 END) AS BIGINT) AS total_mixed_pallet
FROM catalog""")
def q_catalog_summary(spark, sf):
    return K.catalog_summary(V(spark, sf)["catalog"])


@query("agg_category_prices", f"""
SELECT category, count(*) AS count, {R(EM('price_per_unit'), 2)} AS avg_unit_price,
       {R('min(price_per_unit)', 2)} AS min_unit_price, {R('max(price_per_unit)', 2)} AS max_unit_price,
       {R('median(price_per_unit)', 2)} AS median_unit_price, {R(EM('delivered_price'), 2)} AS avg_delivered,
       {R('coalesce(CAST(sum(CAST(delivered_price AS DECIMAL(38,10))) AS DOUBLE), 0.0)', 2)} AS total_value
FROM catalog WHERE price_per_unit IS NOT NULL GROUP BY category""")
def q_category_prices(spark, sf):
    return K.category_prices(V(spark, sf)["catalog"])


@query("agg_maker_prices", f"""
SELECT manufacturer, count(*) AS count, {R(EM('price_per_unit'), 2)} AS avg_unit_price,
       {R('min(price_per_unit)', 2)} AS min_unit_price, {R('max(price_per_unit)', 2)} AS max_unit_price,
       {R(EM('delivered_price'), 2)} AS avg_delivered, count(DISTINCT coalesce(category, '')) AS categories
FROM catalog WHERE price_per_unit IS NOT NULL GROUP BY manufacturer ORDER BY count DESC, manufacturer LIMIT 30""")
def q_maker_prices(spark, sf):
    return K.maker_prices(V(spark, sf)["catalog"], "count", 30)


@query("agg_pallet_efficiency", f"""
SELECT category, {R('CAST(sum(cases_per_pallet) AS DOUBLE) / count(*)', 2)} AS avg_cases_per_pallet,
       {R(EM('delivered_price'), 2)} AS avg_delivered, {R(EM('cost_per_case'), 2)} AS avg_cost_per_case,
       count(*) AS product_count
FROM (SELECT *, {R('CAST(delivered_price AS DOUBLE) / CAST(cases_per_pallet AS DOUBLE)', 2)} AS cost_per_case
      FROM catalog WHERE delivered_price IS NOT NULL AND cases_per_pallet IS NOT NULL) t GROUP BY category""")
def q_pallet_efficiency(spark, sf):
    return K.pallet_efficiency(V(spark, sf)["catalog"])


@query("agg_cost_per_oz", f"""
SELECT category, {R(EM('price_per_oz'), 4)} AS avg_per_oz, {R('min(price_per_oz)', 4)} AS min_per_oz,
       {R('max(price_per_oz)', 4)} AS max_per_oz, {R('median(price_per_oz)', 4)} AS median_per_oz, count(*) AS count
FROM catalog WHERE price_per_oz IS NOT NULL GROUP BY category""")
def q_cost_per_oz(spark, sf):
    return K.cost_per_oz(V(spark, sf)["catalog"])


_AV = """count(*) AS total, CAST(sum(CASE WHEN available THEN 1 ELSE 0 END) AS BIGINT) AS available,
         CAST(sum(CASE WHEN mixed_pallet THEN 1 ELSE 0 END) AS BIGINT) AS mixed_pallet,
         CAST(sum(CASE WHEN has_promo THEN 1 ELSE 0 END) AS BIGINT) AS promo"""


@query("agg_availability", f"""
SELECT category, is_total, total, available, total - available AS unavailable, mixed_pallet,
       total - mixed_pallet AS non_mixed, promo,
       {R('available / CAST(total AS DOUBLE) * 100', 1)} AS avail_pct, {R('mixed_pallet / CAST(total AS DOUBLE) * 100', 1)} AS mixed_pct
FROM (SELECT category, false AS is_total, {_AV} FROM catalog GROUP BY category
      UNION ALL SELECT NULL, true, {_AV} FROM catalog) t""")
def q_availability(spark, sf):
    return K.availability(V(spark, sf)["catalog"])


@query("agg_lead_time_summary", f"""
SELECT category, {R('CAST(sum(lead_time_days) AS DOUBLE) / count(*)', 1)} AS avg_lead,
       {R('min(lead_time_days)', 1)} AS min_lead, {R('max(lead_time_days)', 1)} AS max_lead, count(*) AS count
FROM catalog WHERE lead_time_days IS NOT NULL GROUP BY category""")
def q_lead_time_summary(spark, sf):
    return K.lead_time_summary(V(spark, sf)["catalog"])


@query("agg_lead_time_dist", """
SELECT category, CAST(lead_time_days AS INTEGER) AS lead_time_days, count(*) AS count
FROM catalog WHERE lead_time_days IS NOT NULL GROUP BY 1, 2""")
def q_lead_time_dist(spark, sf):
    return K.lead_time_dist(V(spark, sf)["catalog"])


_HIST = f"""
v0 AS (SELECT CAST(price_per_unit AS DOUBLE) AS x FROM catalog WHERE price_per_unit IS NOT NULL),
q AS (SELECT quantile_cont(x, 0.99) AS q FROM v0),
v AS (SELECT x FROM v0, q WHERE x <= q.q),
m0 AS (SELECT min(x) AS mn, max(x) AS mx FROM v),
m1 AS (SELECT CASE WHEN mn = mx THEN (CASE WHEN mn <> 0 THEN mn - abs(mn) * 0.001 ELSE mn - 0.001 END) ELSE mn END AS lo,
              CASE WHEN mn = mx THEN (CASE WHEN mx <> 0 THEN mx + abs(mx) * 0.001 ELSE mx + 0.001 END) ELSE mx END AS hi,
              mn = mx AS eq FROM m0),
m AS (SELECT lo, hi, (hi - lo) / 30.0 AS step, CASE WHEN eq THEN lo ELSE lo - (hi - lo) * 0.001 END AS e0 FROM m1),
b AS (SELECT CAST(least(30, greatest(1, ceil((x - lo) / step))) AS INTEGER) AS bin, lo, hi, step, e0 FROM v, m),
c AS (SELECT bin, lo, hi, step, e0, count(*) AS count FROM b GROUP BY ALL),
e AS (SELECT bin, count, CASE WHEN bin = 1 THEN e0 ELSE (bin - 1) * step + lo END AS l,
             CASE WHEN bin = 30 THEN hi ELSE bin * step + lo END AS r FROM c)"""


@query("agg_price_histogram", f"""WITH {_HIST}
SELECT bin, {R('l', 2)} AS bin_start, {R('r', 2)} AS bin_end,
       '$' || printf('%.2f', {R('l', 2)}) || '-$' || printf('%.2f', {R('r', 2)}) AS label, count FROM e""",
       views=["catalog"])
def q_price_histogram(spark, sf):
    return K.price_histogram(V(spark, sf)["catalog"], 30)


@query("agg_category_maker_matrix", f"""
WITH top AS (SELECT manufacturer FROM catalog GROUP BY manufacturer ORDER BY count(*) DESC, manufacturer LIMIT 15)
SELECT category, manufacturer, count(*) AS count, coalesce({R(EM('price_per_unit'), 2)}, 0.0) AS avg_price
FROM catalog WHERE manufacturer IN (SELECT manufacturer FROM top) GROUP BY category, manufacturer""")
def q_category_maker_matrix(spark, sf):
    return K.category_maker_matrix(V(spark, sf)["catalog"], 15)


@query("agg_category_breakdown", f"""
SELECT category, count(*) AS product_count, {R('count(*) / CAST((SELECT count(*) FROM catalog) AS DOUBLE) * 100', 1)} AS pct_of_total,
       false AS is_total FROM catalog GROUP BY category
UNION ALL SELECT NULL, count(*), CAST(count(DISTINCT coalesce(category, '')) AS DOUBLE), true FROM catalog""")
def q_category_breakdown(spark, sf):
    return K.category_breakdown(V(spark, sf)["catalog"])


@query("agg_export_summary", f"""
SELECT count(*) AS total_products, count(DISTINCT coalesce(category, '')) AS categories,
       count(DISTINCT coalesce(manufacturer, '')) AS manufacturers, {R(EM('price_per_unit'), 2)} AS avg_unit_price,
       {R('median(price_per_unit)', 2)} AS median_unit_price, {R('min(price_per_unit)', 2)} AS min_unit_price,
       {R('max(price_per_unit)', 2)} AS max_unit_price FROM catalog""")
def q_export_summary(spark, sf):
    return K.export_summary(V(spark, sf)["catalog"])


@query("win_best_value", f"""
WITH v AS (SELECT * FROM catalog WHERE price_per_oz IS NOT NULL AND cases_per_pallet IS NOT NULL),
m AS (SELECT min(price_per_oz) AS pmin, max(price_per_oz) AS pmax, min(cases_per_pallet) AS cmin, max(cases_per_pallet) AS cmax FROM v)
SELECT product_id, product, manufacturer, category, price_per_unit, price_per_oz, delivered_price, pack_size_raw,
       cases_per_pallet, lead_time_days, available, mixed_pallet,
       {R('(1.0 - (CAST(price_per_oz AS DOUBLE) - CAST(pmin AS DOUBLE)) / (CAST(pmax AS DOUBLE) - CAST(pmin AS DOUBLE) + 0.0001)) * 0.6 + ((CAST(cases_per_pallet AS DOUBLE) - CAST(cmin AS DOUBLE)) / (CAST(cmax AS DOUBLE) - CAST(cmin AS DOUBLE) + 0.0001)) * 0.4', 3)} AS value_score
FROM v, m ORDER BY value_score DESC, product_id LIMIT 30""")
def q_best_value(spark, sf):
    return K.best_value(V(spark, sf)["catalog"], 30, "desc")


@query("win_top_by", f"""
SELECT product_id, product, manufacturer, category, delivered_price, price_per_unit, price_per_oz, pack_size_raw,
       cases_per_pallet, pack_count * unit_size AS total_weight
FROM (SELECT *, {_legacy_pack_sql()} FROM catalog) t WHERE price_per_oz IS NOT NULL
ORDER BY price_per_oz ASC, product_id LIMIT 20""")
def q_top_by(spark, sf):
    return K.top_by(V(spark, sf)["catalog"], "price_per_oz", "asc", 20)


@query("agg_source_breakdown", f"""
SELECT 'catalog' AS source, count(*) AS count, {R('count(*) / CAST(count(*) AS DOUBLE) * 100', 1)} AS pct FROM catalog""")
def q_source_breakdown(spark, sf):
    return K.source_breakdown(V(spark, sf)["catalog"])


@query("srt_sample_n", f"""
SELECT product_id, product, manufacturer, category, price_per_unit, total_weight, unit_measure, pack_size_raw
FROM (SELECT *, pack_count * unit_size AS total_weight FROM (SELECT *, {_legacy_pack_sql()} FROM catalog) t) u
WHERE price_per_unit IS NOT NULL AND total_weight IS NOT NULL
ORDER BY md5('42:' || product_id), product_id LIMIT 200""")
def q_sample_n(spark, sf):
    """The sampling operator: 200 of the priced rows."""
    return K.sample_n(V(spark, sf)["catalog"], 200, 42)


@query("srt_page_legacy", f"""
SELECT {CAT_COLS} FROM catalog WHERE available ORDER BY price_per_unit DESC NULLS LAST, product_id LIMIT 50 OFFSET 50""")
def q_page_legacy(spark, sf):
    from pricelens.operators.compare import page
    c = FL.apply_filters(V(spark, sf)["catalog"], {"available_only": True})
    return page(c, "price_per_unit", "desc", 2, 50, nulls_last=True)
