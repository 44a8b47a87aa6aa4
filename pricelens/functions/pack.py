"""Pack-size parsing and unit-price normalisation as Column expressions.

SCL-01 unit_price_struct / normalize_unit_price, SCL-02 parse_pack_legacy,
SCL-03 split_pack, SCL-04 normalize_name.  Everything is built from
``regexp_extract`` / ``when`` chains, so it runs inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.functions.numeric import col_, dbl, pround, truthy_num

# The pack-size patterns the normalisation recognises.
# count, separator (/ x × -), size, measure (oz, fl oz, lb); case-insensitive.
PACK_COUNT_SIZE = r"(?i)(\d+)\s*[/x×-]\s*(\d+(?:\.\d+)?)\s*(oz|fl\s*oz|lb)"
PACK_SIZE_ONLY = r"(?i)(\d+(?:\.\d+)?)\s*(oz|fl\s*oz|lb)"
OZ_UNITS = ["oz", "fl oz", "floz"]
LB_UNITS = ["lb", "lbs"]
# Size tokens cut from a product name before grouping (everything after the first).
NAME_SIZE_SUFFIX = r"(?i)\s*\d+\s*(oz|lb|kg|g|ml|l|ct|pk|pack|count|each|ea|pc|pcs)\b.*$"


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _fmt4(x: Column) -> Column:
    return F.format_string("%.4f", x)


PACK_PARTS = ("_pk_raw", "_pk_c", "_pk_s", "_pk_u", "_pk_s2", "_pk_u2")


def with_pack_parts(df: DataFrame, pack_size_raw: str | None = "pack_size_raw") -> DataFrame:
    """Evaluate each pack-size regex group once, as hidden columns (the unit-price
    ``when`` chains read them many times; inside conditional branches Spark would
    otherwise re-run the regex per reference)."""
    raw = F.coalesce(F.col(pack_size_raw), F.lit("")) if pack_size_raw else F.lit("")
    d = df.withColumn("_pk_raw", raw)
    return (d.withColumn("_pk_c", F.regexp_extract("_pk_raw", PACK_COUNT_SIZE, 1))
             .withColumn("_pk_s", F.regexp_extract("_pk_raw", PACK_COUNT_SIZE, 2))
             .withColumn("_pk_u", F.regexp_extract("_pk_raw", PACK_COUNT_SIZE, 3))
             .withColumn("_pk_s2", F.regexp_extract("_pk_raw", PACK_SIZE_ONLY, 1))
             .withColumn("_pk_u2", F.regexp_extract("_pk_raw", PACK_SIZE_ONLY, 2)))


def _pack_totals(g1, g2, g3, h1, h2):
    cnt, size, size2 = g1.try_cast("double"), g2.try_cast("double"), h1.try_cast("double")
    tot1 = F.when(F.lower(g3).contains("lb"), cnt * size * 16).otherwise(cnt * size)
    tot2 = F.when(F.lower(h2).contains("lb"), size2 * 16).otherwise(size2)
    return tot1, tot2


def _stage_inputs(df: DataFrame, price, price_per_oz, pack_count, unit_size, unit_measure) -> DataFrame:
    """Second stage after ``with_pack_parts``: price, vendor value, structured total,
    measure and parsed totals as hidden columns, so the ``when`` chains only read them."""
    g1, g2, g3, h1, h2 = [F.col(c) for c in PACK_PARTS[1:]]
    tot1, tot2 = _pack_totals(g1, g2, g3, h1, h2)
    d = df.withColumn("_pk_p", dbl(price)).withColumn("_pk_tot1", tot1).withColumn("_pk_tot2", tot2)
    if price_per_oz:
        d = d.withColumn("_pk_vp", truthy_num(price_per_oz)).withColumn("_pk_vpv", pround(dbl(price_per_oz), 4))
    if pack_count and unit_size:
        pc, us = dbl(pack_count), dbl(unit_size)
        have = truthy_num(pack_count) & truthy_num(unit_size)
        meas = F.lower(_strip(F.coalesce(col_(unit_measure), F.lit("")))) if unit_measure else F.lit("")
        d = d.withColumn("_pk_meas", meas).withColumn("_pk_total", F.when(have & (pc > 0) & (us > 0), pc * us))
    return d


def normalize_unit_price(df: DataFrame, prefix: str = "norm_", **cols) -> DataFrame:
    """SCL-01 as a table job: adds norm_price_per_oz, norm_price_per_unit,
    norm_price_per_case_unit, normalization, normalized_label.

    Built in stages of hidden columns (regex groups -> numeric inputs -> decision
    flags and candidate values -> outputs), so every regex, rounding and
    formatting step runs once per row and each generated expression stays small
    enough for whole-stage codegen.
    """
    a = dict(price="unit_price", price_per_oz="price_per_oz", pack_count="pack_count", unit_size="unit_size",
             unit_measure="unit_measure", pack_size_raw="pack_size_raw")
    a.update(cols)
    d = _stage_inputs(with_pack_parts(df, a["pack_size_raw"]), a["price"], a["price_per_oz"],
                      a["pack_count"], a["unit_size"], a["unit_measure"])
    c = F.col
    structured = bool(a["pack_count"] and a["unit_size"])
    # stage 3: decision flags and candidate values
    if structured:
        ok = c("_pk_total").isNotNull() & (c("_pk_total") > 0)
        is_oz, is_lb = c("_pk_meas").isin(OZ_UNITS), c("_pk_meas").isin(LB_UNITS)
        d = (d.withColumn("_pk_ok", ok).withColumn("_pk_is_oz", is_oz).withColumn("_pk_is_lb", is_lb)
              .withColumn("_pk_pc", dbl(a["pack_count"])).withColumn("_pk_us", dbl(a["unit_size"])))
        d = (d.withColumn("_pk_computed", c("_pk_ok") & (c("_pk_is_oz") | c("_pk_is_lb")))
              .withColumn("_pk_comp", F.when(c("_pk_ok") & c("_pk_is_oz"), pround(c("_pk_p") / c("_pk_total"), 4))
                          .when(c("_pk_ok") & c("_pk_is_lb"), pround(c("_pk_p") / (c("_pk_total") * 16), 4)))
              .withColumn("_pk_sunit", F.when(c("_pk_ok") & (c("_pk_pc") > 0), pround(c("_pk_p") / c("_pk_pc"), 4))))
    else:
        d = (d.withColumn("_pk_computed", F.lit(False)).withColumn("_pk_comp", F.lit(None).cast("double"))
              .withColumn("_pk_sunit", F.lit(None).cast("double")))
    vp = c("_pk_vp") if a["price_per_oz"] else F.lit(False)
    d = (d.withColumn("_pk_try", ~c("_pk_computed") & ~vp & (F.length(c("_pk_raw")) > 0))
          .withColumn("_pk_parsed", (c("_pk_c") != "") & F.coalesce(c("_pk_tot1") > 0, F.lit(False)))
          .withColumn("_pk_simple", (c("_pk_s2") != "") & F.coalesce(c("_pk_tot2") > 0, F.lit(False)))
          .withColumn("_pk_pv", pround(c("_pk_p") / c("_pk_tot1"), 4))
          .withColumn("_pk_sv", pround(c("_pk_p") / c("_pk_tot2"), 4)))
    # stage 4: method, value and per-unit price
    vpv = c("_pk_vpv") if a["price_per_oz"] else F.lit(None).cast("double")
    tp, ts = c("_pk_try") & c("_pk_parsed"), c("_pk_try") & c("_pk_simple")
    d = (d.withColumn("_pk_method", F.when(c("_pk_computed"), F.lit("computed")).when(vp, F.lit("vendor_provided"))
                      .when(tp, F.lit("parsed")).when(ts, F.lit("parsed_simple")).otherwise(F.lit("none")))
          .withColumn("_pk_ppo", F.when(c("_pk_computed"), c("_pk_comp")).when(vp, vpv)
                      .when(tp, c("_pk_pv")).when(ts, c("_pk_sv")))
          .withColumn("_pk_unit", F.when(tp, pround(c("_pk_p") / c("_pk_c").try_cast("double"), 4))
                      .otherwise(c("_pk_sunit"))))
    # stage 5: label (formatting only for rows that have a method)
    m = c("_pk_method")
    amount = F.concat(F.lit("$"), F.format_string("%.4f", c("_pk_ppo")))
    if structured:
        detail = F.concat(F.lit("/oz ("), F.format_string("%.0f", c("_pk_pc")), F.lit("x"), c("_pk_us").cast("string"),
                          F.when(c("_pk_is_oz"), c("_pk_meas")).otherwise(F.lit("lb")), F.lit(")"))
    else:
        detail = F.lit(None).cast("string")
    label = (F.when(m == "computed", F.concat(amount, detail))
             .when(m == "parsed", F.concat(amount, F.lit("/oz (parsed)")))
             .when(m.isin("vendor_provided", "parsed_simple"), F.concat(amount, F.lit("/oz"))))
    has_price = c("_pk_p").isNotNull()
    return d.select(*df.columns,
                    F.when(has_price, c("_pk_ppo")).alias(f"{prefix}price_per_oz"),
                    F.when(has_price, c("_pk_unit")).alias(f"{prefix}price_per_unit"),
                    F.when(has_price, c("_pk_sunit")).alias(f"{prefix}price_per_case_unit"),
                    F.when(has_price, m).otherwise(F.lit("none")).alias("normalization"),
                    F.when(has_price, label).alias("normalized_label"))


# ── legacy pack parse (SCL-02) ───────────────────────────────────────────
LEGACY_UNIT = r"^([\d.]+)\s*(.*)"


def parse_pack_legacy(df: DataFrame, col: str = "pack_size_raw") -> DataFrame:
    """'count/size measure': count from the text before the first '/', then a
    leading number and the rest of the text after it ('4/12/1 oz' -> 4, 12, '/1 oz').
    No '/' -> all null.  Adds pack_count, unit_size, unit_measure, total_weight."""
    raw = _strip(F.col(col))
    slash = F.instr(raw, "/")
    has = F.col(col).isNotNull() & (slash > 0)
    count = _strip(F.substring_index(raw, "/", 1)).try_cast("double")
    unit_part = _strip(F.substr(raw, slash + 1))
    matched = unit_part.rlike(LEGACY_UNIT)
    size = F.when(matched, F.regexp_extract(unit_part, LEGACY_UNIT, 1).try_cast("double"))
    measure = F.when(matched, _strip(F.regexp_extract(unit_part, LEGACY_UNIT, 2))).otherwise(unit_part)
    out = (df.withColumn("pack_count", F.when(has, count))
             .withColumn("unit_size", F.when(has, size))
             .withColumn("unit_measure", F.when(has, measure)))
    return out.withColumn("total_weight", F.col("pack_count") * F.col("unit_size"))


# ── export pack split (SCL-03) ───────────────────────────────────────────
def split_pack(df: DataFrame, col: str = "pack_size_raw") -> DataFrame:
    """'10/5 oz' -> ('10', '5 oz'); no leading 'N/' -> ('', raw); empty -> ('', '')."""
    raw = _strip(F.coalesce(F.col(col), F.lit("")))
    pat = r"^(\d+)/(.+)$"
    m = raw.rlike(pat)
    return (df.withColumn("pack_count_text", F.when(m, F.regexp_extract(raw, pat, 1)).otherwise(F.lit("")))
              .withColumn("pack_rest", F.when(m, _strip(F.regexp_extract(raw, pat, 2))).otherwise(raw)))


# ── grouping name (SCL-04) ───────────────────────────────────────────────
def normalize_name_col(c) -> Column:
    n = _strip(F.lower(F.coalesce(col_(c), F.lit(""))))
    n = F.regexp_replace(n, NAME_SIZE_SUFFIX, "")
    n = F.regexp_replace(n, r"[^a-z0-9\s]", "")
    return _strip(F.regexp_replace(n, r"\s+", " "))


def normalize_name(df: DataFrame, col: str = "product_name", out: str = "name_key") -> DataFrame:
    return df.withColumn(out, normalize_name_col(col))
