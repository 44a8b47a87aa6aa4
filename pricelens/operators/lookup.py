"""Price look-ups of other vendors' products at the baseline vendor.

JOI-12 lookup_terms, JOI-13 build_queries, JOI-14 attribute_match,
JOI-15 choose_result.  The look-up itself (a browser session) is not built;
its results arrive as a table keyed by the term that produced them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.functions.numeric import truthy_num
from pricelens.operators.filters import vendor_ids
from pricelens.operators.matching import MATCH_PREFIX
from pricelens.plans.shapes import first_per_group

LEADING_SIZE = r"(?i)^\d+(\.\d+)?\s*(oz|lb|lbs|gal|ct|pk|pc|count)\s+"


def lookup_terms(products: DataFrame, vendors: DataFrame, exclude_slug: str, n: int | None = 100,
                 seed: int = 42) -> DataFrame:
    """Distinct product names (lower/trim key longer than 5 chars, first in name order)
    of every vendor but the baseline; a seeded sample of ``n`` of them: the smallest by the md5
    of seed and name.

    Names above a threshold - set from their number, so that about ``n`` and some to spare
    pass - are left out first, so what is put in order does not grow with the names or tasks."""
    p = products.join(vendor_ids(vendors, exclude_slug), "vendor_id", "left_anti")
    p = p.withColumn("name_key", F.lower(F.regexp_replace(F.col("product_name"), r"^\s+|\s+$", "")))
    p = p.filter(F.length("name_key") > 5)
    firsts = first_per_group(p.select("name_key", "product_name", "product_id", "sku", "brand", "category",
                                      "unit_price", "vendor_id"),
                             ["name_key"], ["product_name", "product_id"])
    if n:
        total = firsts.agg(F.count(F.lit(1)).alias("n")).scalar()
        digest = F.md5(F.concat(F.lit(f"{seed}|"), F.col("name_key")))
        place = F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(16 ** 12)
        firsts = firsts.filter(place * total < n + 8 * n ** 0.5 + 40).orderBy(digest, "name_key").limit(n)
    return firsts


def build_queries(df: DataFrame, name: str = "product_name", brand: str = "brand",
                  max_chars: int | None = 120) -> DataFrame:
    """Search text: leading size removed, brand prepended when absent, spaces squeezed, ``max_chars`` (None: all)."""
    q = F.regexp_replace(F.regexp_replace(F.coalesce(F.col(name), F.lit("")), r"^\s+|\s+$", ""), LEADING_SIZE, "")
    b = F.coalesce(F.col(brand), F.lit(""))
    q = F.when((b != "") & (F.instr(F.lower(q), F.lower(b)) == 0), F.concat(b, F.lit(" "), q)).otherwise(q)
    q = F.regexp_replace(F.regexp_replace(q, r"\s+", " "), r"^\s+|\s+$", "")
    return df.withColumn("search_query", q if max_chars is None else F.substring(q, 1, max_chars))


def attribute_match(results: DataFrame, terms: DataFrame, key: str = "term_id",
                    prefix: str = MATCH_PREFIX, max_chars: int | None = 200) -> DataFrame:
    """A look-up result inherits the term's category and brand (else the title's first
    word when the title has >= 2 words) and records the term's name (its first ``max_chars``
    characters, None: all) in its description."""
    named = F.coalesce("_tname", F.lit(""))
    named = named if max_chars is None else F.substring(named, 1, max_chars)
    t = terms.select(key, F.col("product_name").alias("_tname"), F.col("brand").alias("_tbrand"),
                     F.col("category").alias("_tcat"))
    j = results.join(t, key)
    words = F.split(F.regexp_replace(F.coalesce("title", F.lit("")), r"^\s+|\s+$", ""), r"\s+")
    brand = F.when(F.coalesce(F.col("_tbrand"), F.lit("")) != "", F.col("_tbrand")) \
        .when((F.size(words) >= 2) & (F.get(words, 0) != ""), F.get(words, 0)).otherwise(F.lit(""))
    return j.select(*[c for c in results.columns], F.col("title").alias("product_name"), brand.alias("brand"),
                    F.coalesce("_tcat", F.lit("")).alias("category"),
                    F.concat(F.lit(prefix + " "), named)
                    .alias("description"))


def choose_result(results: DataFrame, key: str = "term_id", rank: str = "rank", price: str = "unit_price"
                  ) -> DataFrame:
    """Per term: the first of the top 3 results with a (non-zero) price, else the first result."""
    r = results.withColumn("_priced", (F.col(rank) <= 3) & truthy_num(price))
    return first_per_group(r, [key], [~F.col("_priced"), F.col(rank)]).drop("_priced")
