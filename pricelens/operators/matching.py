"""Keyword extraction (JOI-03) and the keyword-containment join (JOI-04).

The reference runs one ILIKE query per baseline product ("name contains every
keyword").  Substring semantics rule out a token join ('ring' matches
'spring'), and a nested loop over baseline x offers is a cartesian product.
Instead every keyword (ASCII alphanumeric, >= 3 chars) is blocked on its
*rarest trigram*:

1. distinct lower-cased offer names are exploded into their distinct trigrams;
2. a trigram's frequency is the number of names containing it;
3. each baseline row keeps the least frequent trigram over all its keywords;
4. an equi-join on that trigram yields candidate names, each verified with
   ``instr`` for every keyword; verified names join back to the offers.

Every name containing all keywords contains the chosen trigram, so the result
is exact.  All steps are shuffle joins / aggregates on hashed keys; a very
common trigram is a skewed join key, which AQE's skew-join splitting handles.
The per-baseline ranking (unit_price, vendor_slug, sku) keeps k matches with a
``row_number() <= k`` that Spark limits map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.plans.shapes import top_k_per_group
from pricelens.session import ensure_checkpoint_dir

# Fixed value: description prefix the baseline vendor's rows carry.
MATCH_PREFIX = "Amazon match for:"


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def search_name_col(prefix: str = MATCH_PREFIX, name_col: str = "product_name",
                    desc_col: str = "description", max_chars: int | None = 80) -> Column:
    """The text keywords come from; of a match description the first ``max_chars`` (None: all)."""
    desc = F.coalesce(F.col(desc_col), F.lit(""))
    from_desc = _strip(F.replace(desc, F.lit(prefix), F.lit("")))
    from_desc = from_desc if max_chars is None else F.substring(from_desc, 1, max_chars)
    return F.when(desc.startswith(prefix), from_desc).otherwise(F.coalesce(F.col(name_col), F.lit("")))


def keywords_col(search_name: Column) -> Column:
    """Up to 3 keywords (first 4 words longer than 2 chars must number >= 2); null if unusable."""
    cleaned = _strip(F.regexp_replace(search_name, r"[^a-zA-Z0-9\s]", ""))
    words = F.filter(F.split(cleaned, r"\s+"), lambda w: F.length(w) > 2)
    kw4 = F.slice(words, 1, 4)
    usable = (F.length(search_name) >= 5) & (F.size(kw4) >= 2)
    return F.when(usable, F.slice(kw4, 1, 3))


def match_keywords(df: DataFrame, prefix: str = MATCH_PREFIX) -> DataFrame:
    """Adds search_name and keywords (array<string>, null when the row cannot be matched)."""
    out = df.withColumn("search_name", search_name_col(prefix))
    return out.withColumn("keywords", keywords_col(F.col("search_name")))


def _trigram_rows(df: DataFrame, col: str, out: str = "tri") -> DataFrame:
    """One row per (row, trigram position): ``explode(sequence)`` + ``substr`` - both
    run in generated code (a ``transform`` lambda would be interpreted per element)."""
    n = F.length(F.col(col))
    pos = df.filter(n >= 3).select("*", F.explode(F.sequence(F.lit(1), n - 2)).alias("_i"))
    return pos.withColumn(out, F.substr(F.col(col), F.col("_i"), F.lit(3))).drop("_i")


def trigram_index(names: DataFrame, col: str = "lname") -> DataFrame:
    """(name, trigram) for every distinct name - the blocking index of the keyword join.

    The distinct names are spread over the shuffle partitions before the explode, which
    multiplies rows ~len(name) times.  Nothing runs here: the frequency count and the
    candidate join of one query read the same exchange.
    """
    n = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = names.select(col).distinct().repartition(n, col)
    return _trigram_rows(d, col).select(col, "tri").dropDuplicates([col, "tri"]).withColumnRenamed(col, "lname")


def _contains_all(name: Column, kws: Column, max_kw: int = 3) -> Column:
    """Every (lower-cased) keyword occurs in ``name`` - at most ``max_kw`` keywords."""
    cond = F.lit(True)
    for i in range(max_kw):
        w = F.get(kws, i)
        cond = cond & (w.isNull() | (F.instr(name, w) > 0))
    return cond


def _baseline_sets(baseline: DataFrame) -> DataFrame:
    """(bid, b_vendor_id, kws): the lower-cased keywords of a row, joined by blanks (keywords have none)."""
    lkw = F.slice(F.transform("keywords", lambda w: F.lower(w)), 1, 3)
    return baseline.select("bid", F.col("vendor_id").alias("b_vendor_id"), F.array_join(lkw, " ").alias("kws"))


def name_matches(sets: DataFrame, names: DataFrame, salts: int = 8, index=None) -> DataFrame:
    """(columns of ``sets``, lname): the names of ``names(lname)`` that contain every keyword of a set.

    Works on the distinct rows of ``sets``: ``kws``, and whatever the matches are to be kept apart by.  A trigram that
    most names have is dealt over ``salts`` tasks: each name goes to one of them, each set to all.
    ``index``: a stored ``sinks.nameindex.NameIndex`` that has these names, read instead of making their trigrams;
    names that only the index has may come out too.
    """
    key = sets.columns
    grams = trigram_index(names) if index is None else index.postings().select("lname", "tri")
    freq = grams.groupBy("tri").agg(F.count(F.lit(1)).alias("freq"))
    kw = sets.select(*key).distinct().select(*key, F.explode(F.split("kws", " ")).alias("kw"))
    kwtri = _trigram_rows(kw, "kw").select(*key, "tri")
    pick = (kwtri.join(freq, "tri", "left")
            .groupBy(*key).agg(F.min_by("tri", F.struct(F.coalesce("freq", F.lit(0)), "tri")).alias("tri"),
                               F.min(F.coalesce("freq", F.lit(0))).alias("f"))
            .filter(F.col("f") > 0).select(*key, "tri", F.split("kws", " ").alias("lkw")))
    pick = pick.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    dealt = grams.withColumn("salt", F.pmod(F.xxhash64("lname"), F.lit(salts)).cast("int"))
    found = pick.join(dealt, ["tri", "salt"]).filter(_contains_all(F.col("lname"), F.col("lkw"))).select(*key, "lname")
    return found if index is None else found.distinct()  # loads that broke off may have left a posting twice


MATCH_ORDER = ["unit_price", "vendor_slug", "sku"]


def _named_offers(baseline: DataFrame, offers: DataFrame, cols) -> tuple[DataFrame, DataFrame]:
    """(baseline sets, (lname, own, cols) offers): ``own`` is the offer's vendor if that is a vendor of the
    baseline, whose own rows may not take the offer; else null."""
    own = F.broadcast(baseline.select(F.col("vendor_id").alias("own")).distinct())  # one id per vendor of the baseline
    o = offers.select(F.lower("product_name").alias("lname"), *cols)
    return _baseline_sets(baseline), o.join(own, o["vendor_id"] == own["own"], "left")


def _elsewhere(rows: DataFrame) -> DataFrame:
    """Of rows (b_vendor_id, own, ...) those that are not the baseline row's own vendor's."""
    return rows.filter(F.col("own").isNull() | (F.col("own") != F.col("b_vendor_id")))


def _spare(rows: DataFrame, key: str, order: list[Column], k: int) -> DataFrame:
    """Rows of each ``key`` that hold the best ``k`` whichever one vendor of the baseline is left out: the first
    ``2 * k``, counting the best ``k`` of a vendor only.  So a key has as many however many vendors the baseline has."""
    best = top_k_per_group(rows, [key, "own"], order, k, "_r").drop("_r")
    return top_k_per_group(best, [key], order, 2 * k, "_r").drop("_r")


def keyword_join(baseline: DataFrame, offers: DataFrame, k: int | None = 10,
                 offer_cols=("product_id", "vendor_id", "vendor_slug", "sku", "unit_price"),
                 index=None, write: bool = False) -> DataFrame:
    """All offers of *other* vendors whose name contains every keyword of a baseline row,
    best k per row by (unit_price, vendor_slug, sku).

    ``baseline``: (bid, vendor_id, keywords) - keywords non-null, at most 3.
    ``offers``:   product_name plus ``offer_cols``; offers of the baseline row's own
    vendor are dropped.  Pass only offers that may be ranked: a zero price would come first.
    Returns (bid, <offer_cols prefixed m_>, rank).

    Rows with the same keywords are matched once, at whatever vendor.  Of a name's offers, and of those that keywords
    match, only as many are kept as the best k of any vendor of the baseline can need (``_spare``).
    ``index``: see ``name_matches``.  ``write``: the offers kept of each name go to the session's checkpoint folder, so
    that the offers are read once, not for their names and for themselves.
    """
    b, named = _named_offers(baseline, offers, offer_cols)
    names = named
    if k:
        named = _spare(named, "lname", [F.col(c).asc_nulls_last() for c in MATCH_ORDER], k)
        if write:
            ensure_checkpoint_dir(offers.sparkSession)
            names = named = named.checkpoint()
    m = name_matches(b.select("kws"), names.select("lname"), index=index).join(named, "lname")
    m = m.select("kws", "own", *[F.col(c).alias(f"m_{c}") for c in offer_cols])
    order = [F.col(f"m_{c}").asc_nulls_last() for c in MATCH_ORDER]
    sets = b.select("b_vendor_id", "kws").distinct()
    if k:
        m = _elsewhere(sets.join(_spare(m, "kws", order, k), "kws")).drop("own")
        ranked = top_k_per_group(m, ["b_vendor_id", "kws"], order, k, "rank")
    else:
        w = Window.partitionBy("b_vendor_id", "kws").orderBy(*order)
        ranked = _elsewhere(sets.join(m, "kws")).drop("own").withColumn("rank", F.row_number().over(w).cast("bigint"))
    return b.join(ranked, ["b_vendor_id", "kws"]).drop("b_vendor_id", "kws")


def keyword_best_price(baseline: DataFrame, offers: DataFrame, price: str = "unit_price", index=None) -> DataFrame:
    """(bid, best_other, matched): the lowest non-zero price among *all* matches of a baseline
    row at other vendors (null when all are zero); rows without a match do not appear.
    A minimum per name is joined, never the offers, and of the minima that keywords match the two lowest."""
    b, named = _named_offers(baseline, offers, ("vendor_id", price))
    low = F.min(F.when(F.col(price).cast("double") != 0, F.col(price)))
    names = named.groupBy("lname", "own").agg(low.alias("low"))
    m = name_matches(b.select("kws"), named.select("lname"), index=index).join(names, "lname")
    m = _spare(m.groupBy("kws", "own").agg(F.min("low").alias("low")), "kws", [F.col("low").asc_nulls_last()], 1)
    sets = b.select("b_vendor_id", "kws").distinct()
    rows = _elsewhere(sets.join(m, "kws")).groupBy("b_vendor_id", "kws").agg(F.min("low").alias("best_other"))
    return (b.join(rows, ["b_vendor_id", "kws"])
            .select("bid", "best_other", F.lit(True).alias("_matched")))
