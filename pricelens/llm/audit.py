"""Filter interaction audit: what every order of a set of filters would do, folded from one cell of counts per combination of failures."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import materialize

BLANKS = r"[\x20\x09-\x0D]+"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_filters(min_words: int = 50, distinct_percent: int = 65, capital_percent: int = 5, symbols: str = "#$%&*|") -> dict[str, Column]:
    """Failure conditions by letter, over the columns ``text`` (not null) and ``words``."""
    n, text = F.size("words"), F.col("text")
    return {
        "A": n < min_words,
        "B": 100 * F.size(F.array_distinct("words")) < distinct_percent * n,
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > capital_percent * F.length(text),
        "D": text.rlike(f"[{symbols}]"),
    }


def failures(docs: DataFrame, filters: dict[str, Column] | None = None, copies: str = "E", id_col: str = "doc_id", text_col: str = "text",
             part_col: str = "source") -> DataFrame:
    """``(doc_id, part, digest, mask)``: bit i of ``mask`` is set where the i-th filter (by letter) fails; the last is ``copies``.

    A text is a copy if a row with a smaller id has the same text, whatever became of that row. Texts are compared by
    their SHA-256. The smallest id of a text is a partial aggregate, joined back by text *and* id, so the rows of one
    text do not meet. Rows that repeat the smallest id are not copies; a null id comes after all others.
    """
    filters = text_filters() if filters is None else filters
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    src = src.withColumn("words", F.filter(F.split("text", BLANKS), lambda w: w != ""))
    letters = sorted([*filters, copies])
    bits = [F.when(filters[c], F.lit(1 << i)).otherwise(0) for i, c in enumerate(letters) if c != copies]
    own = sum(bits[1:], bits[0]) if bits else F.lit(0)
    rows = materialize(src.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), own.cast("int").alias("own")), "audit-rows")
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("first")).withColumnRenamed("digest", "of").hint("merge")
    found = rows.join(firsts, (F.col("digest") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("first")), "left")
    mask = F.col("own") + F.when(F.col("of").isNull(), F.lit(1 << letters.index(copies))).otherwise(0)
    return found.select("doc_id", "part", "digest", mask.cast("int").alias("mask"))


def marked(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``rows`` with ``good`` and ``toxic`` (0 or 1) of their ids: whether any label row says so. Null ids have no labels."""
    said = labels.groupBy(F.col(id_col).cast("long").alias("of")).agg(*[F.max((F.col(a) == 1).cast("int")).alias(b) for a, b in (("quality", "good"), ("toxic", "toxic"))])
    said = said.where("of is not null and (good = 1 or toxic = 1)").withColumn("deal", F.lit(0)).hint("merge")
    # null ids match nothing and are dealt by their text, so that they do not meet in one task
    own = rows.withColumn("salt", F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(1 << 16)).cast("int") + 1).otherwise(0))
    out = own.join(said, (F.col("doc_id") == F.col("of")) & (F.col("salt") == F.col("deal")), "left")
    return out.select(*rows.columns, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("good", "toxic")])


def orders_of(letters: list[str]) -> Column:
    """All orders of the filters, each an array of the filters' bits."""
    return F.array(*[F.array(*[F.lit(1 << letters.index(c)) for c in p]) for p in permutations(letters)])


def folded(cell: Column, orders: Column) -> Column:
    """One struct of counts for each order and step, from the counts of one mask.

    Each order is folded step by step, the bits of the steps before being the state; a cell is kept until a bit of its mask
    has come.
    """
    def step(state: Column, bit: Column) -> Column:
        fails, gone = cell["mask"].bitwiseAND(bit) != 0, cell["mask"].bitwiseAND(state["before"]) != 0
        here = fails & ~gone

        def weigh(when: Column, n: str) -> Column:
            return F.when(when, cell[n]).otherwise(F.lit(0).cast("long"))

        got = F.struct(bit.alias("bit"), weigh(~fails & ~gone, "n").alias("kept"), weigh(here, "n").alias("removed"), weigh(fails & gone, "n").alias("redundant"),
                       weigh(cell["mask"] == bit, "n").alias("unique_fails"), weigh(here, "good").alias("good_lost"), weigh(here, "toxic").alias("toxic_lost"))
        return F.struct(state["before"].bitwiseOR(bit).alias("before"), F.concat(state["steps"], F.array(got)).alias("steps"))

    none = F.from_json(F.lit("[]"), "array<struct<bit:int," + ",".join(f"{c}:bigint" for c in COUNTS) + ">>")
    begin = F.struct(F.lit(0).alias("before"), none.alias("steps"))
    return F.flatten(F.transform(orders, lambda o: F.aggregate(o, begin, step)["steps"]))


def interactions(rows: DataFrame, letters: list[str]) -> DataFrame:
    """What each order of the filters ``letters`` would do at each step, from ``rows(part, mask, good, toxic)``.

    Returns ``(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)``, one row
    per part, order and step, zeros included: documents left after the step, removed by it, failing it but removed before,
    failing it and no other, removed by it with a good or toxic label, and the filter's removals over all orders.

    1. Documents are counted by part and mask, the only pass over them: a partial aggregate of at most 2 ** filters rows a part.
    2. Each cell is folded across the array of orders into one struct of counts for each order and step, and the arrays
       of a part's cells are added element by element, all inside the part's one row. What meets for a part is its cells,
       not its documents.
    """
    width = len(letters)
    counted = rows.groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    cells = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    orders = orders_of(letters)
    nothing = F.struct(F.lit(0).alias("mask"), *[F.lit(0).cast("long").alias(c) for c in ("n", "good", "toxic")])
    merged = F.aggregate("cells", folded(nothing, orders), lambda total, cell: F.zip_with(total, folded(cell, orders), lambda a, b: F.struct(
        a["bit"].alias("bit"), *[(a[c] + b[c]).alias(c) for c in COUNTS])))
    table = cells.select("part", merged.alias("table"))
    by_filter = F.transform(F.array(*[F.lit(1 << i) for i in range(width)]), lambda bit: F.aggregate(
        F.filter("table", lambda x: x["bit"] == bit), F.lit(0).cast("long"), lambda total, x: total + x["removed"]))
    out = table.withColumn("by_filter", by_filter).select("part", "by_filter", F.posexplode("table").alias("i", "x"))
    names = F.array(*[F.lit("".join(p)) for p in permutations(letters)])
    which = F.round(F.log2("x.bit")).cast("int") + 1
    return out.select("part", F.element_at(names, (F.floor(F.col("i") / width) + 1).cast("int")).alias("filter_order"), (F.col("i") % width + 1).cast("int").alias("step"),
                      *[F.col(f"x.{c}").alias(c) for c in COUNTS], F.element_at("by_filter", which).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Column] | None = None, copies: str = "E", id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """Interaction of the text filters and of the removal of copies, for each value of ``part_col`` (see ``interactions``).

    Every whole text counts. A null text is empty (it fails ``A``, and the first empty text is no copy), a null part is the empty
    string, and very long texts are one row like others. Rows that repeat an id are documents of their own. Labels said
    more than once for an id count once; null labels are not 1. An empty table has no parts and gives no rows. Other columns of
    ``docs``, of whatever name, are not looked at.
    """
    filters = text_filters() if filters is None else filters
    return interactions(marked(failures(docs, filters, copies, id_col, text_col, part_col), labels, id_col), sorted([*filters, copies]))
