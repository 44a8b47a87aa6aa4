"""Line dedup: content-defined chunks of lines, repeated ones removed. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm import bloom
from pricelens.llm.common import materialize, wide_key

ROLL = 1_000_003  # multiplier of the rolling hash
PRIME = 2_147_483_647
LONGEST = 8  # lines of a short chunk
BLANK = r"[^\x20\x09-\x0D]"  # a character that is not blank


def _previous(a: str, fill: int) -> Column:
    return F.concat(F.array(F.lit(fill).cast("long")), F.slice(a, 1, F.size(a) - 1))


def _next(a: str, fill: int) -> Column:
    return F.concat(F.slice(a, 2, F.size(a)), F.array(F.lit(fill).cast("long")))


def with_chunks(docs: DataFrame, text: Column, seeds: int = 1, equal: int | None = None) -> DataFrame:
    """Adds ``__lines`` (the lines of ``text``) and ``__chunks``: an array of (s, e), the first line of a chunk and the line after it.

    A line's rolling hash covers it and the line before. A chunk ends after every line but the first whose rolling hash is
    smaller than that of the line before and not larger than that of the line after. Each end depends on four lines
    only, so an insertion elsewhere does not move it, and a chunk has two lines at least (the last of a text may have one).
    With ``equal``, a chunk also ends after every ``equal`` equal lines in a row (what follows may then have one line).
    ``seeds`` (4 at most): so many sets of chunks, each by seven other digits of the lines' hash; a chunk of several is there once.
    Every step is its own column: arrays are then built once for a text, not once for each element.
    """
    d = docs.withColumn("__lines", F.split(text, "\n", -1)).withColumn("__m", F.transform("__lines", lambda x: F.md5(x)))
    if equal:
        d = d.withColumn("__n", F.arrays_zip(F.col("__m").alias("m"), F.concat(F.array(F.lit("")), F.slice("__m", 1, F.size("__m") - 1)).alias("p"),
                                             F.sequence(F.lit(0), F.size("__m") - 1).alias("i")))
        d = d.withColumn("__a", F.transform(F.filter("__n", lambda x: x["m"] != x["p"]), lambda x: x["i"]))  # where runs of equal lines begin
        d = d.withColumn("__a", F.arrays_zip(F.col("__a").alias("a"), F.concat(F.slice("__a", 2, F.size("__a")), F.array(F.size("__m"))).alias("b")))
        runs = F.filter("__a", lambda x: x["b"] - x["a"] >= equal)
        d = d.withColumn("__a", F.flatten(F.transform(runs, lambda x: F.sequence(x["a"] + equal, x["b"], F.lit(equal)))))
        d = d.withColumn("__a", F.filter("__a", lambda x: x < F.size("__m")))
    for k in range(seeds):
        d = d.withColumn("__h", F.transform("__m", lambda x: F.conv(F.substring(x, 7 * k + 1, 7), 16, 10).cast("long")))
        d = d.withColumn("__r", F.zip_with("__h", _previous("__h", 0), lambda x, before: (x + before * ROLL) % PRIME))
        d = d.withColumn("__n", F.arrays_zip(F.col("__r").alias("r"), _previous("__r", -1).alias("p"), _next("__r", PRIME).alias("q"),
                                             F.sequence(F.lit(1), F.size("__r")).alias("i")))
        ends = F.transform(F.filter("__n", lambda x: (x["r"] < x["p"]) & (x["r"] <= x["q"]) & (x["i"] < F.size("__r"))), lambda x: x["i"])
        d = d.withColumn("__s", F.concat(F.array(F.lit(0)), F.array_sort(F.array_union(ends, "__a")) if equal else ends))
        e = F.concat(F.slice("__s", 2, F.size("__s")), F.array(F.size("__lines")))
        d = d.withColumn(f"__c{k}", F.arrays_zip(F.col("__s").alias("s"), e.alias("e")))
    d = d.withColumn("__chunks", F.array_distinct(F.concat(*[f"__c{k}" for k in range(seeds)])) if seeds > 1 else F.col("__c0"))
    return d.drop("__m", "__a", "__h", "__r", "__n", "__s", *[f"__c{k}" for k in range(seeds)])


def with_short_chunks(docs: DataFrame, text: Column, open_in: int = 8, longest: int = LONGEST) -> DataFrame:
    """Adds ``__lines`` and ``__chunks`` (as ``with_chunks``): a chunk begins at every line but the last, so chunks overlap.

    It ends after the next line whose rolling hash - of that line and the one before, both in the chunk - says so, as those of all but
    one in ``open_in`` lines do; after ``longest`` lines at the latest, and with the text. A chunk depends on its own lines alone:
    wherever a passage of two lines or more stands, and whatever is around it, its chunks are the same.
    """
    d = docs.withColumn("__lines", F.split(text, "\n", -1))
    d = d.withColumn("__h", F.transform("__lines", lambda x: F.conv(F.substring(F.md5(x), 1, 7), 16, 10).cast("long")))
    d = d.withColumn("__b", F.zip_with("__h", _previous("__h", 0), lambda x, before: (x + before * ROLL) % PRIME % open_in != 0))
    starts = F.when(F.size("__lines") > 1, F.sequence(F.lit(0), F.size("__lines") - 2)).otherwise(F.array().cast("array<int>"))

    def end(i: Column) -> Column:
        out = F.least(i + longest, F.size("__lines"))
        for k in range(longest - 1, 0, -1):
            out = F.when(F.get("__b", i + k) | (i + k + 1 == F.size("__lines")), i + k + 1).otherwise(out)
        return out

    return d.withColumn("__chunks", F.transform(starts, lambda i: F.struct(i.alias("s"), end(i).cast("int").alias("e")))).drop("__h", "__b")


def with_keys(docs: DataFrame, text: Column, seeds: int, equal: int | None) -> DataFrame:
    """Adds ``__lines`` and ``__chunks``: arrays of (s, e, key) of the chunks of two lines or more; the key hashes the lines."""
    d = with_chunks(docs, text, seeds, equal) if seeds else with_short_chunks(docs, text)
    long = F.filter("__chunks", lambda c: c["e"] - c["s"] >= 2) if seeds else F.col("__chunks")
    return d.withColumn("__chunks", F.transform(long, lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), F.xxhash64(_run(c, None if seeds else LONGEST)).alias("key"))))


def dedup_lines(docs: DataFrame, bits_per_key: int = 12, hashes: int = 4, max_bits: int = 1 << 28, id_col: str = "doc_id", text_col: str = "text",
                seeds: int = 0, equal: int | None = None) -> DataFrame:
    """``docs`` with every chunk of lines that occurred before taken out of its text.

    Texts are cut into content-defined chunks: overlapping short ones that begin at every line (``with_short_chunks``), or, with
    ``seeds``, those of ``with_chunks``. Of the chunks of two lines or more that occur more than
    once in the corpus with the same bytes, the first occurrence - smallest id, then place - stays and the others are
    removed with their line ends. A line goes if any of its chunks goes, and an equal line of an earlier place stays. Adds
    ``n_lines`` and ``n_removed_lines``, replacing columns of those names.

    1. Chunks are counted by a 64-bit hash; the hashes that occur more than once go into a Bloom filter.
    2. The chunks that the filter lets through are grouped by hash and bytes, a partial aggregate; each group's smallest place stays. A
       chunk that the filter let through by mistake is a group of its own and its own first.
    3. The places that stay, gathered by document, are joined to the texts that have a chunk in the filter; what else
       the filter has goes. Texts without such a chunk are passed on without a shuffle. Places do not meet by hash.

    What is gathered is bounded by the lines of one document. The filter has ``bits_per_key`` bits for each repeated hash, up to
    ``max_bits`` (32 MB), beyond which more single chunks pass to step 2 and the result is the same. Null texts stay null with 0
    lines, and empty texts have one line; a text without repeated chunks is returned as it is. Very long texts are one row, their chunks many. Rows of the
    same id and text are one document (by a 128-bit key): they are treated alike, and do not make each other's chunks
    repeated. A null id comes before all others. An empty table gives an empty table.
    """
    rk, longest = wide_key(F.col(id_col), F.col(text_col)), None if seeds else LONGEST
    src = with_keys(docs.select(rk.alias("rk"), F.col(id_col).alias("id"), F.col(text_col).alias("text")), F.col("text"), seeds, equal)
    # exploding a new array: from a plain column the optimizer infers a filter and writes all steps into it, for every line
    keys = src.select(F.explode(F.transform("__chunks", lambda c: F.struct(c["key"].alias("key"), F.xxhash64("rk", c["s"], c["e"]).alias("place")))).alias("c")).select("c.*")
    counted = keys.groupBy("key").agg(F.min("place").alias("a"), F.max("place").alias("b"))
    often = materialize(counted.where("a <> b").select("key"), "lines-often")
    size = -(-min(max_bits, max(1, often.count()) * bits_per_key) // bloom.BLOCK) * bloom.BLOCK
    bits = bloom.one_row(often, size, hashes)

    def passing(d: DataFrame) -> DataFrame:
        """The chunks that the filter lets through and that are not blank."""
        d = d.withColumn("__bits", bits).withColumn("__chunks", F.filter("__chunks", lambda c: bloom.has(F.col("__bits"), c["key"], size, hashes))).drop("__bits")
        return d.withColumn("__chunks", F.filter("__chunks", lambda c: F.exists(_run(c, longest), lambda x: x.rlike(BLANK))))

    # texts are made before the explode: above it the lines would be split anew for every chunk
    texts = F.transform("__chunks", lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), c["key"].alias("key"), F.array_join(_run(c, longest), "\n").alias("chunk")))
    rows = passing(src).select("rk", "id", F.explode(texts).alias("c")).select("rk", "id", "c.*")
    firsts = rows.groupBy("key", "chunk").agg(F.min(F.struct("id", "s", "rk", "e")).alias("first")).select("first.*")
    stays = materialize(firsts.groupBy(F.col("rk").alias("__rk")).agg(F.collect_list(_code(F.col("s"), F.col("e"))).alias("__stays")), "lines-stay")

    # the row number keeps the optimizer from moving the filters below, with all steps written into them
    d = passing(with_keys(docs.withColumn("__rk", rk), F.col(text_col), seeds, equal)).withColumn("__n", F.monotonically_increasing_id())
    has_some = (F.size("__chunks") > 0) & (F.col("__n") >= 0)
    codes = F.transform("__chunks", lambda c: _code(c["s"], c["e"]))
    cut = d.where(has_some).join(stays.hint("merge"), "__rk", "left")
    gone = F.array_except(codes, F.coalesce("__stays", F.array().cast("array<bigint>")))
    cut = cut.withColumn("__gone", F.flatten(F.transform(gone, lambda c: F.sequence(F.shiftright(c, 32).cast("int"), c.bitwiseAND(F.lit((1 << 32) - 1)).cast("int") - 1))))
    cut = cut.withColumn("__kept", F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), "__gone")).withColumn("__removed", F.size("__lines") - F.size("__kept"))
    kept = F.when(F.col("__removed") > 0, F.array_join(F.transform("__kept", lambda i: F.get("__lines", i)), "\n")).otherwise(F.col(text_col))
    as_is = docs.where(F.col(text_col).isNull()).select(*_result(docs, text_col, F.col(text_col), F.lit(0), F.lit(0)))
    whole = d.where(~has_some & F.col(text_col).isNotNull()).select(*_result(docs, text_col, F.col(text_col), F.size("__lines"), F.lit(0)))
    return cut.select(*_result(docs, text_col, kept, F.size("__lines"), F.col("__removed"))).union(whole).union(as_is)


def _run(c: Column, longest: int | None) -> Column:
    """A chunk's lines, taken one by one where chunks are short: a slice goes through the whole array, so all of them take the square of its size."""
    if longest is None:  # named twice, so that the optimizer does not write the split of the text into the lambda
        return F.slice("__lines", c["s"] + 1, F.least(c["e"] - c["s"], F.size("__lines")))
    return F.filter(F.array(*[F.when(c["s"] + k < c["e"], F.get("__lines", c["s"] + k)) for k in range(longest)]), lambda x: x.isNotNull())


def _code(s: Column, e: Column) -> Column:
    """A chunk's lines as one long."""
    return F.shiftleft(s.cast("long"), 32) + e


def _result(docs: DataFrame, text_col: str, text: Column, n_lines: Column, removed: Column) -> list[Column]:
    out = {**{c: F.col(c) for c in docs.columns}, "n_lines": n_lines.cast("long"), "n_removed_lines": removed.cast("long"), text_col: text}
    return [v.alias(k) for k, v in out.items()]
