"""URL filters by Bloom filter cascades. DataFrame functions only."""

from __future__ import annotations

import string
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm import bloom
from pricelens.llm.common import materialize


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def keys(host_col: str, path_col: str, lengths: list[int]) -> Column:
    """All keys of a url: its host and every parent domain, each with the first characters of the path."""
    hosts = F.transform(F.sequence(F.lit(1), F.size(F.split(host_col, r"\."))), lambda i: F.call_function("substring_index", F.col(host_col), F.lit("."), -i))
    paths = F.filter(F.transform(F.array(*[F.lit(n) for n in lengths]), lambda n: F.when(F.length(path_col) >= n, F.left(F.col(path_col), n))), lambda p: p.isNotNull())
    return F.array_distinct(F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p)))))


@dataclass
class Bloom:
    name: str
    blocks: Column  # a scalar subquery over the written bitmaps
    size: int
    hashes: int
    seed: int  # another for each level: keys that meet in one level must part in the next

    def has(self, key: Column, filters: Column) -> Column:
        """Whether all bits of the key are set; ``filters`` as ``with_filters`` gives them."""
        return bloom.has(filters[self.name], key, self.size, self.hashes, self.seed)

    @staticmethod
    def of(members: DataFrame, n: int, bits_per_key: int, hashes: int, seed: int, name: str) -> Bloom:
        """Filter of the ``n`` rows of ``members(key)``: its bitmaps are aggregated and written by Spark, ``bits_per_key`` / 8 bytes times n."""
        size = max(64, -(-n * bits_per_key // 8) * 8)
        maps = materialize(bloom.bitmaps(members, size, hashes, seed), "urls-level")
        return Bloom(name, bloom.blocks_in_order(maps, size), size, hashes, seed)


def with_filters(df: DataFrame, column: str, levels: list[Bloom], value: Callable[[Column], Column]) -> DataFrame:
    """Adds ``column``: ``value`` of all levels' blocks in one struct. The struct is made and named once, so that the optimizer
    writes the subqueries into the expression and no row carries the blocks."""
    d = df.withColumn("__filters", F.struct(F.lit(0).alias("none"), *[x.blocks.alias(x.name) for x in levels]))
    return d.withColumn(column, F.element_at(F.transform(F.array("__filters"), value), 1)).drop("__filters")


@dataclass
class Cascade:
    """Filters that by turns encode the listed keys and the keys that the filter before wrongly let through."""

    levels: list[Bloom] = field(default_factory=list)

    def has(self, key: Column, filters: Column) -> Column:
        """Exact for every key of the universe the cascade was built over."""
        out = F.lit(False)
        for i, level in reversed(list(enumerate(self.levels))):
            out = level.has(key, filters) & (F.lit(True) if i == len(self.levels) - 1 else ~out)
        return out

    @staticmethod
    def build(universe: DataFrame, listed: Column, name: str, bits_per_key: int = 10, hashes: int = 4) -> Cascade:
        """``universe(key, ...)`` has every key that will be asked for, once; ``listed`` tells the members."""
        out = Cascade()
        inside, outside = universe.where(listed), universe.where(~listed)
        n = inside.count()
        while n:
            level = Bloom.of(inside, n, bits_per_key, hashes, len(out.levels) * hashes, f"{name}{len(out.levels)}")
            out.levels.append(level)
            passed = with_filters(outside, "__in", [level], lambda f: level.has(F.col("key"), f)).where("__in").drop("__in")
            inside, outside = passed, inside
            n = inside.count()
        return out


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Verdict for every url by the longest rule that fits: ``(page_id, host, path, rule, verdict)``, one row per row of ``pages``.

    ``rules(host, path, verdict)`` - ``allow`` or ``block``; a rule listed twice blocks if either blocks - fits its host and
    all subdomains where the url's path starts with its path. Of the rules that fit the longest (host and path together, in
    characters) wins; no two of one length fit with different text and the same host. Without one the verdict is ``default``.

    The universe is every key that any url of ``pages`` can ask for: made with a partial aggregate and written once. One
    cascade encodes the keys with an allowing rule, one those with a blocking rule, each exact over the universe. Urls
    are then judged in one pass over the pages, without a join. Filters take ``bits_per_key`` bits for each listed key that
    occurs, and are the only thing sent out: each level is a written table that a scalar subquery reads (125 MB for 10^8 listed
    keys that occur), no literal of the plan. Null urls, and urls without ``://``, have an empty host and path; very long
    urls have as many keys as dots times lengths of listed paths. Rows that repeat are judged each for itself, and an empty
    table gives an empty table.
    """
    listed = rules.select(F.concat(F.translate("host", string.ascii_uppercase, string.ascii_lowercase), "path").alias("key"), F.length("path").alias("n"), "verdict")
    lengths = sorted(r["n"] for r in listed.select("n").distinct().collect())
    src = pages.select(F.col(id_col).alias("page_id"), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"))
    asked = src.withColumn("keys", keys("host", "path", lengths)) if lengths else src.withColumn("keys", F.array().cast("array<string>"))
    known = listed.groupBy("key").agg(F.max("verdict").alias("verdict"))  # block comes after allow
    universe = materialize(asked.select(F.explode("keys").alias("key")).distinct().join(known, "key", "left"), "urls-universe")
    blocked = Cascade.build(universe, F.coalesce(F.col("verdict") == "block", F.lit(False)), "block")
    allowed = Cascade.build(universe, F.coalesce(F.col("verdict") == "allow", F.lit(False)), "allow")

    def longest(filters: Column) -> Column:
        fits = F.filter("keys", lambda k: blocked.has(k, filters) | allowed.has(k, filters))
        return F.array_max(F.transform(fits, lambda k: F.struct(F.length(k).alias("n"), k.alias("key"), blocked.has(k, filters).alias("block"))))

    out = with_filters(asked, "best", blocked.levels + allowed.levels, longest)
    verdict = F.when(F.col("best").isNull(), F.lit(default)).when(F.col("best.block"), F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", F.col("best.key").alias("rule"), verdict.alias("verdict"))
