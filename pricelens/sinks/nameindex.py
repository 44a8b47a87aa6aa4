"""A stored index of product names: which names have a trigram.

    root/postings/bucket=<b>/load=<load id>/   (tri, lname), buckets by the hash of the trigram
    root/names/load=<load id>/                 (lname), also names too short for a trigram

An update adds the names that no other load has; files that are there are left alone.  Its postings are
written before its names, each by replacing the partitions of its own load: a run that is repeated adds
nothing, and what a run that broke off left behind is replaced by its repetition.  Postings say only what a
name holds, so those of a name that no offer has any more are harmless: readers join names to offers.
One writer at a time.
"""

from __future__ import annotations

import os
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.operators.matching import trigram_index
from pricelens.session import ensure_checkpoint_dir

MASK_BITS = 63  # trigrams of a term that are intersected; further ones are left to the check of the name


def term_grams(term: str) -> list[str]:
    """Distinct trigrams that every name matching ``ILIKE '%term%'`` has, in lower case.

    They come from the ASCII runs between the term's wildcards; letters beyond ASCII, whose lower case
    can depend on the letters around them, end a run too.
    """
    if "\\" in term:
        return []
    runs = re.findall(r"[\x00-\x24\x26-\x5E\x60-\x7F]{3,}", term)
    return sorted({r.lower()[i:i + 3] for r in runs for i in range(len(r) - 2)})[:MASK_BITS]


class NameIndex:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.buckets = spark, buckets
        self.posting_path, self.name_path = os.path.join(root, "postings"), os.path.join(root, "names")

    def _read(self, path: str, schema: str) -> DataFrame:
        """The table; empty before the first update. Any other failure to read is an error."""
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], schema)
            raise

    def names(self) -> DataFrame:
        return self._read(self.name_path, "lname string, load string")

    def _bucket(self, gram: Column) -> Column:
        return F.pmod(F.xxhash64(gram), F.lit(self.buckets)).cast("int")

    def update(self, offers: DataFrame, load: str, col: str = "product_name") -> None:
        """Add the names of ``offers`` that no other load has."""
        seen = self.names().where(F.col("load") != load).select("lname")
        batch = offers.select(F.lower(col).alias("lname")).where("lname is not null").distinct()
        new = batch.join(seen, "lname", "left_anti")  # the planner sends out the side that is small, if one is
        ensure_checkpoint_dir(self.spark)
        new = new.checkpoint()  # read twice; the offers are not
        grams = trigram_index(new).withColumn("bucket", self._bucket(F.col("tri"))).withColumn("load", F.lit(load))
        # adaptive rebalancing: a bucket with a very common trigram is written by several tasks
        self._replace(grams.hint("rebalance", "bucket"), self.posting_path, ["bucket", "load"])
        self._replace(new.withColumn("load", F.lit(load)), self.name_path, ["load"])

    @staticmethod
    def _replace(rows: DataFrame, path: str, by: list[str]) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)

    def postings(self, grams: list[str] | None = None) -> DataFrame:
        """(tri, lname), a pair once or more often; of ``grams`` only, by reading their buckets only."""
        rows = self._read(self.posting_path, "tri string, lname string, bucket int, load string")
        if grams is not None:
            wanted = self.spark.createDataFrame([(g,) for g in grams], "tri string").select(self._bucket(F.col("tri")).alias("b"))
            buckets = sorted({r["b"] for r in wanted.collect()})  # one row for each trigram of a term
            rows = rows.where(F.col("bucket").isin(buckets) & F.col("tri").isin(grams))
        return rows.select("tri", "lname")

    def search(self, term: str) -> DataFrame:
        """The names that match ``ILIKE '%term%'``, each once: those that have all trigrams of the term, checked.

        A term without a trigram of its own (under three characters, wildcards, other scripts) scans all names.
        """
        grams = term_grams(term)
        if not grams:
            found = self.names().select("lname").distinct()
        else:
            bit = F.lit(0).cast("long")
            for i, g in enumerate(grams):
                bit = F.when(F.col("tri") == g, F.lit(1 << i).cast("long")).otherwise(bit)
            has = self.postings(grams).groupBy("lname").agg(F.bit_or(bit).alias("has"))
            found = has.where(F.col("has") == (1 << len(grams)) - 1).select("lname")
        return found.where(F.col("lname").ilike(f"%{term}%"))
