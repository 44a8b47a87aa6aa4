"""Keyed state kept in hash buckets under a log of commits.

A change reads and rewrites the buckets that its batch touches and no others.  It is written to
a folder of its own and counts only once its rows are appended to the log - one file, the commit
point - so a crash before that leaves the state as it was, and a batch that the log has already
(same source and batch id) changes nothing.

    root/data/v=<version>-<attempt>/_bucket=<b>/   rows of one bucket
    root/_log/                                     (version, source, batch_id, bucket, path, buckets, mark)

One writer at a time.  What comes to the driver is one row per bucket.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = "version long, source string, batch_id long, bucket int, path string, buckets int, mark timestamp_ntz"


@dataclass
class Head:
    """The last commit: its version (-1 before the first), the files of each bucket, and its mark."""

    version: int = -1
    paths: dict[int, str] = field(default_factory=dict)
    mark: dt.datetime | None = None
    done: bool = False  # the batch asked about is in the log


class BucketTable:
    def __init__(self, spark: SparkSession, root: str, key: list[str], buckets: int = 16):
        self.spark, self.root, self.key, self.buckets = spark, root, list(key), buckets

    def log(self) -> DataFrame | None:
        """The commits; None before the first.  Any other failure to read is an error: taking it
        for an empty log would start the state anew."""
        try:
            return self.spark.read.schema(LOG_SCHEMA).parquet(os.path.join(self.root, "_log"))
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def head(self, source: str | None = None, batch_id: int | None = None) -> Head:
        log = self.log()
        if log is None:
            return Head()
        mine = (F.col("source") == F.lit(source)) & (F.col("batch_id") == F.lit(batch_id))
        rows = log.groupBy("bucket").agg(F.max("version").alias("version"), F.max_by("path", "version").alias("path"), F.max("mark").alias("mark"),
                                         F.max(F.coalesce(mine, F.lit(False))).alias("done"), F.max("buckets").alias("buckets")).collect()
        if rows and rows[0]["buckets"] != self.buckets:
            raise ValueError(f"{self.root} has {rows[0]['buckets']} buckets, not {self.buckets}")
        return Head(max((r["version"] for r in rows), default=-1), {r["bucket"]: r["path"] for r in rows if r["path"]},
                    max((r["mark"] for r in rows if r["mark"]), default=None), any(r["done"] for r in rows))

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def read(self, paths: list[str], schema: T.StructType | None = None) -> DataFrame:
        if not paths:
            if schema is None:
                raise ValueError(f"nothing committed under {self.root}")
            return self.spark.createDataFrame([], schema)
        r = self.spark.read if schema is None else self.spark.read.schema(schema)
        return r.parquet(*paths)

    def current(self, schema: T.StructType | None = None) -> DataFrame:
        """All rows of the last commit."""
        head = self.head()
        if head.version < 0:
            raise ValueError(f"nothing committed under {self.root}")
        return self.read([head.paths[b] for b in sorted(head.paths)], schema)

    def begin(self, batch: DataFrame, schema: T.StructType, source: str, batch_id: int, time: str | None = None) -> Change | None:
        """The change that ``batch`` makes; None if the log has it already.  ``time``: the column whose largest value becomes the mark."""
        head = self.head(source, batch_id)
        if head.done:
            return None
        newest = F.max(F.col(time).cast("timestamp_ntz")) if time else F.lit(None).cast("timestamp_ntz")
        seen = batch.agg(F.collect_set(self.bucket()).alias("touched"), newest.alias("newest")).first()  # at most one value per bucket
        mark = max((m for m in (head.mark, seen["newest"]) if m is not None), default=None)
        touched = sorted(seen["touched"])
        return Change(self, head, source, batch_id, touched, mark, self.read([head.paths[b] for b in touched if b in head.paths], schema))


@dataclass
class Change:
    table: BucketTable
    before: Head
    source: str
    batch_id: int
    touched: list[int]
    mark: dt.datetime | None  # the newest time so far, this batch included
    current: DataFrame  # rows of the touched buckets
    written: dict[int, str] = field(default_factory=dict)

    @property
    def version(self) -> int:
        return self.before.version + 1

    def write(self, new: DataFrame) -> None:
        """Write ``new``, all rows of the touched buckets, aside; ``commit`` makes them count."""
        if not self.touched:
            return
        t = self.table
        out = os.path.join(t.root, "data", f"v={self.version:012d}-{uuid.uuid4().hex}")
        # adaptive rebalancing: a large bucket is written by several tasks
        new.withColumn("_bucket", t.bucket()).hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(out)
        there = t.spark.read.schema("_bucket int").parquet(out).distinct().collect()  # at most one row per bucket
        self.written = {r["_bucket"]: os.path.join(out, f"_bucket={r['_bucket']}") for r in there}

    def commit(self) -> None:
        t = self.table
        rows = [(self.version, self.source, self.batch_id, b, self.written.get(b, ""), t.buckets, self.mark) for b in [-1, *self.touched]]
        t.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(os.path.join(t.root, "_log"))
