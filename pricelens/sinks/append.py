"""Append-only tables partitioned by date, with appends that can be repeated.

Rows lie under ``<date column>=<day>/load=<load id>/``.  An append replaces the partitions of its own
load and leaves all others alone (dynamic partition overwrite), so a run that is repeated - after
a crash, or by mistake - adds nothing, and a read of some days lists and scans those days only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOAD = "load"


def append_by_date(rows: DataFrame, root: str, at: str, load: str | Column, day: str = "day", unit: str = "day") -> None:
    """Append ``rows`` under the day of column ``at`` (the first day of its ``unit``: day, month or year) and the
    id ``load`` of this run.

    The rows of a day meet in as many tasks as the day's share of the data asks for (adaptive
    rebalancing), so a day with a third of all rows is split and a small one is one file.
    """
    load = F.lit(load) if isinstance(load, str) else load
    out = rows.withColumn(day, F.to_date(F.date_trunc(unit, at))).withColumn(LOAD, load.cast("string"))
    (out.hint("rebalance", day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(day, LOAD).parquet(root))


def read_by_date(spark: SparkSession, root: str, since=None, until=None, at: str | None = None, day: str = "day", unit: str = "day") -> DataFrame:
    """The table, or its days from ``since`` to ``until``, both included: a filter on the partition column, which
    lists and scans only the units that hold them.  Name ``at`` where a unit is more than a day."""
    df = spark.read.parquet(root)
    for bound, low in ((since, True), (until, False)):
        if bound is not None:
            edge = F.lit(bound).cast("date")
            first = F.to_date(F.date_trunc(unit, edge))
            df = df.filter(F.col(day) >= first if low else F.col(day) <= first)
            if at is not None:
                df = df.filter(F.to_date(at) >= edge if low else F.to_date(at) <= edge)
    return df
