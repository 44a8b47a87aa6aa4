"""Distributed building blocks used by several operators.

* ``first_per_group`` - one row per key chosen by an ordering, as an aggregate
  (``min_by`` over a struct) so it gets map-side partial aggregation: a key
  holding a third of all rows never lands whole in one task.
* ``top_k_per_group`` - ``row_number() <= k``; Spark plans this as a partial
  ``WindowGroupLimit`` before the shuffle, so each map task ships at most k
  rows per key.
* ``global_rank`` - a total-order rank without an unpartitioned window:
  range-partition, count rows per partition (one row per partition), prefix
  sum those counts, add the in-partition row number.
* ``with_scalars`` - attach a one-row aggregate to every row as a scalar
  subquery (computed once, no join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def first_per_group(df: DataFrame, keys: list[str], order: list, cols: list[str] | None = None
                    ) -> DataFrame:
    """Row with the smallest ``order`` per ``keys`` (order: list of ascending columns/
    expressions; wrap with negation for descending numerics)."""
    cols = cols or [c for c in df.columns if c not in keys]
    okey = F.struct(*[o.alias(f"_o{i}") if isinstance(o, Column) else F.col(o).alias(f"_o{i}")
                      for i, o in enumerate(order)])
    agg = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in cols]), okey).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols])


def last_per_group(df: DataFrame, keys: list[str], order: list, cols: list[str] | None = None
                   ) -> DataFrame:
    """Row with the largest ``order`` per ``keys`` (``max_by``; partial aggregation)."""
    cols = cols or [c for c in df.columns if c not in keys]
    okey = F.struct(*[o.alias(f"_o{i}") if isinstance(o, Column) else F.col(o).alias(f"_o{i}")
                      for i, o in enumerate(order)])
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in cols]), okey).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols])


def top_k_per_group(df: DataFrame, keys: list[str], order: list, k: int,
                    rank_col: str = "rn") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    # filter directly on row_number (that shape becomes a map-side WindowGroupLimit), then widen
    return (df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)
            .withColumn(rank_col, F.col(rank_col).cast("bigint")))


def global_rank(df: DataFrame, order: list, rank_col: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """1-based row number over a total order, computed without a single-partition window.

    One range-partitioned sort; a row's place inside its partition comes from
    ``monotonically_increasing_id`` (partition index in the high bits, position in
    the low bits).  The sorted data is checkpointed to the shared checkpoint folder
    so the per-partition counts and the rows come from the *same* evaluation
    (range bounds are sampled, and a re-evaluation after a shuffle may sample
    differently).  ``order`` must be a total order (include unique tie-breakers).
    """
    from pricelens.session import ensure_checkpoint_dir

    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    pid = F.spark_partition_id()
    ranged = (df.repartitionByRange(n, *_cols(order)).sortWithinPartitions(*_cols(order))
              .withColumn("_pid", pid)
              .withColumn("_lrn", F.monotonically_increasing_id() - F.shiftleft(pid.cast("bigint"), 33) + 1)
              .checkpoint(eager=True))
    counts = ranged.groupBy("_pid").agg(F.max("_lrn").alias("_n"))
    # one row per partition: bounded by the partition count, safe to broadcast
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0))).select("_pid", "_off")
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(rank_col, (F.col("_off") + F.col("_lrn")).cast("bigint"))
            .drop("_pid", "_off", "_lrn"))


def with_scalars(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Attach the columns of a one-row DataFrame (a global aggregate) to every row of
    ``df`` as a scalar subquery: the aggregate runs once and its single struct value
    is read by every row - no join (a literal-key join would fold into a cross join)."""
    cols = scalars.columns
    value = scalars.select(F.struct(*[F.col(c) for c in cols]).alias("_s")).scalar()
    return df.withColumn("_scalar", value).select(*df.columns, *[F.col(f"_scalar.{c}").alias(c) for c in cols])


def combine_scalars(*frames: DataFrame) -> DataFrame:
    """Side-by-side join of one-row DataFrames."""
    out = frames[0]
    for f in frames[1:]:
        out = with_scalars(out, f)
    return out


def _place(df: DataFrame, col: str) -> Column:
    """A time or number as a double that does not decrease along it."""
    kind = df.schema[col].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(F.col(col).cast("timestamp")).cast("double")
    return F.col(col).cast("double")


def lag_by_key(df: DataFrame, key: list[str], order: list[str], cols: list[str], prefix: str = "prev_",
               hot_share: int = 1000, bins: int = 4096) -> DataFrame:
    """Previous row's ``cols`` within each key in ``order`` (``prev_<c>``) and ``has_prev``,
    without putting a hot key's rows into one task.

    Keys are counted first (a partial aggregate). A key with more than 1 / ``hot_share`` of all rows is hot, so
    there are fewer than ``hot_share`` of them, and their list can be sent to every task. The rows of all other keys
    take the lag in one window by key. A hot key's rows are dealt by ``bins`` equal parts of the
    range its first order column has; the lag is taken inside a part, and the first row of a part takes
    the last row of the part before it: a second window over the first and last rows only, at
    most 2 * ``bins`` a key. Rows of a hot key with one value in the first order column stay together. One plan for
    every size, and nothing runs while it is built. ``key`` + ``order`` must identify a row.
    """
    x = _place(df, order[0])
    counts = df.select(*key, x.alias("_x")).groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    hot = with_scalars(counts, counts.agg(F.sum("_n").alias("_all"))).filter(F.col("_n") * hot_share > F.col("_all"))
    # fewer than hot_share rows, whatever the data
    hot = F.broadcast(hot.select(*[F.col(c).alias(f"_k_{c}") for c in key], "_lo", "_hi"))
    on = F.lit(True)
    for c in key:
        on = on & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    asc = [F.col(c).asc() for c in order]

    w = Window.partitionBy(*key).orderBy(*asc)
    cold = df.join(hot, on, "left_anti").select(
        *df.columns, *[F.lag(c).over(w).alias(f"{prefix}{c}") for c in cols], (F.row_number().over(w) > 1).alias("has_prev"))

    part = F.when(x.isNull(), -1).when(F.col("_hi") > F.col("_lo"), F.floor((x - F.col("_lo")) * bins / (F.col("_hi") - F.col("_lo")))).otherwise(0)
    wp = Window.partitionBy(*key, "_b").orderBy(*asc)
    dealt = df.join(hot, on).select(*df.columns, part.cast("bigint").alias("_b")).select(
        "*", *[F.lag(c).over(wp).alias(f"{prefix}{c}") for c in cols], (F.row_number().over(wp) > 1).alias("has_prev"),
        F.lead(F.lit(1)).over(wp).isNull().alias("_last"))
    out = cold.columns
    edges = dealt.filter(~F.col("has_prev") | F.col("_last"))
    at_start = ~F.col("has_prev")
    edges = edges.select(
        *df.columns, *[F.when(at_start, F.lag(c).over(w)).otherwise(F.col(f"{prefix}{c}")).alias(f"{prefix}{c}") for c in cols],
        (F.row_number().over(w) > 1).alias("has_prev"))
    return cold.unionByName(dealt.filter(F.col("has_prev") & ~F.col("_last")).select(*out)).unionByName(edges)


def exact_quantile(df: DataFrame, value: str, q: float, group: list[str] | None = None,
                   out: str = "quantile") -> DataFrame:
    """Exact linear-interpolation quantile (``percentile`` / ``median`` semantics) of
    ``value`` per ``group`` (or over all rows), by counting and narrowing: nothing is sorted as a whole, and nothing
    runs while the plan is built.

    Values are counted (a partial aggregate); the counts are added up by fine ranges of ln(1 + |value|) with its
    sign, 2^20 to a unit, and those by coarse ranges of 2^14 fine ones. From the top: the coarse range that holds
    the wanted place is found by a running sum, then the fine range inside it, then the value. The wanted places are
    floor and ceiling of (n - 1) * q, whose values are blended. A window holds the coarse ranges of a group (under
    100,000, whatever the values), the fine ranges of one (2^14), or the distinct values of a fine range, which lie
    within a millionth of each other. Returns one row per group: group columns + ``out``.
    """
    group = group or []
    v = df.select(*group, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    size = F.when(F.isnan("_v"), F.lit(2000.0)).otherwise(
        F.least(F.greatest(F.signum("_v") * F.log1p(F.abs("_v")), F.lit(-1000.0)), F.lit(1000.0)))
    values = v.groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("_c")).withColumn("_fine", F.floor(size * 2 ** 20).cast("bigint"))
    fine = values.groupBy(*group, "_fine").agg(F.sum("_c").alias("_c")).withColumn("_coarse", F.shiftright("_fine", 14))
    coarse = fine.groupBy(*group, "_coarse").agg(F.sum("_c").alias("_c"))

    def before(by: str, *part: str) -> Column:
        w = Window.partitionBy(*group, *part).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_c").over(w), F.lit(0))

    here = (F.col("_before") <= F.col("_r")) & (F.col("_r") < F.col("_before") + F.col("_c"))
    places = F.array(F.struct(F.lit(0).alias("t"), F.floor("_h").cast("bigint").alias("r")), F.struct(F.lit(1).alias("t"), F.ceil("_h").cast("bigint").alias("r")))
    c = coarse.withColumn("_before", before("_coarse")).withColumn("_h", (F.sum("_c").over(Window.partitionBy(*group)) - 1).cast("double") * F.lit(float(q)))
    c = c.withColumn("_p", F.explode(places)).select("*", F.col("_p.t").alias("_t"), F.col("_p.r").alias("_r")).filter(here)
    c = c.select(*group, "_coarse", "_t", "_h", (F.col("_r") - F.col("_before")).alias("_r"))
    f = fine.join(c, [*group, "_coarse"]).withColumn("_before", before("_fine", "_t")).filter(here)
    f = f.select(*group, "_fine", "_t", "_h", (F.col("_r") - F.col("_before")).alias("_r"))
    found = values.join(f, [*group, "_fine"]).withColumn("_before", before("_v", "_t")).filter(here)
    agg = found.groupBy(*group).agg(F.max(F.when(F.col("_t") == 0, F.col("_v"))).alias("_vl"), F.max(F.when(F.col("_t") == 1, F.col("_v"))).alias("_vh"),
                                    F.max("_h").alias("_h"))
    frac = F.col("_h") - F.floor("_h").cast("double")
    res = F.when(F.col("_vl") == F.col("_vh"), F.col("_vl")) \
        .otherwise((F.lit(1.0) - frac) * F.col("_vl") + frac * F.col("_vh"))
    return agg.select(*group, res.alias(out))
