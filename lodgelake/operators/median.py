"""Exact median per group without holding a group in one task.

The values are counted per (group, value) - a hash aggregation that combines
map-side.  The counts of ``WIDTH`` neighbouring values make a bucket, a short
list; the running count over a group's buckets (their number is bounded by the
range of the values, not by rows) finds the one or two in which the middle ranks
lie, and only their values are ranked.  The rows are read once, and there are
three exchanges: by value, by bucket, by group.  The result equals
``percentile_cont(0.5)``: the mean of the two middle values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Values (integers, e.g. cents) to a bucket.
WIDTH = 1000


def exact_median(df: DataFrame, keys: Sequence[str], value: Column,
                 name: str = "median") -> DataFrame:
    """keys..., name (double); groups without a non-NULL value are absent."""
    keys = list(keys)
    counts = (df.select(*keys, value.alias("_v")).where(F.col("_v").isNotNull())
              .groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n")))
    buckets = counts.groupBy(*keys, F.floor(F.col("_v") / WIDTH).alias("_b")).agg(
        F.sum("_n").alias("_bn"), F.collect_list(F.struct("_v", "_n")).alias("_values"))  # at most WIDTH values
    running = lambda *by: Window.partitionBy(*keys, *by).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    # 0-based ranks of the middle values: (all-1) div 2 and all div 2
    low, high = F.floor((F.col("_all") - 1) / 2), F.floor(F.col("_all") / 2)
    middle = (
        buckets.withColumn("_upto", F.sum("_bn").over(running().orderBy("_b")))
        .withColumn("_all", F.sum("_bn").over(Window.partitionBy(*keys)))
        .withColumn("_before", F.col("_upto") - F.col("_bn"))
        .where((F.col("_upto") > low) & (F.col("_before") <= high))
        .select(*keys, "_b", "_before", "_all", F.inline("_values")))
    ranked = middle.withColumn("_cum", F.col("_before") + F.sum("_n").over(running("_b").orderBy("_v")))
    picked = ranked.groupBy(*keys).agg(
        F.min(F.when(F.col("_cum") > low, F.col("_v"))).alias("_lo"),
        F.min(F.when(F.col("_cum") > high, F.col("_v"))).alias("_hi"))
    return picked.select(*keys, ((F.col("_lo").cast("double") + F.col("_hi").cast("double")) / 2).alias(name))
