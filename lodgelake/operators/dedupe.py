"""Pick one row per key.

``first_per_key`` / ``latest_per_key`` are aggregations (min/max of a struct
whose leading fields are the ordering columns), not windows: Spark combines
map-side, so a key holding a third of all rows is reduced inside every task
before the shuffle and no task ever holds a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _pick_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                  largest: bool, keep_null_keys: bool) -> DataFrame:
    keys, order_cols = list(keys), list(order_cols)
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    packed = F.struct(*[F.col(c) for c in order_cols + rest])
    pick = F.max(packed) if largest else F.min(packed)
    group = list(keys)
    if keep_null_keys:
        # A NULL key never conflicts (as with a SQL UNIQUE constraint): give each
        # such row its own group id so it passes through unchanged.
        any_null = F.lit(False)
        for k in keys:
            any_null = any_null | F.col(k).isNull()
        df = df.withColumn("_solo", F.when(any_null, F.monotonically_increasing_id()))
        group.append("_solo")
    out = df.groupBy(*group).agg(pick.alias("_pick")).select(*keys, "_pick.*")
    return out.select(*[c for c in df.columns if c != "_solo"])


def first_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                  keep_null_keys: bool = True) -> DataFrame:
    """Row with the smallest ``order_cols`` per key (ties: remaining columns)."""
    return _pick_per_key(df, keys, order_cols, largest=False, keep_null_keys=keep_null_keys)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                   keep_null_keys: bool = False) -> DataFrame:
    """Row with the largest ``order_cols`` per key; NULLs order lowest."""
    return _pick_per_key(df, keys, order_cols, largest=True, keep_null_keys=keep_null_keys)


def top1_window(df: DataFrame, partition: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """row_number() = 1 for mixed sort directions.

    Only for groups with a structural size bound (e.g. (listing, month) holds at
    most 31 rows because (listing, date) is unique); Spark plans it with
    WindowGroupLimit so each task keeps one row per group before sorting.
    """
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
