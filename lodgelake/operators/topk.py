"""Top-k / bottom-k: a global ORDER BY + LIMIT, planned as TakeOrderedAndProject
(each task keeps k rows, the driver merges k x tasks rows)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First k rows in ``order``; callers pass a total order (add key tie-breaks)."""
    return df.orderBy(*order).limit(k)
