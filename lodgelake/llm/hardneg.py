"""Hard-negative mining by slots between the positives' upper limits.

An anchor's score with a row is the integer inner product of their quantised
vectors.  A positive of score s allows negatives with scores in
``[low * s / 100, high * s / 100]``; an anchor's windows overlap, as each
positive has one of its own.

1. Anchors are a stated query set and are taken in blocks of bounded bytes; one
   block at a time is broadcast, and every task scores its own rows against the
   block by matrix products.
2. Positives: the best rows of the anchor's label, kept per task (a combiner),
   then over all tasks.
3. The positives' distinct upper limits cut an anchor's score line into
   disjoint slots.  A row falls into one slot, and a combiner keeps the best k
   of each slot, so that a task hands on at most k rows a slot whatever it reads.
4. Slots are merged from the highest down.  A positive's window begins at the
   top of its own slot, so it is answered by the suffix of the slots from there
   on: the first k of that suffix which reach its lower limit.

Rows are read in order of their ids within a task, so of equal scores the
smaller id is met first and the running k-th best score shuts out the later.

Cases: a row without id, label or vector, or with a null or non-finite
component (also after scaling), takes no part; a missing component of a shorter
vector counts as zero, and an empty vector scores zero with all; repeated rows
are rows of their own, as anchors, positives and negatives; ties go to the
smaller id; an anchor without positives, or whose positives score below zero,
has no windows; sums beyond 53 bits are taken in exact integers, and a pair
whose score does not fit into 64 bits takes no part; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgelake.llm.common import stored
from lodgelake.session import scratch_path

POSITIVES, NEGATIVES, LOW, HIGH, SCALE = 5, 3, 50, 95, 256
#: Bytes of the vectors of a block of anchors; scores computed at once.
BLOCK_BYTES, SCORES = 16_000_000, 1 << 21
NEVER = np.iinfo(np.int64).min
_BEST = "anchor bigint, slot int, score bigint, id bigint"


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(id, label, vector of whole numbers) of the rows that take part."""
    finite = lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))  # noqa: E731  NaN is above it
    whole = lambda x: F.when(F.abs(x) < F.lit(2.0**53), F.floor(x).cast("double")).otherwise(x)
    vector = F.transform("embedding", lambda x: F.lit(float(scale)) * x.cast("double"))
    return (
        vectors.select(F.col("vec_id").cast("bigint").alias("id"), F.col("label").cast("bigint").alias("label"),
                       vector.alias("vector"))
        .where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.forall("vector", finite), F.lit(False)))
        .withColumn("vector", F.transform("vector", whole))
    )


def matrix(column: pa.ListArray, width: int | None = None) -> np.ndarray:
    """Vectors as rows of a matrix, filled up with zeros."""
    ends = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    wide = max(int(ends.max(initial=0)), width or 0)
    if len(ends) and (ends == wide).all():
        full = flat.reshape(len(ends), wide)
    else:
        full = np.zeros((len(ends), wide))
        full[np.arange(wide)[None, :] < ends[:, None]] = flat
    return full if width is None else full[:, :width]


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` and ``b``; NEVER beyond 64 bits."""
    bound = a.shape[1] * np.abs(a).max(initial=0) * np.abs(b).max(initial=0)
    if bound < 2**53:
        kind = np.float32 if bound < 2**24 else np.float64
        return a.astype(kind) @ b.astype(kind).T
    whole = lambda m: np.array([[int(x) for x in r] for r in m], object).reshape(m.shape)
    exact = whole(a) @ whole(b).T
    return np.where(np.abs(exact) < 2**63, exact, NEVER).astype(np.int64)


class _Block:
    """A block of anchors, and for each anchor its slots: upper limits that fall
    from slot to slot, and the score that a row must beat to enter a slot."""

    def __init__(self, t: pa.Table, labels: bool):
        self.row, self.id, self.label = (t[c].to_numpy() for c in ("row", "id", "label"))
        self.vectors = matrix(t["vector"].combine_chunks())
        self.same = labels
        self.upper = np.full((len(self.row), 1), np.iinfo(np.int64).max)
        self.floor = np.full((len(self.row), 1), NEVER)

    def windows(self, anchor: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Slots for negatives from the windows [low, high] of anchors (by position)."""
        self.same = False
        on = low <= high
        anchor, low, high = anchor[on], low[on], high[on]
        order = np.lexsort([-high, anchor])
        a, h = anchor[order], high[order]
        new = np.r_[True, (np.diff(a) != 0) | (np.diff(h) != 0)] if len(a) else np.zeros(0, bool)
        a, h = a[new], h[new]
        place = np.arange(len(a)) - np.searchsorted(a, a)
        width = int(place.max(initial=0)) + 1
        self.upper = np.full((len(self.row), width), NEVER)
        self.upper[a, place] = h
        least = np.full(len(self.row), np.iinfo(np.int64).max)
        np.minimum.at(least, anchor, low)
        self.floor = np.where(self.upper > NEVER, np.c_[self.upper[:, 1:], np.full(len(self.row), NEVER)], np.iinfo(np.int64).max)
        self.floor = np.maximum(self.floor, np.minimum(least[:, None], np.iinfo(np.int64).max) - 1)

    def best(self, batches, k: int):
        """Best k rows of each slot of each anchor among the rows of a task."""
        floor = self.floor.copy()
        kept = [np.zeros(0, np.int64) for _ in range(4)]  # anchor, slot, score, id
        most = max(1, SCORES // max(1, len(self.row)))
        step = 16
        for b in batches:
            vectors = matrix(b["vector"], self.vectors.shape[1])
            row, ident, label = (b[c].to_numpy() for c in ("row", "id", "label"))
            at = 0
            while at < len(row):
                part = slice(at, at + step)
                at, step = at + step, min(most, 2 * step)
                s = scores(self.vectors, vectors[part])
                hit = (s > floor.min(axis=1).astype(s.dtype)[:, None]) & (s <= self.upper[:, :1].astype(s.dtype))
                a, c = np.divmod(np.flatnonzero(hit.ravel()), s.shape[1])
                score = s[a, c].astype(np.int64)
                same = self.label[a] == label[part][c]
                fit = same & (self.row[a] != row[part][c]) if self.same else ~same
                a, c, score = a[fit], c[fit], score[fit]
                slot = (score[:, None] <= self.upper[a]).sum(axis=1) - 1
                fit = score > floor[a, slot]
                new = a[fit], slot[fit], score[fit], ident[part][c[fit]]
                if not len(new[0]):
                    continue
                kept = [np.concatenate(x) for x in zip(kept, new)]
                order = np.lexsort([kept[3], -kept[2], kept[1], kept[0]])
                kept = [x[order] for x in kept]
                start = np.r_[True, (np.diff(kept[0]) != 0) | (np.diff(kept[1]) != 0)]
                rank = np.arange(len(order)) - np.flatnonzero(start)[np.cumsum(start) - 1]
                kept = [x[rank < k] for x in kept]
                full = rank[rank < k] == k - 1
                floor[kept[0][full], kept[1][full]] = kept[2][full]  # what a later row must beat
        for p in range(0, len(kept[0]), 100_000):
            part = slice(p, p + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.row[kept[0][part]]), pa.array(kept[1][part].astype(np.int32)),
                 pa.array(kept[2][part]), pa.array(kept[3][part])], ["anchor", "slot", "score", "id"])


def _top(best: DataFrame, k: int) -> DataFrame:
    """First k of each slot over all tasks (Spark limits each task's part first)."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def limits(score: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest whole number n with low * s <= 100 n <= high * s."""
    whole, rest = np.divmod(score, 100)
    return low * whole - (-low * rest) // 100, high * whole + (high * rest) // 100


def _blocks(rows: DataFrame, block_bytes: int) -> int:
    total = rows.where("is_anchor").agg(F.sum(8 * F.size("vector") + 256)).first()[0]
    return -(-(total or 0) // block_bytes)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
         high: int = HIGH, scale: int = SCALE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and
    negative_score: for every row that ``is_anchor`` (a condition on ``id``)
    and each of its positives, the first ``negatives`` rows of another label
    with a score of ``low`` to ``high`` percent of the positive's."""
    spark = vectors.sparkSession
    rows = stored(
        quantised(vectors, scale).withColumn("row", F.monotonically_increasing_id())
        .withColumn("is_anchor", F.coalesce(is_anchor, F.lit(False))), "hardneg-rows")
    ordered = rows.select("row", "id", "label", "vector").sortWithinPartitions("id")
    n = _blocks(rows, block_bytes)
    of_block = F.pmod(F.xxhash64("row"), F.lit(max(1, n)))
    found, slots = scratch_path(spark, "hardneg-positives"), scratch_path(spark, "hardneg-slots")
    kinds = ("anchor bigint, anchor_id bigint, positive_id bigint, place int, positive_score bigint, low bigint, slot int",
             _BEST)
    spark.createDataFrame([], kinds[0]).write.parquet(found)
    spark.createDataFrame([], kinds[1]).write.parquet(slots)

    def best(block: _Block, k: int) -> DataFrame:
        held = spark.sparkContext.broadcast(block)  # at most about block_bytes, and k ids a slot
        found_ = stored(_top(ordered.mapInArrow(lambda batches: held.value.best(batches, k), _BEST), k), "hardneg-best")
        held.destroy()
        return found_

    for number in range(n):
        block = _Block(rows.where(F.col("is_anchor") & (of_block == number)).toArrow(), labels=True)
        near = best(block, positives).orderBy("anchor", "rank").toArrow()  # `positives` rows an anchor of the block
        anchor, score = near["anchor"].to_numpy(), near["score"].to_numpy()
        by_row = np.argsort(block.row)
        at = by_row[np.searchsorted(block.row, anchor, sorter=by_row)]
        least, most = limits(score, low, high)
        block.windows(at, least, most)
        slot = (most[:, None] <= block.upper[at]).sum(axis=1) - 1
        spark.createDataFrame(pa.table({
            "anchor": anchor, "anchor_id": block.id[at], "positive_id": near["id"], "place": near["rank"],
            "positive_score": score, "low": least, "slot": pa.array(slot.astype(np.int32))}), kinds[0],
        ).where("slot >= 0").write.mode("append").parquet(found)
        best(block, negatives).select("anchor", "slot", "score", "id").write.mode("append").parquet(slots)

    # An anchor has at most `positives` slots of `negatives` rows each: a short list, from the highest score down.
    merged = spark.read.schema(kinds[1]).parquet(slots).groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("fall"), "id", "slot"))).alias("merged"))
    window = F.slice(F.filter("merged", lambda x: (x["slot"] >= F.col("slot")) & (-x["fall"] >= F.col("low"))), 1, negatives)
    return (
        spark.read.schema(kinds[0]).parquet(found).join(merged, "anchor")
        .select("anchor_id", "positive_id", "positive_score", F.posexplode(window).alias("at", "negative"))
        .select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"),
                F.col("negative.id").alias("negative_id"), "positive_score", (-F.col("negative.fall")).alias("negative_score"))
    )
