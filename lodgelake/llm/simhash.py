"""SimHash near-duplicates: exact pairs within a bit distance by vantage-point trees.

1. Fingerprints: majority bit over the XXH64 values of a text's word shingles.
2. Equal fingerprints collapse to one node before anything is paired, so copies
   cost one row each however many there are.
3. A top tree, built from a bounded sample of the nodes, cuts the space into
   shards: inner nodes hold a vantage point and a radius; points within the
   radius go inside, the others outside.  A point lives in one shard.  Outside
   points nearer than ``radius + bits`` to the vantage point also visit the
   inside as queries (one direction is enough to find each pair); queries
   visit every side that the triangle bound cannot exclude.
4. Each shard continues the same recursion over arrays until few points are
   left, compares those exactly, and returns a spanning forest of its links
   (never all pairs).
5. Components of the forests come from rounds of minimum propagation with
   shortcuts, each round written to the shared folder.

Cost: for fingerprints without structure a point crosses a cut with a chance of
about 0.2 and a query stays on both sides with about 0.45, so visits grow with
the number of shards to the power 0.54; the README has the figures.

Cases: null or empty text has no words and fingerprint 0, linked like any
other; fewer words than a shingle make one shingle; repeated rows keep one
output row each; a null doc_id is returned and linked but never names a
component unless all of its members are null; other columns are ignored.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgelake.llm.common import bounded_batches, chunks, first_by_hash, fresh, row_key, stored, texts_of

SHINGLE, BITS, SEED = 3, 2, 42
#: Points a shard should hold, sample points for each cut-off leaf of the top
#: tree, and the largest sample (8 bytes each) the driver builds the tree from.
SHARD_POINTS, LEAF_SAMPLE, MAX_SAMPLE = 2_048, 16, 1 << 20
#: Points compared exactly instead of being divided further; share of the
#: comparisons that a cut may leave.
EXACT, WORTH = 256, 0.85
#: Edges a file of an intermediate edge table should hold.
FILE_EDGES = 500_000


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit majority of the shingles' hashes; 0 without words."""
    words = text.lower().split()  # bytes: A-Z only, blanks and 9-13 only
    if not words:
        return 0
    if len(words) > shingle:
        texts = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
        n = len(words) - shingle + 1
    else:
        texts, n = iter([b" ".join(words)]), 1
    h = np.fromiter(map(xxhash.xxh64_intdigest, texts, repeat(seed)), np.uint64, n)
    bits = np.unpackbits(h.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    over = 2 * np.add.reduce(bits, axis=0, dtype=np.int32) > n
    return int(np.packbits(over, bitorder="little").view(np.uint64)[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    """Fingerprint of each text as a signed 64-bit number."""
    bounded_batches()

    @F.arrow_udf("bigint")
    def mark(column: pa.Array) -> pa.Array:
        out = [fingerprint(t, shingle, seed) for part in chunks(texts_of(column)) for t in part]
        return pa.array(np.array(out, np.uint64).view(np.int64))

    return mark(text)


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _cut(own: np.ndarray, guests: np.ndarray, bits: int, rng: np.random.Generator):
    """(vantage, radius, its masks) dividing ``own`` best, or None where the
    triangle bound excludes too little to pay: comparisons must fall to
    ``WORTH`` of what they are, and no side may get under a tenth."""
    best, most = None, WORTH * len(own) * (len(own) / 2 + len(guests))
    for v in rng.choice(own, min(3, len(own)), replace=False):
        d = np.bitwise_count(own ^ v).astype(np.int16)
        inside = np.cumsum(np.bincount(d, minlength=65))
        r = int(np.abs(2 * inside - len(own)).argmin())
        n_in, n_out = int(inside[r]), len(own) - int(inside[r])
        if min(n_in, n_out) * 10 < len(own):
            continue
        g = np.bitwise_count(guests ^ v).astype(np.int16)
        masks = d <= r, (d > r) & (d <= r + bits), g <= r + bits, g > r - bits
        work = (n_in * (n_in / 2 + int(masks[1].sum()) + int(masks[2].sum()))
                + n_out * (n_out / 2 + int(masks[3].sum())))
        if work <= most:
            best, most = (v, r, masks), work
    return best


def top_tree(sample: np.ndarray, bits: int = BITS, leaf_sample: int = LEAF_SAMPLE) -> list | int:
    """Nested [vantage, radius, inside, outside] lists with shard numbers at the leaves."""
    rng = np.random.default_rng(SEED)
    shards = iter(range(1 << 40))

    def grow(own: np.ndarray, guests: np.ndarray):
        cut = _cut(own, guests, bits, rng) if len(own) > leaf_sample else None
        if cut is None:
            return next(shards)
        vantage, radius, (near, crossing, inward, outward) = cut
        return [vantage, radius, grow(own[near], np.concatenate([own[crossing], guests[inward]])),
                grow(own[~near], guests[outward])]

    return grow(sample, sample[:0])


def route(tree, points: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, point, at home) for every shard each point lives in or visits."""
    shard, point, home = [], [], []

    def walk(node, own: np.ndarray, guests: np.ndarray) -> None:
        if not len(own) and not len(guests):
            return
        if not isinstance(node, list):
            shard.append(np.full(len(own) + len(guests), node, np.int64))
            point.append(np.concatenate([own, guests]))
            home.append(np.arange(len(own) + len(guests)) < len(own))
            return
        vantage, radius, inside, outside = node
        d, g = (np.bitwise_count(x ^ vantage).astype(np.int16) for x in (own, guests))
        walk(inside, own[d <= radius], np.concatenate(
            [own[(d > radius) & (d <= radius + bits)], guests[g <= radius + bits]]))
        walk(outside, own[d > radius], guests[g > radius - bits])

    walk(tree, points, points[:0])
    if not shard:
        return np.zeros(0, np.int64), points[:0], np.zeros(0, bool)
    return np.concatenate(shard), np.concatenate(point), np.concatenate(home)


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the sets of a[i] and b[i]; label[x] is always the least member."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            short = label[label]
            if (short == label).all():
                break
            label[:] = short


def links(points: np.ndarray, guests: np.ndarray, bits: int, exact: int = EXACT) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (member, least member) of all pairs point-point and
    point-guest within ``bits``; both arrays hold distinct values."""
    node, at = np.unique(np.concatenate([points, guests]), return_inverse=True)
    label = np.arange(len(node))
    rng = np.random.default_rng(SEED)

    def compare(own: np.ndarray, others: np.ndarray) -> None:
        step = max(1, 1_000_000 // max(1, len(own)))
        values = node[own]
        for k in range(0, len(others), step):
            part = others[k:k + step]
            near = np.bitwise_count(node[part][:, None] ^ values[None, :]) <= bits
            i, j = np.nonzero(near)
            _unite(label, part[i], own[j])

    todo = [(at[:len(points)], at[len(points):])]
    while todo:
        own, others = todo.pop()
        if not len(own):
            continue
        cut = _cut(node[own], node[others], bits, rng) if len(own) > exact else None
        if cut is not None:
            near, crossing, inward, outward = cut[2]
            todo.append((own[near], np.concatenate([own[crossing], others[inward]])))
            todo.append((own[~near], others[outward]))
            continue
        compare(own, own)
        compare(own, others)
    moved = label != np.arange(len(node))
    return node[moved], node[label[moved]]


def _forest(nodes: DataFrame, bits: int, shard_points: int) -> DataFrame:
    """Links (fp, other) whose components are those of all pairs of ``nodes``."""
    want = min(MAX_SAMPLE, LEAF_SAMPLE * -(-nodes.count() // shard_points))
    sample = nodes.where(first_by_hash(nodes, "fp", want)).orderBy(F.xxhash64("fp"), "fp").limit(want).select("fp").toArrow()["fp"]
    tree = top_tree(sample.to_numpy().view(np.uint64), bits)
    held = nodes.sparkSession.sparkContext.broadcast(tree)  # at most MAX_SAMPLE / LEAF_SAMPLE cuts

    def visit(batches):
        for b in batches:
            shard, point, home = route(held.value, b["fp"].to_numpy().view(np.uint64), bits)
            for k in range(0, len(point), 100_000):
                s = slice(k, k + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard[s]), pa.array(point[s].view(np.int64)), pa.array(home[s])],
                    ["shard", "fp", "home"])

    def pair(rows: pa.Table) -> pa.Table:
        fp, home = rows["fp"].to_numpy().view(np.uint64), rows["home"].to_numpy()
        a, b = links(fp[home], fp[~home], bits)
        return pa.table({"fp": a.view(np.int64), "other": b.view(np.int64)})

    return (
        nodes.select("fp").mapInArrow(visit, "shard bigint, fp bigint, home boolean")
        .groupBy("shard").applyInArrow(pair, "fp bigint, other bigint")
    )


def components(edges: DataFrame) -> DataFrame:
    """(fp, root): the least member of each node's component, by rounds of
    large-star and small-star steps until no edge moves.  Every step is an
    aggregation per node, written, and a join with the written minima whose
    hot nodes AQE can split; nothing is gathered."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        """Hang each node's larger (or smaller) neighbours on its least one."""
        if large:
            both = e.union(e.select("v", "u").toDF("u", "v"))
        else:
            both = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = write(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        hung = both.join(least, "u")
        if large:
            hung = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            hung = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.toDF("u", "v"))
        return write(hung.where("u != v").distinct())

    def write(rows: DataFrame) -> DataFrame:
        return stored(rows.coalesce(parts), "simhash-edges")

    def summary(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    e = stored(edges.toDF("u", "v").where("u != v"), "simhash-edges")
    before = summary(e)
    parts = -(-before[0] // FILE_EDGES)  # edges never get more
    while before[0]:
        e = star(star(e, True), False)
        now = summary(e)
        if now == before:
            break
        before = now
    return e.toDF("fp", "root")


def _grouped(docs: DataFrame, shingle: int, bits: int, shard_points: int) -> tuple[DataFrame, DataFrame]:
    """Marked rows (no_id, id, text_hash, fp) and (fp, root, least row of the component)."""
    marked = stored(
        row_key(docs.select("doc_id", "text"), ["id", "no_id", "text_hash"])
        .select("id", "no_id", "text_hash", fingerprint_column(F.col("text"), shingle).alias("fp")), "simhash-docs")
    nodes = stored(marked.groupBy("fp").agg(F.min(F.struct("no_id", "id", "text_hash")).alias("least")), "simhash-nodes")
    root = components(_forest(nodes, bits, shard_points))
    rooted = nodes.join(root, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    return marked, rooted


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS,
                    shard_points: int = SHARD_POINTS) -> DataFrame:
    """doc_id, fp and component_id of every row of ``docs``."""
    marked, rooted = _grouped(docs, shingle, bits, shard_points)
    firsts = rooted.groupBy("root").agg(F.min("least").alias("first"))
    named = stored(rooted.join(firsts, "root").select("fp", "first"), "simhash-named")
    id_of = lambda no, i: F.when(~F.col(no), F.col(i))
    return marked.join(named, "fp").select(
        id_of("no_id", "id").alias("doc_id"), "fp", id_of("first.no_id", "first.id").alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS,
             shard_points: int = SHARD_POINTS) -> DataFrame:
    """One row of each component, with the columns of ``docs``: the row of its
    least doc_id (rows without an id come last; equal rows count as one)."""
    names = fresh(docs, "row_id", "row_no_id", "row_text")
    kept = (
        _grouped(docs, shingle, bits, shard_points)[1]
        .groupBy("root").agg(F.min("least").alias("least"))
        .select(F.col("least.id").alias(names[0]), F.col("least.no_id").alias(names[1]),
                F.col("least.text_hash").alias(names[2]))
    )
    return (
        row_key(docs, names).join(kept, names, "left_semi")
        .dropDuplicates(names).select(*(f"`{c}`" for c in docs.columns))
    )
