"""MinHash near-duplicates: one-permutation hashing, optimal densification,
banded buckets, star-shaped candidates and confirmation on whole sets.

1. A text's set: the XXH64 values of its distinct word shingles, sorted.
2. One permutation: the 64-bit range is cut into ``bands * rows`` bins, and a
   bin's value is the least hash in it.  An empty bin takes the value of the
   first filled bin in its own fixed random order of the bins (optimal
   densification: the choice does not depend on where the bin lies).
3. Equal sets collapse to one node before anything is paired, so copies cost
   one row each however many there are.
4. ``rows`` values make a band's key; nodes with equal keys share a bucket.  A
   bucket proposes a star: the edges from its centre to its other members.
5. A candidate goes on if its sizes fit and its odd sketches (parity bit maps of
   the sets) allow a link: the bits in which two sketches differ are never more
   than the elements in which the sets differ, so no link is refused here.  It
   is a link if the whole sets say so: they are built again from the texts of
   the documents in question, so that the sets of all are never stored.
6. A star alone would lose links between two members that the centre is not
   close to.  Buckets that still hold several components are therefore
   compared within tasks by their sketches, in tiles of bounded size.  Of the
   pairs that may be links, a spanning forest and the nearest few of each
   member are confirmed as in 5; a refuted pair is not proposed again.  Rounds
   end when no bucket holds an untested pair of different components: within a
   bucket no link is lost, and pairs are never written out group by group.

A pair at a similarity s shares no bucket with a chance of about
``(1 - s**rows) ** bands``: 6e-9 at 0.85.

Cases: null or empty text has an empty set, is linked with nothing and is its
own component; fewer words than a shingle make one shingle; repeated rows keep
one output row each; a null doc_id is linked, but names no component unless all
of its members are null (its row then counts as kept); other columns are
ignored.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgelake.llm.common import bit_map_of, chunks, list_array, row_key, stored, texts_of
from lodgelake.llm.simhash import components

SHINGLE, PERCENT, BANDS, ROWS, SEED = 3, 85, 40, 6, 42
#: Members of a tile's side; members that a task compares at once in all.
TILE = 1_024
#: Bits of an odd sketch for each element of the set, and its least 64-bit words.
SKETCH_BITS, SKETCH_WORDS = 4, 8
#: Pairs whose sketches are compared at once.
PAIRS = 1 << 18


def shingle_set(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Sorted distinct shingle hashes; empty without words."""
    words = text.lower().split()  # bytes: A-Z only, blanks and 9-13 only
    if len(words) > shingle:
        texts = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
        n = len(words) - shingle + 1
    else:
        texts, n = iter([b" ".join(words)]), min(1, len(words))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, texts, repeat(seed)), np.uint64, n))


def donors(bins: int, seed: int = SEED) -> np.ndarray:
    """For each bin the order in which it looks for a filled one."""
    rng = np.random.default_rng(seed)
    return np.stack([rng.permutation(bins) for _ in range(bins)])


def signature(hashes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """One value for each bin of a non-empty sorted set."""
    bins = len(order)
    at = ((hashes >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)  # rises with the hash
    first = np.flatnonzero(np.diff(at, prepend=np.uint64(bins)))
    filled = np.zeros(bins, bool)
    out = np.zeros(bins, np.uint64)
    filled[at[first]] = True
    out[at[first]] = hashes[first]
    empty = np.flatnonzero(~filled)
    for k in range(0, bins, 16):
        if not len(empty):
            break
        look = filled[order[empty, k:k + 16]]
        found = look.any(axis=1)
        here = empty[found]
        out[here] = out[order[here, k + look[found].argmax(axis=1)]]
        empty = empty[~found]
    return out


def band_keys(values: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each run of ``rows`` values, mixed with the run's number."""
    runs = values.reshape(-1, rows)
    key = np.arange(1, len(runs) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(rows):
        key = (key ^ runs[:, k]) * np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(29)
    return key


def odd_sketch(hashes: np.ndarray) -> np.ndarray:
    """Parity of the number of elements at each bit, as 64-bit words; the width
    is a power of two, and halves of a wider sketch add up to a narrower one."""
    words = SKETCH_WORDS
    while 64 * words < SKETCH_BITS * len(hashes):
        words *= 2
    odd = np.bincount((hashes & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """Sketches (one a row) brought down to ``words`` words."""
    while sketches.shape[1] > words:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


KEY = ["id", "no_id", "text_hash"]
_MARKS = "n_set bigint, set_a bigint, set_b bigint, band_keys array<bigint>, sketch binary"



def _marks(texts: list[bytes], shingle: int, rows: int, order: np.ndarray) -> list[pa.Array]:
    sets = [shingle_set(t, shingle) for t in texts]
    sums = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
    keys = [band_keys(signature(s, order), rows) if len(s) else s for s in sets]
    return [
        pa.array([len(s) for s in sets], pa.int64()),
        pa.array(np.array([v >> 64 for v in sums], np.uint64).view(np.int64)),
        pa.array(np.array([v & (2**64 - 1) for v in sums], np.uint64).view(np.int64)),
        _lists(keys),
        pa.array([odd_sketch(s).tobytes() for s in sets], pa.binary()),
    ]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    return list_array(np.array([len(a) for a in arrays]), pa.array(np.concatenate(arrays).view(np.int64)))


def marked(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """Every row with a number of its own, its set's size and hash, its band keys
    and its sketch."""
    keyed = row_key(docs.select("doc_id", "text"), KEY).select(
        *KEY, F.monotonically_increasing_id().alias("row"), "text")

    def mark(batches):
        order = donors(bands * rows)
        for b in batches:
            texts, at = texts_of(b["text"]), 0
            for part in chunks(texts):
                s = slice(at, at + len(part))
                at += len(part)
                yield pa.RecordBatch.from_arrays(
                    [b[c][s] for c in (*KEY, "row")] + _marks(part, shingle, rows, order),
                    names=[*KEY, "row", *(x.split()[0] for x in _MARKS.split(", "))])

    return keyed.mapInArrow(mark, f"id bigint, no_id boolean, text_hash bigint, row bigint, {_MARKS}")


def _sets(docs: DataFrame, need: DataFrame, shingle: int) -> DataFrame:
    """(row, hashes): the whole sets of the rows ``need`` (row and KEY), built
    again from their texts.  A bit map of fixed size lets few other rows through."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(bit_map_of(need, F.xxhash64(*KEY)))

    def build(batches):
        done = set()
        for b in batches:
            keys = b["key"].to_numpy()
            at = np.flatnonzero(held.value.has(keys.view(np.uint64)))
            at = [k for k in at.tolist() if not (keys[k] in done or done.add(keys[k]))]
            own = b.take(pa.array(at, pa.int64()))
            texts, k = texts_of(own["text"]), 0
            for part in chunks(texts):
                s = slice(k, k + len(part))
                k += len(part)
                yield pa.RecordBatch.from_arrays(
                    [own[c][s] for c in KEY] + [_lists([shingle_set(t, shingle) for t in part])], names=[*KEY, "hashes"])

    keyed = row_key(docs.select("doc_id", "text"), KEY).select(*KEY, "text").withColumn("key", F.xxhash64(*KEY))
    sets = keyed.mapInArrow(build, "id bigint, no_id boolean, text_hash bigint, hashes array<bigint>")
    return sets.join(need, KEY).select("row", "hashes")


def may_link(n: np.ndarray, sketches: list[np.ndarray], a: np.ndarray, b: np.ndarray,
             percent: int) -> tuple[np.ndarray, np.ndarray]:
    """For the pairs (a, b) of members: the bits in which their sketches differ,
    and whether these and the sizes allow a link: a link's sets differ in at most
    ``(n_a + n_b) * (100 - percent) / (100 + percent)`` elements."""
    width = np.array([len(s) for s in sketches], np.int64)
    place, stack = np.zeros(len(n), np.int64), {}
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        place[at], stack[w] = np.arange(len(at)), np.stack([sketches[k] for k in at])
    bits = np.zeros(len(a), np.int64)
    for wa, sa in stack.items():
        for wb, sb in stack.items():
            words = min(wa, wb)
            here = np.flatnonzero((width[a] == wa) & (width[b] == wb))
            step = max(1, 16 * PAIRS // max(wa, wb))
            for p in range(0, len(here), step):
                at = here[p:p + step]
                x, y = folded(sa[place[a[at]]], words), folded(sb[place[b[at]]], words)
                bits[at] = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
    fit = 100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])
    return bits, fit & (bits * (100 + percent) <= (n[a] + n[b]) * (100 - percent))


def survivors(root: np.ndarray, n: np.ndarray, sketches: list[np.ndarray], left: np.ndarray, right: np.ndarray,
              percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, bits that differ) of the pairs of a member of ``left`` and one of
    ``right`` that lie in different components and whose sketches allow a link."""
    found = []
    step = max(1, PAIRS // max(1, len(right)))
    for k in range(0, len(left), step):
        own = left[k:k + step]
        small = np.minimum(n[own][:, None], n[right][None, :])
        large = np.maximum(n[own][:, None], n[right][None, :])
        i, j = np.nonzero((root[own][:, None] != root[right][None, :]) & (100 * small >= percent * large)
                          & (own[:, None] != right[None, :]))
        a, b = own[i], right[j]
        bits, fit = may_link(n, sketches, a, b, percent)
        found.append((a[fit], b[fit], bits[fit]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(x) for x in zip(*found))


def proposals(root: np.ndarray, a: np.ndarray, b: np.ndarray, bits: np.ndarray, each: int) -> np.ndarray:
    """Positions of the pairs to test next: a forest that joins what the pairs
    join, and for every member its ``each`` nearest."""
    order = np.argsort(bits, kind="stable")
    take = [np.zeros(0, np.int64)]
    if each:
        ends = np.concatenate([a[order], b[order]])
        by_end = np.argsort(ends, kind="stable")
        start = np.r_[True, np.diff(ends[by_end]) > 0] if len(by_end) else np.zeros(0, bool)
        rank = np.arange(len(by_end)) - np.flatnonzero(start)[np.cumsum(start) - 1]
        take.append(np.tile(order, 2)[by_end[rank < each]])
    label = np.unique(root, return_inverse=True)[1]
    while len(order):
        x, y = label[a[order]], label[b[order]]
        order = order[x != y]
        x, y = label[a[order]], label[b[order]]
        best = np.unique(np.r_[np.unique(x, return_index=True)[1], np.unique(y, return_index=True)[1]])
        take.append(order[best])
        _merge(label, x[best], y[best])
    return np.unique(np.concatenate(take))


def _merge(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Give the labels that the pairs (x, y) connect their least one."""
    to = np.arange(label.max() + 1)
    while True:
        low = np.minimum(to[x], to[y])
        before = to.copy()
        np.minimum.at(to, to[x], low)
        np.minimum.at(to, to[y], low)
        to = to[to]
        if (to == before).all():
            break
    label[:] = to[label]


def _confirmed(edges: DataFrame, docs: DataFrame, nodes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(u, v, linked): whether the whole sets of a (written) candidate are similar enough."""
    ends = edges.select(F.explode(F.array("u", "v")).alias("row")).distinct()
    sets = _sets(docs, stored(nodes.select("row", *KEY).join(ends, "row"), "minhash-ends"), shingle)
    both = F.size(F.array_intersect("set_u", "set_v"))
    return edges.join(sets.toDF("u", "set_u"), "u").join(sets.toDF("v", "set_v"), "v").select(
        "u", "v", (100 * both >= percent * (F.size("set_u") + F.size("set_v") - both)).alias("linked"))


def _allowed(edges: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Candidates (u, v) whose sizes and sketches allow a link."""
    def sift(batches):
        for b in batches:
            n = np.concatenate([b[c].to_numpy() for c in ("n_u", "n_v")])
            sketches = [np.frombuffer(x, np.uint64) for c in ("sketch_u", "sketch_v") for x in b[c].to_pylist()]
            own = np.arange(b.num_rows)
            fit = pa.array(may_link(n, sketches, own, own + b.num_rows, percent)[1])
            yield pa.RecordBatch.from_arrays([b["u"].filter(fit), b["v"].filter(fit)], ["u", "v"])

    of = nodes.select("row", "n_set", "sketch")
    small, large = F.least("n_u", "n_v"), F.greatest("n_u", "n_v")
    return (
        edges.join(of.toDF("u", "n_u", "sketch_u"), "u").join(of.toDF("v", "n_v", "sketch_v"), "v")
        .where(100 * small >= percent * large).mapInArrow(sift, "u bigint, v bigint")
    )


def _tiles(members: DataFrame, percent: int, each: int) -> DataFrame:
    """Candidates (u, v) of the open buckets' members (key, size, row, root, n_set,
    sketch, refuted), compared tile by tile."""
    def compare(t: pa.Table) -> pa.Table:
        key, i, j = (t[c].to_numpy() for c in ("key", "i", "j"))
        order = np.lexsort([j, i, key])
        cuts = np.flatnonzero((np.diff(key[order]) != 0) | (np.diff(i[order]) != 0) | (np.diff(j[order]) != 0)) + 1
        row, root, n, block = (t[c].to_numpy() for c in ("row", "root", "n_set", "block"))
        sketch, refuted = t["sketch"].to_pylist(), t["refuted"].to_pylist()
        out = []
        for at in np.split(order, cuts):
            side = block[at] == i[at]
            left = np.flatnonzero(side)
            right = left if i[at[0]] == j[at[0]] else np.flatnonzero(~side)
            a, b, bits = survivors(root[at], n[at], [np.frombuffer(sketch[k], np.uint64) for k in at], left, right, percent)
            if right is left:
                a, b, bits = (x[a < b] for x in (a, b, bits))
            gone = {(row[k], r) for k in at for r in refuted[k]}
            if gone:
                keep = np.array([(x, y) not in gone and (y, x) not in gone
                                 for x, y in zip(row[at[a]], row[at[b]])], bool)
                a, b, bits = a[keep], b[keep], bits[keep]
            if len(a):
                next_ = proposals(root[at], a, b, bits, each)
                u, v = row[at[a[next_]]], row[at[b[next_]]]
                out.append((np.minimum(u, v), np.maximum(u, v)))
        u, v = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 2
        return pa.table({"u": u, "v": v})

    blocks = F.ceil(F.col("size") / F.lit(TILE)).cast("int")
    placed = members.withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", "row", "root", "n_set", "sketch", "refuted", "block",
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    bins = max(1, members.select(F.sum(blocks)).first()[0] // (2 * TILE))  # rows in all tiles, by tiles' size
    return spread.groupBy(F.pmod(F.xxhash64("key", "i", "j"), F.lit(bins)).alias("bin")).applyInArrow(
        compare, "u bigint, v bigint").distinct()


def _linked(docs: DataFrame, nodes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(row, root) of the nodes that have a link: the components of all links
    between nodes (row, KEY, n_set, band_keys, sketch, copies) that share a bucket."""
    in_band = nodes.select("row", "copies", F.explode("band_keys").alias("key"))
    buckets = in_band.groupBy("key").agg(
        F.count("*").alias("size"), F.min(F.struct((-F.col("copies")).alias("few"), "row")).getField("row").alias("centre"),
    ).where("size > 1")
    members = stored(in_band.join(buckets, "key").select("key", "row", "size", "centre"), "minhash-buckets")
    star = members.where("row != centre").select(
        F.least("row", "centre").alias("u"), F.greatest("row", "centre").alias("v")).distinct()
    confirmed = lambda edges: stored(_confirmed(
        stored(edges, "minhash-candidates"), docs, nodes, shingle, percent).dropDuplicates(["u", "v"]), "minhash-tested")
    tested = confirmed(_allowed(star, nodes, percent))
    each = 0
    while True:
        roots = components(tested.where("linked").select(F.col("u").alias("fp"), F.col("v").alias("other")))
        rooted = members.join(roots.toDF("row", "root"), "row", "left").withColumn("root", F.coalesce("root", "row"))
        open_ = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
        refuted = tested.where("not linked").groupBy(F.col("v").alias("row")).agg(F.collect_list("u").alias("refuted"))
        left = stored(
            rooted.join(open_.select("key"), "key").select("key", "size", "row", "root")
            .join(nodes.select("row", "n_set", "sketch"), "row").join(refuted, "row", "left")
            .withColumn("refuted", F.coalesce("refuted", F.array().cast("array<bigint>"))), "minhash-open")
        more = confirmed(_tiles(left, percent, each)) if not left.isEmpty() else left
        if more.isEmpty():
            return roots.toDF("row", "root")
        tested = stored(tested.union(more), "minhash-tested")
        each = max(1, 4 * each)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``."""
    rows_ = stored(marked(docs, shingle, bands, rows), "minhash-rows")
    least = F.min(F.struct("no_id", "id", "row")).alias("least")
    full = rows_.where("n_set > 0")
    classes = stored(full.groupBy("set_a", "set_b").agg(least, F.count("*").alias("copies")), "minhash-classes")
    nodes = stored(
        full.select("row", *KEY, "n_set", "band_keys", "sketch")
        .join(classes.select(F.col("least.row").alias("row"), "copies"), "row"), "minhash-nodes")
    roots = _linked(docs, nodes, shingle, percent)
    named = classes.join(roots.withColumnRenamed("row", "rep"), F.col("least.row") == F.col("rep"), "left").select(
        "set_a", "set_b", "least", F.coalesce("root", "least.row").alias("root"))
    firsts = named.groupBy("root").agg(F.min("least").alias("first"))
    of_set = stored(named.join(firsts, "root").select("set_a", "set_b", "first"), "minhash-named")
    id_of = lambda no, i: F.when(~F.col(no), F.col(i))
    slim = rows_.select("id", "no_id", "n_set", "set_a", "set_b")
    joined = slim.where("n_set > 0").join(of_set, ["set_a", "set_b"]).select("id", "no_id", "n_set", "first")
    alone = slim.where("n_set = 0").select(
        "id", "no_id", "n_set", F.struct("no_id", "id", F.lit(0).cast("bigint").alias("row")).alias("first"))
    out = joined.union(alone).select(
        id_of("no_id", "id").alias("doc_id"), F.col("n_set").alias("n_shingles"),
        id_of("first.no_id", "first.id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
