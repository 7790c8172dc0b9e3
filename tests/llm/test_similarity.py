"""SimHash by vantage-point trees against brute force; benchmark matches."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from lodgelake.llm import decontaminate, simhash
from tests.llm.conftest import ALNUM, BLANK, SF, by_id, lower


def plain_fingerprint(text):
    w = BLANK.findall(lower(text))
    if not w:
        return 0
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints):
    """Least index reachable over links of at most 2 bits."""
    label = list(range(len(prints)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_fingerprint():
    for t in (None, "", " \n", "One", "a b", "a b c", "A a\tB\x0bc  d e f\x1cg \xa0 \x85", "Ünïcode Ärger É é " * 5, "x " * 1000):
        assert simhash.fingerprint((t or "").encode()) == plain_fingerprint(t)


def near(rng, n, centres, flips):
    base = [rng.getrandbits(64) for _ in range(centres)]
    return np.unique(np.array([
        rng.choice(base) ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(flips + 1))) for _ in range(n)], np.uint64))


@pytest.mark.parametrize("centres,flips", [(1, 3), (5, 4), (300, 2), (2000, 1)])
def test_forests_of_shards_link_what_brute_force_links(centres, flips):
    """Routing plus shard search, on clusters and on scattered points."""
    v = near(random.Random(centres), 1500, centres, flips)
    tree = simhash.top_tree(v[::4], 2, leaf_sample=16)
    shard, point, home = simhash.route(tree, v, 2)
    assert sorted(point[home]) == sorted(v)  # everyone has one home
    where = {int(x): k for k, x in enumerate(v)}
    label = np.arange(len(v))
    for s in np.unique(shard):
        own, guest = point[(shard == s) & home], point[(shard == s) & ~home]
        a, b = simhash.links(own, guest, 2, exact=32)
        simhash._unite(label, np.array([where[int(x)] for x in a], int), np.array([where[int(x)] for x in b], int))
    assert label.tolist() == plain_components([int(x) for x in v])


def test_components_of_long_chains(spark):
    """Links that make a path, in random order, join into one component."""
    order = list(range(1, 200))
    random.Random(1).shuffle(order)
    edges = spark.createDataFrame([(i, i - 1) for i in order] + [(1000, 1001)], "fp bigint, other bigint")
    got = {r.fp: r.root for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 200)}, 1001: 1000}


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    prints = [plain_fingerprint(r.text) for r in rows]
    root = plain_components(prints)
    got = by_id(simhash.near_duplicates(docs, shard_points=16).withColumn("hex", simhash.hex_of("fp")))
    for i, r in enumerate(rows):
        assert got[r.doc_id].hex == f"{prints[i]:016x}"
        assert got[r.doc_id].component_id == rows[root[i]].doc_id


def test_dedup_cases(spark, docs_of):
    """Nulls, empty texts, repeated rows, clashing columns: one row a component."""
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(1, long), (2, long), (2, long), (None, long), (3, None), (4, ""), (4, ""), (5, "other words here now"),
            (None, "alone without id"), (None, "alone without id"), (6, "Other words HERE now")]
    docs = docs_of(rows, extra=True)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted(
        [("1", long), ("3", None), ("5", "other words here now"), ("None", "alone without id")])
    found = simhash.near_duplicates(docs)
    assert found.count() == len(rows)
    assert by_id(found)[2].component_id == 1 and by_id(found)[4].component_id == 3
    assert {r.component_id for r in found.where("doc_id is null").collect()} == {1, None}
    assert simhash.near_duplicates(docs_of([])).count() == 0 and simhash.keep_one(docs_of([])).count() == 0


def plain_contamination(docs, items):
    out = []
    wins = [(i, w[s:s + 13]) for i, t in items for w in [ALNUM.findall(lower(t))] if w
            for s in range(max(1, len(w) - 12))]
    for d, t in docs:
        w = ALNUM.findall(lower(t))
        hit, ids = set(), set()
        for i, g in wins:
            for s in range(len(w) - len(g) + 1):
                if w[s:s + len(g)] == g:
                    hit |= set(range(s, s + len(g)))
                    ids.add(i)
        names = sorted(str(i) for i in ids - {None})
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def test_contamination_against_brute_force(spark, docs_of):
    """Short items, one-word items, repeats, copies, nulls, overlaps, case."""
    rng = random.Random(3)
    word = lambda: rng.choice(["a", "b", "c", "the", "Éa", "x1", "zz"])
    items = [(1, " ".join(word() for _ in range(30))), (2, "One Two, three!"), (3, "solo"), (4, None), (5, "..."),
             (6, " ".join("abcdefghijklm")), (7, " ".join("abcdefghijklm")), (None, "item without an id"), (8, "b a b a")]
    items += [(9, "Two three")]
    first = items[0][1]
    docs = [(k, " ".join(word() for _ in range(rng.randrange(60)))) for k in range(30)]
    docs += [(100, f"start {first} end {first}"), (101, first.upper()), (102, "one.two-THREE solo solo"), (103, None), (104, ""),
             (105, "x " + " ".join("abcdefghijklm") + " b a b a b"), (105, "same id other text two three"), (None, "solo"),
             (106, "an item without an id here"), (106, "an item without an id here"), (107, " ".join(first.split()[3:16])),
             (108, " ".join(first.split()[3:15])), (109, "filler " * 2000 + "solo")]
    items_df = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.contamination(docs_of(docs, extra=True), items_df)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_contamination(docs, items)
    kept = decontaminate.keep_clean(docs_of(docs, extra=True), items_df)
    assert kept.count() == sum(not r[-1] for r in plain_contamination(docs, items))
    none = items_df.where("false")
    assert decontaminate.contamination(docs_of(docs), none).where("n_hit > 0 or contaminated").count() == 0
    assert decontaminate.contamination(docs_of([]), items_df).count() == 0


def test_windows_in_blocks(spark, docs_of, monkeypatch):
    """More windows than a block holds give the same result."""
    items = [(k, " ".join(f"t{k + j}" for j in range(20))) for k in range(6)]
    docs = [(k, " ".join(f"t{k + j}" for j in range(16))) for k in range(8)]
    items_df = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 5)
    got = decontaminate.contamination(docs_of(docs), items_df)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_contamination(docs, items)


def test_proximity(spark, docs_of):
    """Over a full index, terms may stand a few words from their places."""
    items = spark.createDataFrame([(1, "red green blue")], "item_id bigint, text string")
    windows = decontaminate.windows_of(items)
    docs = docs_of([(1, "red green blue"), (2, "red very green and blue"), (3, "blue far far far far red green"), (4, "red green")])
    index = decontaminate.build_index(docs)
    row = {r.row_id: r.doc_id for r in index.collect()}
    near = {row[r.row_id] for r in decontaminate.search(index, windows, slop=2).collect()}
    exact = {row[r.row_id]: r.starts for r in decontaminate.search(index, windows).collect()}
    assert near == {1, 2} and exact == {1: [0]}


def test_windows_are_searched_one_block_at_a_time(spark, docs_of, monkeypatch):
    """Blocks of a few windows give the matches of one block, and each block's
    broadcast is gone before the next block's is made."""
    from pyspark import Broadcast, SparkContext
    words = [f"w{k}" for k in range(40)]
    texts = [(k, " ".join(words[k % 7 : 20 + k % 20])) for k in range(30)]
    items = spark.createDataFrame([(k, " ".join(words[k : k + 15])) for k in range(12)], "item_id bigint, text string")
    docs, windows = docs_of(texts), decontaminate.windows_of(items)
    index = decontaminate.build_index(docs)
    found = lambda: sorted((r.row_id, r.window, r.starts) for r in decontaminate.search(index, windows).collect())
    whole, live, most = found(), set(), []
    make, destroy = SparkContext.broadcast, Broadcast.destroy

    def counted(self, value):
        b = make(self, value)
        live.add(id(b))
        most.append(len(live))
        return b

    def ended(self, *args, **kw):
        live.discard(id(self))
        return destroy(self, *args, **kw)

    monkeypatch.setattr(SparkContext, "broadcast", counted)
    monkeypatch.setattr(Broadcast, "destroy", ended)
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 4)
    assert found() == whole and whole
    assert len(most) > 2 and set(most) == {1} and not live
