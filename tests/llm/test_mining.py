"""Hard negatives, collocations and MinHash near-duplicates against plain
versions, on small tables and on the cases that tables may hold."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodgelake.llm import collocate, hardneg, minhash
from lodgelake.llm.common import table
from tests.llm.conftest import BLANK, SF, lower

VECTORS = "vec_id bigint, embedding array<double>, label int"


# ---- hard negatives -------------------------------------------------------------

def plain_negatives(rows, every=50):
    """All windows by sorting every row for every anchor and positive."""
    rows = [(i, l, [int(np.floor(256 * x)) for x in v]) for i, v, l in rows
            if i is not None and l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (a, la, va) in enumerate(rows):
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, l) for m, (i, l, v) in enumerate(rows) if m != n)
        for p, pid, _ in [s for s in scored if s[2] == la][:5]:
            fit = [(i, -s) for s, i, l in scored if l != la and 50 * -p <= 100 * -s <= 95 * -p][:3]
            out += [(a, pid, r + 1, i, -p, s) for r, (i, s) in enumerate(fit)]
    return sorted(out)


def mined(spark, rows, extra=False, **kw):
    df = spark.createDataFrame(rows, VECTORS)
    if extra:
        for c in ("id", "row", "slot", "score", "is_anchor", "anchor"):
            df = df.withColumn(c, F.lit("clash"))
    got = hardneg.mine(df.repartition(3), F.col("id") % 50 == 0, **kw)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def vectors(n, dim=6, labels=3, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(size=dim)], int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("block_bytes", [16_000_000, 700])
def test_negatives_equal_plain(spark, block_bytes):
    rows = vectors(260)
    assert mined(spark, rows, block_bytes=block_bytes) == plain_negatives(rows)


def test_negatives_with_ties_copies_and_one_hot_vector(spark):
    rows = vectors(120, dim=2, labels=2)
    rows = [(i, [round(x) / 4 for x in v], l) for i, v, l in rows] + [(i, [0.5, 0.25], i % 2) for i in range(120, 200)]
    rows += rows[:60]  # repeated rows: anchors 0 and 50 stand twice
    assert mined(spark, rows, extra=True) == plain_negatives(rows)


def test_negatives_of_odd_rows(spark):
    rows = vectors(110)
    rows[3] = (3, None, 1)
    rows[4] = (4, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1)
    rows[5] = (5, [float("nan")] + [0.0] * 5, 1)
    rows[6] = (6, [float("inf")] + [0.0] * 5, 1)
    rows[7] = (7, [9.0] * 6, None)
    rows[8] = (None, [9.0] * 6, 2)
    rows[9] = (9, [], 2)
    rows[10] = (10, [0.5, 0.5], 2)
    plain = [(i, v + [0.0] * (6 - len(v)) if v is not None else v, l) for i, v, l in rows]
    assert mined(spark, rows) == plain_negatives(plain)


def test_negatives_beyond_53_bits_are_exact(spark):
    big = float(2**21)
    rows = [(0, [big + 1, 1.0], 0), (1, [big + 1, 3.0], 0), (2, [big * 0.75, 0.5], 1), (3, [big * 0.75, 0.25], 1),
            (4, [1e300, 1.0], 1)]  # the last one's scores fit no long
    assert mined(spark, rows) == plain_negatives(rows[:4])


def test_negatives_of_an_empty_table(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 0)]) == []  # no anchor
    assert mined(spark, [(0, [1.0], 0), (1, [0.9], 1)]) == []  # an anchor without positives


# ---- collocations ----------------------------------------------------------------

def plain_collocations(rows, min_count, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    cands = {g: c for g, c in f.items() if len(g[1]) > 1 and c >= min_count}
    covered = {}
    for (lang, g), c in cands.items():
        for k in range(2, len(g)):
            for s in range(len(g) - k + 1):
                covered[lang, g[s:s + k]] = max(c, covered.get((lang, g[s:s + k]), 0))
    by_lang = {}
    for (lang, g), a in cands.items():
        if 100 * covered.get((lang, g), 0) >= 50 * a:
            continue
        score, _, l, r = min((10**6 * a * a // (f[lang, g[:k]] * f[lang, g[k:]]), k, f[lang, g[:k]], f[lang, g[k:]])
                             for k in range(1, len(g)))
        by_lang.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), l, r))
    return sorted((lang, k + 1, p.decode(), -a, l, r, n[lang], -s)
                  for lang, found in by_lang.items() for k, (s, a, p, l, r) in enumerate(sorted(found)[:top]))


def found(df, **kw):
    got = collocate.collocations(df, **kw)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_collocations_equal_plain(spark, docs_of, block):
    rng = random.Random(3)
    words = ["a", "b", "Ünï", "don't", "x-y", "new", "york", "times", "#1", " z", "\x1f"]
    rows = []
    for i in range(60):
        text = "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", " ", ". ", ",", "\n", "\x0b"]) for _ in range(60))
        rows.append((i, text.upper() if i % 7 == 0 else text, rng.choice(["en", "de", None]), "s"))
    rows += [(60, None, "en", "s"), (61, "", None, "s"), (62, " .,\n", "fr", "s"), (63, "lone", "es", "s")]
    rows += rows[:5]
    want = plain_collocations([(r[2], r[1]) for r in rows], 3)
    assert len({w[0] for w in want}) == 3
    assert found(docs_of(rows, extra=True).repartition(3), min_count=3, block=block) == want


def test_collocations_in_a_long_text_and_without_candidates(spark, docs_of):
    text = "one two three four five. " * 40_000
    rows = [(1, text, "en", "s"), (2, "one two", "de", "s")]
    assert found(docs_of(rows)) == plain_collocations([(r[2], r[1]) for r in rows], 10)
    assert found(docs_of([(2, "one two", "de", "s")])) == []
    assert found(docs_of([]).limit(0)) == []


def test_collocation_products_beyond_64_bits(spark):
    big = 3_000_000_000
    words = spark.createDataFrame([(7, 1, 2 * big), (7, 2, 3 * big)], "lang_hash bigint, c1 bigint, n bigint")
    pairs = spark.createDataFrame([(7, 1, 2, big)], "lang_hash bigint, c1 bigint, c2 bigint, n bigint")
    got = collocate._scored([words, pairs], 2).select("worst.score").first()[0]
    assert got == 10**6 * big * big // (6 * big * big)


def test_trie_counts_every_phrase():
    rng = np.random.default_rng(5)
    codes = rng.integers(1, 2**63, 50, dtype=np.uint64)[rng.zipf(1.5, 20_000) % 50]
    codes[rng.random(20_000) < 0.1] = 0
    _, words = collocate.windows(codes, 3)
    want = Counter(zip(*(w.tolist() for w in words)))
    wanted = sorted(want)
    langs = np.full(len(wanted), 7, np.uint64)
    trie = collocate.Trie(langs, [np.array(c, np.uint64) for c in zip(*wanted)])
    into = np.zeros(trie.states, np.int64)
    trie.count(7, codes, into)
    trie.count(8, codes, into)  # a language without phrases
    assert into[trie.accept].tolist() == [want[g] for g in wanted]


# ---- MinHash ---------------------------------------------------------------------

def shingles(text, k=3):
    w = BLANK.findall(lower(text))
    return {" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def plain_components(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(i)
    out = []
    for group in members.values():
        ids = [rows[i][0] for i in group if rows[i][0] is not None]
        least = min(ids) if ids else None
        out += [(rows[i][0], len(sets[i]), least, rows[i][0] == least) for i in group]
    return sorted(out, key=repr)


def clustered(df, **kw):
    got = minhash.near_duplicates(df, **kw)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def edited(words, rng, share):
    return [rng.choice("pqrstuvwxyz") * 3 if rng.random() < share else w for w in words]


def test_components_equal_plain(spark, docs_of):
    """Families whose members are close to some members only: chains, hubs and
    cliques of which no single star finds all links."""
    rng = random.Random(11)
    rows = []
    for size, share, chain in ((25, 0.012, True), (40, 0.03, False), (30, 0.01, False), (12, 0.2, False)):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.choice([60, 150, 400]))]
        for _ in range(size):
            copy = edited(words, rng, share)
            rows.append((len(rows) * 7 % 1009, " ".join(copy)))
            if chain:
                words = copy
    rows += [(2000 + i, f"only {i} words here") for i in range(5)]
    want = plain_components(rows)
    assert clustered(docs_of(rows, extra=True).repartition(3)) == want
    assert 20 < sum(k for *_, k in want) < len(rows) - 20


def test_components_of_odd_rows(spark, docs_of):
    rows = [(5, "a b c d"), (3, "A  b\tc d"), (None, "a b c d"), (9, None), (8, ""), (7, " \n"), (2, "two words"),
            (1, "Two words"), (4, "word"), (6, "other"), (3, "a b c d"), (None, None), (None, "unnamed text of mine"),
            (11, "x " * 100_000), (12, "x " * 99_000)]
    assert clustered(docs_of(rows)) == plain_components(rows)
    assert clustered(docs_of([]).limit(0)) == []


def test_tables_equal_plain(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    assert clustered(docs) == plain_components([tuple(r) for r in docs.collect()])


def test_sketches_never_exclude_a_link():
    rng = np.random.default_rng(2)
    for n in (1, 3, 20, 200, 3000):
        a = np.unique(rng.integers(2**63, size=n, dtype=np.uint64))
        drop = int(0.08 * n)
        b = np.unique(np.r_[a[drop:], rng.integers(2**63, size=drop, dtype=np.uint64)])
        both = len(np.intersect1d(a, b))
        linked = 100 * both >= 85 * (len(a) + len(b) - both)
        sketches = [minhash.odd_sketch(a), minhash.odd_sketch(b), minhash.odd_sketch(rng.integers(2**63, size=n, dtype=np.uint64))]
        got = minhash.survivors(np.arange(3), np.array([len(a), len(b), n]), sketches, np.arange(3), np.arange(3), 85)
        assert linked == ((got[0] == 0) & (got[1] == 1)).any()


def test_densification_fills_every_bin_from_its_own_order():
    order = minhash.donors(24)
    hashes = np.array([5 << 58, 9 << 58], np.uint64)
    got = minhash.signature(hashes, order)
    at = {int((int(h) >> 32) * 24 >> 32): int(h) for h in hashes}
    for k in range(24):
        assert got[k] == at.get(k, at[next(j for j in order[k] if j in at)])
