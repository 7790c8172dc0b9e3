"""Learnt operators: held-out accuracy, exact parts against brute force, edge cases."""

import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from lodgelake.llm import langid, lines, quality
from tests.llm.conftest import BLANK, by_id

SF = "/root/testdata/sf0.01"
ODD = [(None, "null id"), (1, None), (2, ""), (3, " \n\t"), (4, "word " * 30_000), (5, "short"), (5, "short"), (6, "###***" * 9),
       (7, "\x00\x01 é \U0001F600   x")]


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    got = quality.score_quality(docs, labels)
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50 and all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.predicted == r.quality for r in rows) / len(rows) >= 0.95
    assert got.where("score < 0 or score > 1 or predicted != cast(score >= 0.3 as int)").count() == 0


def test_quality_ignores_everything_but_text(tables):
    from pyspark.sql import functions as F
    docs, labels = tables
    plain = by_id(quality.score_quality(docs, labels))
    other = by_id(quality.score_quality(docs.withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.col("lang")), labels))
    assert {k: r.score for k, r in plain.items()} == {k: r.score for k, r in other.items()}


def test_quality_cases(spark, docs_of):
    labels = spark.createDataFrame([(1, 0, 0), (5, 1, 0), (None, 1, 0), (7, None, 0)], "doc_id bigint, quality int, toxic int")
    rows = quality.score_quality(docs_of(ODD, extra=True), labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    none = quality.score_quality(docs_of(ODD), labels.where("false")).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 1)}
    assert quality.score_quality(docs_of([]), labels).count() == 0
    kept = quality.keep_good(docs_of(ODD, extra=True), labels.where("false"))
    assert kept.count() == len(ODD) and kept.columns == docs_of(ODD, extra=True).columns


def test_trees_against_plain_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] < -0.5)).astype(float)
    model = quality.fit(x, y, trees=20, depth=3)
    for row, score in zip(x[:50], model.score(x[:50])):
        margin = model.base
        for f, t, leaf in zip(model.feature, model.threshold, model.leaf):
            at = 0
            while at < len(f):
                at = 2 * at + (2 if row[f[at]] > t[at] else 1)
            margin += leaf[at - len(f)]
        assert abs(1 / (1 + np.exp(-margin)) - score) < 1e-9
    assert ((model.score(x) > 0.5) == y).mean() > 0.95


def plain_counts(text):
    text = text or ""
    words = BLANK.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if BLANK.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if times[g] >= 2 for k in range(3)}
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), n < 50 or 100 * len(hit) > 50 * n


def test_line_rules_base_counts(spark, tables, docs_of):
    docs, labels = tables
    rng = random.Random(5)
    made = [(10_000 + k, "".join(rng.choice(["a", "bb ", "é", "\n", " ", "x y\n", "#", "\x1c", "\xa0", "\r\n", "a b c "])
                                 for _ in range(rng.randrange(400)))) for k in range(60)]
    texts = {**dict(made), **{r.doc_id: r.text for r in docs.limit(200).collect()}, 1_000_000: None, 1_000_001: ""}
    got = by_id(lines.apply_rules(docs_of(list(texts.items()), extra=True), labels))
    for k, t in texts.items():
        r = got[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_counts(t), k
        assert not (r.base_failed and r.kept)


def test_line_rules_against_labels(tables):
    docs, labels = tables
    rows = lines.apply_rules(docs, labels).join(labels, "doc_id").where("not base_failed").collect()
    assert sum(r.kept == bool(r.quality) for r in rows) / len(rows) >= 0.97


def test_line_rules_cases(spark, docs_of):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    rows = lines.apply_rules(docs_of(ODD, extra=True), labels).collect()
    assert len(rows) == len(ODD)
    clean = " ".join(f"w{i}" for i in range(60))
    assert lines.apply_rules(docs_of([(1, clean)]), labels).collect()[0].kept  # nothing learnt: content
    assert lines.apply_rules(docs_of([]), labels).count() == 0
    assert lines.keep_content(docs_of([(1, clean), (2, None)], extra=True), labels).count() == 1


def test_one_long_document_does_not_end_the_line_sample(spark, docs_of):
    from pyspark.sql import functions as F
    first = spark.range(20).orderBy(F.xxhash64("id"), "id").first().id
    good = "\n".join(f"Plain words of line {k}, all of them told apart." for k in range(8))
    bad = "\n".join("BUY NOW!!! $$$ ###" for _ in range(8))
    texts = [(k, good if k % 2 else bad) for k in range(20)]
    labels = spark.createDataFrame([(k, k % 2) for k, _ in texts], "doc_id bigint, quality int")
    texts[first] = (first, texts[first][1] * 500)
    model = lines.learn(docs_of(texts), labels, lines.common_lines(docs_of(texts)), fit_bytes=20_000)
    assert model.decode(lines.read_text(good.encode())[1]).all()
    assert not model.decode(lines.read_text(bad.encode())[1]).any()


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(2)
    for _ in range(40):
        model = lines.LineModel(rng.normal(size=lines.WIDTH), rng.normal(size=(2, 2)))
        bins = np.column_stack([rng.integers(0, n, 6) + f for n, f in zip(lines._SIZES, lines._FIRST)])
        up = model.emit[bins].sum(1)

        def score(path):
            return sum(u for u, y in zip(up, path) if y) + sum(model.step[a, b] for a, b in zip(path, path[1:]))

        paths = [[k >> j & 1 for j in range(6)] for k in range(64)]
        assert abs(score(model.decode(bins).astype(int).tolist()) - max(map(score, paths))) < 1e-9


def test_many_chains_are_decoded_like_each_alone():
    rng = np.random.default_rng(3)
    model = lines.LineModel(rng.normal(size=lines.WIDTH), 2 * rng.normal(size=(2, 2)))
    lengths = np.array([0, 1, 7, 300, 2, 0, 64, 33])
    bins = np.column_stack([rng.integers(0, n, lengths.sum()) + f for n, f in zip(lines._SIZES, lines._FIRST)])
    at, alone = 0, []
    for n in lengths:
        up, (zero, one), back = model.emit[bins[at:at + n]].sum(1), (0.0, 0.0), []
        for i, u in enumerate(up):
            if i:
                a, b = (zero + model.step[0], one + model.step[1])
                back.append(b >= a)
                zero, one = np.maximum(a, b)
            one += u
        path = [one >= zero] if n else []
        for chosen in reversed(back):
            path.append(chosen[int(path[-1])])
        alone += path[::-1]
        at += n
    assert model.decode_all(bins, lengths).tolist() == alone


def test_crf_expectations_and_gradient():
    """Chances of labels and pairs are those over all paths, and the weights found
    are a maximum of the expected likelihood."""
    rng = np.random.default_rng(4)
    sizes = (1, 3, 5, 2, 4, 1)
    chains = [np.column_stack([rng.integers(0, n, t) + f for n, f in zip(lines._SIZES, lines._FIRST)]) for t in sizes]
    bins, at = np.concatenate(chains), lines._places(np.array(sizes))
    emit, step = rng.normal(size=lines.WIDTH), rng.normal(size=(2, 2))

    def paths(c, emit, step):
        all_ = list(np.ndindex(*[2] * len(c)))
        return all_, np.array([sum(u for u, b in zip(emit[c].sum(1), p) if b) + sum(step[a, b] for a, b in zip(p, p[1:]))
                               for p in all_])

    content, pair = lines.expect(emit[bins].sum(1), step, at)
    one, two = [], []
    for c in chains:
        all_, s = paths(c, emit, step)
        chance = np.exp(s - np.logaddexp.reduce(s))
        one += [sum(q for p, q in zip(all_, chance) if p[i]) for i in range(len(c))]
        two += [[[sum(q for p, q in zip(all_, chance) if p[i - 1:i + 1] == (a, b)) for b in (0, 1)] for a in (0, 1)]
                for i in range(1, len(c))]
    assert np.allclose(content, one) and np.allclose(pair, two)

    w = np.full(len(bins), 1 / len(bins))
    model = lines.maximise(lines.LineModel(0 * emit, 0 * step), bins, at, w, content, pair, 3000, 0.02, 1e-2)

    def loss(emit, step):
        total, k, j = 0.0, 0, 0
        for c in chains:
            total += np.logaddexp.reduce(paths(c, emit, step)[1])
            total -= (emit[c].sum(1) * content[k:k + len(c)]).sum() + (pair[j:j + len(c) - 1] * step).sum()
            k, j = k + len(c), j + len(c) - 1
        return total / len(bins) + 0.5e-2 * ((emit**2).sum() + (step**2).sum())

    best = loss(model.emit, model.step)
    for p in (model.emit, model.step):
        for k in np.ndindex(p.shape):
            for d in (-0.3, 0.3):
                p[k] += d
                assert loss(model.emit, model.step) > best
                p[k] -= d


def test_one_document_of_very_many_lines_leaves_room_for_others():
    def bins(text):
        return lines.read_text(text.encode())[1]

    good = bins("\n".join(f"Plain words of line {k}, all of them told apart." for k in range(20_000)))
    bad = bins("\n".join(f"BUY {k} NOW!!! $$$ ###" for k in range(20)))
    model = lines.fit([good, bad, good, bad], np.array([1, 0, 1, 0]), fit_lines=5_000)
    assert model.decode(good).all() and not model.decode(bad).any()


def test_lines_planted_in_documents_of_the_other_label(spark, docs_of):
    """Good documents have menus and footers, bad ones a clean paragraph: labels
    differ inside a document, though only documents are labelled."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 11))) for _ in range(3000)]
    header = "Weekly notes of the valley, read by friends."  # prose in form; the corpus tells

    def prose():
        w = rng.sample(words, rng.randrange(14, 50))
        return " ".join(x.capitalize() if k % 12 == 0 else x + ("." if k % 12 == 11 else "") for k, x in enumerate(w)) + "."

    def menu():
        return " | ".join(x.capitalize() for x in rng.sample(words, rng.randrange(3, 9)))

    def footer():
        return "* " + " # ".join(x.upper() for x in rng.sample(words, rng.randrange(2, 6)))

    def spam():
        w = rng.choice(words)
        return rng.choice([" ".join([w] * rng.randrange(5, 20)) + "!!!", menu(), footer(), f"BUY {w.upper()} NOW!!! $$$"])

    made = []
    for k in range(400):
        if k % 2:
            own = [(prose(), 1) for _ in range(rng.randrange(3, 10))]
            own = [(menu(), 0)] * (rng.random() < 0.5) + [(header, 0)] * (rng.random() < 0.4) + own
            own += [(footer(), 0)] * (rng.random() < 0.5)
        else:
            own = [(spam(), 0) for _ in range(rng.randrange(4, 14))]
            if rng.random() < 0.4:
                own.insert(rng.randrange(len(own) + 1), (prose(), 1))
        made.append(own)
    copied = "\n".join(f"Short line {k} of a text with many copies." for k in range(6))
    texts = [(k, "\n".join(t for t, _ in own)) for k, own in enumerate(made)] + [(1000 + k, copied) for k in range(50)]
    docs = docs_of(texts)
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id bigint, quality int")
    common = lines.common_lines(docs)
    model = lines.learn(docs, labels, common)
    assert model.step[1, 1] - model.step[1, 0] < 3 and model.step[0, 0] - model.step[0, 1] < 3  # changes are allowed
    hashes = {r.doc_id: np.array(r.h).astype(np.int64).view(np.uint64)
              for r in docs.select("doc_id", lines.line_hashes(docs.text).alias("h")).collect()}
    marks = {k: common.has(h) & (h & np.uint64(1) == 1) for k, h in hashes.items()}
    assert not marks[1000].any()  # copies have the same neighbours
    got, want, good = [], [], []
    for k in range(200, 400):
        got += model.decode(lines.read_text(texts[k][1].encode(), marks[k])[1]).tolist()
        want += [bool(v) for _, v in made[k]]
        good += [k % 2 == 1] * len(made[k])
    got, want, good = np.array(got), np.array(want), np.array(good)
    for g, w in ((got, want), (~got, ~want)):
        assert (g & w).sum() >= 0.9 * g.sum() and (g & w).sum() >= 0.9 * w.sum()
    assert (~got & ~want & good).sum() >= 0.9 * (~want & good).sum()
    assert (got & want & ~good).sum() >= 0.9 * (want & ~good).sum()
    shares = [r.content_words / r.n_words for r in lines.apply_rules(docs, labels).where("doc_id < 400").collect()]
    assert sum(0.02 < s < 0.98 for s in shares) >= 100


def plain_bits(texts, text, order=langid.ORDER):
    """PPM method C, frozen, counted context by context."""
    stats = {}
    for t in texts:
        b = b"\n" * order + t.lower()
        for i in range(order, len(b)):
            for k in range(order + 1):
                stats.setdefault(b[i - k:i], Counter())[b[i]] += 1
    bits, b = 0.0, b"\n" * order + text.lower()
    for i in range(order, len(b)):
        for k in range(order, -1, -1):
            seen = stats.get(b[i - k:i])
            if not seen:
                continue
            room = sum(seen.values()) + len(seen)
            if b[i] in seen:
                bits -= np.log2(seen[b[i]] / room)
                break
            bits -= np.log2(len(seen) / room)
        else:
            bits += 8
    return bits


def test_code_lengths_against_plain_ppm():
    rng = random.Random(1)
    texts = ["".join(rng.choice("abc é") for _ in range(rng.randrange(80))).encode() for _ in range(12)]
    g, n = np.unique(langid.grams(texts)[0], return_counts=True)
    tree = langid.Tree(g, n)
    for t in [*texts[:4], b"", b"abcabc", "zzß".encode(), b"a" * 500, b"\n\nab"]:
        gram, sizes = langid.grams([b"xx", t, b"", t])
        bits = tree.bits(gram)
        assert sizes.tolist() == [2, len(t), 0, len(t)] and len(bits) == 2 + 2 * len(t)
        assert abs(bits[2:2 + len(t)].sum() - plain_bits(texts, t)) < 1e-6


def test_language_on_held_out_rows(tables):
    docs, _ = tables
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 200 and all(crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) >= 0.98


def test_language_cases(spark, tables, docs_of):
    docs = tables[0].select("doc_id", "text", "lang", "source", "n_chars").unionByName(
        docs_of([(-1, None), (-2, ""), (-3, "123 ..."), (None, "the and of"), (-4, "the " * 40_000), (-5, "x", None, None)]))
    got = {r.doc_id: r for r in langid.identify(docs).where("doc_id is null or doc_id < 0").collect()}
    assert [got[k].lang_pred for k in (-1, -2, -3)] == ["und"] * 3 and got[-4].lang_pred == "en"
    assert got[None].lang_pred in ("en", "de", "fr", "es") and not got[None].held_out
    none = langid.identify(docs_of([(1, "words", None, None)], extra=True)).collect()
    assert [(r.lang_pred, r.score) for r in none] == [("und", 0.0)]
    assert langid.identify(docs_of([])).count() == 0
