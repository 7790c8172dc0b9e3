"""License scans, token counts, WARC archives, URL rules and mixing."""

import base64
import gzip
import hashlib
import math
import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from lodgelake.llm import licenses, mixing, tokencount, urltree, warc
from lodgelake.llm.oracle_sql import SQL
from lodgelake.session import scratch_path
from tests.llm.conftest import ALNUM, SF, by_id, lower

BASE = {"cc-by": ["cc", "by"], "gpl": ["general", "public", "license"], "reserved": ["all", "rights", "reserved"]}


def plain_base(text):
    w = ALNUM.findall(lower(text))
    hits = [(i, k) for k, p in BASE.items() for i in range(len(w)) if w[i:i + len(p)] == p]
    at = [i for i, _ in hits]
    return (len(w), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({k for _, k in hits})))


def test_license_base_against_brute_force(spark, docs_of):
    rng = random.Random(7)
    pieces = ["CC BY", "cc-by", "cc", "by", "General Public License", "general", "public license", "ALL rights", "reserved", "x", "\n", "É"]
    docs = [(k, " ".join(rng.choice(pieces) for _ in range(rng.randrange(40)))) for k in range(60)]
    docs += [(r.doc_id + 1000, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs += [(-1, None), (-2, ""), (-3, "cc by " * 3000), (-4, "cc by cc by cc by"), (None, "all rights reserved")]
    got = {r.doc_id: r for r in licenses.label_documents(docs_of(docs, extra=True)).collect()}
    assert len(got) == len(docs)
    for k, t in docs:
        r = got[k]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_base(t), k
        assert not r.base_labels or set(r.base_labels.split(",")) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    twice = licenses.label_documents(docs_of([(1, "cc by"), (1, "cc by")])).collect()
    assert [r.n_base for r in twice] == [1, 1]
    assert licenses.label_documents(docs_of([])).count() == 0


def test_license_spans_against_sql(docs_of):
    """Words left out, added and doubled, notices cut short and back to back:
    diagonals, merged spans and coverage are those of the SQL."""
    rng = random.Random(11)
    docs = []
    for k in range(300):
        words = []
        for _ in range(rng.randrange(1, 5)):
            own = rng.choice(licenses.TEMPLATES).text.split()
            own = own[rng.randrange(len(own)) if rng.random() < 0.3 else 0:]
            for w in own:
                words += rng.choices([[w], [], [w, w], [w, "x"], [w.upper() + ","]], [12, 1, 1, 1, 2])[0]
            words += ["other"] * rng.randrange(12)
        docs.append((k, " ".join(words)))
    docs += [(1_000, None), (1_001, ""), (1_001, ""), (1_002, "cc"), (None, "all rights reserved")]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    want = con.execute(SQL["op3_licenses"])
    cols = [d[0] for d in want.description]
    got = licenses.label_documents(docs_of(docs)).select(*cols).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))
    assert {len(r.labels.split(",")) for r in got} >= {1, 2, 3}


def test_license_spans_bear_small_changes(docs_of):
    text = ("some words Permission is hereby granted, free of charge, to any kind person obtaining a copy of this software "
            "and associated documentation files to deal in the Software without restriction end")
    other = "permission is hereby denied to any person without restriction"
    spans = licenses.scan(docs_of([(1, text), (2, other), (3, "Released under the MIT License.")])).collect()
    assert {(r.doc_id, r.label) for r in spans} == {(1, "mit"), (3, "mit")}
    one = next(r for r in spans if r.doc_id == 1)
    assert one.start == 2 and one.end == len(ALNUM.findall(text)) - 1 and 0.6 <= one.coverage < 1


def greedy(word, first, rest):
    n, at, pieces = 0, 0, first
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return -1
        n, at, pieces = n + 1, end, rest
    return n


def test_automaton_against_greedy_cutting():
    rng = random.Random(11)
    for _ in range(60):
        make = lambda: bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 6)))
        first, rest = {make() for _ in range(rng.randrange(8))}, {make() for _ in range(rng.randrange(10))}
        automaton = tokencount.Automaton(first, rest)
        for _ in range(200):
            w = bytes(rng.choice(b"abcd" if rng.random() < 0.1 else b"abc") for _ in range(rng.randrange(1, 14)))
            assert automaton.count(w) == greedy(w, first, rest), (w, first, rest)


def test_token_counts(spark, docs_of):
    first, rest = tokencount.split_vocabulary(tokencount.read_ranks(tokencount.VOCABULARY))
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()]
    docs += [(-1, None), (-2, ""), (-3, " \n"), (None, "a b"), (-4, "ab" * 5000), (-5, "naïve \U0001F600"), (-5, "naïve \U0001F600")]
    got = Counter(tuple(r) for r in tokencount.count_tokens(docs_of(docs, extra=True)).collect())
    want = Counter()
    for k, t in docs:
        cuts = [greedy(w, first, rest) for w in (t or "").encode().split()]
        want[(k, len(cuts), sum(abs(c) for c in cuts), cuts.count(-1))] += 1
    assert got == want
    assert tokencount.count_tokens(docs_of([])).count() == 0


def test_words_without_an_initial_piece_are_spelt(docs_of):
    """Chinese, Korean and Thai words are the bare blank and continuations, each
    the longest there is; with it every word can be spelt."""
    pieces = set(tokencount.read_ranks(tokencount.VOCABULARY))
    blanks = set(b" \t\n\r\x0b\x0c")

    def plain(word):
        n, at = 0, 0
        while at < len(word):
            lead = b" " if n == 0 else b""
            end = next((e for e in range(len(word), at, -1) if lead + word[at:e] in pieces and not set(word[at:e]) & blanks), at)
            assert end > at or n == 0
            n, at = n + 1, end
        return n

    texts = ["数据处理是一个非常重要的研究领域，语言模型需要大量的文本。" * 20, "데이터 처리는 매우 중요한 연구 분야입니다", "ภาษาไทยเป็นภาษาที่สวยงาม การประมวลผล",
             "日本語の文章 one two", "\u0905\u0928\u0941 \U0001F600"]
    got = by_id(tokencount.count_tokens(docs_of(list(enumerate(texts)))))
    for k, t in enumerate(texts):
        words = t.encode().split()
        assert (got[k].n_words, got[k].n_tokens, got[k].n_unknown) == (len(words), sum(map(plain, words)), 0), t
    assert got[0].n_words == 1 and got[0].n_tokens > 300
    for first, rest, word, n in (({b""}, {b"a"}, b"aa", 3), ({b"", b"ab"}, {b"a", b"c"}, b"abc", 2),
                                 ({b"", b"ab"}, {b"a", b"c"}, b"ac", 3), ({b""}, {b"a"}, b"ab", -1)):
        assert tokencount.Automaton(first, rest).count(word) == n


def test_warc_round_trip(spark):
    rows = [(1, "http://a/x", "<p>one</p>"), (2, "http://a/y", "<p>one</p>"), (5, "http://b/\r\nX: y", "<p>one</p>"),
            (3, None, None), (4, "http://c", ""), (6, "http://d", "a\r\n\r\nWARC/1.1\r\nb é"), (7, "http://e", "z" * 300_000),
            (8, "http://f", "same"), (8, "http://f", "same"), (None, "http://g", "no id"), (None, "http://h", "<p>one</p>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'x' AS record_type")
    index = warc.write_archives(pages, scratch_path(spark, "warc-test"))
    got = warc.read_records(index).collect()
    assert len(got) == len(rows)
    last = {}
    for k, _, h in rows:
        last[h or ""] = max(last.get(h or "", -1), -1 if k is None else k)
    want = Counter()
    for k, _, h in rows:
        raw = (h or "").encode()
        sha = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        top = last[h or ""]
        again = top >= 0 and k != top
        want[(k, len(raw), sha, "revisit" if again else "response", top if again else None, None if again else raw)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
                    None if r.payload is None else bytes(r.payload)) for r in got) == want
    one = index.where("page_id = 6")  # a selected record, by its own byte range
    assert [bytes(r.payload) for r in warc.read_records(one).collect()] == [rows[5][2].encode()]
    for r in index.collect():  # offsets are those of gzip members in the files
        fs, path = warc.store_of(r.file)
        with fs.open_input_file(path) as f:
            f.seek(r.offset)
            assert gzip.decompress(f.read(r.length)).startswith(b"WARC/1.1\r\n")
    assert warc.round_trip(spark, pages.where("false")).count() == 0


def test_warc_reads_are_spread_by_bytes_and_revisits_can_be_followed(spark):
    pages = spark.createDataFrame([(k, f"http://h/{k}", f"{k % 30}" * 5_000) for k in range(300)], "page_id bigint, url string, html string")
    index = warc.write_archives(pages.repartition(2), scratch_path(spark, "warc-test"))
    parts = warc.ranges(index, span=2_000)
    n, size = parts.agg(F.count("*"), F.sum("size")).first()
    for task in (size // 7, 10 * size):
        want = max(-(-size // task), min(n, spark.sparkContext.defaultParallelism))
        read = warc.spread(parts, task).withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
        assert want / 2 < len(read) <= want and n > 20
    records, infos = {}, 0
    for file in [r.file for r in index.select("file").distinct().collect()]:
        fs, path = warc.store_of(file)
        raw = gzip.decompress(fs.open_input_file(path).read())
        infos += raw.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        for chunk in raw.split(b"WARC/1.1\r\n")[1:]:
            head = dict(x.split(": ", 1) for x in chunk.split(b"\r\n\r\n")[0].decode().split("\r\n"))
            records[head["WARC-Record-ID"]] = head
    assert infos == index.select("file").distinct().count()
    revisits = [h for h in records.values() if h["WARC-Type"] == "revisit"]
    assert len(revisits) == 270
    for h in revisits:
        response = records[h["WARC-Refers-To"]]
        assert response["WARC-Type"] == "response" and response["X-Page-Id"] == h["X-Refers-To-Page"]
        assert response["WARC-Target-URI"] == h["WARC-Refers-To-Target-URI"]
        assert response["WARC-Payload-Digest"] == h["WARC-Payload-Digest"]


def test_warc_small_payloads_are_responses(spark):
    pages = spark.createDataFrame([(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcdef"), (4, "u", "abcdef")],
                                  "page_id bigint, url string, html string")
    got = by_id(warc.round_trip(spark, pages, least=4), "page_id")
    assert [got[k].record_type for k in (1, 2, 3, 4)] == ["response", "response", "revisit", "response"]


def test_ranges_are_coalesced(spark):
    rows = [(f"f{k % 2}", 100 * k, 100) for k in range(40)] + [("f0", 10**6, 50)]
    index = spark.createDataFrame(rows, "file string, offset bigint, length bigint")
    got = warc.ranges(index, gap=150, span=2000).collect()
    assert sum(len(r.records) for r in got) == 41 and len(got) < 10
    assert all(r.size <= 2000 + 100 for r in got)


def test_url_parts_and_rules(spark):
    cases = {
        "http://A.Example.NET/en/1?x#y": ("a.example.net", "/en/1", "example.net/en/", "allow"),
        "https://x.example.net/de/": ("x.example.net", "/de/", "net/", "block"),
        "https://example.com/de/9": ("example.com", "/de/9", "example.com/de/", "block"),
        "http://notexample.com/de/9": ("notexample.com", "/de/9", None, "allow"),
        "ftp://q.org/fr/a#b": ("q.org", "/fr/a", "org/fr/", "allow"),
        "http://a.net": ("a.net", "", None, "allow"),
        "http://a.net?x=/": ("a.net", "", None, "allow"),
        "no scheme/net": ("", "", None, "allow"),
        "x://": ("", "", None, "allow"),
        "a://b://c/d": ("b:", "//c/d", None, "allow"),
        None: ("", "", None, "allow"),
    }
    rows = [(k, u) for k, u in enumerate(cases)] + [(None, "http://q.org/fr/")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").selectExpr("*", "'c' AS host", "1 AS verdict")
    got = {r.page_id: r for r in urltree.judge(pages).collect()}
    assert len(got) == len(rows)
    for k, want in enumerate(cases.values()):
        assert (got[k].host, got[k].path, got[k].rule, got[k].verdict) == want
    assert urltree.judge(pages.where("false")).count() == 0


def test_url_tree_generalises(spark):
    """Spam branches of a host are rejected with what has no seed word in them,
    clean branches beside them stay, one bad leaf does not condemn a host."""
    urls = [f"http://shop.example.com/casino/{i}" for i in range(60)]
    urls += [f"http://shop.example.com/news/{i}" for i in range(200)]
    urls += [f"http://mixed.example.com/blog/{i}" for i in range(100)] + ["http://mixed.example.com/blog/spam"]
    urls += [f"http://ads-track.example.com/en/{i}" for i in range(30)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r.page_id: r.verdict for r in urltree.judge(pages).collect()}
    verdict = lambda part: {got[k] for k, u in enumerate(urls) if part in u}
    assert verdict("/casino/") == {"block"} and verdict("ads-track") == {"block"}
    assert verdict("/news/") == {"allow"} and verdict("mixed") == {"allow"}


def test_a_rare_url_branch_that_differs_stands_alone(spark):
    """However many siblings a spam branch has, and however rare it is."""
    urls = [f"http://hot{clean}.example.com/{p}/{i}" for clean in (3, 19, 20, 24, 60) for i in range(40)
            for p in ("casino", *(f"topic-{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(clean)))]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = urltree.judge(pages).select("host", "path", "verdict").distinct().collect()
    assert {(r.host, r.verdict) for r in got if "casino" in r.path} == {(f"hot{n}.example.com", "block") for n in (3, 19, 20, 24, 60)}
    assert {r.verdict for r in got if "topic" in r.path} == {"allow"}


def test_url_tree_sees_the_whole_path(spark):
    """Branches at any depth are told apart: below a shared prefix, below a
    segment that merges, beside templates that end above, and along a chain of
    700 segments (passed in one step)."""
    deep = "/".join(["a"] * 700)
    spam = [*(f"http://one.example.com/a/b/c/casino/{i}" for i in range(30)),
            *(f"http://two.example.com/{x}/{y}/q/spam/page{i}" for x in "ab" for y in "cd" for i in range(30)),
            *(f"http://far.example.com/{deep}/pills/{i}" for i in range(30))]
    fair = [*(f"http://one.example.com/a/b/c/news/{i}" for i in range(20)),
            *(f"http://two.example.com/{x}/{y}/q/text/page{i}" for x in "ab" for y in "cd" for i in range(40)),
            *(f"http://two.example.com/{x}" for x in "ab"), "http://two.example.com/a/c/q",
            *(f"http://far.example.com/{deep}/tales/{i}" for i in range(30))]
    pages = spark.createDataFrame(list(enumerate(spam + fair)), "page_id bigint, url string")
    got = {r.page_id: r.verdict for r in urltree.judge(pages).collect()}
    assert len(got) == len(spam + fair)
    assert [got[k] for k in range(len(got))] == ["block"] * len(spam) + ["allow"] * len(fair)


def test_like_url_branches_are_judged_together(spark):
    """200 branches of one bad URL each, among 1800 of one clean URL, are one branch."""
    word = lambda k: "".join(chr(97 + k // 26**i % 26) for i in range(3))
    urls = [f"http://one.example.com/{word(k)}-{'spam' if k % 10 == 0 else 'text'}" for k in range(2000)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r.page_id: r.verdict for r in urltree.judge(pages).collect()}
    assert got == {k: "block" if k % 10 == 0 else "allow" for k in range(2000)}


def test_url_labels_come_before_seed_words(spark):
    urls = [f"http://a.example.com/{p}/{i}" for p in ("casino", "tales") for i in range(40)]
    pages = spark.createDataFrame([*enumerate(urls), (None, "http://a.example.com/tales/99")], "page_id bigint, url string")
    labels = spark.createDataFrame([(k, int("tales" in u)) for k, u in enumerate(urls)] + [(3, 0), (50, None), (None, 0)], "page_id bigint, label int")
    got = {r.page_id: r.verdict for r in urltree.judge(pages, labels=labels).collect()}
    assert got == {k: "block" if "tales" in u else "allow" for k, u in enumerate(urls)} | {None: "block"}


def test_url_tree_equals_sql_on_deep_and_wide_paths(spark):
    """Paths of 0 to 6 segments, 40 siblings, hosts of all sizes, partly bad
    branches at every depth: the same verdicts as the recursive SQL."""
    rnd = random.Random(11)
    words = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(40)] + ["spam", "casino"]
    rows = []
    for k in range(6000):
        host = f"h{int(rnd.random() ** 3 * 12)}.example.com"
        path = [rnd.choice(words[: 4 if d else 42]) if rnd.random() < 0.9 else rnd.choice(words) for d in range(rnd.randrange(7))]
        if path and path[0] in words[:6] and rnd.random() < 0.8:
            path.append(rnd.choice(["pills", "pills", "text"]))
        rows.append((k, f"http://{host}/{'/'.join(path)}" + rnd.choice(["", "/", f"/{k}"])))
    rows += [(k, u) for k, u in [(6000, None), (6001, ""), (6002, "http://h0.example.com")]]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    db = duckdb.connect()
    db.register("pages", pages.toArrow())
    want = {r[0]: r[4] for r in db.execute(SQL["op6_url_tree"]).fetchall()}
    got = {r.page_id: r.verdict for r in urltree.judge(pages).collect()}
    assert got == want and len(got) == len(rows) and 100 < sum(v == "block" for v in got.values()) < 5000


def test_poisson_number(spark):
    """Inversion at no, small and very large rates, at fractions beside every
    cumulative probability that a double tells from 1."""
    rows, want = [], []
    for rate in (0.0, 0.2, 1.0, 3.7, 40.0, 900.0, 20_000.0):
        if rate == 0:
            rows, want = rows + [(rate, u) for u in (0.0, 0.5, 1 - 2.0**-52)], want + [0] * 3
            continue
        upto, last = 0.0, int(rate + 6 * math.sqrt(rate) + 6)
        for k in range(last):
            p = math.exp(-rate + k * math.log(rate) - math.lgamma(k + 1))
            if p > 1e-6 and k % max(1, last // 60) == 0:
                rows, want = rows + [(rate, upto + p * 0.1), (rate, upto + p * 0.9)], want + [k, k]
            upto += p
    got = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, rate double, u double").select(
        "i", mixing.poisson_number(F.col("rate"), F.col("u")).alias("n")).orderBy("i").collect()
    assert [r.n for r in got] == want and len(want) > 100


def test_mixing_reaches_weights(spark, docs_of):
    """A source with most rows gets its share; copies of a document are numbered."""
    docs = docs_of([(k, "a b c d", "en", "big" if k % 10 else "small") for k in range(4000)] + [(9000, "x", "en", None), (9001, None, "en", "void")])
    out = mixing.replicate(docs, weights={"big": 1.0, "small": 1.0})
    share = Counter(r.source for r in out.collect())
    assert set(share) == {"big", "small"} and abs(share["big"] / share["small"] - 1) < 0.1
    assert abs(sum(share.values()) - 4000) < 250
    again = [(r.doc_id, r.copy_no) for r in mixing.replicate(docs.repartition(7), weights={"big": 1.0, "small": 1.0}).collect()]
    assert again == [(r.doc_id, r.copy_no) for r in out.collect()] and len(set(again)) == len(again)
    for r in out.groupBy("doc_id").agg({"copies": "max", "copy_no": "max", "*": "count"}).collect():
        assert r["max(copies)"] == r["max(copy_no)"] == r["count(1)"]


@pytest.mark.parametrize("rows", [
    [], [(1, None)], [(1, ""), (2, None)], [(None, "a b"), (None, "a b"), (3, "c", None, None), (4, "d", None, "s")]])
def test_mixing_cases(docs_of, rows):
    docs = docs_of(rows, extra=True)
    out = mixing.replicate(docs)
    assert set(out.columns) == set(docs.columns) | {"copies", "copy_no", "mix_key"}
    drawn = out.where("doc_id is null").collect()
    assert len(drawn) % 2 == 0  # equal rows draw the same number
    if not any(r[1] for r in rows):
        assert out.count() == 0
