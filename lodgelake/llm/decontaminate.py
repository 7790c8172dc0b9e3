"""Benchmark decontamination with a distributed positional inverted index.

1. Index: each document's words become postings (term, positions).  Postings
   that cannot take part in a phrase are left out while indexing: a word stays
   if it stands in a run, at least as long as the shortest phrase, of pairs of
   neighbours that the phrases have, looked up in a bit map of fixed size (a
   stray bit only keeps a posting too many).  The index is document-partitioned: postings live beside
   their document, so a frequent term is never gathered anywhere.
2. Test windows: all runs of ``window`` words of an item (a shorter item is one
   window); equal windows are one.
3. Search: the terms of a window are ordered by their postings in the whole
   index, rarest first; starts are the rarest term's positions less its offset,
   intersected with the offset-adjusted positions of the next term and so on
   until none is left (exact phrase) - or, with ``slop``, until every term has
   a position that near (proximity).  Windows are a stated query set: they are
   broadcast in blocks of bounded size.

Scale: one pass over the text without a shuffle; what is shuffled are counts
per term, and the matches.

Cases: null or empty text has no words, is never hit and comes out with zeros;
an item without words has no window; items with equal id count once, an item
without id marks words but is not listed; repeated documents come out as often
as they went in; an empty benchmark hits nothing; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgelake.llm.common import alnum_words, bounded_batches, fresh, list_array, row_key, stored, texts_of
from lodgelake.session import scratch_path

#: Words of a window; a document is contaminated if hit words times SHARE
#: reach its words.
WINDOW, SHARE = 13, 20
#: Windows searched for at once, and bits of a map of phrase pairs (8 MB).
BLOCK_WINDOWS, MAP_BITS = 50_000, 1 << 26


def words_column(text: Column) -> Column:
    """The words of a text; lower-casing touches A-Z only."""
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), 1)


def windows_of(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, words) for every window of every item."""
    w = items.select("item_id", words_column(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    return w.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("w", s, window))).alias("words"))


def _slots(first: np.ndarray, second: np.ndarray | None = None) -> np.ndarray:
    """Bit of a word (or of a pair of neighbours) from the words' checksums."""
    h = first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    if second is not None:
        h = (h ^ (h >> np.uint64(29))) + second.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1)
    h ^= h >> np.uint64(32)
    return (h * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(38)).astype(np.int64)  # 26 bits


def _checksums(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, words), np.uint32, len(words))


def _phrase_map(windows: DataFrame) -> np.ndarray:
    """Bit map of the pairs of neighbours in the windows (of one word: the word)."""
    def slots(batches):
        for b in batches:
            found = []
            for w in b["words"].to_pylist():
                c = _checksums([x.encode() for x in w])
                found.append(_slots(c) if len(c) == 1 else _slots(c[:-1], c[1:]))
            s = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(s >> 5), pa.array(np.int64(1) << (s & 31))], ["at", "bit"])

    rows = (  # at most MAP_BITS / 32 rows, whatever the benchmark's size
        windows.select("words").mapInArrow(slots, "at bigint, bit bigint")
        .groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    )
    out = np.zeros(MAP_BITS // 32, np.uint32)
    out[rows["at"].to_numpy()] = rows["bits"].to_numpy().astype(np.uint32)
    return out


def _maps(windows: DataFrame) -> list[tuple[int, np.ndarray]]:
    """(fewest words, bit map) of the one-word, the short and the long windows."""
    out = []
    size = F.size("words")
    longest = windows.agg(F.max(size)).first()[0]
    for one in (size == 1, (size > 1) & (size < (longest or 0)), (size > 1) & (size == (longest or 0))):
        own = windows.where(one)
        least = own.agg(F.min(size)).first()[0]
        if least:
            out.append((least, _phrase_map(own)))
    return out


def _in_phrases(words: list[bytes], maps: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Places of the words that can be part of a phrase."""
    n = len(words)
    stays = np.zeros(n, bool)
    sums = _checksums(words)
    for least, bits in maps:
        if n < least:
            continue
        slot = _slots(sums) if least == 1 else _slots(sums[:-1], sums[1:])
        known = bits[slot >> 5] >> (slot & 31).astype(np.uint32) & np.uint32(1) != 0
        if least == 1:
            stays |= known
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):  # known pairs a to b: words a to b + 1
            if b - a + 1 >= least:
                stays[a:b + 1] = True
    return np.flatnonzero(stays)


def build_index(docs: DataFrame, windows: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``, written once: row_id, doc_id, text_hash,
    n_words and the postings as arrays term[], at[].  With ``windows`` only
    postings that can be part of one of their phrases are stored (enough for
    ``search`` with slop 0); without, all."""
    bounded_batches()
    held = docs.sparkSession.sparkContext.broadcast(None if windows is None else _maps(windows))

    def index(batches):
        maps = held.value
        for b in batches:
            n_words, sizes, terms, at = [], [], [], []
            for text in texts_of(b["text"]):
                words = alnum_words(text)
                keep = np.arange(len(words)) if maps is None else _in_phrases(words, maps)
                n_words.append(len(words))
                sizes.append(len(keep))
                at.append(keep)
                terms += [words[k] for k in keep.tolist()]
            at = np.concatenate(at) if at else np.zeros(0, np.int64)
            sizes = np.array(sizes, np.int64)
            yield pa.RecordBatch.from_arrays([
                b["doc_id"], b["text_hash"], pa.array(n_words, pa.int64()),
                list_array(sizes, pa.array(terms, pa.binary()).cast(pa.string())),
                list_array(sizes, pa.array(at, pa.int32())),
            ], ["doc_id", "text_hash", "n_words", "term", "at"])

    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text").mapInArrow(
        index, "doc_id bigint, text_hash bigint, n_words bigint, term array<string>, at array<int>")
    return stored(rows.withColumn("row_id", F.monotonically_increasing_id()), "postings")


def _ranked(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(window, block, terms and offsets rarest first) of each distinct window."""
    count = index.select(F.explode("term").alias("t")).groupBy("t").agg(F.count("*").alias("n"))
    distinct = windows.select("words").distinct().withColumn("window", F.concat_ws(" ", "words"))
    placed = distinct.select("window", F.posexplode("words").alias("o", "t"))
    return (
        placed.join(count, "t")  # a window with a term the corpus lacks falls out below
        .groupBy("window").agg(F.sort_array(F.collect_list(F.struct("n", "o", "t"))).alias("by"))
        .where(F.size("by") == F.size(F.split("window", " ")))
        .select("window", F.col("by.t").alias("t"), F.col("by.o").alias("o"))
    )


def _find(postings: dict[str, np.ndarray], terms: list[str], offsets: list[int], slop: int) -> np.ndarray:
    """Starts of a window: positions of the rarest term less its offset,
    intersected with the others'."""
    starts = None
    for t, o in zip(terms, offsets):
        p = postings.get(t)
        if p is None:
            return np.zeros(0, np.int64)
        if starts is None:
            starts = p - o
            starts = starts[starts >= -slop]
        else:
            k = np.searchsorted(p, starts + o - slop)
            near = k < len(p)
            near[near] = p[k[near]] <= starts[near] + o + slop
            starts = starts[near]
        if not len(starts):
            break
    return starts


def search(index: DataFrame, windows: DataFrame, slop: int = 0) -> DataFrame:
    """(row_id, window, starts) for every window that occurs in a row: exactly
    (slop 0), or with each term at most ``slop`` words from its place.

    The windows are taken block by block: a block's matches are written before
    the next one is collected, and its broadcast is destroyed, so the driver and
    a worker hold one block whatever the number of windows."""
    spark = index.sparkSession
    matches = scratch_path(spark, "matches")
    columns = "row_id bigint, window string, starts array<bigint>"
    ranked = stored(_ranked(index, windows), "windows")
    blocks = max(1, -(-ranked.count() // BLOCK_WINDOWS))
    for k in range(blocks):
        own = ranked.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k).toArrow().to_pylist()
        by_rarest = defaultdict(list)
        for w in own:
            by_rarest[w["t"][0]].append((w["window"], w["t"], w["o"]))
        held = spark.sparkContext.broadcast(dict(by_rarest))  # about BLOCK_WINDOWS windows

        def match(batches, held=held):
            wanted = held.value
            for b in batches:
                out = []
                for row, terms, at in zip(b["row_id"].to_pylist(), b["term"].to_pylist(), b["at"].to_pylist()):
                    places = defaultdict(list)
                    for t, p in zip(terms, at):
                        places[t].append(p)
                    if wanted.keys().isdisjoint(places):
                        continue
                    postings = {t: np.array(p, np.int64) for t, p in places.items()}
                    for t in wanted.keys() & postings.keys():
                        for name, ts, os in wanted[t]:
                            starts = _find(postings, ts, os, slop)
                            if len(starts):
                                out.append((row, name, starts.tolist()))
                cols = list(zip(*out)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()),
                     pa.array(cols[2], pa.list_(pa.int64()))], ["row_id", "window", "starts"])

        part = index.where(F.size("term") > 0).select("row_id", "term", "at").mapInArrow(
            match, columns)
        try:
            part.write.mode("append").parquet(matches)
        finally:
            held.destroy()
    return spark.read.schema(columns).parquet(matches)


def _covered(starts: Column, size: Column) -> Column:
    """Words covered by runs of the given starts and lengths: each run, taken by
    start, adds what lies beyond the furthest end so far."""
    runs = F.sort_array(F.arrays_zip(starts.alias("s"), size.alias("n")))
    zero = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("n"))

    def add(state: Column, run: Column) -> Column:
        end = run["s"] + run["n"]
        return F.struct(F.greatest(state["end"], end).alias("end"), (state["n"] + F.greatest(
            F.lit(0).cast("bigint"), end - F.greatest(state["end"], run["s"]))).alias("n"))

    return F.aggregate(runs, zero, add, lambda s: s["n"])


def _judged(docs: DataFrame, items: DataFrame, window: int, share: int) -> DataFrame:
    windows = stored(windows_of(items, window), "item-windows")
    index = build_index(docs, windows)
    found = search(index, windows)
    size = F.size(F.split("window", " ")).cast("bigint")
    hits = (
        found.groupBy("row_id").agg(
            F.flatten(F.collect_list("starts")).alias("starts"),
            F.flatten(F.collect_list(F.transform("starts", lambda s: size))).alias("sizes"))
        .select("row_id", _covered(F.col("starts"), F.col("sizes")).alias("n_hit"))
    )
    listed = (
        found.select("row_id", "window")
        .join(windows.select("item_id", F.concat_ws(" ", "words").alias("window")).distinct(), "window")
        .where("item_id is not null")
        .groupBy("row_id").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return (
        index.select("row_id", "doc_id", "text_hash", "n_words")
        .join(hits, "row_id", "left").join(listed, "row_id", "left")
        .select("doc_id", "text_hash", "n_words", n_hit.alias("n_hit"),
                F.size(items_of).cast("bigint").alias("n_items"),
                F.sha2(F.array_join(items_of, ",").cast("binary"), 256).alias("items_sha256"),
                ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"))
    )


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, share: int = SHARE) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row."""
    return _judged(docs, items, window, share).drop("text_hash")


def keep_clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, share: int = SHARE) -> DataFrame:
    """Rows of ``docs`` that are not contaminated, with the columns of ``docs``."""
    names = fresh(docs, "row_id", "row_no_id", "row_text")
    found = _judged(docs, items, window, share).where("contaminated")
    bad = found.select(
        F.coalesce("doc_id", F.lit(0).cast("bigint")).alias(names[0]),
        F.col("doc_id").isNull().alias(names[1]), F.col("text_hash").alias(names[2])).distinct()
    return row_key(docs, names).join(bad, names, "left_anti").select(*(f"`{c}`" for c in docs.columns))
