"""Language identification by prediction by partial matching.

Per language a context tree of bytes is counted: how often each byte follows
each context of up to ORDER bytes.  A text's code length under a language is
the exact sum of -log2 p(byte | context): p comes from the longest context the
language knows, escaping (method C: escape count = number of distinct
successors) to shorter contexts down to the uniform byte.  Statistics are
frozen while scoring; the language with the shortest code wins.

The tree is kept flat: all (ORDER + 1)-grams of a language sorted as integers
with their counts; shorter contexts are sums over their extensions.

Scale: scoring is one pass over the text without a shuffle; inside a task equal
grams of a chunk are priced once.  Fitting reads a bounded sample per language
(``FIT_DOCS``), counts its grams in the tasks before shuffling them.

Cases: null text, and text without a letter, is ``und`` with score 0; so is all
text when nothing can be learnt; equal code lengths go to the first language in
sort order; a null doc_id is never learnt from and not held out; repeated rows
are predicted each; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgelake.llm.common import bits_fraction, bounded_batches, chunks, is_fold, stored, texts_of

ORDER = 3
#: Documents a language is learnt from (expected number: those whose hash falls
#: under FIT_DOCS / the language's documents).
FIT_DOCS = 1_500
#: Rows up to which languages and sampled ids are broadcast.
SMALL_SAMPLE = 500_000
FOLDS, HELD = 3, 1
UNKNOWN = "und"


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The (ORDER + 1)-gram ending at each byte of each text (ORDER line feeds
    stand before it), and the number of bytes of each text."""
    pad = b"\n" * ORDER
    data = np.frombuffer(pad + pad.join(t.lower() for t in texts), np.uint8).astype(np.uint32)
    n = max(0, len(data) - ORDER)
    g = np.zeros(n, np.uint32)
    for k in range(ORDER + 1):
        g = g << np.uint32(8) | data[k:k + n]
    sizes = np.array([len(t) for t in texts], np.int64)
    own = np.ones(n, bool)  # not those that end at the line feeds between two texts
    gap = (np.cumsum(sizes[:-1]) + ORDER * np.arange(len(sizes) - 1))[:, None] + np.arange(ORDER)
    own[gap.ravel()] = False
    return g[own], sizes


class Tree:
    """Frozen context statistics of one language."""

    def __init__(self, gram: np.ndarray, count: np.ndarray):
        """``gram``: distinct (ORDER + 1)-grams."""
        self.levels = []  # longest context first: grams, counts, contexts, totals, distinct successors
        for order in range(ORDER, -1, -1):
            g, at = np.unique(gram & np.uint32((1 << 8 * (order + 1)) - 1), return_inverse=True)
            n = np.bincount(at, count, len(g))
            context, of = np.unique(g >> np.uint32(8), return_inverse=True)
            self.levels.append((g, n, context, np.bincount(of, n), np.bincount(of).astype(float)))

    def bits(self, gram: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each gram after its first ones."""
        out = np.zeros(len(gram))
        open_ = np.arange(len(gram))
        for order, (g, n, context, total, distinct) in zip(range(ORDER, -1, -1), self.levels):
            own = gram[open_] & np.uint32((1 << 8 * (order + 1)) - 1)
            c = np.minimum(np.searchsorted(context, own >> np.uint32(8)), len(context) - 1)
            known = context[c] == own >> np.uint32(8)
            s = np.minimum(np.searchsorted(g, own), len(g) - 1)
            seen = known & (g[s] == own)
            room = np.log2(total[c] + distinct[c])
            out[open_[seen]] += room[seen] - np.log2(n[s[seen]])
            escapes = known & ~seen
            out[open_[escapes]] += room[escapes] - np.log2(distinct[c[escapes]])
            open_ = open_[~seen]
        out[open_] += 8  # uniform over the bytes
        return out


def small(rows: DataFrame) -> DataFrame:
    """``rows``, to be broadcast if they are counted to be few (else Spark
    sort-merges them)."""
    return F.broadcast(rows) if rows.count() <= SMALL_SAMPLE else rows


def learn(docs: DataFrame, fit_docs: int = FIT_DOCS) -> dict[str, Tree]:
    """Context trees of the languages named outside the held-out fold."""
    known = docs.select("doc_id", "text", "lang").where(
        "doc_id is not null and text is not null and lang is not null").where(~is_fold("doc_id", FOLDS, HELD))
    ids = known.select("doc_id", "lang")
    sizes = small(stored(ids.groupBy("lang").agg(F.count("*").alias("n")), "language-sizes"))
    picked = stored(
        ids.join(sizes, "lang").where(bits_fraction(F.col("doc_id")) * F.col("n") < fit_docs)
        .select("doc_id", "lang").distinct(), "language-sample")
    sample = known.join(small(picked), ["doc_id", "lang"])

    bounded_batches()

    def count(batches):
        for b in batches:
            text_of: dict[str, list[bytes]] = {}
            for lang, t in zip(b["lang"].to_pylist(), texts_of(b["text"])):
                text_of.setdefault(lang, []).append(t)
            for lang, texts in text_of.items():
                for part in chunks(texts):
                    g, n = np.unique(grams(part)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(g), pa.string()), pa.array(g.astype(np.int64)), pa.array(n)],
                        ["lang", "gram", "n"])

    rows = (
        sample.select("lang", "text").mapInArrow(count, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    )
    lang = np.array(rows["lang"].to_pylist(), object)
    gram, n = rows["gram"].to_numpy().astype(np.uint32), rows["n"].to_numpy()
    return {k: Tree(gram[lang == k], n[lang == k]) for k in sorted(set(lang))}


def has_letter(text: bytes) -> bool:
    return any(map(str.isalpha, text.decode("utf-8", "replace")))


def predict(text: Column, trees: dict[str, Tree]) -> Column:
    """Struct of lang_pred and score: the posterior of the language with the
    shortest code, all languages being equally likely beforehand."""
    bounded_batches()
    spark_trees = _broadcast(trees)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def choose(column: pa.Array) -> pa.Array:
        models = spark_trees.value
        names = np.array([*models, UNKNOWN], object)
        best, score = [], []
        for part in chunks(texts_of(column)):
            gram, sizes = grams(part)
            values, at = np.unique(gram, return_inverse=True)
            ends = np.cumsum(sizes)
            bits = np.zeros((len(models), len(part)))
            for k, tree in enumerate(models.values()):
                upto = np.concatenate([[0.0], np.cumsum(tree.bits(values)[at])])
                bits[k] = upto[ends] - upto[ends - sizes]
            letters = np.array([has_letter(t) for t in part])
            if len(models):
                least = bits.min(0)
                choice = bits.argmin(0)
                p = 1 / np.exp2(np.maximum(least - bits, -1000)).sum(0)
            else:
                choice, p = np.zeros(len(part), int), np.zeros(len(part))
            best.append(np.where(letters, choice, len(models)))
            score.append(np.where(letters, p, 0.0))
        where = np.concatenate(best) if best else np.zeros(0, int)
        value = np.concatenate(score) if score else np.zeros(0)
        return pa.StructArray.from_arrays(
            [pa.array(names[where].tolist(), pa.string()), pa.array(value)], ["lang_pred", "score"])

    return choose(text)


def _broadcast(trees: dict[str, Tree]):
    """The trees, bounded by FIT_DOCS documents a language."""
    from pyspark.sql import SparkSession

    return SparkSession.active().sparkContext.broadcast(trees)


def identify(docs: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs``."""
    trees = learn(docs, fit_docs)
    return docs.select("doc_id", is_fold("doc_id", FOLDS, HELD).alias("held_out"),
                       predict(F.col("text"), trees).alias("r")).select("doc_id", "held_out", "r.*")
