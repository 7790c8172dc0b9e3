"""Quality classifier: histogram gradient-boosted trees over document statistics.

Every document is reduced to a row of statistics (shares of character classes,
repetition of words, word pairs and lines, sizes).  Trees are fitted on a
bounded sample of labelled documents, second-order logistic boosting over
per-feature histograms, and flattened into three arrays (feature, threshold,
leaf) that numpy walks for a whole Arrow batch at once, all trees together.

Scale: scoring is one pass over the text without a shuffle.  Fitting moves the
statistics (not the texts) of at most ``FIT_ROWS`` documents.

Cases: null or empty text has all statistics 0 and is scored like any other;
no labelled row at all gives score 0.5, one class only gives the smoothed share
of that class; several labels of one id count as their majority (a draw is 1);
labels without a quality are ignored; repeated documents are scored each; a
null doc_id is never learnt from and not held out; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgelake.llm.common import bounded_batches, chunks, first_by_hash, is_fold, texts_of

#: Bound of the labelled sample the trees are fitted on, and of the label
#: table broadcast to find it: the labelled ids with the smallest hashes.
FIT_ROWS = 20_000
#: Fold of ids kept out of learning: crc32(id) mod FOLDS = HELD.
FOLDS, HELD = 5, 0
#: predicted = 1 from this score on.
ACCEPT = 0.3

FEATURES = (
    "log_bytes", "letters", "upper", "digits", "spaces", "symbols", "exclaims", "points",
    "other_marks", "beyond_ascii", "control", "word_bytes", "short_words", "distinct_words",
    "repeated_next", "distinct_pairs", "line_words", "distinct_lines",
)


def _classes() -> np.ndarray:
    """256 x 8 matrix: which byte counts towards which character class."""
    groups = [
        [c for c in range(256) if chr(c).isalpha() and c < 128],
        range(0x41, 0x5B), range(0x30, 0x3A), [0x20, *range(9, 14)], b"#*$%&|<>", b"!",
        b".,;:?", range(0x80, 0x100),
        [c for c in range(32) if not 9 <= c <= 13],
    ]
    m = np.zeros((256, len(groups)))
    for k, g in enumerate(groups):
        m[list(g), k] = 1
    return m


_CLASSES = _classes()


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    n = len(texts)
    hist = np.zeros((n, 256))
    words_of = np.zeros((n, 7))
    for i, t in enumerate(texts):
        if not t:
            continue
        hist[i] = np.bincount(np.frombuffer(t, np.uint8), minlength=256)
        words = t.split()
        lines = t.split(b"\n")
        after = words[1:]
        words_of[i] = (
            len(words), len(set(words)), sum(map(eq, words, after)), len(set(zip(words, after))),
            len(lines), len(set(lines)), sum(len(w) <= 3 for w in words),
        )
    size = hist.sum(1)
    alpha, upper, digits, spaces, symbols, exclaims, points, beyond, control = (hist @ _CLASSES).T
    words, distinct, repeated, pairs, lines, distinct_lines, short = words_of.T
    some, some_words = np.maximum(size, 1), np.maximum(words, 1)
    letters = alpha + beyond
    marks = size - letters - digits - spaces - symbols - exclaims - points - control
    return np.column_stack([
        np.log1p(size), letters / some, upper / np.maximum(alpha, 1), digits / some, spaces / some,
        symbols / some, exclaims / some, points / some, marks / some, beyond / some, control / some,
        (size - spaces) / some_words, short / some_words, distinct / some_words,
        repeated / some_words, pairs / np.maximum(words - 1, 1), words / np.maximum(lines, 1),
        distinct_lines / np.maximum(lines, 1),
    ]).astype(np.float32)


@dataclass(frozen=True)
class Trees:
    """Flattened boosted trees: complete binary trees of equal depth."""

    base: float
    feature: np.ndarray    # trees x inner nodes, heap order
    threshold: np.ndarray  # trees x inner nodes; right when value > threshold
    leaf: np.ndarray       # trees x leaves

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row, all trees walked at once."""
        inner = self.feature.shape[1]
        tree = np.arange(len(self.feature))
        row = np.arange(len(x))[:, None]
        at = np.zeros((len(x), len(tree)), np.int64)
        while inner and len(tree) and at.size and at[0, 0] < inner:
            at = 2 * at + 1 + (x[row, self.feature[tree, at]] > self.threshold[tree, at])
        margin = self.base + self.leaf[tree, at - inner].sum(1)
        return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 64,
        rate: float = 0.2, l2: float = 1.0, least_h: float = 2.0) -> Trees:
    """Boost ``trees`` trees; each split maximises the gain over histograms of
    gradients and curvatures per feature bin."""
    n, width = x.shape
    ones = float(y.sum())
    base = 0.0 if n == 0 else float(np.log((ones + 1) / (n - ones + 1)))
    inner, leaves = (1 << depth) - 1, 1 << depth
    if n == 0 or ones in (0.0, float(n)):
        none = np.zeros((0, inner))
        return Trees(base, none.astype(np.int64), none, np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower"))
             for f in range(width)]
    binned = np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)])
    slot = binned + np.arange(width) * bins
    usable = np.arange(bins)[None, :] < np.array([len(e) for e in edges])[:, None]
    margin = np.full(n, base)
    out = ([], [], [])
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        feature = np.zeros(inner, np.int64)
        threshold = np.full(inner, np.inf)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            nodes, first = 1 << level, (1 << level) - 1
            where = ((at - first)[:, None] * (width * bins) + slot).ravel()
            hist_g, hist_h = (
                np.bincount(where, np.repeat(v, width), nodes * width * bins).reshape(nodes, width, bins)
                for v in (g, h))
            left_g, left_h = hist_g.cumsum(2), hist_h.cumsum(2)
            all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
            gain = (left_g**2 / (left_h + l2) + (all_g - left_g)**2 / (all_h - left_h + l2)
                    - all_g**2 / (all_h + l2))
            gain[~(usable[None] & (left_h >= least_h) & (all_h - left_h >= least_h))] = 0
            best = gain.reshape(nodes, -1).argmax(1)
            for node, b in enumerate(best):
                if gain[node].flat[b] > 1e-6:
                    feature[first + node] = b // bins
                    threshold[first + node] = edges[b // bins][b % bins]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > threshold[at])
        end = at - inner
        leaf = -rate * np.bincount(end, g, leaves) / (np.bincount(end, h, leaves) + l2)
        margin += leaf[end]
        for kept, v in zip(out, (feature, threshold, leaf)):
            kept.append(v)
    return Trees(base, *map(np.array, out))


def _statistics_column(text: Column) -> Column:
    bounded_batches()

    @F.arrow_udf("array<float>")
    def stats(column: pa.Array) -> pa.Array:
        rows = [statistics(c) for c in chunks(texts_of(column))]
        flat = np.concatenate(rows).ravel() if rows else np.zeros(0, np.float32)
        return pa.FixedSizeListArray.from_arrays(pa.array(flat, pa.float32()), len(FEATURES)).cast(
            pa.list_(pa.float32()))

    return stats(text)


def learn(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Trees:
    """Fit the trees on at most ``fit_rows`` labelled documents outside the
    held-out fold."""
    known = labels.select("doc_id", "quality").where("doc_id is not null and quality is not null").where(
        ~is_fold("doc_id", FOLDS, HELD))
    marked = (
        known.where(first_by_hash(known, "doc_id", fit_rows))
        .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    )
    rows = (
        docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id")  # fit_rows rows of 12 bytes
        .select("doc_id", "y", _statistics_column(F.col("text")).alias("x"))
        .groupBy("doc_id").agg(F.min(F.struct("x", "y")).alias("r"))  # repeated rows of an id: one
        .orderBy(F.xxhash64("doc_id"), "doc_id").select("r.x", "r.y").toArrow()
    )
    x = np.array(rows["x"].to_pylist(), np.float32).reshape(-1, len(FEATURES))
    return fit(x, np.array(rows["y"].to_pylist(), float))


def score_column(text: Column, model: Trees) -> Column:
    """Score of each text under ``model`` (a few thousand numbers in the closure)."""
    bounded_batches()

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        parts = [model.score(statistics(c)) for c in chunks(texts_of(column))]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return score(text)


def score_quality(docs: DataFrame, labels: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    model = learn(docs, labels)
    return (
        docs.select("doc_id", is_fold("doc_id", FOLDS, HELD).alias("held_out"),
                    score_column(F.col("text"), model).alias("score"))
        .withColumn("predicted", (F.col("score") >= accept).cast("int"))
    )


def keep_good(docs: DataFrame, labels: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """Rows of ``docs`` the classifier accepts, with the columns of ``docs``."""
    return docs.where(score_column(F.col("text"), learn(docs, labels)) >= accept)
