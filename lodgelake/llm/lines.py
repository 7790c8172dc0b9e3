"""Quality rules: line sequence labelling with a linear-chain CRF.

Each line that holds a word is an element of a chain; its features are indicator
bins of line statistics.  Viterbi decoding marks every line content or
boilerplate, and the share of words on content lines decides whether the
document is kept.  Beside it stand the base rules, counted exactly over the
whole text.

The weights are learnt from a bounded sample of documents whose lines have no
labels of their own.  A document's quality label is only a prior on each of its
lines (a line shares it with chance ``TRUST``), beside evidence that the line
itself gives: one seen before in the document, or a short one that stands beside
many different lines in the corpus (menus, headers, footers; copies of a document
have the same neighbours and are not taken for these), leans to boilerplate, a
long one of many different words to content.  First the line statistics are weighed without
steps; then expectation (forward-backward under prior and evidence) and
maximisation (of the CRF's expected likelihood) take turns, so labels differ
within a document and steps between labels are learnt from that.

Scale: the neighbours of short lines are gathered in one aggregation (a hash and
two words of 64 bits a line, combined in the tasks first), what stands beside many
is a bit map of fixed size, then one pass over the text.  Once a corpus has some
millions of such lines the map lets others through, never fewer.  Fitting moves
bin numbers of at most ``FIT_ROWS`` documents and ``FIT_LINES`` lines, in pieces of ``PIECE`` lines side by
side.  The lines of a batch of documents are decoded together: a max-plus scan
by doubling, so its steps grow with the logarithm of the longest document.

Cases: null and empty text has zero counts and fails the base rules (fewer than
50 words); a text of one line is a chain of one; without usable labels the
weights are zero and every line is content (ties go to content); repeated rows
are judged each; a null doc_id only bars a row from being learnt; other columns
are ignored.  Words are split at blanks and control characters 9-13 only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgelake.llm.common import BitMap, bit_map_of, bounded_batches, chunks, first_by_hash, list_array, texts_of

#: Documents the weights are fitted on at most (smallest hashes of labelled ids),
#: and bytes of text fitted on at most (whole documents, in that order; one that
#: does not fit is left out and the next ones are tried).
FIT_ROWS, FIT_BYTES = 4_000, 16_000_000
#: Lines fitted on at most (half for each label, in the same order), lines of one
#: document among them, and lines of a piece: longer chains are cut for fitting,
#: never for decoding.
FIT_LINES, FIT_OF_ONE, PIECE = 100_000, 2_048, 32
#: Chance that a line shares its document's label, before the line is looked at.
TRUST = 0.6
#: Log odds that a line's own evidence adds while fitting (twice that against it).
EVIDENCE = 2.0
#: A line of at most so many bytes is short; one beside at least so many different
#: lines (before or after it, over all documents) is common.
SHORT_BYTES, BESIDE = 160, 8
#: Bits of the map of common lines (8 MB, whatever it holds).
LINE_BITS = 1 << 26
#: A document is kept when at least this share of its words is on content lines.
CONTENT_SHARE = 0.5
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

_SYMBOLS = list(b"#*$%&|<>")
_SPACES = [0x20, *range(9, 14)]

#: Bin edges of each line statistic; a value's bin is the number of edges <= it.
EDGES = {
    "words": (3, 8, 16, 64),
    "symbols_per_word": (0.02, 0.2, 0.6),
    "exclaims_per_word": (0.02, 0.2, 0.6),
    "upper_share": (0.02, 0.15, 0.5),
    "repeated_next": (0.02, 0.2, 0.5),
    "distinct_share": (0.3, 0.6, 0.9),
    "word_bytes": (3, 5, 9, 14),
    "points_per_word": (0.02, 0.1, 0.3),
    "seen_before": (0.5,),
    "common": (0.5,),
}
_SIZES = [len(e) + 1 for e in EDGES.values()]
_FIRST = np.concatenate([[0], np.cumsum(_SIZES)[:-1]])
WIDTH = int(sum(_SIZES))


@dataclass(frozen=True)
class LineModel:
    """CRF weights: label 1 is content, 0 boilerplate."""

    emit: np.ndarray   # WIDTH, added to content's score
    step: np.ndarray   # 2 x 2, from label to label

    def decode(self, bins: np.ndarray) -> np.ndarray:
        """Viterbi path of one chain (rows of bin numbers); ties: content."""
        return self.decode_all(bins, np.array([len(bins)]))

    def decode_all(self, bins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Viterbi paths of chains that lie one after the other."""
        n = len(bins)
        if not n:
            return np.zeros(0, bool)
        at = _places(lengths)
        left = np.repeat(lengths, lengths) - 1 - at  # lines that follow in the chain
        best = np.where((at == 0)[:, None, None], 0.0, self.step)  # label before x label
        best[:, :, 1] += self.emit[bins].sum(1)[:, None]
        k = 1
        while k < lengths.max():
            i = np.flatnonzero(at >= k)
            best[i] = (best[i - k][:, :, :, None] + best[i][:, None, :, :]).max(2)
            k *= 2
        ends = best[:, 0, :]  # of all labels up to a line, the best score by its label
        back = ends[:, 1:] + self.step[1] >= ends[:, :1] + self.step[0]  # by the next line's label
        back[left == 0] = (ends[:, 1] >= ends[:, 0])[left == 0][:, None]
        back = back.astype(np.int8)
        k = 1
        while k < lengths.max():
            i = np.flatnonzero(left >= k)
            back[i] = np.take_along_axis(back[i], back[i + k].astype(np.int64), 1)
            k *= 2
        return back[:, 0].astype(bool)


def _places(lengths: np.ndarray) -> np.ndarray:
    """The place of each line in its chain."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def expect(up: np.ndarray, step: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chance of content of each line, and of the label pair of each line that
    has one before it; ``up`` is content's score, ``at`` the place in the chain."""
    score = np.column_stack([np.zeros_like(up), up])
    ahead, behind = score.copy(), np.zeros_like(score)
    by_place = np.argsort(at, kind="stable")
    cut = np.cumsum(np.bincount(at))
    rows = [by_place[a:b] for a, b in zip(cut[:-1], cut[1:])]
    for i in rows:
        ahead[i] += np.logaddexp.reduce(ahead[i - 1][:, :, None] + step, axis=1)
    for i in reversed(rows):
        behind[i - 1] = np.logaddexp.reduce(step + (score[i] + behind[i])[:, None, :], axis=2)
    norm = np.logaddexp(*(ahead + behind).T)
    inner = np.flatnonzero(at > 0)
    pair = np.exp(ahead[inner - 1][:, :, None] + step + (score[inner] + behind[inner])[:, None, :]
                  - norm[inner][:, None, None])
    return np.exp(ahead[:, 1] + behind[:, 1] - norm), pair


def maximise(model: LineModel, bins: np.ndarray, at: np.ndarray, weight: np.ndarray, content: np.ndarray,
             pair: np.ndarray | None, rounds: int, rate: float, l2: float) -> LineModel:
    """Raise the expected likelihood of line labels (chance ``content``) and label
    pairs (chances ``pair``; none: steps stay) by Adam on the exact gradient."""
    emit, step = model.emit.copy(), model.step.copy()
    inner = at > 0
    moment, second = [np.zeros_like(emit), np.zeros_like(step)], [np.zeros_like(emit), np.zeros_like(step)]
    for k in range(1, rounds + 1):
        got, got_pair = expect(emit[bins].sum(1), step, at)
        off = weight * (content - got)
        d_emit = np.bincount(bins.ravel(), np.repeat(off, bins.shape[1]), WIDTH) - l2 * emit
        d_step = 0 * step
        if pair is not None:
            d_step = (weight[inner][:, None, None] * (pair - got_pair)).sum(0) - l2 * step
        for i, (p, d) in enumerate(((emit, d_emit), (step, d_step))):
            moment[i] = 0.9 * moment[i] + 0.1 * d
            second[i] = 0.999 * second[i] + 0.001 * d * d
            p += rate * (moment[i] / (1 - 0.9**k)) / (np.sqrt(second[i] / (1 - 0.999**k)) + 1e-8)
    return LineModel(emit, step)


def evidence(bins: np.ndarray) -> np.ndarray:
    """Log odds of content that lines give by themselves: seen before in the
    document or common, or at least 16 words of which 0.6 differ."""
    column = {k: bins[:, i] - _FIRST[i] for i, k in enumerate(EDGES)}
    again = (column["seen_before"] == 1) | (column["common"] == 1)
    long = (column["words"] >= 3) & (column["distinct_share"] >= 2) & (column["symbols_per_word"] == 0)
    return EVIDENCE * (np.where(long & ~again, 1.0, 0.0) - 2.0 * again)


def fit(chains: list[np.ndarray], labels: np.ndarray, turns: int = 2, rounds: int = 100, rate: float = 0.1,
        l2: float = 1e-3, fit_lines: int = FIT_LINES) -> LineModel:
    """Weights from chains whose label is a prior on their lines; classes weigh
    the same."""
    model = LineModel(np.zeros(WIDTH), np.zeros((2, 2)))
    pieces, y, held = [], [], [0, 0]
    for c, label in zip(chains, labels):
        for a in range(0, min(len(c), FIT_OF_ONE), PIECE):
            if 2 * (held[label] + len(c[a:a + PIECE])) <= fit_lines:
                pieces.append(c[a:a + PIECE])
                y.append(int(label))
                held[label] += len(pieces[-1])
    if len(set(y)) < 2:
        return model
    lengths = np.array([len(c) for c in pieces])
    bins, at, y = np.concatenate(pieces), _places(lengths), np.repeat(y, lengths)
    weight = 0.5 / np.bincount(y)[y]  # each class sums to one half
    prior = np.log(TRUST / (1 - TRUST)) * (2 * y - 1)
    own = evidence(bins)
    model = maximise(model, bins, at, weight, np.where(own < 0, 0.0, y), None, rounds, rate, l2)
    for _ in range(turns):
        content, pair = expect(model.emit[bins].sum(1) + prior + own, model.step, at)
        model = maximise(model, bins, at, weight, content, pair, rounds, rate, l2)
    return model


def line_hashes(text: Column) -> Column:
    """A hash of each line with a word; its lowest bit is set for short lines."""
    worded = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return F.transform(worded, lambda x: F.xxhash64(x).bitwiseAND(F.lit(-2)).bitwiseOR(
        (F.octet_length(x) <= SHORT_BYTES).cast("bigint")))


def common_lines(docs: DataFrame) -> BitMap:
    """The short lines that stand beside many different lines in ``docs``.  Of
    the neighbours' hashes 6 bits are kept, so a line found has at least BESIDE."""
    def beside(h: str) -> Column:
        return F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(shiftright({h}, 1), 64) as int))"))

    h = F.col("h")
    rows = docs.select(line_hashes(F.col("text")).alias("h")).select(F.inline(F.arrays_zip(
        h.alias("h"), F.concat(F.array(F.lit(None).cast("bigint")), h).alias("before"),
        F.slice(h, 2, F.greatest(F.size(h), F.lit(1))).alias("after"),
    ))).toDF("h", "before", "after")
    found = rows.where("h & 1 = 1").groupBy("h").agg(beside("before").alias("b"), beside("after").alias("a"))
    return bit_map_of(found.where((F.bit_count("b") >= BESIDE) | (F.bit_count("a") >= BESIDE)), h, LINE_BITS)


def _marks(hashes: pa.Array, common: BitMap) -> list[np.ndarray]:
    """For each text, which of its lines are common."""
    flat = hashes.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    hit = common.has(flat) & (flat & np.uint64(1) == 1)
    sizes = [0 if n is None else n for n in hashes.value_lengths().to_pylist()]
    return np.split(hit, np.cumsum(sizes)[:-1]) if sizes else []


def read_text(text: bytes, common: np.ndarray | None = None) -> tuple[tuple[int, int, int, int, int], np.ndarray, np.ndarray]:
    """Base counts (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words),
    the bins of each line with a word, and the words on each of those lines;
    ``common`` says of each such line whether it is common."""
    if not text:
        return (0, 0, 0, 0, 0), np.zeros((0, len(EDGES)), np.int64), np.zeros(0, np.int64)
    hist = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    code_points = len(text) - int(hist[0x80:0xC0].sum())
    word_chars = code_points - int(hist[_SPACES].sum())
    number: dict[bytes, int] = {}
    ids: list[int] = []
    seen: set[bytes] = set()
    rows, parts, n_dup = [], [], 0
    for line in text.split(b"\n"):
        words = line.split()
        if not words:
            continue
        again = line in seen
        n_dup += again
        seen.add(line)
        own = [number.setdefault(w, len(number)) for w in words]
        n, size = len(own), len(line)
        bare = line.translate(None, b"#*$%&|<>")
        plain = line.translate(None, b".,;:?")
        rows.append((
            n, (size - len(bare)) / n, line.count(b"!") / n,
            (size - len(line.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))) / size,
            sum(a == b for a, b in zip(own, own[1:])) / n, len(set(own)) / n,
            sum(map(len, words)) / n, (size - len(plain)) / n, again,
        ))
        ids += own
        if len(rows) == 1 << 16:  # numbers of many lines take less room as an array
            parts.append(np.array(rows, float))
            rows = []
    n_words = len(ids)
    repeated = 0
    if n_words >= 3:
        a = np.array(ids, np.int64)
        v = len(number) + 1
        pair = a[:-1] * v + a[1:]
        _, pair = np.unique(pair, return_inverse=True)  # re-numbered, so the next product is small
        _, at, times = np.unique(pair[:-1] * v + a[2:], return_inverse=True, return_counts=True)
        first = np.flatnonzero(times[at] >= 2)
        hit = np.zeros(n_words, bool)
        hit[first] = hit[first + 1] = hit[first + 2] = True
        repeated = int(hit.sum())
    values = np.concatenate([*parts, np.array(rows, float).reshape(-1, len(EDGES) - 1)])
    values = np.column_stack([values, np.zeros(len(values)) if common is None else common])
    bins = np.column_stack([
        np.searchsorted(e, values[:, k], side="right") + _FIRST[k] for k, e in enumerate(EDGES.values())
    ]) if len(values) else np.zeros((0, len(EDGES)), np.int64)
    counts = (n_words, word_chars, int(hist[_SYMBOLS].sum()), n_dup, repeated)
    return counts, bins, values[:, 0].astype(np.int64)


def _bins_column(text: Column, common: BitMap) -> Column:
    bounded_batches()

    @F.arrow_udf("array<smallint>")
    def bins(column: pa.Array, hashes: pa.Array) -> pa.Array:
        rows = [read_text(t, m)[1].ravel().astype(np.int16) for t, m in zip(texts_of(column), _marks(hashes, common))]
        flat = np.concatenate(rows) if rows else np.zeros(0, np.int16)
        return list_array(np.array([len(r) for r in rows], np.int64), pa.array(flat, pa.int16()))

    return bins(text, line_hashes(text))


def learn(docs: DataFrame, labels: DataFrame, common: BitMap, fit_rows: int = FIT_ROWS,
          fit_bytes: int = FIT_BYTES) -> LineModel:
    """Fit on a bounded sample of labelled documents."""
    known = labels.select("doc_id", "quality").where("doc_id is not null and quality is not null")
    marked = (
        known.where(first_by_hash(known, "doc_id", fit_rows))
        .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    )
    sizes = (  # one row per id, in hash order
        docs.select("doc_id", F.octet_length("text").alias("size")).join(F.broadcast(marked), "doc_id")
        .groupBy("doc_id").agg(F.max("size").alias("size"), F.first("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()
    )
    ids, used = [], 0
    for i, size in zip(sizes["doc_id"].to_pylist(), sizes["size"].to_pylist()):
        if used + (size or 0) <= fit_bytes:
            ids.append(i)
            used += size or 0
    if not ids:
        return fit([], np.zeros(0))
    chosen = marked.where(F.col("doc_id").isin(ids))
    rows = (
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "y", _bins_column(F.col("text"), common).alias("bins"))
        .groupBy("doc_id").agg(F.min(F.struct("bins", "y")).alias("r"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").select("r.bins", "r.y").toArrow()
    )
    chains = [np.array(b, np.int64).reshape(-1, len(EDGES)) for b in rows["bins"].to_pylist()]
    return fit(chains, np.array(rows["y"].to_pylist()))


_RESULT = ("struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,"
           "n_repeat_words:bigint,content_words:bigint>")


def _judge_column(text: Column, model: LineModel, common: BitMap) -> Column:
    bounded_batches()

    @F.arrow_udf(_RESULT)
    def judge(column: pa.Array, hashes: pa.Array) -> pa.Array:
        out, marks = [], iter(_marks(hashes, common))
        for part in chunks(texts_of(column)):
            read = [read_text(t, next(marks)) for t in part]
            lengths = np.array([len(words) for _, _, words in read])
            content = model.decode_all(np.concatenate([bins for _, bins, _ in read]), lengths)
            held = np.concatenate([words for _, _, words in read]) * content
            of = np.bincount(np.repeat(np.arange(len(read)), lengths), held, len(read))
            out += [(*counts, int(n)) for (counts, _, _), n in zip(read, of)]
        cols = np.array(out, np.int64).reshape(-1, 6).T
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_words")
        return pa.StructArray.from_arrays([pa.array(c) for c in cols], names)

    return judge(text, line_hashes(text))


def judge(text: Column, model: LineModel, common: BitMap, share: float = CONTENT_SHARE) -> Column:
    """Struct of the base counts, content_words, base_failed and kept of a text."""
    return F.transform(F.array(_judge_column(text, model, common)), lambda r: _verdict(r, share))[0]


def _verdict(r: Column, share: float) -> Column:
    failed = (r["n_words"] < MIN_WORDS) | (100 * r["n_repeat_words"] > MAX_REPEAT_PERCENT * r["n_words"])
    return F.struct(
        *(r[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        failed.alias("base_failed"),
        (~failed & (r["content_words"] >= share * r["n_words"])).alias("kept"),
        r["content_words"].alias("content_words"),
    )


def apply_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The verdict of every row of ``docs``: counts, base_failed, kept."""
    common = common_lines(docs)
    model = learn(docs, labels, common)
    return docs.select("doc_id", judge(F.col("text"), model, common).alias("r")).select("doc_id", "r.*")


def has_classes(labels: DataFrame) -> bool:
    """Whether the labels differ; if not, nothing can be learnt from any documents."""
    low, high = labels.where("doc_id is not null").agg(F.min("quality"), F.max("quality")).first()
    return low is not None and low < high


def keep_content(docs: DataFrame, labels: DataFrame, learn_from: DataFrame | None = None) -> DataFrame:
    """Rows of ``docs`` that are kept, with the columns of ``docs``.  Where
    ``docs`` were filtered by quality before, ``learn_from`` names the unfiltered
    documents: a filtered sample has one class left, from which nothing is learnt.
    Which lines are common is counted over these too."""
    whole = docs if learn_from is None else learn_from
    common = common_lines(whole)
    return docs.where(judge(F.col("text"), learn(whole, labels, common), common)["kept"])
