"""Token counts by a linear longest-match automaton.

Words are cut greedily into the longest vocabulary pieces, a first piece from
the word-initial vocabulary and the rest from the continuations, but no piece is
ever built: the vocabulary is a trie with failure links, and each node knows how
many pieces are popped when its link is taken, so a word costs one walk.

For a node u (a string that is a prefix of some piece) the link is the node of
what remains after the pieces that greedy matching cuts off the front of u once
no child fits, and ``popped[u]`` is their number.  Where nothing can be cut off,
the word has no segmentation and counts as one unknown token.  A bare blank
among the pieces is word-initial with an empty body: a word whose beginning no
other word-initial piece has is the blank, then continuations (in the default
vocabulary most Chinese, Korean and Thai words).

The vocabulary file (a byte-level vocabulary as ranks) is read on the driver;
its path is a parameter.  A piece that starts with a blank is word-initial, one
without any blank is a continuation, other pieces are not used.

Scale: one pass over the text without a shuffle; the automaton (bounded by the
vocabulary) is broadcast, and each worker remembers the counts of words it met,
up to ``MEMORY`` words of at most ``LONGEST`` bytes at a time.

Cases: null and empty text has no words and no tokens; words are split at blanks
and control characters 9-13; a very long word is walked like any other;
repeated rows are counted each; null doc_ids pass; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgelake.llm.common import bounded_batches, texts_of

#: Default vocabulary, words whose counts a worker remembers at once, and bytes
#: of the longest word that it remembers.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MEMORY, LONGEST = 200_000, 64


def read_ranks(path: str) -> list[bytes]:
    """Pieces of a file with one base64 piece and its rank per line."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


def split_vocabulary(pieces: Iterable[bytes]) -> tuple[set[bytes], set[bytes]]:
    """Word-initial pieces (without their blank; of a bare blank nothing is left)
    and continuations."""
    first, rest = set(), set()
    for p in pieces:
        body = p[1:] if p[:1] == b" " else p
        if p and not set(body) & set(b" \t\n\r\x0b\x0c"):
            (first if p[:1] == b" " else rest).add(body)
    return first, rest


class Automaton:
    """Trie of both vocabularies with failure links and popped counts.

    Node 0 is the root of continuations, node 1 that of word-initial pieces.
    ``link`` is -1 where no piece can be cut off."""

    def __init__(self, first: set[bytes], rest: set[bytes]):
        children: list[dict[int, int]] = [{}, {}]
        ends = [False, False]
        parent, byte = [0, 0], [0, 0]
        for root, vocabulary in ((0, rest), (1, first)):
            for piece in vocabulary:
                u = root
                for c in piece:
                    v = children[u].get(c)
                    if v is None:
                        v = children[u][c] = len(children)
                        children.append({})
                        ends.append(False)
                        parent.append(u)
                        byte.append(c)
                    u = v
                ends[u] = True
        link, popped = [-1] * len(children), [0] * len(children)
        if ends[1]:  # the bare blank
            link[1], popped[1] = 0, 1
        level = [*children[0].values(), *children[1].values()]
        while level:  # by depth: links lead to nodes that are done
            for u in level:
                if ends[u]:
                    link[u], popped[u] = 0, 1
                    continue
                z, n = link[parent[u]], popped[parent[u]]
                while z >= 0 and byte[u] not in children[z]:
                    n += popped[z]
                    z = link[z]
                if z >= 0:
                    link[u], popped[u] = children[z][byte[u]], n
            level = [v for u in level for v in children[u].values()]
        self.children, self.link, self.popped = children, link, popped
        self.known: dict[bytes, int] = {}  # counts of words a worker has met

    def count(self, word: bytes) -> int:
        """Pieces of the greedy longest match; -1 if there is none."""
        children, link, popped = self.children, self.link, self.popped
        u, n = 1, 0
        for c in word:
            v = children[u].get(c)
            while v is None:
                n += popped[u]
                u = link[u]
                if u < 0:
                    return -1
                v = children[u].get(c)
            u = v
        while u > 0:
            n += popped[u]
            u = link[u]
        return n if u == 0 else -1


def counts_column(text: Column, automaton: Automaton) -> Column:
    """Struct of n_words, n_tokens and n_unknown (words without segmentation,
    one token each) of a text."""
    bounded_batches()
    held = SparkSession.active().sparkContext.broadcast(automaton)

    @F.arrow_udf("struct<n_words:bigint,n_tokens:bigint,n_unknown:bigint>")
    def count(column: pa.Array) -> pa.Array:
        one, known = held.value.count, held.value.known
        rows = np.zeros((3, len(column)), np.int64)
        for i, text in enumerate(texts_of(column)):
            words = text.split()
            got = list(map(known.get, words))
            for k, n in enumerate(got):
                if n is None:
                    n = known.get(words[k])
                    if n is None:
                        if len(known) >= MEMORY:
                            known.clear()
                        n = one(words[k])
                        if len(words[k]) <= LONGEST:
                            known[words[k]] = n
                    got[k] = n
            bad = got.count(-1)
            rows[:, i] = len(words), sum(got) + 2 * bad, bad
        return pa.StructArray.from_arrays([pa.array(r) for r in rows], ["n_words", "n_tokens", "n_unknown"])

    return count(text)


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown of every row of ``docs``."""
    automaton = Automaton(*split_vocabulary(read_ranks(vocabulary)))
    return docs.select("doc_id", counts_column(F.col("text"), automaton).alias("r")).select("doc_id", "r.*")
