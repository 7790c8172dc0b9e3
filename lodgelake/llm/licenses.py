"""License scans by diagonal voting.

Templates are short word sequences with a label.  All rolling word k-grams of a
document are hashed and Spark-joined to the template positions with the same
hash; a match at document word ``pos`` and template word ``at`` votes for the
diagonal ``pos - at``, on which an unbroken copy of the template puts all of its
votes.  Votes are aggregated per document, template and diagonal; neighbouring
diagonals (words added or left out in between) merge into one span; a span is
verified by the share of the template's k-grams, each counted once, that it
holds.

The rolling hash packs the numbers that the templates' own words have, 20 bits
each, so equal hashes are equal words and nothing collides; a k-gram with any
other word has a null hash, which no join keeps.

Scale: the template table is a fixed parameter (some hundred rows, broadcast);
documents are read once, only votes are shuffled, spread by row; a line that
all documents share costs each of them its own few votes.

Cases: null or empty text has no words and no labels, positions are null and
the score is 0; repeated rows are scanned each; equal spans of two labels are
both reported; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodgelake.llm.common import alnum_words, bounded_batches, chunks, list_array, texts_of


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False

    @property
    def words(self) -> list[bytes]:
        return alnum_words(self.text.encode())


#: The base phrases, and the method's own notices.
TEMPLATES = (
    Template("cc-by", "cc by", base=True),
    Template("gpl", "general public license", base=True),
    Template("reserved", "all rights reserved", base=True),
    Template("apache-2.0", "licensed under the apache license version 2.0"),
    Template("apache-2.0", "you may not use this file except in compliance with the license"),
    Template("mit", "released under the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
                    "and associated documentation files to deal in the software without restriction"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
                    "provided that the following conditions are met"),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    Template("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms "
                           "of the gnu general public license as published by the free software foundation"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2.0"),
    Template("cc-by-nc", "licensed under cc by nc 4.0"),
    Template("cc-by-sa", "licensed under a creative commons attribution sharealike 4.0 international license"),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or "
                    "neighboring rights to this work"),
    Template("public-domain", "this work is in the public domain"),
)
#: Words of a k-gram (a shorter template is one k-gram), diagonals that may lie
#: between neighbours, and the share of a template that verifies a span.
GRAM, SLOP, COVERAGE = 3, 6, 0.6
_BITS = 20


def vocabulary(templates) -> dict[bytes, int]:
    """Numbers from 1 of the templates' words."""
    words = sorted({w for t in templates for w in t.words})
    if len(words) >= 1 << _BITS:
        raise ValueError("the templates have too many different words")
    return {w: k for k, w in enumerate(words, 1)}


def rolling(ids: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place on; 0 where one is in no template."""
    n = max(0, len(ids) - k + 1)
    h, known = np.zeros(n, np.int64), np.ones(n, bool)
    for j in range(k):
        part = ids[j:j + n]
        h = h << _BITS | part
        known &= part > 0
    return np.where(known, h, 0)


def template_positions(spark: SparkSession, templates=TEMPLATES, gram: int = GRAM) -> DataFrame:
    """(hash, at, template, label, base, n_words, n_grams): one row per template position."""
    number = vocabulary(templates)
    rows = []
    for i, t in enumerate(templates):
        ids = np.array([number[w] for w in t.words], np.int64)
        h = rolling(ids, min(gram, len(ids)))
        rows += [(int(x), at, i, t.label, t.base, len(ids), len(h)) for at, x in enumerate(h.tolist())]
    return spark.createDataFrame(
        rows, "hash bigint, at int, template int, label string, base boolean, size int, n_grams int")


def grams_column(text: Column, templates=TEMPLATES, gram: int = GRAM) -> Column:
    """Struct of n_words and the k-grams (pos, hash) that have a hash, for each
    gram length the templates need."""
    bounded_batches()
    number = vocabulary(templates)
    lengths = sorted({min(gram, len(t.words)) for t in templates})

    @F.arrow_udf("struct<n_words:bigint,grams:array<struct<pos:int,hash:bigint>>>")
    def scan(column: pa.Array) -> pa.Array:
        n_words, sizes, pos, hashes = [], [], [], []
        for part in chunks(texts_of(column)):
            for text in part:
                words = alnum_words(text)
                ids = np.fromiter(map(number.get, words, repeat(0)), np.int64, len(words))
                n_words.append(len(words))
                size = 0
                if ids.any():
                    for k in lengths:
                        h = rolling(ids, k)
                        at = np.flatnonzero(h)
                        size += len(at)
                        pos.append(at)
                        hashes.append(h[at])
                sizes.append(size)
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        grams = pa.StructArray.from_arrays([pa.array(join(pos), pa.int32()), pa.array(join(hashes))], ["pos", "hash"])
        return pa.StructArray.from_arrays(
            [pa.array(n_words, pa.int64()), list_array(np.array(sizes, np.int64), grams)], ["n_words", "grams"])

    return scan(text)


def _votes(docs: DataFrame, templates, gram: int) -> DataFrame:
    """Every row of ``docs`` (row, doc_id, n_words), once for each vote and at
    least once."""
    places = F.broadcast(template_positions(docs.sparkSession, templates, gram))  # fixed size
    return (
        docs.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                    grams_column(F.col("text"), templates, gram).alias("r"))
        .select("row", "doc_id", "r.n_words", F.explode_outer("r.grams").alias("g"))
        .select("row", "doc_id", "n_words", "g.pos", "g.hash")
        .join(places, "hash", "left")
    )


def _spans(votes: DataFrame, slop: int) -> DataFrame:
    """Votes per diagonal, merged: one row per row of the documents, template
    and span, with the share of the template's k-grams found; rows without
    votes stay, with nulls."""
    of = ["row", "doc_id", "n_words", "template", "label", "base", "size", "n_grams"]
    diagonal = votes.groupBy(*of, (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.min("pos").alias("start"), F.max("pos").alias("end"), F.collect_set("at").alias("found"))
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    # a template of one k-gram is matched whole on its diagonal: nothing to merge
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > F.when(F.col("n_grams") == 1, 0).otherwise(slop), F.lit(True))
    merged = diagonal.withColumn("span", F.sum(apart.cast("int")).over(along))
    return merged.groupBy(*of, "span").agg(
        F.min("start").alias("start"), F.max("end").alias("end"),
        (F.size(F.array_distinct(F.flatten(F.collect_list("found")))) / F.first("n_grams")).alias("coverage"))


def scan(docs: DataFrame, templates=TEMPLATES, gram: int = GRAM, slop: int = SLOP,
         coverage: float = COVERAGE) -> DataFrame:
    """The verified spans: doc_id, row, label, base, start, end (words from 0,
    end exclusive), coverage."""
    spans = _spans(_votes(docs, templates, gram), slop)
    return spans.where(F.col("coverage") >= coverage).select(
        "doc_id", "row", "label", "base", "start",
        (F.col("end") + F.least("size", F.lit(gram))).alias("end"), "coverage")


def label_documents(docs: DataFrame, templates=TEMPLATES, gram: int = GRAM, slop: int = SLOP,
                    coverage: float = COVERAGE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and
    score (the best coverage) of every row of ``docs``."""
    spans = _spans(_votes(docs, templates, gram), slop)
    good = F.col("coverage") >= coverage
    base = good & F.col("base")
    labels = lambda c: F.array_join(F.sort_array(F.collect_set(F.when(c, F.col("label")))), ",")
    return spans.groupBy("row", "doc_id", "n_words").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("bigint").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("bigint").alias("last_word"),
        labels(base).alias("base_labels"), labels(good).alias("labels"),
        F.coalesce(F.max(F.when(good, F.col("coverage"))), F.lit(0.0)).alias("score"),
    ).drop("row")
