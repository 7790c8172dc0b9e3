"""CSV records with line breaks inside quoted cells, from files read in splits.

A file is read as lines, in as many splits as its size asks for.  A line break
is inside a cell where the number of quotes before it is odd (a doubled quote
counts twice and changes nothing), so:

1. one scan tells of every split whether its quotes are odd; running sums over a
   file's splits (a row each) tell which splits begin inside a cell.  The same
   scan tells which files have such line breaks at all;
2. every split puts its own lines together to records, whole batches at a time.
   The rest of a record that an earlier split began, and a record that the split
   does not finish, are left as fragments;
3. fragments - two a split at most - are joined in the file's order.

No row is moved but the fragments.  Files without such line breaks need none of
this and take Spark's own splittable CSV scan.

Cases: the first record of a file is its header and left out; blank records are
skipped; a cell that is never closed reaches to the end of the file; records end
with ``\\n`` or ``\\r\\n`` (a file with breaks in cells whose records end with a
bare ``\\r`` is not supported).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodgelake.session import own_step

WHOLE, BEGIN, MIDDLE, END = range(4)
_MADE = "_id bigint, _file string, _block bigint, _row bigint, first boolean, kind int, value string"
_KINDS = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.string()]


def plain_path(uri: str) -> str:
    """A path as the file system spells it, from Spark's URI of it or itself."""
    return re.sub(r"^file:/+", "/", unquote(uri))


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines with path, split and order inside the split."""
    return spark.read.options(lineSep="\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"), "value")


def _odd(text: Column) -> Column:
    """Whether a text has an odd number of quotes."""
    return (F.octet_length(text) - F.octet_length(F.replace(text, F.lit('"')))) % 2 == 1


@dataclass(frozen=True)
class Splits:
    """What one scan of the lines tells: the split's file and whether it begins
    inside a cell, by (hash of the path, start); files (``plain_path``) with
    breaks in cells."""
    begin: dict[tuple[int, int], tuple[str, bool]]
    broken: set[str]


def splits(spark: SparkSession, paths: Sequence[str]) -> Splits:
    """One JVM scan of the lines, of which a row for each split comes back."""
    value = F.col("value")
    # a bare \r ends a line for Spark's own CSV scan
    bare = F.contains(F.rtrim(value, F.lit("\r")), F.lit("\r"))
    breaks = F.when(bare, F.exists(F.split(value, "\r"), _odd)).otherwise(_odd(value))
    per = _lines(spark, paths).groupBy("_path", "_file", "_block").agg(
        F.count_if(_odd(value)).alias("odd"), F.max(breaks).alias("breaks"))
    begin, broken, named, before = {}, set(), {}, 0
    with own_step(spark):
        rows = per.withColumn("_id", F.xxhash64("_path")).collect()
    for r in sorted(rows, key=lambda r: (r._path, r._block)):
        if r._id not in named:
            before = 0
        if named.setdefault(r._id, r._path) != r._path:
            raise RuntimeError(f"{r._path} and {named[r._id]} have one hash")
        begin[r._id, r._block] = (r._file, before % 2 == 1)
        before += r.odd
        if r.breaks:
            broken.add(plain_path(r._path))
    return Splits(begin, broken)


def broken_paths(spark: SparkSession, paths: Sequence[str]) -> set[str]:
    """Files (``plain_path``) with a line break inside a cell."""
    return splits(spark, paths).broken


def records(spark: SparkSession, paths: Sequence[str], known: Splits | None = None) -> DataFrame:
    """(_file, _block, _row, value): the files' records, each with the place of
    its first line.  ``known`` are the splits of just these files, if at hand."""
    # one entry for each split (not row)
    begin = spark.sparkContext.broadcast((known or splits(spark, paths)).begin)

    def assemble(batches):
        split, file, rest, parts, place = None, "", False, [], ()
        for b in batches:
            ids, blocks, rows = (b[c].to_numpy() for c in ("_id", "_block", "_row"))
            odd = pc.count_substring(b["value"], '"').to_numpy(zero_copy_only=False) % 2
            cuts = np.flatnonzero((np.diff(ids) != 0) | (np.diff(blocks) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, b.num_rows]):
                if lo == hi:
                    continue
                new = (int(ids[lo]), int(blocks[lo])) != split
                if new:
                    if parts:  # the split before this one ends inside a cell
                        yield _fragment(place, MIDDLE if rest else BEGIN, parts)
                    split, parts = (int(ids[lo]), int(blocks[lo])), []
                    file, rest = begin.value[split]
                value, row = b["value"].slice(lo, hi - lo), rows[lo:hi]
                after = (np.cumsum(odd[lo:hi]) + (rest or bool(parts))) % 2
                starts = np.flatnonzero(np.concatenate([[rest or bool(parts)], after[:-1]]) == 0)
                top, head = (split[0], file, split[1]), new and split[1] == 0
                if not len(starts) or starts[0] > 0:  # lines of a record begun before
                    end = int(starts[0]) if len(starts) else len(row)
                    if not parts:
                        place = (*top, int(row[0]), head)
                    parts += value.slice(0, end).to_pylist()
                    if not after[end - 1]:
                        yield _fragment(place, END if rest else WHOLE, parts)
                        rest, parts = False, []
                if not len(starts):
                    continue
                last = len(row)
                if after[-1]:  # the last record goes on
                    last, starts = int(starts[-1]), starts[:-1]
                    place = (*top, int(row[last]), head and last == 0)
                    parts = value.slice(last).to_pylist()
                if len(starts):
                    yield _whole(top, head, value, row, starts, last)
        if parts:
            yield _fragment(place, MIDDLE if rest else BEGIN, parts)

    made = _lines(spark, paths).select(F.xxhash64("_path").alias("_id"), "_block", "_row", "value").mapInArrow(assemble, _MADE)
    order = Window.partitionBy("_id").orderBy("_block", "_row")  # fragments only: two a split
    number = F.sum((F.col("kind") == BEGIN).cast("int")).over(order)
    piece = F.struct("_block", "_row", "value", "_file", "first")
    joined = (
        made.where(F.col("kind") != WHOLE).withColumn("number", number).groupBy("_id", "number")
        .agg(F.sort_array(F.collect_list(piece)).alias("p"))
        .select(F.col("p")[0]["_file"].alias("_file"), F.col("p")[0]["_block"].alias("_block"),
                F.col("p")[0]["_row"].alias("_row"), F.col("p")[0]["first"].alias("first"),
                F.array_join(F.col("p")["value"], "\n").alias("value"))
    )
    every = made.where(F.col("kind") == WHOLE).select("_file", "_block", "_row", "first", "value").union(joined)
    plain = F.when(F.contains("value", F.lit("\r")), F.regexp_replace("value", "\r$", "")).otherwise(F.col("value"))
    return every.where(~F.col("first") & F.col("value").rlike("[^ \r\n\t]")).select(
        "_file", "_block", "_row", plain.alias("value"))


def _fragment(place: tuple, kind: int, lines: list[str]) -> pa.RecordBatch:
    return _batch([[v] for v in (*place, kind, "\n".join(lines))])


def _whole(top: tuple, head: bool, value: pa.Array, row: np.ndarray, starts: np.ndarray, last: int) -> pa.RecordBatch:
    """Records that lie in one run of lines: lines from each start to the next,
    the last one up to line ``last``."""
    n, first = int(starts[0]), np.zeros(len(starts), bool)
    first[0] = head and n == 0
    text = value.slice(n, last - n)
    if len(starts) < last - n:
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array([*(starts - n), last - n], pa.int32()), text), "\n")
    return _batch([*(pa.repeat(pa.scalar(v, k), len(starts)) for v, k in zip(top, _KINDS)), row[starts], first,
                   np.full(len(starts), WHOLE), text])


def _batch(columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, _KINDS)],
                                      ["_id", "_file", "_block", "_row", "first", "kind", "value"])
