"""Helpers shared by the document operators: byte-level tokenising of Arrow
text columns, chunking by bytes, folds, and tables written once to the shared
folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgelake.session import scratch_path

#: A-Z lower-cased; every other ASCII byte that is no digit or a-z becomes a
#: blank.  Bytes >= 0x80 stay, so splitting on blanks gives exactly the words
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the lower-cased text.
_WORDS = bytes(
    c + 32 if 0x41 <= c <= 0x5A
    else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A
    else 0x20
    for c in range(256)
)

#: Bytes of text worked on at once inside a task (one longer text is one chunk).
CHUNK_BYTES = 2_000_000


#: Rows of an Arrow batch at most: texts may be long, and a batch is held whole
#: by the JVM and by the Python worker.
BATCH_ROWS = 512


def bounded_batches() -> None:
    """Keep the session's Arrow batches small (a smaller setting stays)."""
    conf, key = SparkSession.active().conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))


@contextmanager
def small_batches(spark: SparkSession, size: int = 8 << 20):
    """Arrow batches of at most about ``size`` bytes for what runs inside; the
    caller's setting holds again afterwards."""
    conf, key = spark.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = conf.get(key)
    conf.set(key, str(size))
    try:
        yield
    finally:
        conf.set(key, before)


def alnum_words(text: bytes) -> list[bytes]:
    """Lower-cased words made of digits, letters and non-ASCII characters."""
    return text.translate(_WORDS).split()


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null reads as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if t is None else t for t in column.cast(kind).to_pylist()]


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[list[bytes]]:
    """Consecutive runs of texts of about ``limit`` bytes, so that working
    arrays stay small however many rows a batch has."""
    part, held = [], 0
    for t in texts:
        if part and held + len(t) > limit:
            yield part
            part, held = [], 0
        part.append(t)
        held += len(t)
    if part:
        yield part


def list_array(lengths: np.ndarray, values: pa.Array) -> pa.ListArray:
    """Arrow list column from the length of each list and all values in order."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def id_fold(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n (null for a null id)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(n))


def is_fold(doc_id: str | Column, n: int, k: int) -> Column:
    """Whether the id falls in fold k of n; false for a null id."""
    return F.coalesce(id_fold(doc_id, n) == k, F.lit(False))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back:
    lineage is cut, and a lost executor costs no recomputation upstream."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *bases: str) -> list[str]:
    """Column names, made from ``bases``, that ``df`` does not have."""
    have = {c.lower() for c in df.columns}
    out = []
    for b in bases:
        while b.lower() in have:
            b = f"_{b}"
        have.add(b.lower())
        out.append(b)
    return out


def bits_fraction(c: Column) -> Column:
    """A column hashed to [0, 1): 53 bits of its xxhash64."""
    return F.shiftrightunsigned(F.xxhash64(c), 11) / F.lit(float(1 << 53))


def first_by_hash(rows: DataFrame, key: str, n: int) -> Column:
    """Condition that all but about ``2 n`` keys of ``rows`` fail, and no key
    that is among the ``n`` smallest by xxhash64: it goes before a sort with a
    limit, whose last task then reads so few rows however many there are."""
    keys = float(rows.agg(F.approx_count_distinct(key, 0.01)).first()[0])
    return (F.xxhash64(key) / F.lit(2.0**64) + 0.5) * keys <= 2.0 * n + 1000


def row_key(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` with three non-null columns that tell its rows apart: the id (0
    if null), whether it is null, and a hash of the text."""
    return df.withColumns({
        names[0]: F.coalesce("doc_id", F.lit(0).cast("bigint")),
        names[1]: F.col("doc_id").isNull(),
        names[2]: F.xxhash64(F.coalesce("text", F.lit(""))),
    })


#: Bits of a map of hashes (2 MB, whatever it holds).
MAP_BITS = 1 << 24


class BitMap:
    """A bit map of hashes; ``has`` may be true for a hash that was not put in."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h & np.uint64(8 * len(self.bits) - 1)
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bit_map_of(rows: DataFrame, h: Column, size: int = MAP_BITS) -> BitMap:
    """The bit map of a column of hashes; 4 KB for each 32768 bits come to the driver."""
    at = h.bitwiseAND(F.lit(size - 1))
    got = rows.groupBy(F.shiftright(at, 15).alias("part")).agg(
        F.bitmap_construct_agg(F.pmod(at, F.lit(1 << 15))).alias("bits")).toArrow()
    bits = np.zeros((size >> 15, 1 << 12), np.uint8)
    for part, data in zip(got["part"].to_pylist(), got["bits"].to_pylist()):
        bits[part] = np.frombuffer(data, np.uint8)
    return BitMap(bits.ravel())
