"""File landing zone: CSV drops, file selection and month tags.

File-system calls (listing, renaming) touch metadata only and go through the
Hadoop FileSystem of the session, so they work the same on a local disk, HDFS
or an object store.  Row data never passes through the driver.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: month tag in a listing file name (searched, case-insensitive) ---
MONTH_FILE_PATTERN = r"(?i)(\d{2})_(\d{4})\.csv$"
_MONTH_RE = re.compile(r"(\d{2})_(\d{4})\.csv$", re.IGNORECASE)

# --- fixed values: substrings that select census and mapping files ---
KIND_MARKERS = {"census_g01": "G01", "census_g02": "G02",
                "nsw_lga_suburb": "SUBURB", "nsw_lga_code": "CODE"}


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_files(spark: SparkSession, directory: str) -> list[str]:
    """Names of the plain files directly inside ``directory`` (sorted)."""
    fs, p = _fs(spark, directory)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isFile())


def bytes_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files below a folder."""
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that the caller wrote and is done with."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def select_files(names: list[str], kind: str | None = None) -> list[str]:
    """CSV files (suffix case-insensitive) whose name holds the kind's marker
    (case-sensitive); ``kind=None`` keeps every CSV."""
    out = [n for n in names if n.lower().endswith(".csv")]
    if kind is not None:
        out = [n for n in out if KIND_MARKERS[kind] in n]
    return out


def kinds_of(names: DataFrame) -> DataFrame:
    """(name, kind) of the files that a kind takes, for a table of names; month
    files have the kind ``month``.  The rule of ``select_files`` on many names."""
    is_csv = F.lower(F.col("name")).endswith(".csv")
    kinds = [F.when(F.col("name").contains(marker), F.lit(kind)) for kind, marker in KIND_MARKERS.items()]
    kinds.append(F.when(F.col("name").rlike(MONTH_FILE_PATTERN), F.lit("month")))
    return names.where(is_csv).select("name", F.explode(F.array_compact(F.array(*kinds))).alias("kind"))


def month_of_name(name: str) -> tuple[int, int] | None:
    """(yyyy, mm) from '..._MM_YYYY.csv', or None."""
    m = _MONTH_RE.search(name)
    return (int(m.group(2)), int(m.group(1))) if m else None


def month_files_sorted(names: list[str]) -> list[str]:
    """Month files ordered by (year, month, name); others are ignored."""
    tagged = [(month_of_name(n), n) for n in names]
    return [n for t, n in sorted((t, n) for t, n in tagged if t is not None)]


def file_month(file_name: Column) -> Column:
    """Month number (int) from a file-name column, NULL when untagged."""
    return F.regexp_extract(file_name, MONTH_FILE_PATTERN, 1).try_cast("int")


def file_year(file_name: Column) -> Column:
    return F.regexp_extract(file_name, MONTH_FILE_PATTERN, 2).try_cast("int")


def _rename_parts(spark: SparkSession, staging: str, landing: str, naming) -> list[str]:
    """Move every part file of a (possibly partitioned) write into ``landing``
    under ``naming(partition_value, task_index)``."""
    fs, st_path = _fs(spark, staging)
    _, land_path = _fs(spark, landing)
    fs.mkdirs(land_path)
    jvm = spark.sparkContext._jvm
    moved = []
    stack = [(st_path, None)]
    while stack:
        d, value = stack.pop()
        for st in fs.listStatus(d):
            name = st.getPath().getName()
            if st.isDirectory():
                stack.append((st.getPath(), name.split("=", 1)[-1]))
            elif name.startswith("part-") and name.endswith(".csv"):
                task = int(name.split("-")[1])
                target = naming(value, task)
                fs.rename(st.getPath(), jvm.org.apache.hadoop.fs.Path(land_path, target))
                moved.append(target)
    return sorted(moved)


# quotes inside a cell are doubled, blanks around it stay
_WRITE = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def by_month_and_key(rows: DataFrame, date: Column, key: str) -> DataFrame:
    """Rows range-partitioned by month and key: a month is a file or, if large,
    a few."""
    return rows.repartitionByRange(F.date_format(date, "MM_yyyy"), F.col(key))


def in_file_order(rows: DataFrame, date: Column, order_cols: list[str]) -> DataFrame:
    """Rows sorted within their partitions as ``write_month_files`` wants them,
    before they are made into (much wider) text."""
    return rows.withColumn("_month", F.date_format(date, "MM_yyyy")).sortWithinPartitions("_month", *order_cols)


def write_month_files(spark: SparkSession, rows: DataFrame, landing: str, staging: str,
                      prefix: str = "listings") -> list[str]:
    """Write rows as monthly CSV drops named ``{prefix}_{part}_{MM}_{YYYY}.csv``.

    Rows come in ``in_file_order``, every copy of one key in one partition and so
    in one file: "first row wins" is then independent of the order in which files
    are loaded.  Nothing is moved or sorted here.  Headers are upper-case as in
    the source system.
    """
    renamed = rows.select(*[F.col(c).alias(c if c == "_month" else c.upper()) for c in rows.columns])
    renamed.write.mode("overwrite").options(**_WRITE).partitionBy("_month").csv(staging)
    return _rename_parts(spark, staging, landing,
                         lambda month, task: f"{prefix}_{task:05d}_{month}.csv")


def write_named_csv(spark: SparkSession, df: DataFrame, landing: str, staging: str,
                    file_name: str) -> str:
    """Write a small reference table (one row per area) as one named CSV."""
    df.repartition(1).write.mode("overwrite").options(**_WRITE).csv(staging)
    _rename_parts(spark, staging, landing, lambda _v, _t: file_name)
    return file_name
