"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: text a loader treats as a missing value ---
NULL_SENTINELS = ["", "NaT", "NULL"]

_WORD_OR_GAP = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"


def lower_trim(c: Column) -> Column:
    """Join key for free-text area names: lower(trim(x))."""
    return F.lower(F.trim(c))


def strip_ws(c: Column) -> Column:
    """Remove leading/trailing whitespace of any kind (tabs, newlines too)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def digits_only(c: Column) -> Column:
    """Keep only 0-9, so 'LGA10050' and '10050' give the same key."""
    return F.regexp_replace(c.cast("string"), "[^0-9]", "")


def initcap_words(c: Column) -> Column:
    """Upper-case the first letter after every non-alphanumeric character.

    Spark's ``initcap`` only splits on blanks (o'connor -> O'connor); here the
    text is cut into runs of letters/digits and runs of other characters and
    each run is capitalised, giving O'Connor and Hunters-Hill.
    """
    runs = F.regexp_extract_all(F.lower(c), F.lit(_WORD_OR_GAP), 0)
    return F.when(c.isNotNull(), F.array_join(F.transform(runs, lambda r: F.initcap(r)), ""))


def null_sentinels(c: Column) -> Column:
    """Trimmed text, with '', 'NaT' and 'NULL' turned into NULL."""
    s = strip_ws(c.cast("string"))
    return F.when(~s.isin(*NULL_SENTINELS), s)
