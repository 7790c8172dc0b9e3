"""Date helpers: month buckets, trailing windows and tolerant parsing."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodgelake.functions.text import null_sentinels

# --- fixed values: accepted date layouts, the same for every loader ---
SLASH_DAY_FIRST = "d/M/yyyy"
DAY_FIRST = [SLASH_DAY_FIRST, "d-M-yyyy"]
MONTH_FIRST = ["M/d/yyyy", "M-d-yyyy"]
ISO = "yyyy-MM-dd"
# year first or month by name: no doubt about the order
CERTAIN = [ISO, "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy/MM/dd",
           "d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy"]


# what the letters of a layout may read, and a little more
_DAY, _MONTH = "0*([1-9]|[12][0-9]|3[01])", "0*([1-9]|1[0-2])"
_READS = {"yyyy": "[+-]?[0-9]{4,}", "d": _DAY, "dd": _DAY, "M": _MONTH, "MM": _MONTH, "MMM": ".+", "MMMM": ".+",
          "HH": "[0-9]+", "mm": "[0-9]+", "ss": "[0-9]+", "'T'": "[Tt]"}
# days that no year has (30 February, 31 April), by what the layout begins with
_NO_SUCH_DAY = {"d": r"(?!0*(3[01]\D0*2|31\D0*(4|6|9|11))\D)", "M": r"(?!0*(2\D0*3[01]|(4|6|9|11)\D0*31)\D)"}


def shape(layout: str) -> str:
    """Pattern of every text that the layout can read (and of some that it cannot)."""
    parts = re.findall(r"'T'|y+|M+|d+|H+|m+|s+|.", layout)
    return "^" + _NO_SUCH_DAY.get(layout[0], "") + "".join(_READS.get(part, part) for part in parts) + "$"


def to_date_exact(s: Column, layout: str) -> Column:
    """Parse with one layout; a malformed or impossible date gives NULL.  A text
    of another shape is not parsed: each failed parse would cost an exception."""
    return F.when(s.rlike(shape(layout)), F.try_to_date(s, layout))


def first_date(s: Column, layouts: Sequence[str]) -> Column:
    """The reading of the first layout that fits; NULL when none does."""
    return F.coalesce(*[to_date_exact(s, f) for f in layouts])


def _read_once(s: Column, reading: Callable[[Column], Column]) -> Column:
    """``reading`` of the text without sentinels, which is made once for all layouts."""
    return F.transform(F.array(null_sentinels(s)), reading)[0]


def month_bucket(d: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(d, "month")


def format_month(d: Column) -> Column:
    """'YYYY-MM' label of a date."""
    return F.date_format(d, "yyyy-MM")


def minus_months(d: Column, n: int) -> Column:
    """d - n months, clamped to month end (2020-02-29 - 12 -> 2019-02-28)."""
    return F.add_months(d, -n)


def parse_date_cascade(s: Column) -> Column:
    """Bulk loads: day-first with slashes, then certain layouts, then the generic
    reading (month-first, else day-first); NULL when none fits."""
    return _read_once(s, lambda t: first_date(t, [SLASH_DAY_FIRST, *CERTAIN, *MONTH_FIRST, *DAY_FIRST]))


def parse_date_dayfirst(s: Column) -> Column:
    """Day-first, then certain layouts, then month-first (host_since of the
    monthly loader).  ISO dates stay ISO."""
    return _read_once(s, lambda t: first_date(t, [*DAY_FIRST, *CERTAIN, *MONTH_FIRST]))


def parse_date_month_locked(s: Column, file_month: Column) -> Column:
    """Resolve an ambiguous a/b/yyyy date with the month the file is for.

    Day-first wins when its month equals the file month, else month-first when
    its month does; otherwise a certain layout is taken (its month is not
    checked).  Without a file month only certain layouts are read.
    """
    def reading(t: Column) -> Column:
        d1, d2 = first_date(t, DAY_FIRST), first_date(t, MONTH_FIRST)
        return F.coalesce(
            F.when(F.month(d1) == file_month, d1),
            F.when(F.month(d2) == file_month, d2),
            first_date(t, CERTAIN),
        )

    return _read_once(s, reading)
