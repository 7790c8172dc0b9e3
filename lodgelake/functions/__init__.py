"""Column helpers (scalar functions).  All are built from JVM-side Spark SQL
functions, so they stay inside whole-stage code generation; none is a UDF."""

from lodgelake.functions.text import (  # noqa: F401
    digits_only, initcap_words, lower_trim, null_sentinels, strip_ws,
)
from lodgelake.functions.dates import (  # noqa: F401
    format_month, minus_months, month_bucket, parse_date_cascade,
    parse_date_dayfirst, parse_date_month_locked, to_date_exact,
)
from lodgelake.functions.numeric import (  # noqa: F401
    clean_price, cents, exact_quotient, pct_change_rounded, pct_change_exact,
    ratio_half_up, round_cents_half_up, safe_ratio, stays_30, stays_30_clamped,
)
