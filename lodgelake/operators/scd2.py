"""Slowly-changing history (type 2) and the point-in-time lookup.

Contract: validity is half-open [valid_from, valid_to), valid_to NULL means
current.  A later ``updated_at`` opens a new version even when attributes are
unchanged (timestamp strategy); an earlier or equal one is ignored.  Several
attribute sets with one timestamp resolve to the greatest, compared attribute
by attribute with NULL lowest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgelake.operators.keyfilter import cannot_match, may_match

FROM, TO = "valid_from", "valid_to"


def _one_per_timestamp(src: DataFrame, key: str, attrs: Sequence[str], ts: str, untimed: bool = False) -> DataFrame:
    """``untimed``: a key's rows without a timestamp leave one row too."""
    carried = [c for c in src.columns if c not in (key, ts) and c not in attrs]
    packed = F.struct(*[F.col(c) for c in list(attrs) + carried])
    timed = F.lit(True) if untimed else F.col(ts).isNotNull()
    return (src.where(F.col(key).isNotNull() & timed)
            .groupBy(key, ts).agg(F.max(packed).alias("_v"))
            .select(key, "_v.*", ts))


def build_history(src: DataFrame, key: str, attrs: Sequence[str], ts: str = "updated_at") -> DataFrame:
    """Full rebuild: one version per (key, ts), chained with ``lead``.

    The window holds one row per distinct timestamp of a key, so its size is
    bounded by the number of scrape dates, not by the number of rows.
    """
    per_ts = _one_per_timestamp(src, key, attrs, ts)
    w = Window.partitionBy(key).orderBy(ts)
    return per_ts.withColumn(FROM, F.col(ts)).withColumn(TO, F.lead(ts).over(w))


def current(history: DataFrame) -> DataFrame:
    """Open versions only."""
    return history.where(F.col(TO).isNull())


def apply_batch(history: DataFrame, batch: DataFrame, key: str, attrs: Sequence[str],
                ts: str = "updated_at", invalidate_hard_deletes: bool = False,
                as_of: Column | None = None) -> DataFrame:
    """Merge a batch into a history (incremental snapshot run).

    Batch rows newer than all of the key's versions (also those that a hard
    delete has closed: not before their end) become new versions (several
    new timestamps are chained); the open version is closed at the first of
    them.  With ``invalidate_hard_deletes`` an open version whose key is absent
    from the batch is closed at ``as_of`` (default: the batch's latest ts).
    The caller writes the result to a new location; never over the input.
    """
    cols, held = history.columns, history.schema[TO].dataType
    closed_v = history.where(F.col(TO).isNotNull())  # stay as they are, unshuffled
    ends = closed_v.groupBy(key).agg(F.max(FROM).alias(FROM), F.max(TO).alias(TO)).withColumn("_kind", F.lit(0))
    open_v = current(history).withColumn("_kind", F.lit(1))
    new_v = _one_per_timestamp(batch, key, attrs, ts, untimed=invalidate_hard_deletes).withColumns(
        {FROM: F.col(ts), TO: F.lit(None).cast(held), "_kind": F.lit(2)})
    # one shuffle by key; a key has its open version, its timestamps and one row for all that are closed
    rows = open_v.select(*cols, "_kind").unionByName(new_v.select(*cols, "_kind")).unionByName(ends, allowMissingColumns=True)
    own, new = Window.partitionBy(key), F.col("_kind") == 2
    rows = rows.withColumns({"_last": F.max(F.when(~new, F.col(FROM))).over(own), "_ended": F.max(F.when(~new, F.col(TO))).over(own),
                             "_seen": F.max(new).over(own)})
    later = (F.col(ts) > F.col("_last")) & (F.col("_ended").isNull() | (F.col(ts) >= F.col("_ended")))
    rows = rows.withColumn("_fresh", new & F.col(ts).isNotNull() & (F.col("_last").isNull() | later))
    close_at = F.min(F.when(F.col("_fresh"), F.col(ts))).over(own)
    if invalidate_hard_deletes:
        stamp = as_of if as_of is not None else batch.agg(F.max(ts)).scalar()
        close_at = F.when(F.col("_seen"), close_at).otherwise(stamp)
    # fresh timestamps are the last of a key's new ones: what follows one is fresh too
    follows = F.lead(ts).over(Window.partitionBy(key, "_kind").orderBy(ts))
    rows = rows.withColumn("_until", F.when(new, follows).otherwise(close_at).cast(held))
    merged = rows.where((F.col("_kind") == 1) | F.col("_fresh")).withColumn(TO, F.col("_until"))
    return closed_v.select(*cols).unionByName(merged.select(*cols))


def splice(history: DataFrame, batch: DataFrame, key: str, attrs: Sequence[str], ts: str = "updated_at") -> DataFrame:
    """Merge rows of any time into a history without hard deletes: the versions
    of the batch's keys are chained again with the new ones in between, those of
    other keys stay.  Equals a rebuild from all rows; rows met again change nothing.
    Versions whose key cannot be in the batch pass by without a shuffle."""
    cols = history.columns
    touched = batch.where(F.col(ts).isNotNull()).select(key).where(F.col(key).isNotNull()).distinct()
    rows = [c for c in cols if c not in (FROM, TO)]
    near = may_match(history, touched, [key])
    own = near.join(touched, key, "left_semi").select(*rows)
    again = build_history(own.unionByName(batch.select(*rows)), key, attrs, ts)
    others = cannot_match(history, touched, [key]).unionByName(near.join(touched, key, "left_anti").select(*cols))
    return others.unionByName(again.select(*cols))


def _carried_over(side: DataFrame, versions: DataFrame, key: str) -> DataFrame:
    """For every (key, bucket) with facts the last version of the buckets before
    it, as a version that sorts before all of the bucket's rows."""
    ends = versions.groupBy(key, "_asof_b").agg(F.max_by("_asof_v", "_asof_t").alias("_end"))
    asked = side.groupBy(key, "_asof_b").agg(F.lit(True).alias("_asked"))
    before = Window.partitionBy(key).orderBy("_asof_b").rowsBetween(Window.unboundedPreceding, -1)
    both = asked.unionByName(ends, allowMissingColumns=True).groupBy(key, "_asof_b").agg(
        F.max("_asked").alias("_asked"), F.first("_end", ignorenulls=True).alias("_end"))
    return (both.withColumn("_asof_v", F.last("_end", ignorenulls=True).over(before))
            .where(F.col("_asked") & F.col("_asof_v").isNotNull())
            .select(key, F.lit(None).cast("timestamp_ntz").alias("_asof_t"), F.lit(-1).alias("_asof_kind"),
                    "_asof_v", "_asof_b"))


def asof_join(facts: DataFrame, history: DataFrame, key: str, date_col: str,
              attrs: Sequence[str], how: str = "left", keep_validity: bool = False,
              bounded_per_key: bool = False, probes: DataFrame | None = None,
              bucket: str | None = None) -> DataFrame:
    """Attach the version valid at each fact's date: key equal and
    valid_from <= date < valid_to (or valid_to NULL).

    Facts and version starts are unioned and sorted per key by time (a version
    sorts before a fact of the same instant); ``last(ignorenulls)`` over the
    running frame carries the latest started version to each fact, which is
    kept when the fact lies before that version's end.  One shuffle, one sort,
    linear work; never all pairs of a key.

    The window group of a key must stay bounded.  With ``bounded_per_key``
    (at most one fact per key and date, e.g. listing snapshots) the facts enter
    the window themselves and need no join back.
    Otherwise (a host may own a third of all rows) only the distinct
    (key, date) pairs enter the window - bounded by the number of dates - and
    the matches come back to the facts by an equi-join that AQE can split when
    one key is skewed.  ``probes`` may supply a cheaper frame whose (key, date)
    pairs cover those of the facts (e.g. the scan the facts were reduced from),
    so the reduction is not computed a second time for the probe branch.
    Versions of a key must be disjoint, as history builds them.  Facts with a
    NULL key or date match nothing.

    ``bucket`` (a unit of ``date_trunc``: "year" to "second") is for keys with
    very many instants: a window then holds one (key, bucket), so a key with a
    third of all rows is spread over as many windows as it has buckets.  What a
    bucket begins with is the last version of the buckets before it, carried
    over by a scan of one row per (key, bucket).
    """
    t = "_asof_t"
    vf, vt = "_asof_from", "_asof_to"
    packed = F.struct(*[F.col(c) for c in attrs], F.col(FROM).alias(vf), F.col(TO).alias(vt))
    versions = (history.where(F.col(key).isNotNull() & F.col(FROM).isNotNull())
                .select(key, F.col(FROM).cast("timestamp_ntz").alias(t),
                        F.lit(0).alias("_asof_kind"), packed.alias("_asof_v")))
    has_key = F.col(key).isNotNull() & F.col(date_col).isNotNull()
    if bounded_per_key:
        # a fact without key or date is its own window group (matches nothing)
        side = facts.withColumn("_asof_solo", F.when(~has_key, F.monotonically_increasing_id()))
    else:
        side = (probes if probes is not None else facts).select(key, date_col).where(
            has_key).distinct().withColumn(
            "_asof_solo", F.lit(None).cast("long"))
    side = side.withColumn(t, F.col(date_col).cast("timestamp_ntz")).withColumn("_asof_kind", F.lit(1))
    within = [key, "_asof_solo"]
    if bucket:
        within.append("_asof_b")
        side, versions = (df.withColumn("_asof_b", F.date_trunc(bucket, F.col(t).cast("timestamp"))) for df in (side, versions))
        versions = versions.unionByName(_carried_over(side.where(F.col("_asof_solo").isNull()), versions, key))
    w = (Window.partitionBy(*within).orderBy(t, "_asof_kind")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cur = F.col("_asof_cur")
    carried = (side.unionByName(versions.withColumn("_asof_solo", F.lit(None).cast("long")),
                                allowMissingColumns=True)
               .withColumn("_asof_cur", F.last("_asof_v", ignorenulls=True).over(w))
               .where(F.col("_asof_kind") == 1))
    # the carried version started at or before the fact; half-open end
    hit = cur.isNotNull() & (cur[vt].isNull() | (F.col(t) < cur[vt]))
    outs = [F.when(hit, cur[c]).alias(c) for c in attrs]
    if keep_validity:
        outs += [F.when(hit, cur[vf]).alias(FROM), F.when(hit, cur[vt]).alias(TO)]
    if bounded_per_key:
        matched = carried.select(*facts.columns, *outs)
        return matched.where(hit) if how == "inner" else matched
    matched = carried.where(hit).select(key, date_col, *outs)
    return facts.join(matched, [key, date_col], how)
