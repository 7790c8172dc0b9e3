"""Mixing sources to target weights by Poisson replication.

Each source gets a target share of the mixture; a document's expected number
of copies is  budget * share(source) / size(source).  The number itself comes
from inverting that Poisson distribution at a fraction hashed from the seed
and the document's id, so it needs no state, repeats exactly on any
partitioning and splits a hot source like any other rows.  Documents are
exploded by their number and shuffled globally by a hashed key.

Scale: one aggregation per source (combined before the shuffle), a join with
the per-source table (broadcast if its measured size allows, else sort-merged)
and one range shuffle of the copies.  No Python runs.

Cases: a null source is a source of its own; a source without any word (null or
empty texts only) has rate 0 and leaves the mixture, while a wordless document
of another source is replicated like the rest; a null doc_id draws by its text;
repeated rows draw the same number; an empty table gives no rows; the input's
other columns are passed through, and one that has the name of a result column
(copy_no, copies, mix_key) is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgelake.llm.common import fresh, stored

#: Production parameters: shares are proportional to words ** ALPHA (between
#: the natural mixture, 1, and equal sources, 0); expected words out are
#: EPOCHS times the words in.
ALPHA, EPOCHS, SEED = 0.5, 1.0, "mix-1"
#: Bytes up to which the per-source table is broadcast.
SMALL_RATES = 16 << 20
#: md5 hex digits that make the fraction and its value range: 52 bits.
_DIGITS, _RANGE = 13, float(1 << 52)


def fraction(*parts: Column) -> Column:
    """A fraction in [0, 1) from the md5 of the parts joined by ':'."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("bigint") / F.lit(_RANGE)


def word_count(text: Column) -> Column:
    """Runs of characters other than blank and 9-13; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def identity(doc_id: Column, text: Column) -> Column:
    """What a document draws by: its id, else its text."""
    return F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.coalesce(text, F.lit(""))))


def source_rates(docs: DataFrame, alpha: float = ALPHA, epochs: float = EPOCHS,
                 weights: dict[str, float] | None = None) -> DataFrame:
    """(source, n_docs, n_words, rate): expected copies of each document.
    ``weights`` (source -> weight) replaces the words ** alpha rule; sources it
    does not name get weight 0."""
    per = docs.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum(word_count(F.col("text"))).alias("n_words"))
    if weights is None:
        weight = F.pow(F.col("n_words").cast("double"), F.lit(alpha))
    elif weights:
        named = F.create_map(*(F.lit(x) for kv in weights.items() for x in kv))
        weight = F.coalesce(F.try_element_at(named, F.col("source")), F.lit(0.0))
    else:
        weight = F.lit(0.0)
    # decimals: sums do not depend on the order of addition
    per = stored(per.withColumn(
        "weight", F.when(F.col("n_words") > 0, weight).otherwise(0.0).cast("decimal(28,6)")), "source-sizes")
    all_weight, all_words = (  # two numbers
        float(x or 0) for x in per.agg(F.sum("weight").cast("double"), F.sum("n_words")).first())
    rate = F.lit(epochs * all_words) * F.col("weight").cast("double") / (F.lit(all_weight) * F.col("n_words"))
    return per.select("source", "n_docs", "n_words", F.when(F.col("weight") > 0, rate).otherwise(0.0).alias("rate"))


def poisson_number(rate: Column, u: Column) -> Column:
    """The Poisson number at the fraction ``u``: how many of the cumulative
    probabilities of 0, 1, 2, ... are at or below it, up to where the rest is
    less than a fraction can resolve.  By logarithms, so any rate works; a
    document's steps are about as many as its copies."""
    last = F.ceil(rate + 10 * F.sqrt(rate) + 20).cast("int")
    zero = F.struct((-rate).alias("log_p"), F.lit(0.0).alias("upto"), F.lit(0).alias("n"), u.alias("u"))

    def add(state: Column, k: Column) -> Column:
        upto = state["upto"] + F.exp(state["log_p"])
        return F.struct((state["log_p"] + F.log(rate) - F.log(k.cast("double"))).alias("log_p"), upto.alias("upto"),
                        (state["n"] + (upto <= state["u"]).cast("int")).alias("n"), state["u"].alias("u"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(1), last + 1), zero, add, lambda s: s["n"])).otherwise(0)


def replicate(docs: DataFrame, alpha: float = ALPHA, epochs: float = EPOCHS,
              weights: dict[str, float] | None = None, seed: str = SEED) -> DataFrame:
    """Every document times its Poisson number, in a global random order:
    the columns of ``docs`` plus copies, copy_no (from 1) and mix_key."""
    rate, of = fresh(docs, "mix_rate", "mix_source")
    rates = source_rates(docs, alpha, epochs, weights).select(F.col("source").alias(of), F.col("rate").alias(rate))
    size = rates.agg(F.sum(F.octet_length(F.coalesce(of, F.lit(""))) + 64)).first()[0]
    if (size or 0) <= SMALL_RATES:  # else a sort-merge join, whose hot sources AQE splits
        rates = F.broadcast(rates)
    who = identity(F.col("doc_id"), F.col("text"))
    drawn = fraction(F.lit(seed), F.lit("draw"), who)
    joined = docs.join(rates, F.col("source").eqNullSafe(F.col(of)))
    kept = [c for c in docs.columns if c.lower() not in ("copies", "copy_no", "mix_key")]
    return (
        joined.select(*(f"`{c}`" for c in kept),
                      poisson_number(F.col(rate), drawn).alias("copies"))
        .where("copies > 0")
        .withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .withColumn("mix_key", F.substring(F.md5(F.concat_ws(
            ":", F.lit(seed), F.lit("order"), who, F.col("copy_no")).cast("binary")), 1, 16))
        .orderBy("mix_key", "doc_id", "copy_no")
    )
