"""URL filter by a path-template tree per host.

Rules (host, path) decide the URLs they fit.  The others are judged by a tree
of path templates that is grown per host from all URLs:

1. A path is cut into all of its segments.  In a segment every run of digits is
   a wildcard, so numbered leaves are one template.
2. Labels: a URL is positive or negative as ``labels`` says, where they are
   given.  By default URLs a block rule fits and URLs with a seed word in host or
   path are positive, all others count as negative (unlabelled URLs are mostly good).
3. Level by level a node's segments become its branches.  Segments are put in
   order by their share of positives (in bins of a hundredth, so that a node has
   at most 101 whatever the number of its segments); neighbours whose shares do
   not differ significantly (two-sided two-sample z test, the pooled share
   smoothed for small counts) are merged into one branch, so that many rare
   segments that are bad in the same way are judged together.  The names of a
   branch's segments are a wildcard from there on; what differs below is told
   apart at the next levels.  A node is a leaf when its URLs are all positive or
   all negative, or are one template: no cut could differ.  There is no bound on
   the depth; a run of segments that all of a node's templates share is passed
   in one step.
4. A leaf is rejected when its smoothed purity, (positives + PRIOR * the overall
   share) / (URLs + PRIOR), reaches PURITY.

Everything is a DataFrame expression: URLs are first aggregated to (host,
template) counts, so a host with a third of all URLs is combined before the
shuffle, and the tree is made of those counts; the verdict returns by a join on
(host, template) that AQE may broadcast or split.  There are as many rounds as
levels at which mixed nodes branch, each over the counts of mixed nodes only.

Cases: a null URL, or one without ``://``, has empty host and path, fits no rule
and is judged as a URL of the empty host; repeated rows are judged each (and
count each); a null page_id passes, without a label; several labels of a page: the
largest counts; a null label is none; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgelake.llm.common import stored
from lodgelake.session import scratch_path

#: Rules: verdict, host, path.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Words of a host or path that label a URL positive when between non-letters.
SEED_WORDS = ("ads", "adult", "bets", "casino", "pills", "porn", "spam", "viagra", "xxx")
#: z beyond which two branches differ; weight of the overall share; purity that
#: rejects; bins of the share of positives.
Z, PRIOR, PURITY, BINS = 2.58, 5.0, 0.6, 100


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; empty without ``://``."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    none = F.lit("")
    return F.coalesce(lower, none), F.coalesce(path, none)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule, written host/path, and its verdict; null if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def template(path: Column) -> Column:
    """The path's segments with runs of digits as wildcards."""
    parts = F.split(F.regexp_replace(path, r"[0-9]+", "*"), "/", -1)
    return F.slice(parts, 2, F.size(parts))


def _differ(n: Column, bad: Column, n2: Column, bad2: Column) -> Column:
    """Whether two branches differ in their shares of positives."""
    pool = (bad + bad2 + 1) / (n + n2 + 2)
    return F.abs(bad / n - bad2 / n2) > Z * F.sqrt(pool * (1 - pool) * (1 / n + 1 / n2))


def _branches(child: DataFrame) -> DataFrame:
    """(node, segment, branch) of the rows (node, segment, n, bad)."""
    child = child.withColumn("bin", F.expr(f"({BINS} * bad) div n"))
    order = Window.partitionBy("node").orderBy("bin")  # at most BINS + 1 rows of a node
    bins = child.groupBy("node", "bin").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    cut = _differ(F.col("n"), F.col("bad"), F.lag("n").over(order), F.lag("bad").over(order))
    bins = bins.withColumn("cut", F.coalesce(cut, F.lit(False)).cast("int"))
    return child.select("node", "segment", "bin").join(
        bins.select("node", "bin", F.sum("cut").over(order).alias("branch")), ["node", "bin"]).drop("bin")


def _shared(a: Column, b: Column) -> Column:
    """Number of leading segments that two templates share."""
    apart = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(apart > 0, apart - 1).otherwise(F.size(a)).cast("int")


def grow(counts: DataFrame) -> DataFrame:
    """(host, template, purity) for the rows (host, template, n, bad)."""
    spark = counts.sparkSession
    total = counts.agg(F.sum("n"), F.sum("bad")).first()  # two numbers
    share = float(total[1] or 0) / float(total[0] or 1)
    purity = (F.col("all_bad") + PRIOR * share) / (F.col("all_n") + PRIOR)
    leaves = scratch_path(spark, "url-leaves")
    going = F.when(F.size("rest") > 0, F.col("rest"))  # null for a template that ends above
    tree = counts.select("host", "template", "n", "bad", F.col("host").alias("node"), F.col("template").alias("rest"))
    while True:
        nodes = stored(tree.groupBy("node").agg(
            F.sum("n").alias("all_n"), F.sum("bad").alias("all_bad"),
            F.min("rest").alias("least"), F.max("rest").alias("most"),
            F.min(going).alias("low"), F.max(going).alias("high"),
        ).select(
            "node", "all_n", "all_bad",
            ((F.col("all_bad") > 0) & (F.col("all_bad") < F.col("all_n")) & (F.col("least") != F.col("most"))).alias("open"),
            # beside templates that end above, the last shared segment is a cut of its own
            F.greatest(F.lit(0), _shared(F.col("low"), F.col("high")) - F.when(F.size("least") == 0, 1).otherwise(0)).alias("skip"),
        ), "url-nodes")
        tree.join(nodes.where("not open"), "node").select("host", "template", purity.alias("purity")) \
            .write.mode("append").parquet(leaves)
        if nodes.where("open").isEmpty():
            break
        tree = tree.join(nodes.where("open"), "node").withColumn(
            "segment", F.coalesce(F.concat(F.lit("="), F.get("rest", F.col("skip"))), F.lit("end")))
        named = _branches(tree.groupBy("node", "segment").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
        below = F.slice("rest", F.col("skip") + 2, F.size("rest"))
        tree = stored(tree.join(named, ["node", "segment"]).select(
            "host", "template", "n", "bad", F.concat_ws("/", "node", "branch").alias("node"),
            F.when(F.size("rest") > 0, below).otherwise(F.col("rest")).alias("rest")), "url-tree")
    return spark.read.schema(counts.select("host", "template", F.lit(0.0).alias("purity")).schema).parquet(leaves)


def judge(pages: DataFrame, rules=RULES, seed_words=SEED_WORDS, labels: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and purity (of the leaf that decided
    where no rule fits) of every row of ``pages``.  ``labels`` (page_id, label:
    1 positive, 0 negative) stand before what rules and seed words say of a page."""
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, ruled = rule_of(F.col("host"), F.col("path"), rules)
    urls = urls.select("*", rule.alias("rule"), ruled.alias("ruled"), template(F.col("path")).alias("template"))
    words = rf"(?i)(^|[^a-z])({'|'.join(seed_words)})([^a-z]|$)"
    positive = F.coalesce(F.col("ruled") == "block", F.concat("host", "path").rlike(words))
    marked = urls
    if labels is not None:
        known = labels.where("label is not null").groupBy("page_id").agg((F.max("label") > 0).alias("known"))
        marked, positive = urls.join(known, "page_id", "left"), F.coalesce(F.col("known"), positive)
    counts = stored(marked.groupBy("host", "template").agg(
        F.count("*").alias("n"), F.count(F.when(positive, 1)).alias("bad")), "url-counts")
    return urls.join(grow(counts), ["host", "template"]).select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("purity") >= PURITY, "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("rule").isNull(), F.col("purity")).alias("purity"))
