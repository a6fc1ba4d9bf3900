"""URL filters (operator 5): a temporal list join.

A list is a set of dated entries (rule, listed_at, action). Entries of one rule
become validity intervals: each holds from its time until the rule's next entry.
A capture asks for the rules that could cover its URL: the host, every parent
domain of two labels or more, and the host with its first path segment. The
as-of join finds, per rule, the entry active at fetch time; the longest such
rule decides, and a capture without an active rule is allowed.

The join is an equi-join on (rule, time bucket): an interval is repeated for
each bucket of ``bucket_seconds`` it touches within the range of the captures,
so a rule with very many captures or entries is spread over its buckets, and a
bucket holds few intervals of one rule. Adaptive execution splits what is still
skewed.

Times are whole seconds since 1970. Cases: a null or unparseable URL, or a null
time, matches nothing and is allowed; two entries of a rule at the same second:
block wins; entries with a null rule, time or action are left out; repeated rows are
evaluated each (told apart by a row key); empty tables give no rows or no
matches; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKET_SECONDS = 30 * 86400
#: Derived list of the registered query: first day, days covered, entries tried per rule (fixed values)
FIRST_SECOND = 1704067200
DAYS = 366
ENTRIES = 4
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
SEGMENT = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)"


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, HOST, 1))


def rules_of(url: Column) -> Column:
    """All rules that could cover ``url``, as an array."""
    labels = F.split(host_of(url), r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    segment = F.regexp_extract(url, SEGMENT, 1)
    own = F.when(F.length(segment) > 0, F.array(F.concat(host_of(url), F.lit("/"), segment))).otherwise(
        F.array().cast("array<string>"))
    return F.when(F.length(host_of(url)) > 0, F.array_distinct(F.concat(domains, own))).otherwise(
        F.array().cast("array<string>"))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """rule, action, valid_from, valid_to (exclusive; null: still valid)."""
    one = (entries.where(F.col("rule").isNotNull() & F.col("listed_at").isNotNull() & F.col("action").isNotNull())
           .groupBy("rule", "listed_at").agg(F.max("action").alias("action")))
    upto = F.lead("listed_at").over(Window.partitionBy("rule").orderBy("listed_at"))
    return one.select("rule", "action", F.col("listed_at").alias("valid_from"), upto.alias("valid_to"))


def evaluate(captures: DataFrame, entries: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """``captures`` (page_id, url, fetched_at) with rule, listed_at and blocked."""
    keyed = captures.select("page_id", "url", "fetched_at")
    bucket = lambda c: F.floor(c / bucket_seconds)
    asked = (keyed.where(F.col("fetched_at").isNotNull() & F.col("url").isNotNull()).distinct()
             .select("page_id", "url", "fetched_at", bucket(F.col("fetched_at")).alias("bucket"),
                     F.explode(rules_of(F.col("url"))).alias("rule")))
    lo, hi = (captures.agg(f("fetched_at")).scalar() for f in (F.min, F.max))
    held = (validity_intervals(entries).withColumns({"lo": lo, "hi": hi})
            .where((F.col("valid_from") <= F.col("hi")) & F.coalesce(F.col("valid_to") > F.col("lo"), F.lit(True)))
            .select("rule", "action", "valid_from", "valid_to", F.explode(F.sequence(
                bucket(F.greatest("valid_from", "lo")),
                bucket(F.least(F.coalesce(F.col("valid_to") - 1, F.col("hi")), F.col("hi"))))).alias("bucket")))
    active = (asked.join(held, ["rule", "bucket"])
              .where((F.col("fetched_at") >= F.col("valid_from"))
                     & F.coalesce(F.col("fetched_at") < F.col("valid_to"), F.lit(True))))
    best = active.groupBy("page_id", "url", "fetched_at").agg(F.max_by(
        F.struct("rule", "valid_from", "action"), F.struct(F.length("rule"), F.col("rule"))).alias("best"))
    # one row per distinct capture comes back to each of its rows
    b = best.select(F.col("page_id").alias("_p"), F.col("url").alias("_u"), F.col("fetched_at").alias("_t"), "best")
    return (keyed.join(b, keyed["page_id"].eqNullSafe(b["_p"]) & (keyed["url"] == b["_u"])
                       & (keyed["fetched_at"] == b["_t"]), "left")
            .select("page_id", "url", "fetched_at", F.col("best.rule").alias("rule"),
                    F.col("best.valid_from").alias("listed_at"),
                    F.coalesce(F.col("best.action") == "block", F.lit(False)).alias("blocked")))


def _number(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def derived_captures(pages: DataFrame) -> DataFrame:
    """Pages have no fetch time: one is derived from the id."""
    n = _number(F.col("page_id").cast("string"))
    return pages.select("page_id", "url", (F.lit(FIRST_SECOND) + F.pmod(n, F.lit(DAYS * 86400))).alias("fetched_at"))


def derived_entries(pages: DataFrame) -> DataFrame:
    """A dated list over the rules that the pages' URLs name: up to ``ENTRIES``
    entries a rule, their days and actions from a hash of the rule."""
    n = _number(F.concat("rule", F.lit("#"), F.col("j").cast("string")))
    return (pages.select(F.explode(rules_of(F.col("url"))).alias("rule")).distinct()
            .withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(ENTRIES - 1))))
            .where(F.pmod(n, F.lit(3)) != 0)
            .select("rule", (F.lit(FIRST_SECOND) + F.pmod(F.floor(n / 3), F.lit(DAYS)) * 86400).alias("listed_at"),
                    F.when(F.pmod(F.floor(n / 2048), F.lit(2)) == 0, "block").otherwise("allow").alias("action")))


def filter_pages(pages: DataFrame) -> DataFrame:
    """The registered query."""
    return evaluate(derived_captures(pages), derived_entries(pages.select("url")))
