"""URL rules by a sort-merge range join, with DataFrame functions only.

A rule's canonical key is its host with the labels reversed, a slash, and its path. The
keys below it form one interval of the byte order, and intervals of different rules are
nested or apart. A URL gets such a key for each suffix of its host, as a rule covers
subdomains. Boundaries and URL keys are sorted together; a sweep keeps the stack of open
rules by the depth of nesting, and each URL key takes the rule on top.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subtide.llm.scratch import partitions_for, store
from subtide.operators.joins import hash_join

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ? or #, A-Z in lower case. Path: from there up
    to ? or #. Both are empty if the url is null or has no ://."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"\A[^?#]*", 0)
    return F.translate(raw, UPPER, LOWER), path


def canonical_key(labels: Column, path: Column) -> Column:
    """Bytes; no host holds a slash, so a rule with an empty path covers its host alone."""
    return F.concat(F.array_join(F.reverse(labels), "."), F.lit("/"), path).cast("binary")


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], "verdict string, host string, path string")


def boundaries(rules: DataFrame) -> DataFrame:
    """(key, top): the ends of the rules' intervals in byte order, with the rule on top of
    the stack after each; null where the stack is empty. Of two rules with one host and
    path a block wins. No UTF-8 text holds the byte FF, so prefix + FF ends an interval."""
    labels = F.split(F.col("host"), r"\.")
    distinct = (
        rules.select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .filter(F.col("host").isNotNull())
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
        .select(
            F.element_at(labels, -1).alias("zone"),
            canonical_key(labels, F.col("path")).alias("prefix"),
            F.struct(F.concat("host", "path").alias("rule"), "verdict").alias("own"),
        )
    )
    ends = distinct.select(
        "zone", "own",
        F.explode(F.array(
            F.struct(F.col("prefix").alias("key"), F.lit(1).alias("step")),
            F.struct(F.concat("prefix", F.unhex(F.lit("FF"))).alias("key"), F.lit(-1).alias("step")),
        )).alias("end"),
    ).select("zone", "own", "end.*")
    # rules of different top-level labels are never nested, so each is swept by itself
    sweep = Window.partitionBy("zone").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened = F.when(F.col("step") == 1, F.col("own"))
    level = Window.partitionBy("zone", "depth").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # an opening rule lies on its depth; after a closing one the latest rule opened on the
    # depth that is left lies on top
    return ends.withColumn("depth", F.sum("step").over(sweep)).select(
        "key", F.when(F.col("depth") > 0, F.last(opened, ignorenulls=True).over(level)).alias("top")
    )


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", page_id: str = "page_id", url: str = "url") -> DataFrame:
    """One row per row of pages: page_id, host, path, rule, verdict. The longest rule that
    fits wins; if none does, rule is null and the verdict is the default. Null urls and
    urls without :// have an empty host and path, which no rule fits. Very long urls are
    judged whole; an empty table of pages gives no row, one of rules the default."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url))
    parsed = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    depth = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    labels = F.split(F.col("host"), r"\.")
    # a suffix of more labels than any rule's host has fits none
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(depth, 1)))),
        lambda n: F.slice(labels, -n, n),
    )
    # repeated urls are swept once, so a hot url is one row
    urls = parsed.select("host", "path").distinct().select(
        F.explode(suffixes).alias("suffix"), "host", "path"
    ).select(
        canonical_key(F.col("suffix"), F.col("path")).alias("key"),
        F.lit(1).alias("kind"), "host", "path", F.lit(None).cast("struct<top:struct<rule:string,verdict:string>>").alias("state"),
    )
    bounds = boundaries(rules).select(
        "key", F.lit(0).alias("kind"), F.lit("").alias("host"), F.lit("").alias("path"), F.struct("top").alias("state")
    )
    order = ["key", "kind", "host"]
    # ranges of the sort; written, as a second run might draw them elsewhere
    ranges = store(
        urls.unionByName(bounds).repartitionByRange(partitions_for(spark), *order).withColumn("part", F.spark_partition_id()),
        "url-keys",
    )
    # what the last boundary of a range leaves open is carried into those after it
    left = ranges.filter(F.col("kind") == 0).groupBy("part").agg(F.max_by("state", "key").alias("state"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    seeds = (
        ranges.select("part").distinct().join(left, "part", "left")  # a row for each range
        .select("part", F.last("state", ignorenulls=True).over(earlier).alias("state"))
        .select(F.lit(b"").alias("key"), F.lit(0).alias("kind"), F.lit("").alias("host"), F.lit("").alias("path"), "state", "part")
    )
    sweep = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = ranges.unionByName(seeds).withColumn("top", F.last("state", ignorenulls=True).over(sweep)["top"])
    best = (
        swept.filter((F.col("kind") == 1) & F.col("top").isNotNull())
        .groupBy("host", "path").agg(F.max(F.struct(F.length("top.rule").alias("size"), "top.rule", "top.verdict")).alias("best"))
    )
    # a popular url, or null ones, may be a large share of the pages
    return hash_join(parsed, best, ["host", "path"]).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
