"""URL rules as a sort-merge range join, in DataFrame operations only.

A rule is a host and a path prefix and fits the host, all its subdomains and all paths that
begin with the prefix; the longest fitting rule wins. The canonical key is the reversed host
followed by the path. A path prefix p is then the interval [p, p + 0xFF) of its host's keys (bytes;
0xFF never occurs in UTF-8). Prefix intervals nest, so a sweep over the sorted keys keeps a stack: the start of an
interval pushes its rule, the end pops it. The height of the stack is a running sum of starts less ends,
and its top is the newest rule that was pushed to that height, so each height is a place of the stack.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RULES_SCHEMA = "action string, host string, path string"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.concat_ws(".", F.reverse(F.split(host, r"\.")))


def rule_bounds(rules: DataFrame) -> DataFrame:
    """Start (kind 1) and end (kind 0) of each rule's interval of keys, with the rule."""
    top = F.struct(F.length("path").alias("depth"), "action", "path").alias("top")
    key = F.encode("path", "utf-8")
    edges = F.array(
        F.struct(key.alias("key"), F.lit(1).alias("kind")),
        F.struct(F.concat(key, F.lit(b"\xff")).alias("key"), F.lit(0).alias("kind")),
    )
    return rules.select("rev", F.explode(edges).alias("e"), top).select("rev", "e.*", "top")


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", salts: int = 64) -> DataFrame:
    """Every row with ``host``, ``path``, ``rule`` and ``verdict`` added (columns so named are replaced).

    A null url, or one without ``://``, has an empty host and path, so no rule fits and the verdict is
    ``default``. Of rules with one host and path, ``block`` beats ``allow``. Distinct (host, path) pairs are
    judged once; each host's keys are dealt over ``salts`` sweeps, so that a host with most
    of the pages is not one task, and each sweep gets all of that host's rule bounds.
    """
    added = ("host", "path", "rule", "verdict")
    rest = [F.col(f"`{c}`") for c in pages.columns if c not in added]
    pages = pages.select(*rest, url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    rules = rules.where("action is not null and host is not null and path is not null")
    rules = rules.groupBy("host", "path").agg(F.max("action").alias("action")).withColumn("rev", reversed_host(F.col("host")))
    most = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 1  # labels of the longest host

    urls = pages.select("host", "path").distinct()
    # All ends of the host that a rule could name, as reversed keys: org, org.example, ...
    parts = F.reverse(F.split("host", r"\."))
    ends = urls.withColumn("parts", parts)
    ends = ends.select("host", "path", "parts", F.explode(F.sequence(F.lit(1), F.least(F.size("parts"), F.lit(most)))).alias("n"))
    ends = ends.select("host", "path", F.concat_ws(".", F.slice("parts", F.lit(1), F.col("n"))).alias("rev"))
    ends = ends.join(rules.select("rev").distinct(), "rev", "left_semi")

    none = F.lit(None).cast("struct<depth:int,action:string,path:string>")
    points = ends.select("rev", F.pmod(F.xxhash64("host", "path"), F.lit(salts)).cast("int").alias("salt"), F.encode("path", "utf-8").alias("key"), F.lit(2).alias("kind"), none.alias("top"), "host", "path")
    bounds = rule_bounds(rules.select("rev", "path", "action")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    bounds = bounds.withColumns({"host": F.lit(None).cast("string"), "path": F.lit(None).cast("string")})

    sweep = Window.partitionBy("rev", "salt").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(F.col("kind") == 1, 1).when(F.col("kind") == 0, -1).otherwise(0)
    swept = points.unionByName(bounds).withColumn("height", F.sum(step).over(sweep)).where("kind > 0")
    place = Window.partitionBy("rev", "salt", "height").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = swept.withColumn("now", F.last("top", ignorenulls=True).over(place))
    length = (F.length("rev") + F.col("depth")).alias("length")
    best = F.max(F.struct(length, F.length("rev").alias("l"), "action", reversed_host(F.col("rev")).alias("h"), "rule_path")).alias("best")
    fits = swept.where("kind = 2 and height > 0").select("host", "path", "rev", "now.depth", "now.action", F.col("now.path").alias("rule_path"))
    found = fits.groupBy("host", "path").agg(best)
    out = pages.join(found, ["host", "path"], "left")
    return out.select(*rest, "host", "path", F.concat("best.h", "best.rule_path").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"))


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, RULES_SCHEMA)
