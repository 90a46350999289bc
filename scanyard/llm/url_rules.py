"""URL filter rules by a sort-merge range join over reversed-host keys.

A rule names a host and a path. It fits the host and all its subdomains, where the URL's path
begins with the rule's. The canonical key of a host is its labels in reverse, each ended by a dot,
so the hosts a rule fits are one interval of keys. Intervals are nested or apart. Sorted together
with the URLs, interval ends and starts say which rules are active from there on: each boundary
carries the stack of hosts then open, outermost first. A URL takes the stack of the last boundary
before it; the rules of the hosts on it whose path the URL's begins with fit, and the longest
wins.

Everything is a DataFrame expression. The sweep runs in ranges of sorted keys; what is open where
a range begins comes from the boundaries of the ranges before it, one row per range. URLs of one
host differ in path and id, by which ranges go on, so a hot host spreads over several ranges.

Defined cases: a null URL, or one without ``://``, has empty host and path and fits no rule;
repeated rows and ids each get a row; of rules with equal host and path the blocking one counts;
of fitting rules of equal length the one with the longer host wins; rules with a null or empty
host, or a null path or verdict, are ignored; with no rules all URLs get the default; columns
other than id and URL are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scanyard.llm.common import keep, lower_az

ALLOW, BLOCK = "allow", "block"
# Labels of a host end in a dot; the character after it ends the interval.
_END = "/"


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return lower_az(F.regexp_extract(_rest(url), r"(?s)^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")


def key_of(host: Column) -> Column:
    """Labels in reverse, each ended by a dot: ``a.b.org`` is ``org.b.a.``."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (host, path, verdict)."""
    names = ("host", "path", "verdict")
    given = [F.struct(*(F.lit(v).cast("string").alias(n) for n, v in zip(names, rule)))
             for rule in rules]
    if not given:
        return spark.range(0).select(*(F.lit("").alias(n) for n in names))
    return spark.range(1).select(F.inline(F.array(*given)))


_RULES = "array<struct<host string, path string, verdict string>>"


def boundaries(rules: DataFrame) -> DataFrame:
    """(key, stack): from this key on, until the next one, the rules of these hosts are active.

    A host's start opens it on top of those of its parents that have rules; its end closes it.
    """
    by_host = rules.groupBy("host").agg(F.collect_list(F.struct("host", "path", "verdict"))
                                        .alias("own"))
    # All suffixes of a host at label bounds, to find the parents that have rules.
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels) - i + 1), "."))
    chain = by_host.select("host", F.explode(suffixes).alias("parent")).join(
        by_host.select(F.col("host").alias("parent"), "own"), "parent")
    depth = F.length("parent")
    stacks = chain.groupBy("host").agg(
        F.sort_array(F.collect_list(F.struct(depth.alias("depth"), "own"))).alias("open"))
    key = key_of(F.col("host"))
    start = stacks.select(key.alias("key"), F.flatten("open.own").alias("stack"))
    # The end: the key with its last dot raised by one, and the stack without the host itself.
    end = stacks.select(
        F.concat(F.substr(key, F.lit(1), F.length(key) - 1), F.lit(_END)).alias("key"),
        F.flatten(F.slice("open.own", 1, F.size("open") - 1)).alias("stack"))
    return start.unionByName(end)


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          default: str = ALLOW) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict."""
    known = rules.select(lower_az(F.col("host")).alias("host"), "path", "verdict").where(
        "host <> '' and path is not null and verdict is not null")
    known = known.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    marks = boundaries(known).select(
        "key", F.lit(0).alias("kind"), F.lit("").alias("path"), "stack",
        F.lit("").alias("host"), F.lit(None).cast(pages.schema[id_col].dataType).alias("id"))
    url = F.col(url_col).cast("string")
    points = pages.select(F.col(id_col).alias("id"), F.coalesce(host_of(url), F.lit("")).alias(
        "host"), F.coalesce(path_of(url), F.lit("")).alias("path"))
    points = points.select(
        key_of(F.col("host")).alias("key"), F.lit(1).alias("kind"), "path",
        F.lit(None).cast(_RULES).alias("stack"), "host", "id")
    # Kept as files, so that the ranges below stay as they are wherever they are read again.
    swept = keep(marks.unionByName(points).repartitionByRange("key", "kind", "path", "id")
                 .withColumn("part", F.spark_partition_id()), "swept")

    within = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(
        Window.unboundedPreceding, 0)
    parts = swept.groupBy("part").agg(
        F.max_by("stack", F.when(F.col("kind") == 0, F.col("key"))).alias("last"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    opening = keep(parts.select("part", F.last("last", ignorenulls=True).over(before).alias(
        "opening")), "opening")
    active = swept.withColumn("here", F.last("stack", ignorenulls=True).over(within)).where(
        F.col("kind") == 1).join(F.broadcast(opening), "part")
    stack = F.coalesce("here", "opening")
    fitting = F.filter(stack, lambda r: F.startswith(F.col("path"), r["path"]))
    ranked = F.transform(fitting, lambda r: F.struct(
        (F.length(r["host"]) + F.length(r["path"])).alias("size"),
        F.length(r["host"]).alias("depth"), F.concat(r["host"], r["path"]).alias("rule"),
        r["verdict"].alias("verdict")))
    best = F.array_max(ranked)
    return active.select("id", "host", "path", best["rule"].alias("rule"), F.coalesce(
        best["verdict"], F.lit(default)).alias("verdict"))
