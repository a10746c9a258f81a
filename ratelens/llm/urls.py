"""URL filter rules by a sort-merge range join, in DataFrame operations only.

A rule is a host and the start of a path, with a verdict.  It fits a url if
the url's host is the rule's host or a subdomain of it and the url's path
starts with the rule's path; of the rules that fit, the longest decides.

Both conditions are prefixes of a canonical key:

* the host with its labels reversed, each followed by a dot
  (``www.example.com`` -> ``com.example.www.``): a host and its subdomains are
  all the keys that start with the host's;
* that key of the rule's host, a slash (which no host holds), and the path.

The keys that start with a rule's key are one interval of the sorted keys,
and two such intervals are nested or apart.  ``active_rules`` sweeps rules and
points in sorted order: a stack holds the rules whose interval is open, a
rule's start drops what has ended and adds the rule, and a point reads the
stack.  It is used twice: distinct hosts against the rules' hosts, then every
(rule host, path) that this gives against the rules.

The sweep over rules runs in blocks of at most ``BLOCK`` neighbouring rules,
each begun with the rules still open there, found by equality with the
prefixes of the block's first key; points take the stack of the last rule
before them by a running ``last`` in range partitions.  No partition needs
another's rows, only the stack at its start.  Urls are swept once per
distinct (host, path), so a url, host or page repeated by a third of all rows
is one point; its rows only meet the result in a left join whose large side
Spark can split.

Defined results: a NULL url, or one without ``://``, has an empty host and
path and is judged like any other; the host is everything up to ``/``, ``?``
or ``#`` (with a port or user, if any); only A-Z are lower-cased.  Longest
means most characters of host and path together, then the longer host.  Of
rules with equal host and path the one that blocks counts; rules with a NULL
host, path or verdict are ignored.  Rows repeat as often as they are given; an
empty table gives an empty result; columns of the input named like a new one
are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.llm.common import cut_lineage, replace_column

#: rules that one step of the sweep folds
BLOCK = 512
#: verdict of a url that no rule fits
DEFAULT = "allow"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """Host of a url, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """Path of a url, without query and fragment; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels in reverse order, each followed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _in_ranges(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` in ranges of ``cols``, with the number of the range as ``_range``;
    written out, so that every later read sees the same ranges."""
    return cut_lineage(df.repartitionByRange(*cols).withColumn("_range", F.spark_partition_id()))


def _ended(stack: Column, key: Column) -> Column:
    """``stack`` without the rules whose interval ends before ``key``."""
    return F.filter(stack, lambda rule: F.startswith(key, rule["key"]))


def _stacks(rules: DataFrame) -> DataFrame:
    """``rules(key, mark)``, keys distinct -> ``(key, stack)``: the rules open
    at the rule's start, itself last, outermost first."""
    ranged = _in_ranges(rules, "key")
    order = Window.partitionBy("_range").orderBy("key")
    blocks = cut_lineage(
        ranged.withColumn("_block", F.floor((F.row_number().over(order) - 1) / BLOCK))
        .groupBy("_range", "_block").agg(F.array_sort(F.collect_list(F.struct("key", "mark"))).alias("rules")))
    first = F.col("rules")[0]["key"]
    begun = blocks.where(F.length(first) > 1).select("_range", "_block", F.explode(F.transform(
        F.sequence(F.lit(1), F.length(first) - 1), lambda n: F.substring(first, F.lit(1), n))).alias("key"))
    carried = (begun.join(rules, "key").groupBy("_range", "_block")
               .agg(F.array_sort(F.collect_list(F.struct("key", "mark"))).alias("carry")))
    rule = "array<struct<key:string,mark:string>>"
    carry = F.coalesce(F.col("carry"), F.array()).cast(rule)
    # the stacks so far; the last one is the sweep's present state
    swept = F.aggregate(
        "rules", F.array(carry).cast(f"array<{rule}>"),
        lambda done, r: F.concat(done, F.array(F.concat(
            _ended(F.element_at(done, -1), r["key"]), F.array(r)).cast(rule))).cast(f"array<{rule}>"))
    return (blocks.join(carried, ["_range", "_block"], "left")
            .select(F.explode(F.slice(swept, 2, F.size("rules"))).alias("stack"))
            .select(F.element_at("stack", -1)["key"].alias("key"), "stack"))


def active_rules(points: DataFrame, rules: DataFrame) -> DataFrame:
    """``points(key, …)`` and ``rules(key, mark)``, keys distinct in each ->
    points with ``active``: the rules (key, mark) whose keys the point's key
    starts with, shortest first."""
    rest = [c for c in points.columns if c != "key"]
    stacks = _stacks(rules).select("key", F.lit(False).alias("_point"), "stack", *[
        F.lit(None).cast(points.schema[c].dataType).alias(c) for c in rest])
    events = _in_ranges(stacks.unionByName(
        points.withColumn("_point", F.lit(True)), allowMissingColumns=True), "key", "_point")
    # what is open at the start of each range: one row a range
    last = events.groupBy("_range").agg(F.max_by("stack", F.when(~F.col("_point"), F.col("key"))).alias("stack"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    start = last.select("_range", F.last("stack", True).over(earlier).alias("start"))
    before = Window.partitionBy("_range").orderBy("key", "_point").rowsBetween(Window.unboundedPreceding, 0)
    return (events.withColumn("stack", F.last("stack", True).over(before)).where("_point")
            .join(start, "_range")
            .withColumn("active", F.coalesce(_ended(F.coalesce("stack", "start"), F.col("key")), F.array()))
            .select(*points.columns, "active"))


def _rule_table(rules: DataFrame) -> DataFrame:
    """Distinct (host, path) with host key, key and verdict."""
    host = F.translate("host", _UPPER, _LOWER)
    return (rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
            .select(host.alias("host"), "path", "verdict")
            .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block > allow
            .withColumn("host_key", host_key(F.col("host")))
            .withColumn("key", F.concat("host_key", F.lit("/"), "path")))


def decide(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls(host, path)``, distinct, and ``rules(host, path, verdict)`` ->
    ``(host, path, rule, verdict)`` of the urls that a rule fits."""
    table = cut_lineage(_rule_table(rules))
    hosts = urls.select("host").distinct().withColumn("key", host_key(F.col("host")))
    rule_hosts = table.select(F.col("host_key").alias("key"), F.col("host").alias("mark")).distinct()
    chain = (active_rules(hosts, rule_hosts).where(F.size("active") > 0)
             .select("host", F.explode("active").alias("at"))
             .select("host", F.col("at")["key"].alias("host_key"), F.col("at")["mark"].alias("rule_host")))
    paths = urls.join(chain, "host").withColumn("key", F.concat("host_key", F.lit("/"), "path"))
    points = paths.select("key").distinct()
    fits = (active_rules(points, table.select("key", F.col("verdict").alias("mark")))
            .where(F.size("active") > 0).select("key", F.element_at("active", -1).alias("top")))
    path = F.substr(F.col("top")["key"], F.length("host_key") + 2)
    return (paths.join(fits, "key")
            .select("host", "path", F.concat("rule_host", path).alias("rule"),
                    F.length("rule_host").alias("at"), F.col("top")["mark"].alias("verdict"))
            .groupBy("host", "path").agg(F.max(F.struct(F.length("rule"), "at", "rule", "verdict")).alias("best"))
            .select("host", "path", "best.rule", "best.verdict"))


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host and path of the longest
    rule that fits, else NULL) and ``verdict`` (the rule's, else ``default``)."""
    url = F.col(url_col)
    named = replace_column(replace_column(
        pages.withColumn("_host", host_of(url)).withColumn("_path", path_of(url)).drop("rule", "verdict"),
        "host", F.col("_host")), "path", F.col("_path")).drop("_host", "_path")
    fits = decide(named.select("host", "path").distinct(), rules)
    return (named.join(fits, ["host", "path"], "left")
            .withColumn("verdict", F.coalesce("verdict", F.lit(default)))
            .select(*named.columns, "rule", "verdict"))
