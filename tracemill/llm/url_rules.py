"""URL filters by host and path rules: a range join over reversed-host keys.

A host read from its last label on, followed by ``/`` and the path, turns a rule
into a prefix, and a prefix into an interval of sorted keys. Intervals of prefixes
are nested or apart, so one sweep over sorted keys with a stack of the open rules
finds, for every key, the longest rule around it.

A rule also fits subdomains, whose path does not follow the rule's host directly. So
a URL is looked up once for each ending of its host, but never for endings with more
labels than any rule has, and never with more of its path than any rule has. Only
distinct combinations of these are swept; copies and hot hosts shrink to few rows
before anything is sorted.

The sorted keys are cut into ranges for the tasks. A range that starts inside open
rules gets its own copies of them: at each cut these are prefixes of one key, so few.
Keys that many sites share are cut by a hash of the site as well.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.llm.batches import map_slices
from tracemill.sources.staging import stage

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Characters of a key that decide the range it is sorted in.
ROUTED = 64
# Sampled keys per range; they balance the ranges and do not touch the result.
SAMPLED = 64
RULES_SCHEMA = "host string, path string, verdict string"
_LOWEST, _HIGHEST = -(2**63), 2**63
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    """What follows the first ``://``, up to ``/``, ``?`` or ``#``; else empty."""
    host = F.translate(F.regexp_extract(url, _URL, 1), UPPER, LOWER)
    return F.coalesce(host, F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``; else empty."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules ``(host, path, verdict)`` as a table."""
    return spark.createDataFrame(list(rules), RULES_SCHEMA)


def _keyed_rules(rules: DataFrame) -> DataFrame:
    """One row per rule. Of contradicting rules, ``block`` counts."""
    usable = rules.filter(
        F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isNotNull()
    )
    host = F.translate("host", UPPER, LOWER)
    one = usable.groupBy(host.alias("host"), "path").agg(F.max("verdict").alias("verdict"))
    turned = F.array_join(F.reverse(F.split("host", r"\.")), ".")
    return one.select("*", F.concat(turned, F.lit("/"), "path").alias("key"))


def _range_bounds(keys: DataFrame, ranges: int) -> list[tuple[str, int]]:
    total = keys.count()
    share = min(1.0, SAMPLED * ranges / max(total, 1))
    taken = keys.sample(share, 7).select(F.substring("key", 1, ROUTED), "salt").collect()
    found = sorted(map(tuple, taken))
    return found[SAMPLED - 1 :: SAMPLED] if share < 1 else found[:: -(-len(found) // ranges) or 1][1:]


def _lookups(pages: DataFrame, labels: int, characters: int) -> DataFrame:
    """The distinct ``(site, head)`` of pages with a key for each host ending."""
    once = pages.select("site", "head").distinct()
    parts = F.split("site", r"\.")
    endings = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))),
        lambda i: F.array_join(F.reverse(F.slice(parts, -i, i)), "."),
    )
    keys = once.select("site", "head", F.explode(endings).alias("ending"))
    return keys.select(
        "site",
        "head",
        F.concat("ending", F.lit("/"), "head").alias("key"),
        F.xxhash64("site", "head").alias("salt"),
    )


def longest_rules(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """For every looked-up key inside a rule: ``site, head``, and the longest rule."""
    ranges = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = _range_bounds(keys, ranges)

    def route_keys():
        def step(sites, heads, names, salts):
            parts = [bisect_right(bounds, (k[:ROUTED], s)) for k, s in zip(names, salts)]
            count = len(names)
            return [parts, names, [1] * count, sites, heads, [None] * count, [None] * count]

        return step

    def route_rules():
        def step(hosts, paths, verdicts, names):
            rows = []
            for host, path, verdict, key in zip(hosts, paths, verdicts, names):
                short = key[:ROUTED]
                end = short if len(key) >= ROUTED else short + "\U0010ffff" * ROUTED
                first = bisect_right(bounds, (short, _LOWEST))
                last = bisect_left(bounds, (end, _HIGHEST))
                rows += [(p, key, 0, host, path, verdict, host) for p in range(first, last + 1)]
            return [list(column) for column in zip(*rows)] or [[] for _ in range(7)]

        return step

    def sweep():
        open_rules: list[tuple] = []
        at = None

        def step(parts, names, kinds, sites, heads, verdicts, hosts):
            nonlocal at
            found = [[] for _ in range(5)]
            for part, key, kind, site, head, verdict, host in zip(
                parts, names, kinds, sites, heads, verdicts, hosts
            ):
                if part != at:
                    open_rules.clear()
                    at = part
                while open_rules and not key.startswith(open_rules[-1][0]):
                    open_rules.pop()
                if kind == 0:
                    open_rules.append((key, host, head, verdict))
                elif open_rules:
                    _, *rule = open_rules[-1]
                    for column, value in zip(found, (site, head, *rule)):
                        column.append(value)
            return found

        return step

    events = "part int, key string, kind int, site string, head string, verdict string, host string"
    routed = map_slices(keys.select("site", "head", "key", "salt"), route_keys, events).unionByName(
        map_slices(rules.select("host", "path", "verdict", "key"), route_rules, events)
    )
    dealt = routed.repartitionById(len(bounds) + 1, F.col("part"))
    ordered = dealt.sortWithinPartitions("part", "key", "kind")
    found = "site string, head string, rule_host string, rule_path string, verdict string"
    hits = map_slices(ordered, sweep, found)
    rule = F.concat("rule_host", "rule_path")
    best = hits.groupBy("site", "head").agg(
        F.max(
            F.struct(F.length(rule), F.length("rule_host"), rule.alias("rule"), "verdict")
        ).alias("best")
    )
    return best.select("site", "head", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_column: str = "page_id",
    url: str = "url",
    default: str = ALLOW,
) -> DataFrame:
    """Every page with ``host``, ``path``, the longest fitting ``rule`` and its ``verdict``.

    A rule fits its host and all subdomains where the path starts with the rule's.
    The longest is that with most characters in host and path, then in the host.
    Without a rule, ``rule`` is null and the verdict is ``default``; a null URL and
    one without ``://`` have an empty host and path. Rules with a null field fit
    nothing. Every row comes back once, copies and rows without id too; columns
    other than the two named are not looked at. No rules or no pages are no error.
    """
    rules = stage(_keyed_rules(rules), "url-rules")
    limits = rules.agg(
        F.max(F.size(F.split("host", r"\."))), F.max(F.length("path"))
    ).first()
    read = pages.select(F.col(id_column).alias(id_column), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    if limits[0] is None:
        nothing = F.lit(None).cast("string").alias("rule")
        return read.select("*", nothing, F.lit(default).alias("verdict"))
    labels, characters = limits
    parts = F.split("host", r"\.")
    cut = F.when(F.size(parts) > labels, F.array_join(F.slice(parts, -labels, labels), "."))
    read = read.select(
        "*",
        F.coalesce(cut, F.col("host")).alias("site"),
        F.substring("path", 1, characters).alias("head"),
    )
    keys = stage(_lookups(read, labels, characters), "url-keys")
    found = longest_rules(keys, rules)
    joined = read.join(found, ["site", "head"], "left")
    return joined.select(
        id_column, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
