"""Crawl permission: robots rules as a table, matched to URLs by host and prefix."""

from __future__ import annotations

from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.text import strip_text
from quern.functions.urls import netloc
from quern.session import stage

from .skew import HOT_ROWS, join_groups

# A host's rules can be long, so fewer hosts are broadcast than plain keys.
MAX_BROADCAST_HOSTS = 500

_RULES = "array<struct<path:string,allow:boolean>>"
_UNRESERVED = r"^[A-Za-z0-9_.~/-]*$"


@F.pandas_udf(T.StringType())
def _requote(paths: pd.Series) -> pd.Series:
    return pd.Series([None if p is None else quote(unquote(p)) for p in paths], dtype=object)


def canonical_path(path: Column) -> Column:
    """Percent-encoding in one form; plain paths never leave the JVM."""
    plain = F.coalesce(path.rlike(_UNRESERVED), F.lit(True))
    return F.when(plain, path).otherwise(_requote(F.when(~plain, path)))


def robots_rules(robots: DataFrame) -> DataFrame:
    """(host, entry, is_default, agents, rules) from (host, status, body).

    A file that was not answered with 200 allows everything; a null status
    (unreachable) forbids everything. A group of agent lines and the rules after
    it make an entry; a blank line ends it. Rules keep their order.
    """
    body = (
        F.when(F.col("status").isNull(), "User-agent: *\nDisallow: /")
        .when(F.col("status") == 200, F.coalesce("body", F.lit("")))
        .otherwise("User-agent: *\nAllow: /")
    )
    lines = robots.select("host", F.posexplode(F.split(body, r"\r\n|\r|\n")).alias("at", "raw"))
    bare = strip_text(F.substring_index("raw", "#", 1))
    split = lines.select(
        "host",
        "at",
        "raw",
        F.lower(strip_text(F.substring_index(bare, ":", 1))).alias("field"),
        F.when(F.contains(bare, F.lit(":")), strip_text(F.regexp_replace(bare, "^[^:]*:", ""))).alias(
            "value"
        ),
    )
    event = (
        F.when(F.col("raw") == "", "blank")
        .when(F.col("value").isNull(), None)
        .when(F.col("field") == "user-agent", "agent")
        .when(F.col("field").isin("allow", "disallow", "crawl-delay", "request-rate"), "rule")
    )
    events = split.withColumn("event", event).where(F.col("event").isNotNull())
    # One host's file per window; its size is that of one robots file.
    by_line = Window.partitionBy("host").orderBy("at")
    starts = (F.col("event") == "agent") & (
        F.coalesce(F.lag("event").over(by_line), F.lit("blank")) != "agent"
    )
    opener = F.last(F.when(F.col("event") != "rule", F.col("event")), ignorenulls=True).over(by_line)
    placed = (
        events.withColumn("entry", F.sum(starts.cast("int")).over(by_line))
        .withColumn("opener", opener)
        .where(F.col("opener") == "agent")
    )
    named = placed.withColumn("path", canonical_path(F.col("value")))
    allow = (F.col("field") == "allow") | (F.col("value") == "")
    agents = F.collect_list(F.when(F.col("event") == "agent", F.lower("value")))
    rules = F.collect_list(
        F.when(
            F.col("field").isin("allow", "disallow"),
            F.struct(F.col("at"), F.col("path"), allow.alias("allow")),
        )
    )
    entries = named.groupBy("host", "entry").agg(
        agents.alias("agents"),
        F.array_sort(rules).alias("rules"),
        F.count_if(F.col("event") == "rule").alias("n_rules"),
    )
    return entries.where(F.col("n_rules") > 0).select(
        "host",
        "entry",
        F.array_contains("agents", "*").alias("is_default"),
        "agents",
        F.expr("transform(rules, r -> struct(r.path AS path, r.allow AS allow))")
        .cast(_RULES)
        .alias("rules"),
    )


def rules_for_agent(entries: DataFrame, agent: str) -> DataFrame:
    """(host, rules): the entry that applies to ``agent`` on each host.

    The first entry that names the agent, else the first one for ``*``.
    """
    token = agent.split("/")[0].lower()
    named = F.exists("agents", lambda name: F.contains(F.lit(token), name))
    usable = entries.where(F.col("is_default") | named)
    return usable.groupBy("host").agg(
        F.min_by("rules", F.struct("is_default", "entry")).alias("rules")
    )


def prefix_rules(rules: DataFrame) -> DataFrame:
    """(host, prefix, at, allow): every rule path of a host once, at its first line; ``*`` matches all."""
    every = rules.select("host", F.posexplode("rules").alias("at", "rule"))
    prefix = F.when(F.col("rule.path") == "*", "").otherwise(F.col("rule.path"))
    first = F.min_by(F.col("rule.allow"), F.col("at")).alias("allow")
    return every.groupBy("host", prefix.alias("prefix")).agg(F.min("at").alias("at"), first)


def forbidden_urls(urls: DataFrame, rules: DataFrame, url: str = "url", hot_rows: int = HOT_ROWS) -> DataFrame:
    """The distinct URLs that may not be fetched, as column ``url``.

    A URL's path becomes its prefixes of the lengths that the host's rules have, and
    those meet the rules by equality on (host, prefix): the cost is the number of
    lengths, not of rules. The first rule by line decides. A prefix that very many
    URLs share (``/`` of a large host) does not meet in one task.
    """
    parts = urls.select(F.col(url).alias("url")).where("url IS NOT NULL").distinct()
    parts = parts.withColumn("host", netloc(F.col("url"))).withColumn("path", canonical_path(_path(F.col("url"))))
    given = stage(prefix_rules(rules), "prefixes")
    lengths = given.groupBy("host").agg(F.array_sort(F.collect_set(F.length("prefix"))).alias("lengths"))
    hosts = parts.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    known = stage(hosts.join(lengths, "host"), "lengths")
    # At most one length per character of the longest path.
    weight = 8 * F.size("lengths").cast("long") + 64
    sized = join_groups(parts, known, "host", "n", hot_rows, MAX_BROADCAST_HOSTS, weight)
    met = sized.select("url", "host", "path", F.explode(F.filter("lengths", lambda x: x <= F.length("path"))).alias("length"))
    prefix = F.struct("host", F.expr("left(path, length)").alias("prefix")).alias("place")
    prefixes = stage(met.select("url", prefix), "places")
    counts = prefixes.groupBy("place").agg(F.count(F.lit(1)).alias("n"))
    ruled = given.select(F.struct("host", "prefix").alias("place"), "at", "allow").join(counts, "place")
    matched = join_groups(prefixes, stage(ruled, "ruled"), "place", "n", hot_rows)
    verdicts = matched.groupBy("url").agg(F.min_by("allow", "at").alias("allow"))
    return verdicts.where(~F.col("allow")).select("url")


def robots_filter(
    urls: DataFrame, rules: DataFrame, url: str = "url", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Rows whose URL may be fetched. A host without rules allows everything.

    The first rule whose path is a prefix of the URL's path decides. A row without a URL goes.
    """
    forbidden = forbidden_urls(urls, rules, url, hot_rows).withColumnRenamed("url", "_forbidden")
    return urls.where(F.col(url).isNotNull()).join(forbidden, F.col(url) == F.col("_forbidden"), "left_anti")


def _path(url: Column) -> Column:
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    return F.when(rest == "", "/").otherwise(rest)
