"""URL filters whose lists change over time.

Dated list entries - a pattern joins or leaves a list on a day - become validity intervals. Each
capture is broken into the few patterns that could match it: its host, the domains above, and its
host with every leading part of the path. An as-of join on the pattern then evaluates the capture
against the entries that were active when it was fetched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)"


def url_host(url: Column) -> Column:
    """The host in lower case without a final dot; empty where there is none."""
    return F.coalesce(F.rtrim(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(".")), F.lit(""))


def url_patterns(url: Column) -> Column:
    """Every pattern that matches the URL: its host, domains above it, and the host with leading parts of the path.

    ``https://a.b.c/x/y`` has ``a.b.c``, ``b.c``, ``c``, ``a.b.c/x`` and ``a.b.c/x/y``.
    """
    host = url_host(url)
    labels = F.split(host, r"\.")
    domains = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    parts = F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda p: p != "")
    paths = F.transform(parts, lambda _, i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i + 1), "/")))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(domains, paths)))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """``list, pattern, valid_from, valid_to`` from ``list, pattern, action, at``.

    An ``add`` holds from its time until the next entry of the pattern in the list, an ``add`` again
    or a ``remove``; the last one has no end (null). At equal times a ``remove`` counts. Entries with
    a null, or another action, say nothing; repeated entries count once. Patterns are compared in
    lower case for the host, as they stand for the path, without a final slash.
    """
    host, path = F.lower(F.regexp_extract("pattern", "^([^/]*)", 1)), F.rtrim(F.regexp_extract("pattern", "(/.*)$", 1), F.lit("/"))
    known = entries.select("list", F.concat(F.rtrim(host, F.lit(".")), path).alias("pattern"), "action", "at").dropna()
    known = known.filter(F.col("action").isin("add", "remove"))
    single = known.groupBy("list", "pattern", "at").agg(F.max("action").alias("action"))
    following = F.lead("at").over(Window.partitionBy("list", "pattern").orderBy("at"))
    spans = single.withColumn("valid_to", following).filter("action = 'add'")
    return spans.select("list", "pattern", F.col("at").alias("valid_from"), "valid_to")


def last_before(spans: Column, at: Column) -> Column:
    """Of intervals in the order of their ``valid_from``, the last that starts no later than ``at``; null if none does.

    A binary search: each step halves the places between which the answer lies.
    """
    step = lambda low, high: F.struct(low.alias("low"), high.alias("high"))

    def halve(between: Column, _: Column) -> Column:
        middle = F.floor((between["low"] + between["high"]) / 2).cast("int")
        begun = F.get(spans, middle)["valid_from"] <= at
        return F.when(begun, step(middle + 1, between["high"])).otherwise(step(between["low"], middle))

    steps = F.sequence(F.lit(1), F.length(F.bin(F.size(spans))))
    begun = F.aggregate(steps, step(F.lit(0), F.size(spans)), halve)["low"]
    return F.get(spans, begun - 1)


def evaluate_captures(captures: DataFrame, entries: DataFrame, row_id: str = "page_id", url: str = "url", at: str = "fetched_at") -> DataFrame:
    """``captures`` with ``blocked``, ``lists`` and ``pattern``, by the entries active at the time ``at``.

    ``lists`` are the names of the lists with an active match, in order; ``pattern`` is the longest
    active one, the first in order of several. A null or malformed URL and a null time match nothing.
    ``row_id`` tells rows apart: rows of one id share what either of them matches; a null id matches
    nothing. Columns of the three names are replaced; all others stay.

    Only ids, times and patterns are joined. The entries have one row for each list and pattern, which
    holds its intervals in order, so a capture meets a pattern once, however often that was added and
    removed, and finds the interval of its time by binary search. A host with a third of all captures is
    a hot key of that join; as the other side is unique, the adaptive skew join splits it, or the
    entries, if small, are broadcast by Spark's own rule.
    """
    intervals = validity_intervals(entries)
    keys = captures.select(F.col(row_id).alias("_id"), F.col(at).alias("_at"), F.explode(url_patterns(F.col(url))).alias("pattern"))
    keys = keys.filter("_id IS NOT NULL AND _at IS NOT NULL")
    spans = F.array_sort(F.collect_list(F.struct("valid_from", "valid_to"))).alias("spans")
    ordered = intervals.groupBy("list", "pattern").agg(spans)
    span = last_before(F.col("spans"), F.col("_at"))
    asof = keys.join(ordered, "pattern").select("_id", "_at", "list", "pattern", span.alias("span")).filter("span IS NOT NULL")
    matched = asof.filter("span.valid_to IS NULL OR _at < span.valid_to")
    longest = F.min(F.struct((-F.length("pattern")).alias("less"), "pattern"))["pattern"]
    found = matched.groupBy("_id").agg(F.array_sort(F.collect_set("list")).alias("lists"), longest.alias("pattern"))
    rows, found = captures.drop("blocked", "lists", "pattern"), found.alias("found")
    joined = rows.alias("rows").join(found, F.col(f"rows.{row_id}") == F.col("found._id"), "left")
    lists = F.coalesce("found.lists", F.array().cast("array<string>"))
    return joined.select("rows.*", (F.size(lists) > 0).alias("blocked"), lists.alias("lists"), "found.pattern")
