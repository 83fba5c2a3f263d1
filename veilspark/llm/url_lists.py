"""URL filters with lists that change over time.

A list's entries are dated: an entry is added or removed on a day. Each pattern's history
becomes intervals in which it was active, and an as-of join finds, for each capture, the
patterns active at its fetch time. Patterns are hosts, domains with all their hosts, or
paths below a host. The most specific active pattern decides; where an allowing and a blocking
one are equally specific, the allowing one does.

Captures and intervals meet on the pattern and the month, so a pattern that changes often, or
has a third of all captures, makes neither a large group nor pairs of captures with old intervals.
Every capture has a row for each pattern that could match it, `domain com` among them; those that no
list holds are left out before anything is exchanged, by marks of the lists' patterns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: The parts of a URL.
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*://"
_HOST = _SCHEME + r"(?:[^/?#@]*@)?([^/?#:]*)"
_PATH = _SCHEME + r"[^/?#]*([^?#]*)"
OPEN_END = "9999-12-31 00:00:00"
#: Most marks of patterns, so that all of them, 8 bytes each, can be sent to every task whatever the lists hold.
MARKS = 1 << 20


def host(url: Column) -> Column:
    """The host in lower case without user, port and closing dot; empty if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, _HOST, 1)), r"\.+$", "")


def segments(url: Column) -> Column:
    """The parts of the path, without empty ones, query and fragment."""
    return F.filter(F.split(F.regexp_extract(url, _PATH, 1), "/"), lambda part: part != "")


def month(time: Column) -> Column:
    return F.year(time) * 12 + F.month(time)


def _mark(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(MARKS))


def intervals(entries: DataFrame) -> DataFrame:
    """list, scope, pattern, verdict, since, until: when each pattern of `entries` was active.

    `entries` has list, scope (host, domain or prefix), pattern, verdict (allow or block), action
    (add or remove) and effective (timestamp). Of entries of one moment, remove counts.
    The interval ends at the next entry of the pattern, exclusive. Entries with a null in any
    of these columns count for nothing; repeated ones count once. Patterns are compared as they
    are written, hosts in lower case; a prefix is a host and parts of a path, as `host/a/b`.
    """
    key = ["list", "scope", "pattern", "verdict"]
    known = entries.select(*key, "action", "effective").dropna()
    moments = known.groupBy(*key, "effective").agg(F.bool_or(F.col("action") == "remove").alias("removed"))
    until = F.lead("effective").over(Window.partitionBy(*key).orderBy("effective"))
    spans = moments.withColumn("until", F.coalesce(until, F.lit(OPEN_END).cast("timestamp")))
    return spans.where(~F.col("removed")).select(*key, F.col("effective").alias("since"), "until")


def evaluate(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Each capture (capture_id, url, fetched) with active, verdict, scope, pattern and list.

    `active` counts the lists' patterns that match and were active when it was fetched; verdict,
    scope, pattern and list are those of the deciding one (ties: the first list by name), or
    null if none. A capture without URL, host or fetch time matches nothing. Repeated captures
    stay repeated; other columns are ignored. Without entries nothing matches.
    """
    rows = captures.groupBy("capture_id", "url", "fetched").agg(F.count("*").alias("copies"))
    spans = intervals(entries)
    segments_of = F.when(F.col("scope") == "prefix", F.size(F.split("pattern", "/")) - 1)
    depth = int(spans.agg(F.coalesce(F.max(segments_of), F.lit(0)).alias("depth")).first()["depth"])
    # The months of an interval, within those of the captures.
    limits = captures.agg(*[f(month(F.col("fetched"))).alias(f.__name__) for f in (F.min, F.max)]).first()
    first, last = (F.lit(limits[name]).cast("int") for name in ("min", "max"))
    low, high = F.greatest(month(F.col("since")), first), F.least(month(F.col("until")), last)
    spans = spans.withColumn("key", F.concat_ws(" ", "scope", "pattern"))
    spans = spans.where(low <= high).withColumn("month", F.explode(F.sequence(low, high)))

    name = F.col("host")
    labels = F.split(name, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    some = F.slice("segments", 1, depth)
    paths = F.when(F.size(some) > 0, F.transform(F.sequence(F.lit(1), F.size(some)), lambda i: F.array_join(F.slice(some, 1, i), "/")))
    keys = F.concat(
        F.array(F.concat(F.lit("host "), name)),
        F.transform(domains, lambda d: F.concat(F.lit("domain "), d)),
        F.transform(F.coalesce(paths, F.array().cast("array<string>")), lambda p: F.concat(F.lit("prefix "), name, F.lit("/"), p)),
    )
    read = rows.withColumns({"host": host(F.col("url")), "segments": segments(F.col("url"))})
    asked = read.select("capture_id", "url", "fetched", "copies", month(F.col("fetched")).alias("month"), F.when(name != "", keys).alias("keys"))
    # A mark may stand for several patterns, so what it lets through is still compared below.
    marks = F.broadcast(spans.select(_mark(F.col("key")).alias("mark")).distinct())
    asked = asked.withColumn("key", F.explode("keys")).drop("keys").withColumn("mark", _mark(F.col("key")))
    asked = asked.join(marks, "mark", "left_semi").drop("mark")

    c, s = asked.alias("c"), spans.alias("s")
    same = (F.col("c.key") == F.col("s.key")) & (F.col("c.month") == F.col("s.month"))
    active = (F.col("c.fetched") >= F.col("s.since")) & (F.col("c.fetched") < F.col("s.until"))
    met = c.join(s, same & active)
    rank = F.when(F.col("s.scope") == "prefix", 3).when(F.col("s.scope") == "host", 2).otherwise(1)
    decides = F.struct(
        rank.alias("rank"),
        F.length("s.pattern").alias("long"),
        (F.col("s.verdict") == "allow").alias("allows"),
        F.col("s.verdict").alias("verdict"),
        F.col("s.scope").alias("scope"),
        F.col("s.pattern").alias("pattern"),
    )
    weights = [-rank, -F.length("s.pattern"), -(F.col("s.verdict") == "allow").cast("int")]
    matches = met.select("c.capture_id", "c.url", "c.fetched", "c.copies", decides.alias("by"), F.struct(*weights, "s.list").alias("first"), "s.list")
    # Each capture's own row stands for it where no pattern matched.
    found = matches.unionByName(rows, allowMissingColumns=True).groupBy("capture_id", "url", "fetched", "copies").agg(
        F.count("list").alias("active"), F.max(F.when(F.col("list").isNotNull(), F.struct("by"))).alias("top"), F.min_by("list", "first").alias("list")
    )
    out = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    top = F.col("top.by")
    return out.select(
        "capture_id", "url", "fetched", "active", top["verdict"].alias("verdict"), top["scope"].alias("scope"), top["pattern"].alias("pattern"), "list"
    )
