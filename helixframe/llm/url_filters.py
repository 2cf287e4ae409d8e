"""URL filters by a temporal list join, in DataFrame functions only.

List entries (list, kind, key, action, since) are dated: `add` and `remove` events of a host suffix
(kind `host`) or of a host with leading path segments (kind `prefix`). Each becomes a
validity interval [since, until); an as-of join evaluates every capture against the entries
active at its fetch time.

Hosts are compared in lower case without a final dot, paths as they are written (their case counts), without empty segments; keys are
brought to that form before their events are put in order.

Defined results: a null or malformed url, or a null fetch time, matches nothing and is kept;
repeated captures are evaluated each; of events of one key at one time the last by action name counts (`remove`
after `add`); unknown actions and entries with a null field are ignored; an empty list matches nothing; other columns of captures are kept,
names that clash with the result's (host, n_entries, lists, first_entry, blocked) are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: An interval table of at most so many rows is broadcast (some 100 bytes a row); a larger one is shuffled.
BROADCAST_ROWS = 100_000


def host_of(url: Column) -> Column:
    return F.rtrim(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit("."))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)


def _path_segments(path: Column) -> Column:
    return F.filter(F.split(path, "/", -1), lambda s: s != "")


def key_of(kind: Column, key: Column) -> Column:
    """An entry's key in the form that `keys_of` gives those of a capture."""
    host = F.rtrim(F.lower(F.substring_index(key, "/", 1)), F.lit("."))
    segments = _path_segments(F.regexp_replace(key, "^[^/]*", ""))
    return F.when(kind == "host", F.rtrim(F.lower(key), F.lit("."))).otherwise(F.array_join(F.concat(F.array(host), segments), "/"))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, kind, key, since, until): until is null while the entry is active; intervals of a key are disjoint."""
    e = entries.where(F.col("action").isin("add", "remove")).dropna(subset=["list", "kind", "key", "since"]).withColumn("key", key_of(F.col("kind"), F.col("key")))
    # of events at one time the last action counts
    e = e.groupBy("list", "kind", "key", "since").agg(F.max("action").alias("action"))
    w = Window.partitionBy("list", "kind", "key").orderBy("since")
    return e.withColumn("until", F.lead("since").over(w)).where("action = 'add'").select("list", "kind", "key", "since", "until")


def keys_of(host: Column, path: Column) -> Column:
    """Every key that could list a capture: the host's suffixes, and the host with leading path segments."""
    labels = F.split(host, r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(F.lit("host").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("key")))
    segments = _path_segments(path)
    leading = F.transform(
        F.filter(F.sequence(F.lit(0), F.size(segments)), lambda i: i > 0),
        lambda i: F.struct(F.lit("prefix").alias("kind"), F.concat(host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i), "/")).alias("key")),
    )
    return F.concat(suffixes, leading)


def evaluate(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Every row of captures(url, fetched_at, ...) with the entries active at its fetch time.

    Captures are reduced to distinct (url, time) pairs first, so a hot page costs one evaluation;
    the as-of join is an equality join on the key with the interval as its residual, broadcast if the interval
    table is small, else shuffled (AQE splits a hot key). Verdicts exist for hits alone and are joined back.
    """
    valid = intervals(entries)
    small = valid.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    asked = captures.where("url is not null and fetched_at is not null").select("url", "fetched_at").distinct()
    asked = asked.where(host != "").select("url", "fetched_at", F.explode(keys_of(host, path)).alias("k")).select("url", "fetched_at", "k.kind", "k.key")
    active = asked.join(F.broadcast(valid) if small else valid, ["kind", "key"]).where("since <= fetched_at and (until is null or fetched_at < until)")
    # of several entries, the most specific is named first: a prefix before a host, then the longest key
    named = F.struct((F.col("kind") == "host").alias("later"), (-F.length("key")).alias("short"), F.concat("list", F.lit(":"), "key").alias("name"))
    hits = active.groupBy("url", "fetched_at").agg(
        F.count("*").alias("n_entries"), F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"), F.min(named)["name"].alias("first_entry")
    )
    clean = captures.drop("host", "n_entries", "lists", "first_entry", "blocked")
    out = clean.join(hits, ["url", "fetched_at"], "left")
    return out.select(
        *clean.columns, host.alias("host"), F.coalesce("n_entries", F.lit(0).cast("long")).alias("n_entries"), F.coalesce("lists", F.lit("")).alias("lists"),
        F.coalesce("first_entry", F.lit("")).alias("first_entry"), F.col("n_entries").isNotNull().alias("blocked"),
    )
