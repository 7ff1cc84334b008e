"""URL filters by a temporal join with dated lists.

List entries say that a domain or a URL prefix was added or removed at some time. They become
validity intervals, and a capture is judged by the entries that were in force when it was fetched,
not by today's list. A capture can only be hit by an entry for one of its own host's domains or its
path's prefixes, so those are its join keys, and the as-of condition is checked on each match.

A domain with a third of all captures would make one task as large. Frequent keys are found by a
Misra-Gries type sketch; their captures are spread over ``SALTS`` salts and their few intervals
repeated for each. Captures are reduced to distinct (URL, time) pairs first. DataFrame
expressions only.

Defined cases: a capture without URL, host or time is never blocked. Entries with a null in any
column are ignored, repeated ones count once, and of an addition and a removal at the same time the
removal holds. An interval includes its start and excludes its end. An empty list blocks nothing.
Case counts in paths only; final and doubled slashes do not count, so a prefix of just a host is the
whole host without its subdomains. Further columns of captures are kept; ``n_hits``, ``hits`` and ``blocked``
replace columns of these names. Repeated captures are judged alike, an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowsmith.llm.common import fresh, heavy_hitters
from rowsmith.session import Scratch

SALTS = 32


def host_of(url: Column) -> Column:
    """The host in lower case, without user, port and final dot; empty if there is none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), r"\.?(:[0-9]*)?$", ""))


def path_of(url: Column) -> Column:
    """The path without query and fragment."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def segments(path: Column) -> Column:
    """The parts of a path between slashes, without empty ones."""
    return F.filter(F.split(path, "/"), lambda s: s != "")


def entry_key(scope: Column, value: Column) -> Column:
    """The key that an entry names: hosts in lower case, the path of a prefix as it is but for needless slashes."""
    host = F.lower(F.substring_index(value, "/", 1))
    prefix = F.array_join(F.concat(F.array(host), segments(F.regexp_replace(value, "^[^/]*", ""))), "/")
    return F.concat(scope, F.lit(":"), F.when(scope == "prefix", prefix).otherwise(F.lower(value)))


def keys_of(host: Column, path: Column) -> Column:
    """What an entry must name to hit this URL: ``domain:`` and each parent up to the last label, ``prefix:`` of the host and each longer one."""
    labels = F.split(host, r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.lit("domain:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    parts = segments(path)
    longer = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.concat(F.lit("prefix:"), F.array_join(F.concat(F.array(host), F.slice(parts, F.lit(1), i)), "/")))
    return F.array_distinct(F.concat(parents, longer))


def intervals(entries: DataFrame) -> DataFrame:
    """``key, since, until`` in which each entry was in force; ``until`` is null while it still is.

    ``entries`` has ``scope`` (domain or prefix), ``value``, ``action`` (add or remove) and ``dated``.
    """
    states = (
        entries.where("scope IS NOT NULL AND value IS NOT NULL AND dated IS NOT NULL AND action IN ('add', 'remove')")
        .groupBy(entry_key(F.col("scope"), F.col("value")).alias("key"), "dated")
        .agg(F.max("action").alias("action"))  # 'remove' sorts after 'add'
    )
    by_key = W.partitionBy("key").orderBy("dated")
    # Only changes of state start or end an interval.
    changes = states.withColumn("before", F.lag("action").over(by_key)).where("before IS NULL OR before != action")
    ends = changes.withColumn("until", F.lead("dated").over(by_key))
    return ends.where("action = 'add'").select("key", F.col("dated").alias("since"), "until")


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures`` (``url``, ``fetched_at`` and others) with ``n_hits``, ``hits`` and ``blocked``."""
    with Scratch(captures.sparkSession, "urls") as scratch:
        pairs = captures.where("url IS NOT NULL AND fetched_at IS NOT NULL").select("url", "fetched_at").distinct()
        parts = pairs.select("url", "fetched_at", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).where("host != ''")
        asked = parts.select("url", "fetched_at", F.explode(keys_of(F.col("host"), F.col("path"))).alias("key"))
        asked = scratch.write(asked, "keys", keep=True)
        listed = scratch.write(intervals(entries), "intervals", keep=True)
        hot = [k for k, _ in heavy_hitters(asked, "key", 0.002)]
    is_hot = F.col("key").isin(hot) if hot else F.lit(False)
    salt = F.when(is_hot, F.pmod(F.xxhash64("url", "fetched_at"), F.lit(SALTS))).otherwise(F.lit(0).cast("bigint"))
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))).cast("array<bigint>")
    asked = asked.withColumn("salt", salt)
    listed = listed.withColumn("salt", F.explode(salts))
    hits = (
        asked.join(listed, ["key", "salt"])
        .where("since <= fetched_at AND (until IS NULL OR fetched_at < until)")
        .groupBy("url", "fetched_at")
        .agg(F.count("*").alias("n_hits"), F.array_join(F.array_sort(F.collect_set("key")), " ").alias("hits"))
    )
    # Captures that nothing can hit are spread over all tasks: a listed URL never begins with a blank.
    asks = F.col("url").isNotNull() & F.col("fetched_at").isNotNull()
    spread = F.concat(F.lit(" "), F.monotonically_increasing_id().cast("string"))
    at, when, count, found = (fresh(captures.columns, c) for c in ("at_url", "at_time", "hit_count", "hit_keys"))
    rows = captures.withColumns({at: F.when(asks, F.col("url")).otherwise(spread), when: F.coalesce("fetched_at", F.lit(0).cast("timestamp"))})
    joined = rows.join(hits.toDF(at, when, count, found), [at, when], "left")
    own = [c for c in captures.columns if c.lower() not in ("n_hits", "hits", "blocked")]
    return joined.select(
        *own, F.coalesce(count, F.lit(0)).alias("n_hits"), F.coalesce(found, F.lit("")).alias("hits"), F.col(count).isNotNull().alias("blocked")
    )
