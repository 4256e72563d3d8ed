"""URL filters: a temporal join of captures with the list entries active when they were fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from obslake.llm.columns import unused, without

# A validity interval is cut at these bounds, so captures of one busy host meet in many groups.
BUCKET_SECONDS = 30 * 86_400
SCOPES = ("host", "domain", "prefix")

URL_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
URL_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def url_host(url: Column) -> Column:
    """Host of a URL in lower case, without user, port and final dot; null if there is none."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, URL_HOST, 1)), r"\.+$", "")
    return F.when(host != "", host)


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, URL_PATH, 1)


def validity_intervals(entries: DataFrame) -> DataFrame:
    """Dated list entries as intervals: ``list``, ``scope``, ``value``, ``since``, ``until`` (excluded; null: open).

    ``entries`` has ``list``, ``scope`` (host, domain, prefix), ``value``, ``action`` (add,
    remove) and ``effective_at``.  An entry holds from its time to the next one for the same
    list, scope and value.  Of entries with the same time an addition wins.  Adding what is
    there, or removing what is not, changes nothing.  Entries with a null field or an unknown
    scope or action are not used.
    """
    key = ["list", "scope", "value"]
    value = F.regexp_replace(F.lower("value"), r"^\.+|\.+$", "")
    events = (
        entries.select("list", "scope", F.when(F.col("scope") == "prefix", F.col("value")).otherwise(value).alias("value"),
                       "effective_at", (F.col("action") == "add").alias("added"))
        .where(F.col("scope").isin(*SCOPES) & entries["action"].isin("add", "remove"))
        .dropna(subset=["list", "scope", "value", "effective_at"])
        .groupBy(*key, "effective_at")
        .agg(F.max("added").alias("added"))
    )
    by_time = Window.partitionBy(*key).orderBy("effective_at")
    return (
        events.withColumn("before", F.lag("added").over(by_time))
        .where(F.col("added") != F.coalesce("before", F.lit(False)))
        .withColumn("until", F.lead("effective_at").over(by_time))
        .where("added")
        .select(*key, F.col("effective_at").alias("since"), "until")
    )


def _bucket(time: Column) -> Column:
    return F.floor(F.unix_seconds(time) / BUCKET_SECONDS)


def _keys(host: Column, path: Column) -> Column:
    """What of a URL can be listed: its host, each domain it lies in, and host with each leading part of the path."""
    labels = F.split(host, r"\.")
    count = F.size(labels)
    domains = F.transform(F.sequence(F.lit(1), count), lambda k: F.array_join(F.slice(labels, k, count), "."))
    parts = F.split(F.regexp_replace(path, r"^/+|/+$", ""), "/+")
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda k: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), k), "/"))
    )
    keyed = lambda scope: lambda value: F.struct(F.lit(scope).alias("scope"), value.alias("value"))
    return F.array_distinct(
        F.concat(
            F.array(F.struct(F.lit("host").alias("scope"), host.alias("value"))),
            F.transform(domains, keyed("domain")),
            F.transform(F.when(F.length(F.regexp_replace(path, "/", "")) > 0, prefixes).otherwise(F.array().cast("array<string>")), keyed("prefix")),
        )
    )


def match_lists(captures: DataFrame, entries: DataFrame, url: str = "url", fetched_at: str = "fetched_at") -> DataFrame:
    """All rows and columns of ``captures``, ``lists`` (sorted names, empty if none) and ``listed_since``.

    An entry applies if its scope covers the URL and its interval holds at ``fetched_at``: scope
    ``host`` means this host, ``domain`` this domain and all below, ``prefix`` this host and path
    or what lies below that path.  ``listed_since`` is the earliest beginning among the intervals
    that apply.

    Distinct pairs of URL and time are looked up.  Their keys meet the intervals on key and time
    bucket, by equality, so a host with most captures is split by time (and by the skew join),
    and neither a list nor a history is held whole anywhere.

    A null URL, one without host, or a null time matches nothing; the row stays.  Repeated rows
    stay.  Empty captures give no rows, empty lists match nothing.  Columns named as the added
    ones are replaced.
    """
    kept = without(captures, "lists", "listed_since")
    site, when, keys, slot, begin, end = unused(captures.columns, "site", "time", "keys", "slot", "begin", "end")
    distinct = captures.select(F.col(url).alias(site), F.col(fetched_at).alias(when)).distinct()
    known = distinct.where(url_host(F.col(site)).isNotNull() & F.col(when).isNotNull())
    asked = (
        known.withColumn(keys, F.explode(_keys(url_host(F.col(site)), url_path(F.col(site)))))
        .select(site, when, f"{keys}.scope", f"{keys}.value", _bucket(F.col(when)).alias(slot))
    )
    bounds = captures.agg(_bucket(F.min(fetched_at)).alias(begin), _bucket(F.max(fetched_at)).alias(end)).first()
    first, last = (bounds[0] or 0), (bounds[1] or 0)
    intervals = validity_intervals(entries)
    low = F.greatest(_bucket(F.col("since")), F.lit(first))
    high = F.least(F.coalesce(_bucket(F.col("until")), F.lit(last)), F.lit(last))
    active = intervals.where(low <= high).withColumn(slot, F.explode(F.sequence(low, high)))
    holds = (F.col("since") <= F.col(when)) & (F.col("until").isNull() | (F.col(when) < F.col("until")))
    found = (
        asked.join(active, ["scope", "value", slot])
        .where(holds)
        .groupBy(site, when)
        .agg(F.array_sort(F.collect_set("list")).alias("lists"), F.min("since").alias("listed_since"))
    )
    rows = captures.select(*kept, F.col(url).alias(site), F.col(fetched_at).alias(when))
    return rows.join(found, [site, when], "left").select(
        *kept, F.coalesce("lists", F.array().cast("array<string>")).alias("lists"), "listed_since"
    )
