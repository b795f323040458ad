"""URL filters: dated block lists joined as of the time of each capture. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantflow.functions.ordered import time_chunk, with_next

from .common import fresh

#: Length of the time buckets in which captures meet intervals, and of the chunks of one entry's history.
BUCKET_SECONDS = 32 * 86_400


def url_host(url: Column) -> Column:
    """Host in lower case, without user, port, brackets or a final dot; empty when there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?\[?([^/?#:\]]*)", 1)
    return F.coalesce(F.rtrim(host, F.lit(".")), F.lit(""))


def url_keys(url: Column) -> Column:
    """What a list entry may be written as to match the URL: the host, its parent domains, host and leading folders.

    ``https://a.b.org/x/y?q`` has ``a.b.org``, ``b.org``, ``org``, ``a.b.org/x`` and ``a.b.org/x/y``.
    """
    host = url_host(url)
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    folders = F.when(F.size(parts) > 0, F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1))),
        lambda i: F.concat_ws("/", host, F.array_join(F.slice(parts, 1, i), "/")),
    )).otherwise(F.array().cast("array<string>"))
    return F.when(host != "", F.array_distinct(F.concat(domains, folders))).otherwise(F.array().cast("array<string>"))


def validity(entries: DataFrame) -> DataFrame:
    """Dated entries ``(list, pattern, action, at)`` as intervals ``(list, pattern, valid_from, valid_to)``.

    ``action`` is ``add`` or ``remove``; of several at one time ``add`` wins. An interval runs from an ``add`` to the
    next dated entry of the same list and pattern, without an end if there is none. Rows without pattern, action
    or time take no part; a null list is the list ''. Hosts in patterns are compared in lower case.
    """
    known = entries.where(F.col("pattern").isNotNull() & F.col("at").isNotNull() & F.col("action").isin("add", "remove"))
    known = known.select(
        F.coalesce("list", F.lit("")).alias("list"),
        F.concat(F.lower(F.substring_index("pattern", "/", 1)), F.expr("substring(pattern, length(substring_index(pattern, '/', 1)) + 1)")).alias("pattern"),
        "at", "action",
    ).groupBy("list", "pattern", "at").agg(F.min("action").alias("action"))
    dated = with_next(known, ["list", "pattern"], ["at"], ["at"], time_chunk(F.col("at"), BUCKET_SECONDS))
    return dated.where("action = 'add'").select("list", "pattern", F.col("at").alias("valid_from"), F.col("next_at").alias("valid_to"))


def _bucket(at: Column) -> Column:
    return F.floor(F.unix_micros(at) / F.lit(BUCKET_SECONDS * 1_000_000)).cast("long")


def filter_captures(captures: DataFrame, entries: DataFrame, url: str = "url", at: str = "fetched_at") -> DataFrame:
    """Each capture with the list entries active when it was fetched.

    Adds ``host``, ``blocked``, ``n_entries`` (active entries that match), ``lists`` (their lists, sorted) and
    ``rule`` (the longest matching pattern, ties to the first by code point; null if none). Captures without URL,
    host or time match nothing; every row stays, repeated rows too. Other columns are kept; columns with the
    added names are replaced.

    Captures are reduced to distinct (URL, time), each of which meets the intervals of its keys in its time bucket,
    so an entry with a long history is not compared as a whole. A key with many captures is the large side of an
    equi-join, which Spark splits.
    """
    added = ["host", "blocked", "n_entries", "lists", "rule"]
    captures = captures.drop(*[c for c in added if c in captures.columns])
    url_, at_ = fresh("_url", captures.columns), fresh("_at", captures.columns)
    asked = captures.select(F.col(url).alias("_url"), F.col(at).alias("_at")).where("_url is not null and _at is not null").distinct()
    keyed = asked.select("_url", "_at", _bucket(F.col("_at")).alias("_bucket"), F.explode(url_keys(F.col("_url"))).alias("_key"))
    lo, hi = captures.agg(F.min(_bucket(F.col(at))), F.max(_bucket(F.col(at)))).first()
    spans = validity(entries)
    first = F.greatest(_bucket(F.col("valid_from")), F.lit(lo).cast("long"))
    last = F.least(F.coalesce(_bucket(F.col("valid_to")), F.lit(hi).cast("long")), F.lit(hi).cast("long"))
    spans = spans.withColumn("_bucket", F.explode(F.when(first <= last, F.sequence(first, last))))
    hits = keyed.join(spans, (F.col("_key") == F.col("pattern")) & (keyed["_bucket"] == spans["_bucket"])
                      & (F.col("valid_from") <= F.col("_at")) & (F.col("valid_to").isNull() | (F.col("_at") < F.col("valid_to"))))
    found = hits.groupBy("_url", "_at").agg(
        F.count("*").alias("n_entries"), F.sort_array(F.collect_set("list")).alias("lists"),
        F.min_by("pattern", F.struct(-F.length("pattern"), "pattern")).alias("rule"),
    )
    found = found.withColumnsRenamed({"_url": url_, "_at": at_})
    out = captures.join(found, (captures[url] == found[url_]) & (captures[at] == found[at_]), "left")
    return out.select(
        *[captures[c] for c in captures.columns], url_host(captures[url]).alias("host"), F.col("n_entries").isNotNull().alias("blocked"),
        F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"),
        F.coalesce("lists", F.array().cast("array<string>")).alias("lists"), "rule",
    )
