"""URL filters with dated lists: every capture against the entries active when it was fetched.

A list is a history: an entry names a pattern, a category, a day, and whether the pattern
was added or removed. Each pattern's history becomes validity intervals, from an addition
to the next removal. A pattern is a domain, which holds for its subdomains, or a host with
a path prefix, cut at slashes. A capture is looked up under the few keys its URL has, so
the join is on equal keys; a time bucket in the key keeps long histories apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Width of the time buckets, in days.
BUCKET_DAYS = 64
_EPOCH = "1970-01-01"


def _bucket(moment: Column) -> Column:
    days = F.datediff(moment.cast("date"), F.lit(_EPOCH).cast("date"))
    return F.floor(days / BUCKET_DAYS).cast("int")


def intervals(entries: DataFrame) -> DataFrame:
    """(pattern, category, valid_from, valid_to) of a list's history; an open end is NULL.

    *entries*: pattern, category, day, active. Several entries of one day count as active
    if one of them is. Entries with a NULL are left out.
    """
    days = (
        entries.select("pattern", "category", "day", "active")
        .dropna()
        .groupBy("pattern", "category", "day")
        .agg(F.max("active").alias("active"))
    )
    history = Window.partitionBy("pattern", "category").orderBy("day")
    return (
        days.withColumn("valid_to", F.lead("day").over(history))
        .where("active")
        .select(
            "pattern",
            "category",
            F.col("day").cast("timestamp_ntz").alias("valid_from"),
            F.col("valid_to").cast("timestamp_ntz").alias("valid_to"),
        )
    )


def url_keys(url: Column) -> Column:
    """The patterns an URL could be listed under: domains from the host up, and path prefixes."""
    text = F.coalesce(url, F.lit(""))
    host = F.lower(
        F.regexp_extract(text, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    )
    path = F.regexp_extract(text, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*(/[^?#]*)", 1)
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    prefixes = F.when(
        F.size(parts) > 0,
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1))),
            lambda n: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, n), "/")),
        ),
    ).otherwise(F.array().cast("array<string>"))
    found = F.array_distinct(F.concat(domains, prefixes))
    return F.when(host != "", found).otherwise(F.array().cast("array<string>"))


def filter_urls(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(page_id, url, fetched_at, blocked, categories, pattern, listed_since) of captures.

    *captures*: page_id, url, fetched_at. ``categories`` are those of all active entries,
    sorted and comma-joined (empty if none); ``pattern`` and ``listed_since`` are of the
    longest active pattern (NULL if none). An URL without a host, a NULL URL or a NULL time
    is blocked by nothing. Equal captures are one; other columns are ignored; with an empty
    list every capture passes.
    """
    rows = captures.select("page_id", "url", "fetched_at").distinct()
    valid = intervals(entries)
    last = rows.agg(F.max(_bucket(F.col("fetched_at")))).first()[0]
    begin = _bucket(F.col("valid_from"))
    last = begin if last is None else F.lit(last)
    until = F.least(F.coalesce(_bucket(F.col("valid_to")), last), last)
    spread = (
        valid.withColumn("until", until)
        .where(F.col("until") >= begin)
        .withColumn("bucket", F.explode(F.sequence(begin, "until")))
        .drop("until")
    )
    keyed = rows.withColumn("pattern", F.explode(url_keys(F.col("url")))).withColumn(
        "bucket", _bucket(F.col("fetched_at"))
    )
    active = (
        keyed.join(spread, ["pattern", "bucket"])
        .where(
            (F.col("fetched_at") >= F.col("valid_from"))
            & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to")))
        )
        .groupBy("page_id", "url", "fetched_at")
        .agg(
            F.array_join(F.sort_array(F.collect_set("category")), ",").alias("categories"),
            F.max(F.struct(F.length("pattern"), "pattern", "valid_from")).alias("longest"),
        )
        .withColumnsRenamed({"page_id": "p", "url": "u", "fetched_at": "f"})
    )
    same = (
        F.col("page_id").eqNullSafe(F.col("p"))
        & F.col("url").eqNullSafe(F.col("u"))
        & F.col("fetched_at").eqNullSafe(F.col("f"))
    )
    return rows.join(active, same, "left").select(
        "page_id",
        "url",
        "fetched_at",
        F.col("categories").isNotNull().alias("blocked"),
        F.coalesce("categories", F.lit("")).alias("categories"),
        F.col("longest.pattern").alias("pattern"),
        F.col("longest.valid_from").alias("listed_since"),
    )
