"""Dated URL lists: which entries were active when a page was fetched.

A list is a table of dated changes (kind, pattern, listed, at).  The changes of a
pattern become validity intervals; a capture meets the interval of each of its
keys (domains of its host, prefixes of its path) that holds its fetch time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Kinds of entries: ``domain`` covers a host and all below it, ``prefix`` a host and
# a path up to a whole segment, such as ``www.example.org/en``.
KINDS = ("domain", "prefix")
AUTHORITY = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
PATH = r"^[^:/?#]+://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """The host in lower case; empty if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, AUTHORITY, 1)), r"\.+$", "")


def path_of(url: Column) -> Column:
    """The path without a slash at its end."""
    return F.regexp_replace(F.regexp_extract(url, PATH, 1), "/+$", "")


def intervals(changes: DataFrame) -> DataFrame:
    """Validity intervals (kind, pattern, begin, end) of a list's changes.

    An entry is active from the time it is listed until the pattern's next change;
    ``end`` is null if there is none.  Of changes at the same time listing wins.
    Rows with a null in any column, or another kind, are no changes.
    """
    clean = changes.select(
        "kind", F.regexp_replace(F.trim("pattern"), r"[/.]+$", "").alias("pattern"), "listed", "at",
    ).where(F.col("kind").isin(*KINDS) & (F.col("pattern") != "") & F.col("listed").isNotNull() & F.col("at").isNotNull())
    host = F.lower(F.substring_index("pattern", "/", 1))
    clean = clean.withColumn("pattern", F.concat(host, F.expr("substr(pattern, length(substring_index(pattern, '/', 1)) + 1)")))
    merged = clean.groupBy("kind", "pattern", "at").agg(F.max("listed").alias("listed"))
    following = F.lead("at").over(Window.partitionBy("kind", "pattern").orderBy("at"))
    return merged.select("kind", "pattern", "listed", F.col("at").alias("begin"), following.alias("end")).where("listed").drop("listed")


def keys(host: Column, path: Column, labels: int, segments: int) -> Column:
    """The (kind, pattern) keys of a URL, as deep as the list's deepest entries."""
    parts = F.split(host, r"\.")
    names = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(1, labels)))),
        lambda i: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(parts, -i, i), ".").alias("pattern")))
    steps = F.split(path, "/", segments + 2)
    prefixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(steps), F.lit(segments + 1))),
        lambda i: F.struct(F.lit("prefix").alias("kind"), F.concat(host, F.array_join(F.slice(steps, 1, i), "/")).alias("pattern")))
    return F.concat(names, prefixes)


def evaluate(captures: DataFrame, changes: DataFrame, url: str = "url", at: str = "at") -> DataFrame:
    """``captures`` with ``listed``, the most specific active ``entry`` and ``n_active``.

    The most specific entry has the longest pattern.  A capture without a URL, a
    host or a time is not listed.  Each row stays one row; equal captures are looked
    up once.  Columns of the result's names are replaced.
    """
    valid = intervals(changes)
    deepest = valid.agg(
        F.max(F.when(F.col("kind") == "domain", F.size(F.split("pattern", r"\.")))).alias("labels"),
        F.max(F.when(F.col("kind") == "prefix", F.size(F.split("pattern", "/")) - 1)).alias("segments")).first()
    link, time = F.col(f"`{url}`"), F.col(f"`{at}`")
    keyed = (
        captures.select(link.alias("url"), time.alias("at")).where("url IS NOT NULL AND at IS NOT NULL").distinct()
        .withColumn("host", host_of(F.col("url"))).where("host != ''")
        .select("url", "at", F.explode(keys(F.col("host"), path_of(F.col("url")), deepest["labels"] or 0, deepest["segments"] or 0)).alias("key"))
        .select("url", "at", F.col("key.kind").alias("kind"), F.col("key.pattern").alias("pattern"))
    )
    active = keyed.join(valid, ["kind", "pattern"]).where("begin <= at AND (end IS NULL OR at < end)")
    best = F.max(F.struct(F.length("pattern").alias("size"), F.concat_ws(":", "kind", "pattern").alias("entry"))).alias("best")
    # Names that no column of the captures has.
    mark = "_" * (1 + max(map(len, captures.columns)))
    found = active.groupBy("url", "at").agg(best, F.count("*").alias("n")).select(
        F.col("url").alias(mark + "url"), F.col("at").alias(mark + "at"), F.col("best.entry").alias(mark + "entry"), F.col("n").alias(mark + "n"))
    kept = captures.select(*[F.col(f"`{c}`") for c in captures.columns if c.lower() not in ("listed", "entry", "n_active")])
    # Rows that cannot match keep away from the join, where their nulls would meet in one task.
    able = link.isNotNull() & time.isNotNull()
    shown = [F.col(f"`{c}`") for c in kept.columns]
    joined = kept.where(able).join(found, (link == F.col(mark + "url")) & (time == F.col(mark + "at")), "left")
    return joined.select(
        *shown, F.col(mark + "n").isNotNull().alias("listed"), F.col(mark + "entry").alias("entry"), F.coalesce(mark + "n", F.lit(0)).alias("n_active"),
    ).unionAll(kept.where(~able).select(
        *shown, F.lit(False).alias("listed"), F.lit(None).cast("string").alias("entry"), F.lit(0).cast("long").alias("n_active")))
