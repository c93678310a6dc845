"""Captures against dated URL lists by an as-of join (operator 5). DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)"
SEGMENT = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]+)"


def _found(url: str, pattern: str) -> Column:
    found = F.regexp_extract(url, pattern, 1)
    return F.when(found != "", found)


def validity(events: DataFrame) -> DataFrame:
    """list, allows, entry, valid_from, valid_to (null: still valid) from dated events (list, allows, entry, day, adds).

    Several events of an entry on one day count as one, a removal if any of them is; repeated additions extend, repeated
    removals do nothing. Days are put in order after events of a day are one row, so the window of an entry is as long
    as its list's history in days, however many events there are. Events without list, entry or day are ignored.
    """
    key = ["list", "allows", "entry"]
    days = events.filter("list is not null and entry is not null and day is not null").groupBy(
        "list", F.coalesce("allows", F.lit(False)).alias("allows"), F.lower("entry").alias("entry"), "day"
    ).agg(F.min(F.coalesce("adds", F.lit(False))).alias("adds"))
    order = Window.partitionBy(*key).orderBy("day")
    changes = days.withColumn("was", F.coalesce(F.lag("adds").over(order), F.lit(False))).filter("adds <> was")
    return changes.withColumn("valid_to", F.lead("day").over(order)).filter("adds").select(*key, F.col("day").alias("valid_from"), "valid_to")


def filter_captures(captures: DataFrame, events: DataFrame) -> DataFrame:
    """page_id, url, host, fetched, n_active, verdict, list, entry, valid_from for every capture (page_id, url, fetched).

    An entry is a domain (it covers its subdomains) or a host and first path segment, as `host/segment`. Active are the
    entries whose interval holds the day of the fetch, its first day included, its last not. The longest active entry
    decides, an allowing one before a blocking one of the same length; `keep` if none is active or the URL has no host
    or the day is null. Each host and segment is matched once, to the whole history of its entries; captures then look
    up one row and evaluate it at their own day, so a host with many captures makes no group. Repeated rows are judged
    alike; further columns are ignored.
    """
    entry = F.struct(
        F.length("entry").alias("length"), "allows", "list", "entry", "valid_from", "valid_to"
    )
    history = validity(events).groupBy("entry").agg(F.collect_list(entry).alias("entries")).withColumnRenamed("entry", "key")
    rows = captures.select(
        "page_id", "url", F.lower(_found("url", HOST)).alias("host"), F.lower(_found("url", SEGMENT)).alias("segment"), F.col("fetched").cast("date").alias("fetched")
    )
    places = rows.filter("host is not null").select("host", F.coalesce("segment", F.lit("")).alias("segment")).distinct()
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    keys = F.concat(suffixes, F.when(F.col("segment") != "", F.array(F.concat("host", F.lit("/"), "segment"))).otherwise(F.array().cast("array<string>")))
    matched = (
        places.withColumn("key", F.explode(F.array_distinct(keys))).join(history, "key")
        .groupBy("host", "segment").agg(F.flatten(F.collect_list("entries")).alias("entries"))  # as many as the host has labels, and one
        .withColumnsRenamed({"host": "_host", "segment": "_segment"})
    )
    found = rows.join(matched, (F.col("host") == F.col("_host")) & (F.coalesce("segment", F.lit("")) == F.col("_segment")), "left")
    active = F.filter(
        "entries", lambda e: (e["valid_from"] <= F.col("fetched")) & (e["valid_to"].isNull() | (F.col("fetched") < e["valid_to"]))
    )
    decided = found.withColumn("active", active).withColumn("first", F.array_max("active"))
    return decided.select(
        "page_id", "url", "host", "fetched", F.greatest(F.coalesce(F.size("active"), F.lit(0)), F.lit(0)).cast("long").alias("n_active"),
        F.when(F.col("first").isNull(), "keep").when(F.col("first.allows"), "allow").otherwise("block").alias("verdict"),
        F.col("first.list").alias("list"), F.col("first.entry").alias("entry"), F.col("first.valid_from").alias("valid_from"),
    )
