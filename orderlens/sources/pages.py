"""Landed page files of a collection: contract check, records in page order, raw snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens import schemas

PAGE, ITEM = "_page_skip", "_page_item"
POSITION = (PAGE, ITEM)


class ContractError(ValueError):
    """The landed pages do not form one complete collection."""


def read_pages(spark: SparkSession, path: str, key: str, item: T.StructType | None = None, multi_line: bool = False) -> DataFrame:
    """Page envelopes (total, skip, limit, key) from JSON files: a page on every line, or with `multi_line` one page a file."""
    schema = schemas.page(key, item or schemas.COLLECTIONS[key])
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def page_contract(pages: DataFrame, key: str) -> DataFrame:
    """Facts of the page contract in one row; `violations` must be zero.

    The pages tile 0..total when every page's end is the start of another page or the total. That is an
    equi-join on the offsets, so no task has to see all pages in order.
    """
    size = F.coalesce(F.size(key), F.lit(0)).cast("long")
    slim = pages.select(
        "total", "skip", "limit", size.alias("_size"),
        F.col(key).isNull().alias("_no_list"),
        F.coalesce(F.exists(key, lambda item: item.isNull()), F.lit(False)).alias("_bad_item"),
    )
    facts = slim.agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("_size").alias("records"),
        F.min("total").alias("total"),
        F.count_if(F.col("total").isNull() | F.col("skip").isNull() | F.col("limit").isNull() | F.col("_no_list")).alias("missing_fields"),
        F.count_if(F.col("total") < 0).alias("negative_totals"),
        (F.max("total") - F.min("total")).alias("total_change"),
        F.count_if((F.col("_size") == 0) & (F.col("skip") < F.col("total"))).alias("early_empty_pages"),
        F.count_if("_bad_item").alias("invalid_items"),
        (F.count("skip") - F.count_distinct("skip")).alias("repeated_offsets"),
        F.coalesce(F.min("skip"), F.lit(0)).alias("first_offset"),
    )
    ends = slim.select((F.col("skip") + F.col("_size")).alias("skip"), "total").filter(F.col("skip") != F.col("total"))
    broken = ends.join(slim.select("skip"), "skip", "left_anti").agg(F.count(F.lit(1)).alias("broken_offsets"))
    checks = ("missing_fields", "negative_totals", "total_change", "early_empty_pages", "invalid_items",
              "repeated_offsets", "first_offset", "broken_offsets")
    row = facts.crossJoin(broken).withColumn("missing_records", F.col("total") - F.col("records"))
    violations = sum((F.abs(F.coalesce(F.col(c), F.lit(0))) for c in checks), F.abs(F.coalesce("missing_records", F.lit(0))))
    return row.withColumn("violations", violations)


def page_records(pages: DataFrame, key: str) -> DataFrame:
    """Records with their place (`POSITION`): page offset and index inside the page."""
    return pages.select(F.col("skip").alias(PAGE), F.posexplode(key).alias(ITEM, "_record")).select("_record.*", PAGE, ITEM)


def read_collection(spark: SparkSession, path: str, key: str, item: T.StructType | None = None, multi_line: bool = False) -> DataFrame:
    """Checked records of a collection; an incomplete or empty one is an error."""
    pages = read_pages(spark, path, key, item, multi_line)
    facts = page_contract(pages, key).first()
    if facts["violations"]:
        raise ContractError(f"{key}: {({k: v for k, v in facts.asDict().items() if v})}")
    if not facts["records"]:
        raise ContractError(f"{key}: empty collection")
    return page_records(pages, key)


def collection_counts(declared: dict[str, int], **collections: DataFrame) -> DataFrame:
    """Records found against the numbers a source declares."""
    frames = [
        df.agg(F.count(F.lit(1)).alias("records")).select(
            F.lit(name).alias("collection"), "records", F.lit(declared.get(name)).cast("long").alias("declared")
        )
        for name, df in collections.items()
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out.withColumn("agrees", F.col("records").eqNullSafe(F.col("declared")))


def landed_counts(**landed: DataFrame) -> DataFrame:
    """Records on the landed pages of each collection against the total that its envelopes declare (null without pages)."""
    frames = [
        df.agg(F.coalesce(F.sum(F.greatest(F.size(key), F.lit(0))), F.lit(0)).cast("long").alias("records"), F.max("total").cast("long").alias("declared"))
        .select(F.lit(key).alias("collection"), "records", "declared")
        for key, df in landed.items()
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out.withColumn("agrees", F.col("records").eqNullSafe(F.col("declared")))


def detail_mismatches(listing: DataFrame, detail: DataFrame, key: str) -> DataFrame:
    """Keys present in one view only."""
    left, right = listing.select(key).distinct(), detail.select(key).distinct()
    return (
        left.join(right, key, "left_anti").withColumn("side", F.lit("listing"))
        .unionByName(right.join(left, key, "left_anti").withColumn("side", F.lit("detail")))
    )


def write_snapshot(records: DataFrame, path: str, source: str) -> DataFrame:
    """Raw copy of the records as JSON lines; returns the audit row (source, count)."""
    raw = records.drop(*POSITION)
    raw.write.mode("overwrite").json(path)
    stored = records.sparkSession.read.schema(raw.schema).json(path)
    return stored.agg(F.count(F.lit(1)).alias("count")).select(F.lit(source).alias("source"), "count")
