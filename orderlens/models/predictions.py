"""Predicted quantities as a versioned table, keyed by line, that the scenarios join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.fixed_values import MIN_WHOLESALE_QUANTITY
from orderlens.functions.numbers import rounded_clip, share

KEY = ("order_id", "line_number", "product_id", "unit_price")
VALUES = ("quantity_rf_estimated", "revenue_rf_estimated")


def write_predictions(predictions: DataFrame, path: str, version: str) -> None:
    """One row a line under a new version; an existing version is never overwritten."""
    if not version or not version.replace("-", "").replace("_", "").isalnum():
        raise ValueError("a version is made of letters, digits, - and _")
    rows = predictions.groupBy(*KEY).agg(*[F.max(c).alias(c) for c in VALUES])
    rows.write.mode("errorifexists").parquet(f"{path}/version={version}")


def read_predictions(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """The rows of a version, by default of the one that sorts last."""
    rows = spark.read.option("basePath", path).option("recursiveFileLookup", False).parquet(path).withColumn("version", F.col("version").cast("string"))
    chosen = version if version is not None else rows.agg(F.max("version")).first()[0]
    return rows.filter(F.col("version") == chosen).drop("version")


def mean_predictions(df: DataFrame) -> DataFrame:
    """The plainest regression: the mean known quantity of the product, else of all lines, as a bounded whole number."""
    quantity = F.col("quantity").cast("double")
    known = df.filter(quantity.isNotNull())
    overall = known.agg(share(F.sum(quantity), F.count(quantity)).alias("_all"), F.max(quantity).alias("_top"))
    products = known.groupBy("product_id").agg(share(F.sum(quantity), F.count(quantity)).alias("_mean"))
    missing = df.filter(quantity.isNull()).select(*KEY).join(products, "product_id", "left").crossJoin(overall)  # one row
    estimated = F.least(rounded_clip(F.coalesce("_mean", "_all"), MIN_WHOLESALE_QUANTITY, float("inf")), F.col("_top")).cast("long")
    return missing.withColumn("quantity_rf_estimated", estimated).select(
        *KEY, "quantity_rf_estimated", (F.col("unit_price").cast("double") * F.col("quantity_rf_estimated")).alias("revenue_rf_estimated")
    )


def attach_predictions(scenarios: DataFrame, predictions: DataFrame) -> DataFrame:
    """Forest columns on every line: the prediction where one exists, else the original value.

    Joined on the line key and price, so that copies of a line key with another price keep their own value.
    """
    money = dict(scenarios.dtypes)["revenue"]
    chosen = predictions.groupBy(*KEY).agg(
        F.max("quantity_rf_estimated").cast("double").alias("quantity_rf_estimated"),
        F.max("revenue_rf_estimated").cast(money).alias("revenue_rf_estimated"),
    )
    # only the lines without a quantity are joined; the others pass through
    known = scenarios.filter(F.col("quantity").isNotNull()).withColumns(
        {"quantity_rf_estimated": F.col("quantity").cast("double"), "revenue_rf_estimated": F.col("revenue")}
    )
    missing = scenarios.filter(F.col("quantity").isNull()).join(chosen, list(KEY), "left")
    return known.unionByName(missing)
