"""Customer features: extended RFM, preferences by value, concentration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.fixed_values import NO_DATA, PRICE_LABELS
from orderlens.functions.numbers import share
from orderlens.operators.filters import valid_sales
from orderlens.operators.kpis import shown

FEATURE_COLUMNS = (
    "user_id", "customer_name", "country", "retailer_type", "order_count", "total_revenue", "average_order_revenue",
    "units", "average_days_between_orders", "recency_days", "category_count", "top_category", "top_channel",
    "dominant_price_segment", "premium_revenue_share", "category_concentration_hhi",
)


def customer_gaps(sales: DataFrame) -> DataFrame:
    """Mean days between consecutive orders per customer; null with a single order, zero for same-day ones.

    The sum of consecutive gaps is the span from the first to the last order, so no window has to sort a
    customer's orders.
    """
    dated = sales.filter("user_id is not null").select("user_id", "order_id", "order_date").distinct()
    span = F.datediff(F.max("order_date"), F.min("order_date"))
    return dated.groupBy("user_id").agg(
        share(span, F.count("order_date") - 1).alias("average_days_between_orders")
    )


def dominant_value(value: Column, weight: Column, when: Column) -> Column:
    """Aggregate: value with the largest weight, ties in alphabetical order, null last."""
    return F.min(F.when(when, F.struct((-weight).alias("w"), value.isNull().alias("n"), value.alias("v"))))


def build_customer_features(df: DataFrame) -> DataFrame:
    """One row per customer with a valid sale. Every part is combined on the map side before each shuffle."""
    sales = valid_sales(df).filter("user_id is not null")
    latest = valid_sales(df).agg(F.max("order_date").alias("_latest"))

    # the attributes go apart: text in an aggregate's buffer would make Spark sort the lines
    names = ("customer_name", "country", "retailer_type")
    attributes = sales.select("user_id", *names).distinct().groupBy("user_id").agg(*[F.min(c).alias(c) for c in names])

    orders = sales.groupBy("user_id", "order_id", "order_date").agg(
        F.sum("revenue").alias("_revenue"), F.sum("quantity").alias("_units")
    )
    span = F.datediff(F.max("order_date"), F.min("order_date"))
    totals = orders.groupBy("user_id").agg(
        F.count_distinct("order_id").alias("order_count"),
        F.sum("_revenue").alias("_total"),
        F.sum("_units").cast("double").alias("units"),
        share(span, F.count("order_date") - 1).alias("average_days_between_orders"),
        F.max("order_date").alias("_last"),
    )

    kinds = ("category", "channel", "price_segment")
    long = sales.select("user_id", "revenue", *kinds).unpivot(["user_id", "revenue"], list(kinds), "kind", "value")
    weights = long.groupBy("user_id", "kind", "value").agg(F.sum("revenue").alias("_w"))
    of = lambda k: F.col("kind") == k
    value, weight = F.col("value"), F.col("_w")
    known_category = of("category") & value.isNotNull()
    preferences = weights.groupBy("user_id").agg(
        *[dominant_value(value, weight, of(k)).alias(f"_{k}") for k in kinds],
        F.count_if(known_category).alias("category_count"),
        F.sum(F.when(of("price_segment") & (value == PRICE_LABELS[2]), weight)).alias("_premium"),
        F.sum(F.when(known_category, weight.cast("double") * weight.cast("double"))).alias("_squares"),
    )

    total = F.col("_total").cast("double")
    top = lambda k: F.coalesce(F.col(f"_{k}")["v"], F.lit(NO_DATA))
    return (
        totals.join(attributes, "user_id")
        .join(preferences, "user_id")
        .crossJoin(latest)  # one row
        .select(
            "user_id",
            F.coalesce("customer_name", F.concat(F.lit("Cliente "), F.col("user_id").cast("string"))).alias("customer_name"),
            F.coalesce("country", F.lit(NO_DATA)).alias("country"),
            F.coalesce("retailer_type", F.lit(NO_DATA)).alias("retailer_type"),
            "order_count",
            shown("_total").alias("total_revenue"),
            share(total, F.col("order_count")).alias("average_order_revenue"),
            "units",
            "average_days_between_orders",
            F.datediff("_latest", "_last").alias("recency_days"),
            "category_count",
            top("category").alias("top_category"),
            top("channel").alias("top_channel"),
            top("price_segment").alias("dominant_price_segment"),
            F.coalesce(share(F.col("_premium"), F.when(total != 0, total)), F.lit(0.0)).alias("premium_revenue_share"),
            F.coalesce(F.try_divide(F.col("_squares"), total * total), F.lit(0.0)).alias("category_concentration_hhi"),
        )
    )
