"""One row per order, and cancellation rates by dimension, band and product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.fixed_values import DISCOUNT_BANDS_CANCELLATION, QUANTITY_BAND_LABELS
from orderlens.functions.numbers import band, quantile_band, share
from orderlens.operators.integrity import order_product_pairs
from orderlens.operators.kpis import shown, total
from orderlens.operators.ordered import exact_percentiles
from orderlens.session import materialize

ORDER_ATTRIBUTES = ("user_id", "order_date", "order_status", "channel", "country", "city", "retailer_type", "age")


def first_known(c: str):
    """Value of the first line that has one."""
    return F.min_by(c, F.when(F.col(c).isNotNull(), F.col("line_number"))).alias(c)


def order_level(df: DataFrame) -> DataFrame:
    """Order attributes, counts, sums, means, dominant category and price segment (lowest label on ties).

    Means add decimals, so that they do not depend on the order of the lines and equal means stay tied.
    """
    mean = lambda c: share(F.sum(F.col(c).cast("decimal(27,9)")), F.count(c))
    return (
        df.filter("order_id is not null")
        .groupBy("order_id")
        .agg(
            *[first_known(c) for c in ORDER_ATTRIBUTES],
            F.count("line_number").alias("line_count"),
            shown(total("quantity")).alias("total_quantity"),
            shown(total("revenue")).alias("order_revenue"),
            mean("unit_price").alias("avg_unit_price"),
            mean("discount_percentage").alias("avg_discount"),
            mean("inventory").alias("avg_inventory"),
            mean("rating").alias("avg_rating"),
            F.mode("category", True).alias("dominant_category"),
            F.mode("price_segment", True).alias("dominant_price_segment"),
        )
        .withColumns(
            {
                "cancelled_flag": F.coalesce(F.col("order_status") == "cancelled", F.lit(False)).cast("int"),
                "month": F.month("order_date"),
                "quarter": F.quarter("order_date"),
            }
        )
    )


def cancellation_rate(orders: DataFrame, variable: str) -> DataFrame:
    """Orders, cancelled orders and rate per label (null kept)."""
    return orders.groupBy(variable).agg(
        F.count("order_id").alias("pedidos"),
        F.sum("cancelled_flag").alias("cancelados"),
        F.avg("cancelled_flag").alias("tasa_cancelacion"),
    ).withColumn("tasa_cancelacion_pct", F.col("tasa_cancelacion") * 100)


def cancellation_by_quantity_band(orders: DataFrame) -> DataFrame:
    """Rates by quartile of the order's units; equal quantities always share a band."""
    orders = materialize(orders.select("order_id", "total_quantity", "cancelled_flag"))
    edges = exact_percentiles(orders, {"total_quantity": [0.0, 0.25, 0.5, 0.75, 1.0]})["total_quantity"]
    label, _ = quantile_band(F.col("total_quantity"), [e for e in edges if e is not None], QUANTITY_BAND_LABELS)
    return cancellation_rate(orders.withColumn("quantity_band", label), "quantity_band")


def cancellation_by_discount_band(orders: DataFrame) -> DataFrame:
    label, _ = band(F.col("avg_discount"), DISCOUNT_BANDS_CANCELLATION)
    return cancellation_rate(orders.withColumn("discount_band", label), "discount_band")


def product_cancellation(df: DataFrame, min_orders: int = 5) -> DataFrame:
    """Cancellation rate per product over the orders that hold it, from a minimum support on."""
    pairs = order_product_pairs(df, "product_name", "category", "order_status").withColumn(
        "_cancelled", F.col("order_status").eqNullSafe("cancelled").cast("int")
    )
    return (
        pairs.dropna(subset=["product_id", "product_name", "category"])
        .groupBy("product_id", "product_name", "category")
        .agg(
            F.count("order_id").alias("pedidos"),  # one row per order already
            F.sum("_cancelled").alias("cancelados"),
            F.avg("_cancelled").alias("tasa_cancelacion"),
        )
        .filter(F.col("pedidos") >= min_orders)
    )
