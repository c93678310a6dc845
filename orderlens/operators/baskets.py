"""Discount bands, category baskets and correlations of the discount."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.fixed_values import DISCOUNT_BANDS_ANALYSIS, DISCOUNT_BANDS_EXECUTIVE
from orderlens.functions.numbers import band, share
from orderlens.operators.kpis import shown


def discount_bands_executive(sales: DataFrame) -> DataFrame:
    """Value and mean quantity per discount band; values outside all bands and empty bands are left out."""
    label, index = band(F.col("discount_percentage"), DISCOUNT_BANDS_EXECUTIVE)
    return (
        sales.select(label.alias("discount_band"), index.alias("band_index"), "revenue", "quantity")
        .filter("discount_band is not null")
        .groupBy("discount_band", "band_index")
        .agg(shown(F.sum("revenue")).alias("value"), F.avg("quantity").alias("avg_quantity"))
    )


def discount_bands(sales: DataFrame) -> DataFrame:
    """Lines, units, value and medians per discount band; empty bands stay with zero sums.

    The medians are exact and cheap to merge: quantity and rating take few distinct values.
    """
    label, index = band(F.col("discount_percentage"), DISCOUNT_BANDS_ANALYSIS)
    grouped = (
        sales.select(label.alias("banda_descuento"), "quantity", "rating", "revenue")
        .groupBy("banda_descuento")
        .agg(
            F.count(F.lit(1)).alias("lineas"),
            F.sum("quantity").alias("unidades"),
            F.sum("revenue").alias("revenue"),
            F.percentile("quantity", 0.5).alias("cantidad_mediana"),
            F.percentile("rating", 0.5).alias("rating_mediano"),
        )
    )
    labels = DISCOUNT_BANDS_ANALYSIS[2]
    bands = sales.sparkSession.createDataFrame(list(enumerate(labels)), "orden int, banda_descuento string")
    return F.broadcast(bands).join(grouped, "banda_descuento", "left").select(
        "orden", "banda_descuento",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("lineas",)],
        *[F.coalesce(shown(c), F.lit(0.0)).alias(c) for c in ("unidades", "revenue")],
        "cantidad_mediana", "rating_mediano",
    )


def discount_correlations(sales: DataFrame) -> DataFrame:
    """Pearson correlation of the discount with quantity and revenue, each over complete pairs."""
    pair = lambda c: F.corr("discount_percentage", F.col(c).cast("double"))
    return sales.agg(pair("quantity").alias("discount_quantity_corr"), pair("revenue").alias("discount_revenue_corr"))


def discount_hypothesis(sales: DataFrame) -> DataFrame:
    """Registered gross value against the value if the discount were not yet included (exact sums)."""
    after = F.col("revenue") * (100 - F.col("discount_percentage").cast("decimal(9,4)"))
    return sales.agg(
        shown(F.sum("revenue")).alias("revenue_bruto_registrado"),
        (shown(F.sum(after)) / 100).alias("revenue_hipotetico_despues_descuento"),
    ).withColumn("diferencia_hipotetica", F.col("revenue_bruto_registrado") - F.col("revenue_hipotetico_despues_descuento"))


def category_baskets(sales: DataFrame, anchor: str, others: Sequence[str]) -> DataFrame:
    """Share of orders with two or more categories, and how often others join the anchor category.

    Orders are reduced to (order, category) first, so no order's categories are collected.
    """
    pairs = sales.select("order_id", "category").distinct()
    holds = lambda c: F.coalesce(F.max((F.col("category") == c).cast("int")), F.lit(0))
    orders = pairs.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_n"),
        holds(anchor).alias("_anchor"),
        *[holds(c).alias(f"_o{i}") for i, c in enumerate(others)],
    )
    return orders.agg(
        F.count(F.lit(1)).alias("orders"),
        F.avg((F.col("_n") >= 2).cast("double")).alias("multi_category_share"),
        F.sum("_anchor").alias("anchor_orders"),
        *[
            share(F.sum(F.col("_anchor") * F.col(f"_o{i}")), F.sum("_anchor")).alias(f"attach_{c}")
            for i, c in enumerate(others)
        ],
    )
