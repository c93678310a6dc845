"""Products and customers: rankings, concentration, what the leaders share, exclusive values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.numbers import percent, share
from orderlens.operators.kpis import shown
from orderlens.operators.ordered import running_totals
from orderlens.operators.shape import long_form

CUSTOMER = ("user_id", "customer_name", "country")
PRODUCT = ("product_id", "product_name", "category", "brand")


def entity_values(sales: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Value, units and orders per customer or product (null keys kept)."""
    return sales.groupBy(*keys).agg(
        F.sum("revenue").alias("_value"),
        shown(F.sum("quantity")).alias("units"),
        F.count_distinct("order_id").alias("orders"),
    )


def top_entities(sales: DataFrame, keys: Sequence[str], n: int = 10) -> DataFrame:
    """The n largest by value (ties by key) with each one's share of the whole."""
    whole = sales.agg(F.sum("revenue").alias("_whole"))
    best = entity_values(sales, keys).orderBy(F.col("_value").desc(), keys[0]).limit(n)
    return best.crossJoin(whole).select(
        *keys, shown("_value").alias("value"), "units", "orders", share(F.col("_value"), F.col("_whole")).alias("share")
    )


def top_share(sales: DataFrame, keys: Sequence[str], n: int = 10) -> DataFrame:
    """Share of the whole held by the n largest."""
    sums = sales.groupBy(*keys).agg(F.sum("revenue").alias("_value"))
    best = sums.orderBy(F.col("_value").desc(), keys[0]).limit(n).agg(F.sum("_value").alias("_top"))
    return best.crossJoin(sums.agg(F.sum("_value").alias("_whole"), F.count(F.lit(1)).alias("entities"))).select(
        "entities", share(F.col("_top"), F.col("_whole")).alias("top_share")
    )


def customer_summary(sales: DataFrame) -> DataFrame:
    """Customers with revenue, units, orders, categories, share and cumulative share by falling revenue.

    The cumulative share is a distributed prefix sum, so the number of customers is not bound to a task.
    """
    keys = ["user_id", "customer_name", "country", "retailer_type"]
    grouped = sales.dropna(subset=keys).groupBy(*keys).agg(
        F.sum("revenue").alias("_revenue"),
        shown(F.sum("quantity")).alias("unidades"),
        F.count_distinct("order_id").alias("pedidos"),
        F.count_distinct("category").alias("categorias"),
    )
    running = running_totals(grouped, "_revenue", {"_until": F.col("_revenue")}, tie="user_id", descending=True)
    whole = running.agg(F.sum("_revenue").alias("_whole"))
    return running.crossJoin(whole).select(
        *keys, shown("_revenue").alias("revenue"), "unidades", "pedidos", "categorias",
        percent(F.col("_revenue"), F.col("_whole")).alias("participacion_pct"),
        percent(F.col("_until"), F.col("_whole")).alias("participacion_acumulada_pct"),
    )


def customers_to_share(summary: DataFrame, threshold: float = 80.0) -> DataFrame:
    """How many of the largest customers reach the threshold of the value."""
    return summary.agg(
        (F.count_if(F.col("participacion_acumulada_pct") < threshold) + 1).alias("customers_to_share"),
        F.count(F.lit(1)).alias("customers"),
    )


def product_summary(active: DataFrame) -> DataFrame:
    """Active sales per product: units, revenue, orders, mean price and discount, reach, inventory."""
    keys = [*PRODUCT, "price_segment"]
    return active.dropna(subset=keys).groupBy(*keys).agg(
        shown(F.sum("quantity")).alias("unidades"),
        shown(F.sum("revenue")).alias("revenue"),
        F.count_distinct("order_id").alias("pedidos"),
        share(F.sum("unit_price"), F.count("unit_price")).alias("precio_promedio"),
        F.avg("discount_percentage").alias("descuento_promedio"),
        F.count_distinct("country").alias("paises"),
        F.count_distinct("channel").alias("canales"),
        F.max("inventory").alias("inventario_catalogo"),  # one catalog value per product
    )


def top_products(active: DataFrame, n: int = 10) -> DataFrame:
    """The n best sellers by units, then revenue, then id and price segment."""
    return product_summary(active).orderBy(
        F.col("unidades").desc(), F.col("revenue").desc(), "product_id", "price_segment"
    ).limit(n)


def top_commonality(active: DataFrame, n: int = 10, channels: int = 3) -> DataFrame:
    """What the best sellers have in common against all other lines, from one scan with a marked join."""
    best = top_products(active, n)
    ids = best.select("product_id").distinct().withColumn("_top", F.lit(True))
    marked = active.join(F.broadcast(ids), "product_id", "left").withColumn("_top", F.coalesce("_top", F.lit(False)))
    top, other = F.col("_top"), ~F.col("_top")
    lines = marked.agg(
        percent(F.sum(F.when(top, F.col("quantity"))), F.sum("quantity")).alias("participacion_en_unidades_pct"),
        percent(F.sum(F.when(top, F.col("revenue"))), F.sum("revenue")).alias("participacion_en_revenue_pct"),
        F.avg(F.when(top, F.col("discount_percentage"))).alias("descuento_promedio_top10"),
        F.avg(F.when(other, F.col("discount_percentage"))).alias("descuento_promedio_otros"),
    )
    reach = best.agg(
        F.avg("paises").alias("paises_promedio_por_producto_top10"),
        F.count_if(F.col("canales") == channels).alias("productos_top_presentes_en_3_canales"),
    )
    return lines.crossJoin(reach)  # one-row frames


def top_segment_counts(active: DataFrame, n: int = 10) -> DataFrame:
    """Price segments of the best sellers."""
    return top_products(active, n).groupBy("price_segment").agg(F.count(F.lit(1)).alias("productos"))


def customers_without_sales(users: DataFrame, sales: DataFrame) -> DataFrame:
    """Users that never bought."""
    return users.join(sales.select("user_id").distinct(), "user_id", "left_anti")


def exclusive_values(orders: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Values seen only in cancelled, or only in other orders, for all variables in one pass."""
    seen = long_form(orders, variables, "string", ["cancelled_flag"]).filter("value is not null")
    flags = seen.groupBy("variable", "value").agg(
        F.max("cancelled_flag").alias("_any"), F.min("cancelled_flag").alias("_all")
    )
    return flags.filter(F.col("_any") == F.col("_all")).select(
        "variable", "value", F.when(F.col("_any") == 1, "solo_en_cancelados").otherwise("solo_en_no_cancelados").alias("grupo")
    )


def exclusive_products(df: DataFrame) -> DataFrame:
    """Product names seen only in cancelled, or only in other orders."""
    cancelled = F.coalesce(F.col("order_status") == "cancelled", F.lit(False)).cast("int").alias("cancelled_flag")
    return exclusive_values(df.select("product_name", cancelled), ["product_name"]).select(
        F.col("value").alias("product_name"), "grupo"
    )
