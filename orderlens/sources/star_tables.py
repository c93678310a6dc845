"""Adapter: the star-schema tables as products, users and order lines.

Used by the registered queries and the benchmark. Columns a query does not ask for are not built, so
the scan reads only what is needed and a dimension is joined only when one of its columns is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators import enrich
from orderlens.operators.quality import evaluate_quality, iqr_fences, valid_sale
from orderlens.session import stored

PRICE_EDGES = (1000, 4000)
MONEY = "decimal(18,2)"
DOMAINS = {
    "country": ("AFRICA", "AMERICA", "ASIA", "EUROPE"),
    "channel": ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"),
    "order_status": ("confirmed", "shipped", "delivered", "cancelled"),
}
_RULE_COLUMNS = (
    "order_id", "user_id", "product_id", "line_number", "order_status", "channel", "country", "order_date", "quantity",
    "unit_price", "price_difference", "revenue", "inventory", "rating",
)
_PRODUCT_NEEDS = set(enrich.PRODUCT_COLUMNS) | {
    "product_name", "product_match_flag", "price_difference", "price_difference_pct", "discount_percentage",
}
_USER_NEEDS = set(enrich.USER_COLUMNS) | {"user_match_flag"}


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table by its known schema, so that no job has to read footers first."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def products(spark: SparkSession, folder: str) -> DataFrame:
    """Catalog records in the shape of the product collection."""
    key, size = F.col("p_partkey"), F.col("p_size")
    return table(spark, folder, "part").select(
        key.alias("id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"),
        (size % 20).cast("double").alias("discountPercentage"),
        F.when(key % 97 != 0, size).alias("stock"),
        F.when(key % 41 != 0, 2.5 + (key % 26) / 10).alias("rating"),
        (key % 500).cast("int").alias("reviews"),
        F.concat_ws("|", "p_name", "p_brand", "p_type", size.cast("string")).alias("sku"),
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    """Customer records in the shape of the user collection."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return (
        table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("firstName"),
            F.lit(None).cast("string").alias("lastName"),
            F.lit(None).cast("string").alias("email"),
            F.lit(None).cast("string").alias("phone"),
            F.lit(None).cast("string").alias("address"),
            (20 + F.col("c_custkey") % 50).cast("int").alias("age"),
            F.concat(F.lit(" "), F.col("r_name"), F.lit(" ")).alias("country"),
            F.col("n_name").alias("city"),
            F.col("c_mktsegment").alias("retailerType"),
        )
    )


def _raw_status() -> Column:
    return (
        F.when(F.col("o_orderstatus") == "F", "Delivered")
        .when(F.col("o_orderstatus") == "O", "confirmed")
        .when(F.col("o_orderkey") % 3 == 0, "CANCELED")
        .otherwise("shipped")
    )


def _raw_channel() -> Column:
    """A fifteenth of the order keys, where cancelled, have a channel that no other order has."""
    returned = ~F.col("o_orderstatus").isin("F", "O") & (F.col("o_orderkey") % 15 == 0)
    return F.when(returned, "6-RETURNED").otherwise(F.col("o_orderpriority"))


def lines(spark: SparkSession, folder: str, declared: bool = True, buyers: DataFrame | None = None) -> DataFrame:
    """Order lines as they come out of the unnesting; `declared` adds the line count of each order.

    A user dimension is joined to the orders, before their lines: orders are fewer and narrower, and no line is shuffled by user.
    """
    items = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders").withColumnRenamed("o_custkey", "user_id")
    orders = enrich.join_dimensions(orders, None, buyers)
    bought = [c for c in (*enrich.USER_COLUMNS, "user_match_flag") if c in orders.columns]
    if declared:
        counts = items.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("_lines"))
        orders = orders.join(counts, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")
        total = (F.col("_lines") - F.when(F.col("o_orderkey") % 101 == 0, 1).otherwise(0)).cast("int")
    else:
        total = F.lit(None).cast("int")
    price = (F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")) / 100).cast(MONEY)
    # one line in 61, and every line of one customer in 97, who are left without a valid sale
    withheld = ((F.col("l_orderkey") * 31 + F.col("l_partkey")) % 61 == 0) | (F.col("user_id") % 97 == 0)
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("order_id"),
        "user_id",
        F.col("o_orderdate").cast("date").alias("order_date"),
        _raw_status().alias("order_status"),
        _raw_channel().alias("channel"),
        total.alias("reported_total_products"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.lit(None).cast("string").alias("line_product_name"),
        F.lit(None).cast("string").alias("line_category"),
        price.alias("unit_price"),
        F.when(~withheld, F.col("l_quantity")).alias("quantity"),
        F.when(F.col("l_partkey") % 13 != 0, F.round(F.col("l_discount") * 100, 2)).alias("line_discount_percentage"),
        *bought,
    )


def carts(spark: SparkSession, folder: str) -> DataFrame:
    """Order documents with all their lines in a nested product array; an order without lines has an empty one.

    An array is as long as one order. Lines stand in the order of their number, then part, price, quantity and discount.
    """
    line = F.struct("l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_discount")
    items = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("_lines"))
    products_ = F.transform(
        F.coalesce("_lines", F.array().cast(items.schema["_lines"].dataType)),
        lambda x: F.struct(
            x["l_partkey"].alias("id"),
            F.lit(None).cast("string").alias("title"),
            x["l_extendedprice"].alias("price"),
            x["l_quantity"].cast("int").alias("quantity"),
            F.lit(None).cast("string").alias("category"),
            F.round(x["l_discount"] * 100, 2).alias("discountPercentage"),
        ),
    )
    orders = table(spark, folder, "orders")
    return orders.join(items, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("userId"),
        F.size(products_).alias("totalProducts"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("orderDate"),
        _raw_status().alias("status"),
        _raw_channel().alias("channel"),
        products_.alias("products"),
    )


def enriched(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The enriched line with the columns asked for (all 48 when none is named)."""
    wanted = list(columns) or list(enrich.ENRICHED_COLUMNS)
    needs = set(wanted)
    flags = "data_quality_flag" in needs
    catalog = buyers = None
    if flags or needs & _PRODUCT_NEEDS:
        flag_sku = flags or "catalog_duplicate_flag" in needs
        catalog = enrich.prepare_products(products(spark, folder), unique=True, flag_sku=flag_sku)
    if flags or needs & _USER_NEEDS:
        # written once: the planner then knows the size of the joined dimension, and repeated ids are reduced to one row
        buyers = stored(enrich.prepare_users(users(spark, folder)))
    fact = lines(spark, folder, "reported_total_products" in needs, buyers)
    joined = enrich.join_dimensions(fact, catalog, None)
    if needs & {"valid_sales_flag", "data_quality_flag"}:
        needs |= {"quantity", "unit_price", "revenue"}
    if flags:
        needs |= set(_RULE_COLUMNS)
    if needs & {"catalog_price", "price_difference", "price_difference_pct"}:
        # half of the catalog carries the line price, so that both outcomes of the price rule occur
        joined = joined.withColumn(
            "catalog_price",
            F.when(F.col("product_id") % 2 == 0, F.col("unit_price")).otherwise(F.col("catalog_price").cast(MONEY)),
        )
    derived = enrich.derive_columns(joined, sorted(needs), price_edges=PRICE_EDGES, money=MONEY)
    if flags:
        derived = stored(derived)  # the fences, the key check and the flags each read a part of it
        derived = evaluate_quality(derived, DOMAINS, iqr_fences(derived, ["revenue", "quantity"]))
    elif "valid_sales_flag" in needs:
        derived = derived.withColumn("valid_sales_flag", valid_sale())
    return derived.select(*wanted)


def master(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The enriched line written once, as the ETL job leaves it, for operators that read it several times."""
    return stored(enriched(spark, folder, *columns))


def sales(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Lines with a valid sale."""
    return enriched(spark, folder, *dict.fromkeys([*columns, "valid_sales_flag"])).filter("valid_sales_flag")
