"""Registered queries over the star-schema tables, each next to its DuckDB equivalent."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    """Add a query under a name; `sql` is None where SQL cannot express it (or is too slow on whole tables)."""

    def add(run):
        QUERIES[name] = Query(run, sql)
        return run

    return add


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Doubles rounded for comparison; used only here, never inside the operators."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


# --- the enriched line in DuckDB SQL, column for column ---
LINES = """
WITH order_counts AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1),
parts AS (
  SELECT p_partkey AS id, p_name, p_type, p_brand, CAST(p_retailprice AS DECIMAL(18,2)) AS list_price,
         CAST(p_size % 20 AS DOUBLE) AS catalog_discount_percentage,
         CASE WHEN p_partkey % 97 <> 0 THEN CAST(p_size AS DOUBLE) END AS inventory,
         CASE WHEN p_partkey % 41 <> 0 THEN 2.5 + CAST(p_partkey % 26 AS DOUBLE) / 10 END AS rating,
         CAST(p_partkey % 500 AS DOUBLE) AS reviews,
         p_name || '|' || p_brand || '|' || p_type || '|' || CAST(p_size AS VARCHAR) AS sku,
         count(*) OVER (PARTITION BY p_name, p_brand, p_type, p_size) > 1 AS catalog_duplicate_flag
  FROM part),
buyers AS (
  SELECT c_custkey AS id, c_name, CAST(20 + c_custkey % 50 AS INTEGER) AS age, r_name, n_name, c_mktsegment
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey),
raw AS (
  SELECT l_orderkey AS order_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS order_date,
         CASE WHEN o_orderstatus = 'F' THEN 'Delivered' WHEN o_orderstatus = 'O' THEN 'confirmed'
              WHEN o_orderkey % 3 = 0 THEN 'CANCELED' ELSE 'shipped' END AS status_original,
         CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'confirmed'
              WHEN o_orderkey % 3 = 0 THEN 'cancelled' ELSE 'shipped' END AS order_status,
         CASE WHEN o_orderstatus NOT IN ('F', 'O') AND o_orderkey % 15 = 0 THEN '6-RETURNED' ELSE o_orderpriority END AS channel,
         CAST(n - CASE WHEN o_orderkey % 101 = 0 THEN 1 ELSE 0 END AS INTEGER) AS reported_total_products,
         l_linenumber AS line_number, l_partkey AS product_id,
         CAST(floor(l_extendedprice * 100 / l_quantity) / 100 AS DECIMAL(18,2)) AS unit_price,
         CASE WHEN (l_orderkey * 31 + l_partkey) % 61 <> 0 AND o_custkey % 97 <> 0 THEN l_quantity END AS quantity,
         CASE WHEN l_partkey % 13 <> 0 THEN round(l_discount * 100, 2) END AS line_discount_percentage
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN order_counts ON k = o_orderkey),
priced AS (
  SELECT raw.*, p_name, p_type, p_brand, catalog_discount_percentage, inventory, rating, reviews, sku,
         catalog_duplicate_flag, parts.id IS NOT NULL AS product_match_flag, buyers.id IS NOT NULL AS user_match_flag,
         CASE WHEN product_id % 2 = 0 THEN unit_price ELSE list_price END AS catalog_price,
         age, r_name, n_name, c_mktsegment, c_name,
         CAST(unit_price * CAST(quantity AS DECIMAL(12,3)) AS DECIMAL(18,2)) AS revenue
  FROM raw LEFT JOIN parts ON product_id = parts.id LEFT JOIN buyers ON user_id = buyers.id),
e AS (
  SELECT order_id, user_id, order_date, order_status, channel, reported_total_products, line_number, product_id,
         CAST(NULL AS VARCHAR) AS line_product_name, CAST(NULL AS VARCHAR) AS line_category, unit_price, quantity,
         line_discount_percentage, p_name AS catalog_product_name, p_type AS category, p_brand AS brand, catalog_price,
         catalog_discount_percentage, inventory, rating, reviews, sku, catalog_duplicate_flag, age, r_name AS country,
         n_name AS city, c_mktsegment AS retailer_type, c_name AS customer_name, p_name AS product_name,
         r_name AS country_original, channel AS channel_original, status_original,
         coalesce(line_discount_percentage, catalog_discount_percentage) AS discount_percentage, revenue,
         CASE WHEN unit_price < 1000 THEN 'Económico' WHEN unit_price <= 4000 THEN 'Medio'
              WHEN unit_price > 4000 THEN 'Premium' ELSE 'Sin clasificar' END AS price_segment,
         CAST(year(order_date) AS INTEGER) AS year, CAST(quarter(order_date) AS INTEGER) AS quarter,
         CAST(month(order_date) AS INTEGER) AS month,
         ['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre',
          'Diciembre'][month(order_date)] AS month_name,
         strftime(order_date, '%Y-%m') AS year_month,
         CAST(order_status = 'delivered' AS INTEGER) AS delivered_flag,
         CAST(order_status = 'cancelled' AS INTEGER) AS canceled_flag,
         product_match_flag, user_match_flag, unit_price - catalog_price AS price_difference,
         CASE WHEN catalog_price <> 0 THEN CAST(unit_price - catalog_price AS DOUBLE) / CAST(catalog_price AS DOUBLE) END
           AS price_difference_pct,
         coalesce(quantity > 0, FALSE) AND coalesce(unit_price > 0, FALSE) AND revenue IS NOT NULL
           AND order_id IS NOT NULL AS valid_sales_flag
  FROM priced),
sales AS (SELECT * FROM e WHERE valid_sales_flag),
fences AS (
  SELECT quantile_cont(CAST(revenue AS DOUBLE), 0.25) AS r1, quantile_cont(CAST(revenue AS DOUBLE), 0.75) AS r3,
         quantile_cont(quantity, 0.25) AS q1, quantile_cont(quantity, 0.75) AS q3,
         quantile_cont(CAST(unit_price AS DOUBLE), 0.25) AS u1, quantile_cont(CAST(unit_price AS DOUBLE), 0.75) AS u3
  FROM e)
"""


def lines(select: str) -> str:
    """Oracle SQL over the enriched line `e`, its valid `sales` and the IQR `fences`."""
    return LINES + select


def lines_with(ctes: str, select: str) -> str:
    return f"{LINES.rstrip()},\n{ctes.strip()}\n{select}"


def load() -> dict[str, Query]:
    from registry import customers, enrichment, models, orders, reports, scenarios  # noqa: F401

    return QUERIES
