"""Order level, cancellations and inference."""

from __future__ import annotations

import uuid

from orderlens.operators import inference, order_level, rankings
from orderlens.operators.integrity import LINE_KEY
from orderlens.session import shared_folder
from orderlens.sources import files
from orderlens.sources import star_tables as star
from registry import lines, lines_with, register, rounded

_LEVEL_COLUMNS = (
    "order_id", "line_number", *order_level.ORDER_ATTRIBUTES, "quantity", "revenue", "unit_price", "discount_percentage",
    "inventory", "rating", "category", "price_segment",
)


def _mode(c: str) -> str:
    return (
        f"m_{c} AS (SELECT order_id AS k, arg_min(v, (-n, v)) AS dominant_{c} FROM (SELECT order_id, {c} AS v, count(*) AS n FROM e "
        f"WHERE {c} IS NOT NULL GROUP BY 1, 2) GROUP BY 1)"
    )


# order attributes are constant per order, so any aggregate gives the first line's value
_ORDERS = ", ".join(_mode(c) for c in ("category", "price_segment")) + """,
o0 AS (SELECT order_id, min(user_id) AS user_id, min(order_date) AS order_date, min(order_status) AS order_status, min(channel) AS channel,
    min(country) AS country, min(city) AS city, min(retailer_type) AS retailer_type, min(age) AS age, count(line_number) AS line_count,
    coalesce(sum(quantity), 0) AS total_quantity, CAST(coalesce(sum(revenue), 0) AS DOUBLE) AS order_revenue,
    CAST(sum(unit_price) AS DOUBLE) / count(unit_price) AS avg_unit_price, sum(discount_percentage) / count(discount_percentage) AS avg_discount,
    sum(inventory) / nullif(count(inventory), 0) AS avg_inventory, CAST(sum(CAST(rating AS DECIMAL(18,9))) AS DOUBLE) / nullif(count(rating), 0) AS avg_rating FROM e GROUP BY order_id),
o AS (SELECT o0.*, dominant_category, dominant_price_segment, CAST(order_status = 'cancelled' AS INTEGER) AS cancelled_flag,
    CAST(month(order_date) AS INTEGER) AS month, CAST(quarter(order_date) AS INTEGER) AS quarter
    FROM o0 LEFT JOIN m_category c ON c.k = order_id LEFT JOIN m_price_segment p ON p.k = order_id)"""


def _orders(spark, sf):
    return order_level.order_level(star.enriched(spark, sf, *_LEVEL_COLUMNS))


@register("order_level", lines_with(_ORDERS, "SELECT * FROM o"))
def order_level_table(spark, sf):
    return _orders(spark, sf)


@register("order_level_from_table", lines_with(_ORDERS, "SELECT * FROM o"))
def order_level_from_table(spark, sf):
    """From the SQL table, which is laid out by order: no exchange between its scan and the result."""
    name = f"lines_{uuid.uuid4().hex}"
    files.write_table(star.enriched(spark, sf, *_LEVEL_COLUMNS), name, f"{shared_folder(spark)}/{name}", buckets=16)
    return order_level.order_level(spark.table(name))


_RATE = "count(order_id) AS pedidos, CAST(sum(cancelled_flag) AS BIGINT) AS cancelados, round(avg(cancelled_flag), 6) AS tasa_cancelacion, round(avg(cancelled_flag) * 100, 4) AS tasa_cancelacion_pct"


def _rate(df):
    return rounded(rounded(df, 6, "tasa_cancelacion"), 4, "tasa_cancelacion_pct")


def _cancellation(variable: str) -> None:
    @register(f"cancellation_by_{variable}", lines_with(_ORDERS, f"SELECT {variable}, {_RATE} FROM o GROUP BY {variable}"))
    def rate(spark, sf):
        return _rate(order_level.cancellation_rate(_orders(spark, sf), variable))


for _variable in ("country", "channel", "retailer_type", "dominant_price_segment", "dominant_category", "month"):
    _cancellation(_variable)


@register(
    "cancellation_by_quantity_band",
    lines_with(
        _ORDERS + ", q AS (SELECT quantile_cont(total_quantity, 0.25) AS a, quantile_cont(total_quantity, 0.5) AS b, "
        "quantile_cont(total_quantity, 0.75) AS c FROM o)",
        "SELECT CASE WHEN total_quantity <= a THEN 'Q1 - baja' WHEN total_quantity <= b THEN 'Q2' WHEN total_quantity <= c THEN 'Q3' "
        f"ELSE 'Q4 - alta' END AS quantity_band, {_RATE} FROM o, q GROUP BY 1",
    ),
)
def cancellation_by_quantity_band(spark, sf):
    return _rate(order_level.cancellation_by_quantity_band(_orders(spark, sf)))


@register(
    "cancellation_by_discount_band",
    lines_with(
        _ORDERS,
        "SELECT CASE WHEN avg_discount <= 5 THEN '<=5' WHEN avg_discount <= 10 THEN '5-10' WHEN avg_discount <= 15 THEN '10-15' WHEN "
        f"avg_discount <= 20 THEN '15-20' WHEN avg_discount <= 25 THEN '20-25' WHEN avg_discount > 25 THEN '>25' END AS discount_band, {_RATE} "
        "FROM o GROUP BY 1",
    ),
)
def cancellation_by_discount_band(spark, sf):
    return _rate(order_level.cancellation_by_discount_band(_orders(spark, sf)))


@register(
    "product_cancellation",
    lines_with(
        "p AS (SELECT DISTINCT order_id, product_id, product_name, category, CAST(order_status = 'cancelled' AS INTEGER) AS c FROM e)",
        "SELECT product_id, product_name, category, count(*) AS pedidos, CAST(sum(c) AS BIGINT) AS cancelados, round(avg(c), 6) AS tasa_cancelacion "
        "FROM p GROUP BY product_id, product_name, category HAVING count(*) >= 5",
    ),
)
def product_cancellation(spark, sf):
    df = star.enriched(spark, sf, *LINE_KEY, "product_name", "category", "order_status")
    return rounded(order_level.product_cancellation(df), 6, "tasa_cancelacion")


_EXCLUSIVE = ("country", "city", "channel", "retailer_type", "dominant_price_segment", "dominant_category")


@register(
    "exclusive_values",
    lines_with(
        _ORDERS + ", x AS (SELECT cancelled_flag, unnest([" + ", ".join(f"'{v}'" for v in _EXCLUSIVE) + "]) AS variable, unnest(["
        + ", ".join(_EXCLUSIVE) + "]) AS value FROM o)",
        "SELECT variable, value, CASE WHEN max(cancelled_flag) = 1 THEN 'solo_en_cancelados' ELSE 'solo_en_no_cancelados' END AS grupo "
        "FROM x WHERE value IS NOT NULL GROUP BY variable, value HAVING max(cancelled_flag) = min(cancelled_flag)",
    ),
)
def exclusive_values(spark, sf):
    return rankings.exclusive_values(_orders(spark, sf), _EXCLUSIVE)


@register(
    "exclusive_skus",
    lines(
        "SELECT sku AS product_name, CASE WHEN max(canceled_flag) = 1 THEN 'solo_en_cancelados' ELSE 'solo_en_no_cancelados' END AS grupo "
        "FROM e GROUP BY sku HAVING max(canceled_flag) = min(canceled_flag)"
    ),
)
def exclusive_skus(spark, sf):
    """The part names have few values, so the SKU stands for the product name."""
    df = star.enriched(spark, sf, "sku", "order_status").withColumnRenamed("sku", "product_name")
    return rankings.exclusive_products(df)


# ---------------------------------------------------------------- inference
_NUMERIC_LONG = (
    "x AS (SELECT cancelled_flag AS f, unnest([" + ", ".join(f"'{v}'" for v in inference.NUMERIC_VARIABLES) + "]) AS variable, unnest(["
    + ", ".join(f"CAST({v} AS DOUBLE)" for v in inference.NUMERIC_VARIABLES) + "]) AS v FROM o)"
)


_RANKS = """,
        t AS (SELECT variable, v, count(*) AS t, sum(f) AS t1 FROM x WHERE v IS NOT NULL GROUP BY 1, 2),
        r AS (SELECT *, sum(t) OVER (PARTITION BY variable ORDER BY v ROWS UNBOUNDED PRECEDING) - (t - 1) / 2.0 AS mid FROM t),
        s AS (SELECT variable, CAST(sum(t1) AS DOUBLE) AS n1, CAST(sum(t - t1) AS DOUBLE) AS n0, CAST(sum(t1 * mid) AS DOUBLE) AS r1,
              sum(CAST(t AS DOUBLE) * t * t - t) AS ties FROM r GROUP BY 1),
        u AS (SELECT *, r1 - n1 * (n1 + 1) / 2 AS u, n1 + n0 AS n FROM s),
        mw AS (SELECT *, (greatest(u, n1 * n0 - u) - n1 * n0 / 2 - 0.5) / sqrt(n1 * n0 / 12 * ((n + 1) - ties / (n * (n - 1)))) AS z FROM u)"""


@register(
    "mann_whitney",
    lines_with(
        _ORDERS + ", " + _NUMERIC_LONG + _RANKS,
        "SELECT variable, CAST(n1 AS BIGINT) AS n1, CAST(n0 AS BIGINT) AS n0, u, round(z, 6) AS z, ties > 0 AS has_ties FROM mw",
    ),
)
def mann_whitney(spark, sf):
    return rounded(inference.mann_whitney(_orders(spark, sf)), 6, "z")


_GROUPS = """,
        g AS (SELECT variable, avg(v) FILTER (f = 1) AS a, avg(v) FILTER (f = 0) AS b, quantile_cont(v, 0.5) FILTER (f = 1) AS ma,
            quantile_cont(v, 0.5) FILTER (f = 0) AS mb, corr(f, v) AS r, count(v) AS n, count(v) FILTER (f = 1) AS n1, count(v) FILTER (f = 0) AS n0,
            var_samp(v) FILTER (f = 1) AS va, var_samp(v) FILTER (f = 0) AS vb FROM x WHERE v IS NOT NULL GROUP BY 1)"""


@register(
    "group_comparison",
    lines_with(
        _ORDERS + ", " + _NUMERIC_LONG + _GROUPS,
        "SELECT variable, round(a, 4) AS media_cancelados, round(ma, 6) AS mediana_cancelados, round(b, 4) AS media_no_cancelados, "
        "round(mb, 6) AS mediana_no_cancelados, round(r, 6) AS correlacion_punto_biserial, n AS pares, "
        "round((a - b) / sqrt(((n1 - 1) * va + (n0 - 1) * vb) / (n1 + n0 - 2)), 6) AS smd FROM g",
    ),
)
def group_comparison(spark, sf):
    out = rounded(inference.group_comparison(_orders(spark, sf)), 4, "media_cancelados", "media_no_cancelados")
    return rounded(out, 6, "mediana_cancelados", "mediana_no_cancelados", "correlacion_punto_biserial", "smd")


# upper tails by power series: of the gamma distribution, which has the normal and the chi-square ones, and of the beta distribution
_GAMMA_TAIL = "(1 - list_sum([exp((n + {a}) * ln({x}) - {x} - lgamma(n + {a} + 1)) FOR n IN range(0, 2000)]))"
_BETA_TAIL = "(1 - list_sum([exp((n + 0.5) * ln({y}) + {b} * ln(1 - {y}) + lgamma(n + 0.5 + {b}) - lgamma(n + 1.5) - lgamma({b})) FOR n IN range(0, 2000)]))"


@register(
    "numeric_tests",
    lines_with(
        _ORDERS + ", " + _NUMERIC_LONG + _RANKS + _GROUPS + ", p AS (SELECT g.*, CASE WHEN z <= 0 THEN 1.0 ELSE "
        + _GAMMA_TAIL.format(a="0.5", x="(z * z / 2)") + " END AS pm, " + _BETA_TAIL.format(y="(r * r)", b="((g.n - 2) / 2.0)")
        + " AS pr FROM g JOIN mw USING (variable))",
        "SELECT variable, round(a, 4) AS media_cancelados, round(ma, 6) AS mediana_cancelados, round(b, 4) AS media_no_cancelados, "
        "round(mb, 6) AS mediana_no_cancelados, round(pm, 6) AS mann_whitney_p, round(r, 6) AS correlacion_punto_biserial, round(pr, 6) AS correlacion_p, "
        "round((a - b) / sqrt(((n1 - 1) * va + (n0 - 1) * vb) / (n1 + n0 - 2)), 6) AS smd, pm < 0.05 AS evidencia_p_menor_005 FROM p",
    ),
)
def numeric_tests(spark, sf):
    """With p values; SQL adds up the series of the tails."""
    out = rounded(inference.numeric_tests(_orders(spark, sf)), 4, "media_cancelados", "media_no_cancelados")
    return rounded(out, 6, "mediana_cancelados", "mediana_no_cancelados", "mann_whitney_p", "correlacion_punto_biserial", "correlacion_p", "smd")


_CELLS = (
        _ORDERS + ", x AS (SELECT cancelled_flag AS f, unnest([" + ", ".join(f"'{v}'" for v in inference.CATEGORICAL_VARIABLES)
        + "]) AS variable, unnest([" + ", ".join(f"CAST({v} AS VARCHAR)" for v in inference.CATEGORICAL_VARIABLES) + """]) AS v FROM o),
        c AS (SELECT variable, v, CAST(sum(f) AS DOUBLE) AS o1, CAST(sum(1 - f) AS DOUBLE) AS o0 FROM x WHERE v IS NOT NULL GROUP BY 1, 2),
        n AS (SELECT *, sum(o1) OVER w AS n1, sum(o0) OVER w AS n0, count(*) OVER w AS k FROM c WINDOW w AS (PARTITION BY variable)),
        s AS (SELECT variable, k, n1 + n0 AS n, sum((o1 - (o1 + o0) * n1 / (n1 + n0)) ** 2 / ((o1 + o0) * n1 / (n1 + n0))
              + (o0 - (o1 + o0) * n0 / (n1 + n0)) ** 2 / ((o1 + o0) * n0 / (n1 + n0))) AS x2 FROM n GROUP BY ALL)"""
)


@register(
    "chi_square",
    lines_with(
        _CELLS,
        "SELECT variable, round(x2, 6) AS chi2, k - 1 AS grados_libertad, round(sqrt(x2 / n), 6) AS cramers_v FROM s",
    ),
)
def chi_square(spark, sf):
    return rounded(inference.chi_square(_orders(spark, sf)), 6, "chi2", "cramers_v")


@register(
    "categorical_tests",
    lines_with(
        _CELLS + ", p AS (SELECT *, " + _GAMMA_TAIL.format(a="((k - 1) / 2.0)", x="greatest(x2 / 2, 1e-300)") + " AS p FROM s)",
        "SELECT variable, round(x2, 6) AS chi2, k - 1 AS grados_libertad, round(p, 6) AS p_value, round(sqrt(x2 / n), 6) AS cramers_v, "
        "p < 0.05 AS evidencia_p_menor_005 FROM p",
    ),
)
def categorical_tests(spark, sf):
    """With p values; SQL adds up the series of the chi-square tail."""
    return rounded(inference.categorical_tests(_orders(spark, sf)), 6, "chi2", "p_value", "cramers_v")


_ATTRIBUTES = ("unit_price", "catalog_price", "discount_percentage", "rating", "inventory", "quantity", "revenue")


def _spearman_sql() -> str:
    parts = []
    for i, a in enumerate(_ATTRIBUTES):
        for b in _ATTRIBUTES[i + 1:]:
            parts.append(
                f"SELECT '{a}' AS a, '{b}' AS b, corr(x, y) AS rho FROM (SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0 "
                f"AS x, rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS y FROM sales WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
            )
    both = "r AS (" + " UNION ALL ".join(parts) + ")"
    diagonal = " UNION ALL ".join(f"SELECT '{a}', '{a}', 1.0" for a in _ATTRIBUTES)
    return lines_with(
        both,
        f"SELECT a AS variable, b AS otra, round(rho, 6) AS rho FROM r UNION ALL SELECT b, a, round(rho, 6) FROM r UNION ALL {diagonal}",
    )


@register("spearman_attributes", _spearman_sql())
def spearman_attributes(spark, sf):
    return rounded(inference.spearman(star.sales(spark, sf, *_ATTRIBUTES), _ATTRIBUTES), 6, "rho")
