"""Indicators, summaries, periods, rankings, baskets and outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlens.operators import baskets, kpis, outliers, rankings
from orderlens.operators.filters import active_sales, semi_lines
from orderlens.operators.integrity import LINE_KEY
from orderlens.sources import star_tables as star
from registry import lines, lines_with, register, rounded

CHANNELS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


# ---------------------------------------------------------------- indicators
def _leader(d: str, source: str = "sales") -> str:
    return (
        f"l_{d} AS (SELECT {d} AS label, CAST(sum(revenue) AS DOUBLE) AS v FROM {source} GROUP BY 1 "
        f"ORDER BY sum(revenue) DESC, 1 LIMIT 1)"
    )


_MONTHS = """mon AS (SELECT year_month AS m, CAST(sum(revenue) AS DOUBLE) AS v FROM sales GROUP BY 1),
chg AS (SELECT m, v / lag(v) OVER (ORDER BY m) - 1 AS c, (v - lag(v) OVER (ORDER BY m)) / lag(v) OVER (ORDER BY m) AS d FROM mon),
lastchg AS (SELECT d FROM chg ORDER BY m DESC LIMIT 1),
st AS (SELECT order_id, min(order_status) AS s FROM e GROUP BY 1)"""


@register(
    "calculate_kpis",
    lines_with(
        ", ".join(_leader(d) for d in ("country", "channel", "category")) + ",\n" + _MONTHS,
        "SELECT CAST(sum(revenue) AS DOUBLE) AS total_revenue, sum(quantity) AS units_sold, count(DISTINCT order_id) AS orders, "
        "count(DISTINCT user_id) AS customers, round(CAST(sum(revenue) AS DOUBLE) / count(DISTINCT order_id), 4) AS average_order_revenue, "
        "round(CAST(sum(revenue) AS DOUBLE) / sum(quantity), 4) AS average_unit_price, "
        + ", ".join(
            f"(SELECT label FROM l_{d}) AS leading_{d}, round((SELECT v FROM l_{d}) / CAST(sum(revenue) AS DOUBLE), 6) AS leading_{d}_share"
            for d in ("country", "channel", "category")
        )
        + ", round((SELECT avg(CASE WHEN s = 'delivered' THEN 1.0 ELSE 0.0 END) FROM st), 6) AS delivered_order_rate, "
        "round((SELECT d FROM lastchg), 6) AS latest_month_change FROM sales",
    ),
)
def calculate_kpis(spark, sf):
    df = star.master(
        spark, sf, "order_id", "line_number", "user_id", "order_status", "country", "channel", "category", "year_month",
        "quantity", "revenue", "valid_sales_flag",
    )
    out = rounded(kpis.calculate_kpis(df), 4, "average_order_revenue", "average_unit_price")
    return rounded(
        out, 6, "leading_country_share", "leading_channel_share", "leading_category_share", "delivered_order_rate",
        "latest_month_change",
    )


@register(
    "leaders",
    lines_with(
        ", ".join(_leader(d) for d in ("country", "channel", "category")),
        "SELECT "
        + ", ".join(
            f"(SELECT label FROM l_{d}) AS leading_{d}, round((SELECT v FROM l_{d}) / CAST(sum(revenue) AS DOUBLE), 6) AS leading_{d}_share"
            for d in ("country", "channel", "category")
        )
        + " FROM sales",
    ),
)
def leaders(spark, sf):
    df = star.enriched(spark, sf, "country", "channel", "category", "revenue", "valid_sales_flag")
    return rounded(kpis.leaders(df), 6, "leading_country_share", "leading_channel_share", "leading_category_share")


def _ranked(d: str) -> str:
    return (
        f"r_{d} AS (SELECT {d} AS label, CAST(sum(revenue) AS DOUBLE) AS v, row_number() OVER (ORDER BY sum(revenue) DESC, {d}) AS p, "
        f"count(*) OVER () AS n FROM sales WHERE {d} IS NOT NULL GROUP BY {d})"
    )


@register(
    "insight_metrics",
    lines_with(
        ", ".join(_ranked(d) for d in ("country", "channel", "category")) + ",\n" + _MONTHS + """,
        cust AS (SELECT sum(revenue) AS v FROM sales GROUP BY user_id, customer_name, country ORDER BY sum(revenue) DESC, user_id LIMIT 10)""",
        "SELECT "
        + ", ".join(
            f"(SELECT label FROM r_{d} WHERE p = 1) AS first_{d}, (SELECT v FROM r_{d} WHERE p = 1) AS first_{d}_revenue, "
            f"round((SELECT v FROM r_{d} WHERE p = 1) / CAST(sum(revenue) AS DOUBLE), 6) AS first_{d}_share, "
            f"(SELECT label FROM r_{d} WHERE p = 2) AS second_{d}, (SELECT label FROM r_{d} WHERE p = n) AS last_{d}"
            for d in ("country", "channel", "category")
        )
        + ", round(CAST((SELECT sum(v) FROM cust) AS DOUBLE) / CAST(sum(revenue) AS DOUBLE), 6) AS top_customer_share, "
        "round((SELECT avg(CASE WHEN s = 'delivered' THEN 1.0 ELSE 0.0 END) FROM st), 6) AS delivered_rate, "
        "round((SELECT avg(CASE WHEN s = 'cancelled' THEN 1.0 ELSE 0.0 END) FROM st), 6) AS cancelled_rate, "
        "round((SELECT d FROM lastchg), 6) AS latest_change FROM sales",
    ),
)
def insight_metrics(spark, sf):
    df = star.master(
        spark, sf, "order_id", "line_number", "user_id", "customer_name", "order_status", "country", "channel", "category",
        "year_month", "revenue", "valid_sales_flag",
    )
    return rounded(
        kpis.insight_metrics(df), 6, "first_country_share", "first_channel_share", "first_category_share",
        "top_customer_share", "delivered_rate", "cancelled_rate", "latest_change",
    )


# ---------------------------------------------------------------- summaries
def _dimension(column: str) -> None:
    sql = lines(
        f"SELECT {column}, CAST(sum(revenue) AS DOUBLE) AS revenue, sum(quantity) AS unidades, count(DISTINCT order_id) AS pedidos, "
        f"count(DISTINCT user_id) AS clientes, round(CAST(sum(revenue) AS DOUBLE) / CAST(sum(sum(revenue)) OVER () AS DOUBLE) * 100, 6) "
        f"AS participacion_revenue_pct, round(CAST(sum(revenue) AS DOUBLE) / count(DISTINCT order_id), 4) AS revenue_por_pedido "
        f"FROM sales GROUP BY {column}"
    )

    @register(f"dimension_summary_{column}", sql)
    def summary(spark, sf):
        out = kpis.dimension_summary(star.sales(spark, sf, column, "revenue", "quantity", "order_id", "user_id"), column)
        return rounded(rounded(out, 6, "participacion_revenue_pct"), 4, "revenue_por_pedido")


for _column in ("country", "channel", "category", "price_segment"):
    _dimension(_column)


@register(
    "status_summary",
    lines(
        "SELECT order_status, count(DISTINCT order_id) AS pedidos, count(line_number) AS lineas, sum(quantity) AS unidades, "
        "CAST(sum(revenue) AS DOUBLE) AS revenue, round(count(DISTINCT order_id) * 100.0 / (SELECT count(DISTINCT order_id) FROM e), 6) "
        "AS porcentaje_pedidos FROM e GROUP BY order_status"
    ),
)
def status_summary(spark, sf):
    df = star.enriched(spark, sf, "order_id", "line_number", "order_status", "quantity", "revenue")
    return rounded(kpis.status_summary(df), 6, "porcentaje_pedidos")


@register(
    "revenue_stage_summary",
    lines(
        "SELECT CASE order_status WHEN 'delivered' THEN 'realizado' WHEN 'cancelled' THEN 'cancelado' ELSE 'en_proceso' END AS "
        "revenue_stage, count(*) AS lineas, count(DISTINCT order_id) AS pedidos, CAST(sum(revenue) AS DOUBLE) AS revenue, "
        "round(CAST(sum(revenue) AS DOUBLE) / CAST(sum(sum(revenue)) OVER () AS DOUBLE) * 100, 6) AS participacion_pct FROM sales GROUP BY 1"
    ),
)
def revenue_stage_summary(spark, sf):
    df = star.sales(spark, sf, "order_id", "line_number", "order_status", "revenue")
    return rounded(kpis.revenue_stage_summary(df), 6, "participacion_pct")


@register(
    "status_value_split",
    lines_with(
        """v AS (SELECT CAST(sum(revenue) AS DOUBLE) AS gross,
            CAST(sum(revenue) FILTER (order_status = 'delivered') AS DOUBLE) AS delivered,
            CAST(sum(revenue) FILTER (order_status = 'cancelled') AS DOUBLE) AS cancelled,
            CAST(sum(revenue) FILTER (order_status IN ('confirmed', 'shipped')) AS DOUBLE) AS pipeline FROM sales)""",
        "SELECT gross, delivered, cancelled, pipeline, round(delivered / gross, 6) AS delivered_share, "
        "round(cancelled / gross, 6) AS cancelled_share, round(pipeline / gross, 6) AS pipeline_share, "
        "round(gross * greatest(cancelled / gross - 0.09, 0), 2) AS potential_recovery FROM v",
    ),
)
def status_value_split(spark, sf):
    out = kpis.status_value_split(star.sales(spark, sf, "order_status", "revenue"))
    return rounded(rounded(out, 6, "delivered_share", "cancelled_share", "pipeline_share"), 2, "potential_recovery")


@register(
    "country_channel_matrix",
    lines(
        "SELECT country, "
        + ", ".join(f"CAST(coalesce(sum(revenue) FILTER (channel = '{c}'), 0) AS DOUBLE) AS \"{c}\"" for c in CHANNELS)
        + " FROM sales GROUP BY country"
    ),
)
def country_channel_matrix(spark, sf):
    return kpis.pivot_revenue(star.sales(spark, sf, "country", "channel", "revenue"), "country", "channel", CHANNELS)


def _status_matrix(index: str) -> None:
    statuses = ("confirmed", "shipped", "delivered", "cancelled")
    sql = lines_with(
        f"m AS (SELECT {index}, "
        + ", ".join(f"CAST(coalesce(sum(revenue) FILTER (order_status = '{s}'), 0) AS DOUBLE) AS {s}" for s in statuses)
        + f", CAST(sum(revenue) AS DOUBLE) AS total FROM sales GROUP BY {index})",
        f"SELECT {index}, {', '.join(statuses)}, round(total, 2) AS total, round(delivered / total, 6) AS delivered_share, "
        "round(cancelled / total, 6) AS cancel_share FROM m",
    )

    @register(f"{index}_status_matrix", sql)
    def matrix(spark, sf):
        out = kpis.status_matrix(star.sales(spark, sf, index, "order_status", "revenue"), index)
        return rounded(rounded(out, 2, "total"), 6, "delivered_share", "cancel_share")


for _index in ("channel", "country"):
    _status_matrix(_index)


def _series(name: str, *period: str) -> None:
    keys = ", ".join(period)
    sql = lines_with(
        f"s AS (SELECT {keys}, CAST(sum(revenue) AS DOUBLE) AS revenue, sum(quantity) AS unidades, count(DISTINCT order_id) AS pedidos "
        f"FROM sales GROUP BY {keys})",
        f"SELECT *, round((revenue - lag(revenue) OVER (ORDER BY {keys})) / lag(revenue) OVER (ORDER BY {keys}) * 100, 6) "
        "AS variacion_revenue_pct FROM s",
    )

    @register(name, sql)
    def series(spark, sf):
        df = star.sales(spark, sf, *period, "revenue", "quantity", "order_id")
        return rounded(kpis.period_series(df, *period), 6, "variacion_revenue_pct")


_series("monthly_series", "year_month")
_series("quarterly_series", "year", "quarter")


@register(
    "quarter_totals",
    lines("SELECT 'Q' || quarter AS period, CAST(sum(revenue) AS DOUBLE) AS value FROM sales GROUP BY 1"),
)
def quarter_totals(spark, sf):
    return kpis.quarter_totals(star.sales(spark, sf, "quarter", "revenue"))


@register(
    "monthly_variability",
    lines_with(
        "m AS (SELECT year_month, CAST(sum(revenue) AS DOUBLE) AS v FROM sales GROUP BY 1)",
        "SELECT count(*) AS months, round(stddev_samp(v) / avg(v), 6) AS monthly_cv, "
        "(SELECT year_month FROM m ORDER BY v DESC, 1 LIMIT 1) AS best_month, max(v) AS best_value, "
        "(SELECT year_month FROM m ORDER BY v, 1 LIMIT 1) AS lowest_month, min(v) AS lowest_value FROM m",
    ),
)
def monthly_variability(spark, sf):
    return rounded(kpis.monthly_variability(star.sales(spark, sf, "year_month", "revenue")), 6, "monthly_cv")


# ---------------------------------------------------------------- rankings
def _top(name: str, keys: tuple[str, ...]) -> None:
    cols = ", ".join(keys)
    sql = lines(
        f"SELECT {cols}, CAST(sum(revenue) AS DOUBLE) AS value, sum(quantity) AS units, count(DISTINCT order_id) AS orders, "
        f"round(CAST(sum(revenue) AS DOUBLE) / (SELECT CAST(sum(revenue) AS DOUBLE) FROM sales), 6) AS share "
        f"FROM sales GROUP BY {cols} ORDER BY sum(revenue) DESC, {keys[0]} LIMIT 10"
    )
    share_sql = lines_with(
        f"t AS (SELECT {keys[0]}, sum(revenue) AS v FROM sales GROUP BY {cols}), b AS (SELECT v FROM t ORDER BY v DESC, {keys[0]} LIMIT 10)",
        "SELECT count(*) AS entities, round(CAST((SELECT sum(v) FROM b) AS DOUBLE) / CAST(sum(v) AS DOUBLE), 6) AS top_share FROM t",
    )

    @register(f"top_{name}", sql)
    def top(spark, sf):
        df = star.sales(spark, sf, *keys, "order_id", "revenue", "quantity")
        return rounded(rankings.top_entities(df, keys), 6, "share")

    @register(f"top_{name}_share", share_sql)
    def top_share(spark, sf):
        return rounded(rankings.top_share(star.sales(spark, sf, *keys, "revenue"), keys), 6, "top_share")


_top("customers", rankings.CUSTOMER)
_top("products", rankings.PRODUCT)

_PARETO = """t AS (SELECT user_id, customer_name, country, retailer_type, sum(revenue) AS r, sum(quantity) AS unidades,
    count(DISTINCT order_id) AS pedidos, count(DISTINCT category) AS categorias FROM sales GROUP BY ALL),
p AS (SELECT *, CAST(r AS DOUBLE) / CAST(sum(r) OVER () AS DOUBLE) * 100 AS share,
    CAST(sum(r) OVER (ORDER BY r DESC, user_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) / CAST(sum(r) OVER () AS DOUBLE) * 100 AS running FROM t)"""


def _customers(spark, sf):
    return rankings.customer_summary(
        star.sales(
            spark, sf, "user_id", "customer_name", "country", "retailer_type", "revenue", "quantity", "order_id", "category"
        )
    )


@register(
    "pareto_customers",
    lines_with(
        _PARETO,
        "SELECT user_id, customer_name, country, retailer_type, CAST(r AS DOUBLE) AS revenue, unidades, pedidos, categorias, "
        "round(share, 6) AS participacion_pct, round(running, 6) AS participacion_acumulada_pct FROM p",
    ),
)
def pareto_customers(spark, sf):
    return rounded(_customers(spark, sf), 6, "participacion_pct", "participacion_acumulada_pct")


@register(
    "customers_to_80",
    lines_with(_PARETO, "SELECT count(*) FILTER (running < 80) + 1 AS customers_to_share, count(*) AS customers FROM p"),
)
def customers_to_80(spark, sf):
    return rankings.customers_to_share(_customers(spark, sf))


_PRODUCTS = """a AS (SELECT * FROM sales WHERE order_status <> 'cancelled'),
ps AS (SELECT product_id, product_name, category, brand, price_segment, sum(quantity) AS unidades, CAST(sum(revenue) AS DOUBLE) AS revenue,
    count(DISTINCT order_id) AS pedidos, CAST(sum(unit_price) AS DOUBLE) / count(unit_price) AS precio, avg(discount_percentage) AS descuento,
    count(DISTINCT country) AS paises, count(DISTINCT channel) AS canales, max(inventory) AS inventario_catalogo FROM a GROUP BY ALL),
best AS (SELECT * FROM ps ORDER BY unidades DESC, revenue DESC, product_id, price_segment LIMIT 10)"""
_PRODUCT_OUT = (
    "product_id, product_name, category, brand, price_segment, unidades, revenue, pedidos, precio AS precio_promedio, "
    "descuento AS descuento_promedio, paises, canales, inventario_catalogo"
)


def _active(spark, sf):
    return active_sales(
        star.enriched(
            spark, sf, *rankings.PRODUCT, "price_segment", "quantity", "revenue", "order_id", "unit_price", "discount_percentage",
            "country", "channel", "inventory", "order_status", "valid_sales_flag",
        )
    )


@register("product_ranking", lines_with(_PRODUCTS, f"SELECT {_PRODUCT_OUT} FROM ps"))
def product_ranking(spark, sf):
    return rankings.product_summary(_active(spark, sf))


@register("top_10_products", lines_with(_PRODUCTS, f"SELECT {_PRODUCT_OUT} FROM best"))
def top_10_products(spark, sf):
    return rankings.top_products(_active(spark, sf))


@register(
    "top_commonality",
    lines_with(
        _PRODUCTS + ", m AS (SELECT a.*, product_id IN (SELECT product_id FROM best) AS t FROM a)",
        "SELECT round(sum(quantity) FILTER (t) / sum(quantity) * 100, 6) AS participacion_en_unidades_pct, "
        "round(CAST(sum(revenue) FILTER (t) AS DOUBLE) / CAST(sum(revenue) AS DOUBLE) * 100, 6) AS participacion_en_revenue_pct, "
        "round(avg(discount_percentage) FILTER (t), 6) AS descuento_promedio_top10, "
        "round(avg(discount_percentage) FILTER (NOT t), 6) AS descuento_promedio_otros, "
        "round((SELECT avg(paises) FROM best), 6) AS paises_promedio_por_producto_top10, "
        "(SELECT count(*) FROM best WHERE canales = 3) AS productos_top_presentes_en_3_canales FROM m",
    ),
)
def top_commonality(spark, sf):
    return rounded(
        rankings.top_commonality(_active(spark, sf)), 6, "participacion_en_unidades_pct", "participacion_en_revenue_pct",
        "descuento_promedio_top10", "descuento_promedio_otros", "paises_promedio_por_producto_top10",
    )


@register(
    "top_segment_counts", lines_with(_PRODUCTS, "SELECT price_segment, count(*) AS productos FROM best GROUP BY 1")
)
def top_segment_counts(spark, sf):
    return rankings.top_segment_counts(_active(spark, sf))


@register(
    "customers_without_sales",
    lines("SELECT id AS user_id, c_name AS customer_name FROM buyers WHERE id NOT IN (SELECT user_id FROM sales WHERE user_id IS NOT NULL)"),
)
def customers_without_sales(spark, sf):
    users = star.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("customer_name"))
    return rankings.customers_without_sales(users, star.sales(spark, sf, "user_id"))


@register(
    "premium_order_lines",
    lines(
        "SELECT order_id, line_number, product_id, revenue FROM e WHERE order_id IN (SELECT order_id FROM e WHERE price_segment = 'Premium')"
    ),
)
def premium_order_lines(spark, sf):
    """Semi join: all lines of the orders that hold a premium line."""
    df = star.enriched(spark, sf, *LINE_KEY, "revenue", "price_segment")
    return semi_lines(df, F.col("price_segment") == "Premium", "order_id").drop("price_segment")


# ---------------------------------------------------------------- discounts and baskets
@register(
    "discount_bands_executive",
    lines_with(
        "b AS (SELECT *, CASE WHEN discount_percentage < -0.01 THEN NULL WHEN discount_percentage <= 5 THEN 0 WHEN discount_percentage <= 10 "
        "THEN 1 WHEN discount_percentage <= 15 THEN 2 WHEN discount_percentage <= 20 THEN 3 WHEN discount_percentage <= 25 THEN 4 END AS i FROM sales)",
        "SELECT i AS band_index, ['0–5%', '5–10%', '10–15%', '15–20%', '20–25%'][i + 1] AS discount_band, CAST(sum(revenue) AS DOUBLE) "
        "AS value, round(avg(quantity), 6) AS avg_quantity FROM b WHERE i IS NOT NULL GROUP BY i",
    ),
)
def discount_bands_executive(spark, sf):
    out = baskets.discount_bands_executive(star.sales(spark, sf, "discount_percentage", "revenue", "quantity"))
    return rounded(out, 6, "avg_quantity")


@register(
    "discount_bands",
    lines_with(
        "b AS (SELECT *, CASE WHEN discount_percentage <= 0 THEN 0 WHEN discount_percentage <= 10 THEN 1 WHEN discount_percentage <= 20 "
        "THEN 2 WHEN discount_percentage > 20 THEN 3 END AS i FROM sales)",
        "SELECT k.i AS orden, ['0%', '>0–10%', '>10–20%', '>20%'][k.i + 1] AS banda_descuento, count(b.order_id) AS lineas, "
        "coalesce(sum(quantity), 0) AS unidades, CAST(coalesce(sum(revenue), 0) AS DOUBLE) AS revenue, "
        "quantile_cont(quantity, 0.5) AS cantidad_mediana, round(quantile_cont(rating, 0.5), 6) AS rating_mediano "
        "FROM (VALUES (0), (1), (2), (3)) AS k(i) LEFT JOIN b ON b.i = k.i GROUP BY k.i",
    ),
)
def discount_bands(spark, sf):
    out = baskets.discount_bands(star.sales(spark, sf, "discount_percentage", "revenue", "quantity", "rating"))
    return rounded(out, 6, "rating_mediano")


@register(
    "discount_correlations",
    lines(
        "SELECT round(corr(discount_percentage, quantity), 6) AS discount_quantity_corr, "
        "round(corr(discount_percentage, CAST(revenue AS DOUBLE)), 6) AS discount_revenue_corr FROM sales"
    ),
)
def discount_correlations(spark, sf):
    out = baskets.discount_correlations(star.sales(spark, sf, "discount_percentage", "quantity", "revenue"))
    return rounded(out, 6, "discount_quantity_corr", "discount_revenue_corr")


@register(
    "discount_hypothesis",
    lines_with(
        "d AS (SELECT CAST(sum(revenue) AS DOUBLE) AS a, CAST(sum(revenue * (100 - CAST(discount_percentage AS DECIMAL(9,4)))) AS DOUBLE) / 100 "
        "AS b FROM sales)",
        "SELECT a AS revenue_bruto_registrado, round(b, 4) AS revenue_hipotetico_despues_descuento, round(a - b, 4) AS diferencia_hipotetica FROM d",
    ),
)
def discount_hypothesis(spark, sf):
    out = baskets.discount_hypothesis(star.sales(spark, sf, "discount_percentage", "revenue"))
    return rounded(out, 4, "revenue_hipotetico_despues_descuento", "diferencia_hipotetica")


@register(
    "category_baskets",
    lines_with(
        "o AS (SELECT order_id, count(DISTINCT coalesce(category, '?')) AS n, max(CAST(category = 'ECONOMY' AS INTEGER)) AS a, "
        "max(CAST(category = 'SMALL' AS INTEGER)) AS x, max(CAST(category = 'LARGE' AS INTEGER)) AS y FROM sales GROUP BY 1)",
        "SELECT count(*) AS orders, round(avg(CASE WHEN n >= 2 THEN 1.0 ELSE 0.0 END), 6) AS multi_category_share, "
        "CAST(sum(a) AS BIGINT) AS anchor_orders, round(CAST(sum(a * x) AS DOUBLE) / sum(a), 6) AS \"attach_SMALL\", "
        "round(CAST(sum(a * y) AS DOUBLE) / sum(a), 6) AS \"attach_LARGE\" FROM o",
    ),
)
def category_baskets(spark, sf):
    out = baskets.category_baskets(star.sales(spark, sf, "order_id", "category"), "ECONOMY", ["SMALL", "LARGE"])
    return rounded(out, 6, "multi_category_share", "attach_SMALL", "attach_LARGE")


# ---------------------------------------------------------------- outliers
_STUDY = (*outliers.MEASURES,)
_Q = "quantile_cont(CAST({c} AS DOUBLE), {p})"


def _report_sql(c: str) -> str:
    return (
        f"SELECT '{c}' AS variable, q1, q3, iqr, q1 - 1.5 * iqr AS lo, q3 + 1.5 * iqr AS hi, (SELECT count(*) FROM e WHERE CAST({c} AS DOUBLE) "
        f"< q1 - 1.5 * iqr OR CAST({c} AS DOUBLE) > q3 + 1.5 * iqr) AS n FROM (SELECT q1, q3, q3 - q1 AS iqr FROM (SELECT "
        f"{_Q.format(c=c, p=0.25)} AS q1, {_Q.format(c=c, p=0.75)} AS q3 FROM e))"
    )


@register(
    "iqr_report",
    lines_with(
        "r AS (" + " UNION ALL ".join(_report_sql(c) for c in _STUDY) + ")",
        "SELECT variable, round(q1, 6) AS q1, round(q3, 6) AS q3, round(iqr, 6) AS iqr, round(lo, 6) AS limite_inferior, "
        "round(hi, 6) AS limite_superior, n AS outliers, round(n * 100.0 / (SELECT count(*) FROM e), 6) AS porcentaje FROM r",
    ),
)
def iqr_report(spark, sf):
    out = outliers.iqr_report(star.master(spark, sf, *_STUDY), _STUDY)
    return rounded(out, 6, "q1", "q3", "iqr", "limite_inferior", "limite_superior", "porcentaje")


def _low_high(c: str) -> str:
    q1, q3 = _Q.format(c=c, p=0.25), _Q.format(c=c, p=0.75)
    return f"{q1} - 1.5 * ({q3} - {q1}) AS lo_{c}, {q3} + 1.5 * ({q3} - {q1}) AS hi_{c}"


def _out(c: str) -> str:
    return f"coalesce(CAST({c} AS DOUBLE) < lo_{c} OR CAST({c} AS DOUBLE) > hi_{c}, FALSE)"


# the star tables have heavy-tailed prices, so the price takes the part that revenue has in the reports
_FLAGGED = (
    "edges AS (SELECT " + ", ".join(map(_low_high, _STUDY)) + " FROM e), "
    f"f AS (SELECT e.*, {_out('unit_price')} AS pu, {_out('revenue')} AS pr, " + " OR ".join(map(_out, _STUDY)) + " AS any_outlier_iqr, "
    "concat_ws(', ', " + ", ".join(f"CASE WHEN {_out(c)} THEN '{c}' END" for c in _STUDY) + ") AS outlier_variables FROM e CROSS JOIN edges)"
)


def _flagged(spark, sf, *columns, measures=_STUDY):
    return outliers.flag_outliers(star.master(spark, sf, *dict.fromkeys((*columns, *measures))), measures)


@register(
    "outlier_flags",
    lines_with(
        "edges AS (SELECT " + ", ".join(map(_low_high, _STUDY)) + " FROM e), f AS (SELECT order_id, line_number, product_id, "
        + ", ".join(f"{_out(c)} AS {c}_outlier_iqr" for c in _STUDY)
        + " FROM e CROSS JOIN edges)",
        "SELECT *, " + " OR ".join(f"{c}_outlier_iqr" for c in _STUDY) + " AS any_outlier_iqr, concat_ws(', ', "
        + ", ".join(f"CASE WHEN {c}_outlier_iqr THEN '{c}' END" for c in _STUDY) + ") AS outlier_variables FROM f",
    ),
)
def outlier_flags(spark, sf):
    """All eight measures on every line."""
    return outliers.flag_outliers(star.master(spark, sf, *LINE_KEY, *_STUDY)).drop(*_STUDY)


@register(
    "outlier_price_history",
    lines_with(
        _FLAGGED,
        "SELECT product_id, product_name, order_id, order_date, unit_price, catalog_price, price_difference, quantity, revenue, any_outlier_iqr, "
        "outlier_variables FROM f WHERE product_id IN (SELECT product_id FROM f WHERE any_outlier_iqr)",
    ),
)
def outlier_price_history(spark, sf):
    df = _flagged(spark, sf, "product_id", "product_name", "order_id", "order_date", "catalog_price", "price_difference")
    return outliers.product_price_history(df)


_SUMMARY = _FLAGGED + """,
h AS (SELECT * FROM f WHERE product_id IN (SELECT product_id FROM f WHERE any_outlier_iqr)),
s AS (SELECT product_id, product_name, category, brand, count(*) AS lineas_historicas, count(DISTINCT order_id) AS pedidos_distintos,
    count(*) FILTER (any_outlier_iqr) AS lineas_con_algun_outlier, count(*) FILTER (pu) AS lineas_outlier_precio,
    count(*) FILTER (pr) AS lineas_outlier_revenue, count(DISTINCT unit_price) AS precios_historicos_distintos,
    CAST(min(unit_price) AS DOUBLE) AS precio_minimo, CAST(max(unit_price) AS DOUBLE) AS precio_maximo,
    CAST(sum(unit_price) AS DOUBLE) / count(unit_price) AS pm, coalesce(stddev_samp(CAST(unit_price AS DOUBLE)), 0) AS ds,
    CAST(min(catalog_price) AS DOUBLE) AS catalog_price_minimo, CAST(max(catalog_price) AS DOUBLE) AS catalog_price_maximo,
    min(quantity) AS cantidad_minima, max(quantity) AS cantidad_maxima, CAST(max(revenue) AS DOUBLE) AS revenue_maximo
    FROM h GROUP BY product_id, product_name, category, brand)"""


def _price_summary(spark, sf):
    df = _flagged(spark, sf, *rankings.PRODUCT, "order_id", "catalog_price", "quantity")
    return outliers.product_price_summary(df)


@register(
    "product_price_summary",
    lines_with(
        _SUMMARY,
        "SELECT s.* EXCLUDE (pm, ds), pm AS precio_promedio, round(ds, 4) AS desviacion_precio, "
        "round(precio_maximo - precio_minimo, 4) AS variacion_precio, round((precio_maximo - precio_minimo) / precio_minimo * 100, 4) "
        "AS variacion_precio_pct, precios_historicos_distintos > 1 AS presenta_variacion_precio, CASE WHEN lineas_outlier_precio > 0 AND "
        "lineas_outlier_revenue > 0 THEN 'Precio y revenue' WHEN lineas_outlier_precio > 0 THEN 'Precio' WHEN lineas_outlier_revenue > 0 "
        "THEN 'Revenue sin precio atípico' ELSE 'Otra variable' END AS tipo_alerta FROM s",
    ),
)
def product_price_summary(spark, sf):
    out = outliers.ranked_price_summary(_price_summary(spark, sf))
    return rounded(out, 4, "desviacion_precio", "variacion_precio", "variacion_precio_pct")


@register(
    "alert_counts",
    lines_with(
        _SUMMARY,
        "SELECT count(*) AS productos, count(*) FILTER (precios_historicos_distintos > 1) AS con_variacion_precio, "
        "count(*) FILTER (lineas_outlier_precio > 0) AS con_outlier_precio, count(*) FILTER (lineas_outlier_revenue > 0) "
        "AS con_outlier_revenue FROM s",
    ),
)
def alert_counts(spark, sf):
    return outliers.alert_counts(_price_summary(spark, sf))


@register(
    "top_outlier_lines",
    lines_with(
        _FLAGGED,
        "SELECT order_id, line_number, product_id, unit_price, quantity, revenue FROM f WHERE pu ORDER BY unit_price DESC, order_id, "
        "line_number, product_id LIMIT 15",
    ),
)
def top_outlier_lines(spark, sf):
    df = _flagged(spark, sf, *LINE_KEY, "quantity", "revenue", measures=("unit_price",))
    return outliers.top_outlier_lines(df, "unit_price").select(*LINE_KEY, "unit_price", "quantity", "revenue")


@register(
    "outlier_sensitivity",
    lines_with(
        _FLAGGED + ", v AS (SELECT * FROM f WHERE valid_sales_flag), t AS (SELECT CAST(sum(revenue) AS DOUBLE) AS whole FROM v), "
        "u AS (SELECT 'Líneas válidas completas' AS escenario, count(*) AS lineas, CAST(sum(revenue) AS DOUBLE) AS revenue FROM v "
        "UNION ALL SELECT 'Sin outliers IQR de unit_price', count(*), CAST(sum(revenue) AS DOUBLE) FROM v WHERE NOT pu)",
        "SELECT escenario, lineas, revenue, round(revenue / lineas, 4) AS ticket_medio_linea, round((revenue / whole - 1) * 100, 6) "
        "AS cambio_revenue_vs_completo_pct, round(1 - revenue / whole, 6) AS participacion_outliers FROM u, t",
    ),
)
def outlier_sensitivity(spark, sf):
    df = _flagged(spark, sf, "revenue", "valid_sales_flag", measures=("unit_price",)).filter("valid_sales_flag")
    out = outliers.outlier_sensitivity(df, "unit_price")
    return rounded(rounded(out, 4, "ticket_medio_linea"), 6, "cambio_revenue_vs_completo_pct", "participacion_outliers")


@register(
    "revenue_distribution",
    lines_with(
        """x AS (SELECT CAST(revenue AS DOUBLE) AS v FROM e WHERE revenue IS NOT NULL),
        b AS (SELECT min(v) AS lo, (max(v) - min(v)) / 30 AS w FROM x),
        c AS (SELECT CAST(least(floor((v - lo) / w), 29) AS INTEGER) AS bin, count(*) AS n FROM x, b GROUP BY 1)""",
        "SELECT CAST(i AS INTEGER) AS bin, round(lo + i * w, 4) AS lower, round(lo + (i + 1) * w, 4) AS upper, coalesce(n, 0) AS lineas "
        "FROM range(30) AS r(i) CROSS JOIN b LEFT JOIN c ON c.bin = i",
    ),
)
def revenue_distribution(spark, sf):
    return rounded(outliers.distribution(star.enriched(spark, sf, "revenue")), 4, "lower", "upper")


@register(
    "price_box_statistics",
    lines_with(
        "x AS (SELECT CAST(unit_price AS DOUBLE) AS v, u1, u3, u1 - 1.5 * (u3 - u1) AS lo, u3 + 1.5 * (u3 - u1) AS hi FROM e CROSS JOIN fences)",
        "SELECT round(min(u1), 6) AS q1, round(quantile_cont(v, 0.5), 6) AS mediana, round(min(u3), 6) AS q3, min(v) FILTER (v >= lo) "
        "AS bigote_inferior, max(v) FILTER (v <= hi) AS bigote_superior, count(*) FILTER (v < lo OR v > hi) AS atipicos FROM x",
    ),
)
def price_box_statistics(spark, sf):
    return rounded(outliers.box_statistics(star.master(spark, sf, "unit_price"), "unit_price"), 6, "q1", "mediana", "q3")
