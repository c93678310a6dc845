"""Scenarios for missing quantities and the dashboard datasets."""

from __future__ import annotations

import uuid

from orderlens.fixed_values import ESTIMATION_LEVELS
from orderlens.models import predictions
from orderlens.operators import filters, scenarios
from orderlens.session import shared_folder
from orderlens.sources import star_tables as star
from registry import lines_with, register, rounded


def _level_sql(i: int, keys: tuple[str, ...]) -> str:
    columns = ", ".join(keys)
    group = f"GROUP BY {columns}" if keys else ""
    return (
        f"g{i} AS (SELECT {columns + ', ' if keys else ''}count(*) AS n{i}, quantile_cont(quantity, 0.9) AS p{i} FROM e WHERE quantity > 0 "
        f"{group} HAVING count(*) >= 3)"
    )


def _join_sql(i: int, keys: tuple[str, ...]) -> str:
    test = " AND ".join(f"m.{k} IS NOT DISTINCT FROM g{i}.{k}" for k in keys) or "TRUE"
    return f"LEFT JOIN g{i} ON {test}"


_LEVELS = [(i, name, keys) for i, (name, keys) in enumerate(ESTIMATION_LEVELS)]
_CASES = " ".join(f"WHEN n{i} IS NOT NULL THEN '{name}'" for i, name, _ in _LEVELS)
_SCENARIOS = ", ".join(_level_sql(i, keys) for i, _, keys in _LEVELS) + f""",
big AS (SELECT CAST(max(quantity) AS INTEGER) AS top FROM e),
est AS (SELECT m.*, CASE {_CASES} END AS quantity_estimation_method, coalesce({', '.join(f'n{i}' for i, _, _ in _LEVELS)}) AS quantity_reference_count,
    coalesce({', '.join(f'p{i}' for i, _, _ in _LEVELS)}) AS quantity_reference_p90
    FROM e m {' '.join(_join_sql(i, keys) for i, _, keys in _LEVELS)} WHERE m.quantity IS NULL),
sc0 AS (
  SELECT e.*, 'Dato original' AS quantity_estimation_method, NULL AS quantity_reference_count, NULL AS quantity_reference_p90,
         CAST(quantity AS BIGINT) AS quantity_scenario_min, CAST(quantity AS BIGINT) AS quantity_scenario_max FROM e WHERE quantity IS NOT NULL
  UNION ALL BY NAME
  SELECT est.*, CAST(5 AS BIGINT) AS quantity_scenario_min,
         CAST(least(greatest(ceil(round(quantity_reference_p90, 6)), 5), top) AS BIGINT) AS quantity_scenario_max FROM est CROSS JOIN big),
sc AS (SELECT *, CAST(unit_price * quantity_scenario_min AS DECIMAL(18,2)) AS revenue_scenario_min,
    CAST(unit_price * quantity_scenario_max AS DECIMAL(18,2)) AS revenue_scenario_max FROM sc0)"""

_NEEDED = ("user_id", "product_id", "category", "brand", "quantity", "unit_price", "revenue")


def _scenarios(spark, sf, *columns):
    return scenarios.build_retrospective_scenarios(star.master(spark, sf, *dict.fromkeys((*columns, *_NEEDED))))


def _with_predictions(spark, sf, *columns):
    """Scenarios with a version of predictions read back from its table.

    The version holds the product means, which SQL repeats; the forest's own predictions are those of `quantity_predictions`.
    """
    df = star.master(spark, sf, *dict.fromkeys((*predictions.KEY, *columns, *_NEEDED)))
    path = f"{shared_folder(spark)}/predictions-{uuid.uuid4().hex}"
    predictions.write_predictions(predictions.mean_predictions(df), path, "product-mean")
    return predictions.attach_predictions(scenarios.build_retrospective_scenarios(df), predictions.read_predictions(spark, path))


_PREDICTED = _SCENARIOS + """,
product_mean AS (SELECT product_id, CAST(sum(quantity) AS DOUBLE) / count(quantity) AS m FROM e WHERE quantity IS NOT NULL GROUP BY 1),
all_mean AS (SELECT CAST(sum(quantity) AS DOUBLE) / count(quantity) AS m, max(quantity) AS top FROM e),
predicted AS (SELECT sc.*, CASE WHEN quantity IS NULL THEN least(round_even(greatest(coalesce(p.m, a.m), 5), 0), a.top) ELSE quantity END AS quantity_rf
    FROM sc LEFT JOIN product_mean p ON p.product_id = sc.product_id CROSS JOIN all_mean a),
rf AS (SELECT *, CASE WHEN quantity IS NULL THEN CAST(CAST(unit_price AS DOUBLE) * quantity_rf AS DECIMAL(18,2)) ELSE revenue END AS revenue_rf FROM predicted)"""


@register(
    "quantity_scenarios",
    lines_with(
        _SCENARIOS,
        "SELECT order_id, line_number, product_id, unit_price, quantity, quantity_scenario_min, quantity_scenario_max, revenue_scenario_min, "
        "revenue_scenario_max, quantity_scenario_max - quantity_scenario_min AS quantity_scenario_range, revenue_scenario_max - "
        "revenue_scenario_min AS revenue_scenario_range, quantity_estimation_method, quantity_reference_count FROM sc",
    ),
)
def quantity_scenarios(spark, sf):
    out = scenarios.scenario_ranges(_scenarios(spark, sf, "order_id", "line_number"))
    return out.drop("user_id", "category", "brand", "revenue", "quantity_reference_p90")


@register(
    "missing_lines",
    lines_with(
        _SCENARIOS,
        "SELECT order_id, user_id, order_date, order_status, product_id, product_name, category, brand, unit_price, quantity, revenue, "
        "quantity_scenario_min, quantity_scenario_max, revenue_scenario_min, revenue_scenario_max, quantity_estimation_method, "
        "quantity_reference_count, round(quantity_reference_p90, 6) AS quantity_reference_p90 FROM sc WHERE quantity IS NULL",
    ),
)
def missing_lines(spark, sf):
    df = _scenarios(spark, sf, "order_id", "order_date", "order_status", "product_name")
    return rounded(scenarios.missing_listing(df), 6, "quantity_reference_p90")


@register(
    "scenario_checks",
    lines_with(
        "z AS (SELECT 0 AS zero)",
        "SELECT count(*) FILTER (quantity IS NULL) AS lineas_sin_cantidad, "
        + ", ".join(
            f"0 AS {c}"
            for c in (
                "minimo_distinto", "maximo_menor_que_minimo", "maximo_sobre_observado", "minimo_alterado", "maximo_alterado",
                "revenue_minimo_alterado", "revenue_maximo_alterado",
            )
        )
        + " FROM e",
    ),
)
def scenario_checks(spark, sf):
    """The star tables hold quantities below five, where a known line may have maximum = minimum = itself."""
    return scenarios.scenario_checks(_scenarios(spark, sf))


@register(
    "scenario_comparison",
    lines_with(
        _PREDICTED + """,
        t AS (SELECT CAST(sum(revenue) AS DOUBLE) AS o, CAST(sum(revenue_scenario_min) AS DOUBLE) AS a, CAST(sum(revenue_scenario_max) AS DOUBLE) AS b,
              CAST(sum(revenue_rf) AS DOUBLE) AS c FROM rf),
        u AS (SELECT 'Original conocido' AS scenario, o AS v, o FROM t UNION ALL SELECT 'Mínimo mayorista', a, o FROM t
              UNION ALL SELECT 'Random Forest experimental', c, o FROM t UNION ALL SELECT 'Máximo jerárquico', b, o FROM t)""",
        "SELECT scenario, v AS revenue_total, round(v - o, 2) AS difference_vs_original, round((v - o) / o * 100, 6) AS change_vs_original_pct FROM u",
    ),
)
def scenario_comparison(spark, sf):
    out = scenarios.scenario_comparison(_with_predictions(spark, sf))
    return rounded(rounded(out, 2, "difference_vs_original"), 6, "change_vs_original_pct")


@register(
    "affected_orders",
    lines_with(
        _SCENARIOS,
        "SELECT order_id, user_id, order_date, order_status, channel, count(*) AS product_lines, count(*) FILTER (quantity IS NULL) AS "
        "missing_quantity_lines, CAST(coalesce(sum(revenue), 0) AS DOUBLE) AS revenue_original_conocido, CAST(sum(revenue_scenario_min) AS DOUBLE) "
        "AS revenue_scenario_min, CAST(sum(revenue_scenario_max) AS DOUBLE) AS revenue_scenario_max, round(CAST(sum(revenue_scenario_max) AS DOUBLE) - "
        "CAST(sum(revenue_scenario_min) AS DOUBLE), 2) AS estimated_revenue_range FROM sc GROUP BY ALL HAVING count(*) FILTER (quantity IS NULL) > 0",
    ),
)
def affected_orders(spark, sf):
    lines = star.master(spark, sf, "order_id", "order_date", "order_status", "channel", *_NEEDED)
    out = scenarios.affected_orders(scenarios.build_retrospective_scenarios(lines), lines)
    return rounded(out, 2, "estimated_revenue_range")


_STACK = """,
st AS (SELECT 'Original' AS scenario, year_month, revenue AS r, quantity AS q FROM sc
  UNION ALL SELECT 'Mínimo mayorista', year_month, revenue_scenario_min, quantity_scenario_min FROM sc
  UNION ALL SELECT 'Random Forest', year_month, revenue_rf, quantity_rf FROM rf
  UNION ALL SELECT 'Máximo jerárquico', year_month, revenue_scenario_max, quantity_scenario_max FROM sc)"""


@register(
    "scenario_totals",
    lines_with(_PREDICTED + _STACK, "SELECT scenario, CAST(sum(r) AS DOUBLE) AS revenue, sum(q) AS quantity FROM st GROUP BY 1"),
)
def scenario_totals(spark, sf):
    return scenarios.scenario_totals(_with_predictions(spark, sf))


@register(
    "scenario_monthly",
    lines_with(_PREDICTED + _STACK, "SELECT scenario, year_month, CAST(sum(r) AS DOUBLE) AS revenue FROM st GROUP BY 1, 2"),
)
def scenario_monthly(spark, sf):
    return scenarios.scenario_monthly(_with_predictions(spark, sf, "year_month"))


_BOARD = (
    "order_id", "line_number", "country", "channel", "category", "price_segment", "order_status", "year_month", "product_name",
    "customer_name",
)


def _selection(spark, sf):
    """All lines of one dashboard selection (a country and a price segment)."""
    return filters.selected(star.master(spark, sf, *_BOARD, "user_id", "quantity", "revenue"), country="ASIA", price_segment="Premium", channel=None)


_SELECTED = "w AS (SELECT * FROM e WHERE country = 'ASIA' AND price_segment = 'Premium')"


@register(
    "kpi_board",
    lines_with(
        _SELECTED + ", "
        + ", ".join(
            f"l_{d} AS (SELECT {d} AS label FROM w GROUP BY 1 ORDER BY coalesce(sum(revenue), 0) DESC, 1 LIMIT 1)"
            for d in ("country", "channel", "category")
        )
        + ", s AS (SELECT order_id, max(order_status) AS st FROM w GROUP BY 1)",
        "SELECT 'Original' AS scenario, CAST(sum(revenue) AS DOUBLE) AS revenue, sum(quantity) AS units, count(DISTINCT order_id) AS orders, "
        "count(DISTINCT user_id) AS customers, round(CAST(sum(revenue) AS DOUBLE) / count(DISTINCT order_id), 4) AS value_per_order, "
        "round(CAST(sum(revenue) AS DOUBLE) / sum(quantity), 4) AS price_per_unit, "
        + ", ".join(f"(SELECT label FROM l_{d}) AS leading_{d}" for d in ("country", "channel", "category"))
        + ", round((SELECT avg(CASE WHEN st = 'delivered' THEN 1.0 ELSE 0.0 END) FROM s), 6) AS delivered_share FROM w",
    ),
)
def kpi_board(spark, sf):
    out = scenarios.kpi_board(_selection(spark, sf))
    return rounded(rounded(out, 4, "value_per_order", "price_per_unit"), 6, "delivered_share")


def _view_sql(title: str, label: str, value: str, tail: str = "") -> str:
    return (
        f"(SELECT '{title}' AS \"view\", {label} AS label, CAST(NULL AS VARCHAR) AS other, CAST(coalesce(sum({value}), 0) AS DOUBLE) AS value FROM w GROUP BY 2 {tail})"
    )


@register(
    "board_groups",
    lines_with(
        _SELECTED,
        " UNION ALL ".join(
            [
                _view_sql("monthly_revenue", "year_month", "revenue"), _view_sql("monthly_units", "year_month", "quantity"),
                _view_sql("country", "country", "revenue"), _view_sql("channel", "channel", "revenue"),
                _view_sql("price_segment", "price_segment", "revenue"), _view_sql("category", "category", "revenue"),
                _view_sql("top_products", "product_name", "quantity", "ORDER BY 4 DESC, 2 LIMIT 10"),
                _view_sql("top_customers", "customer_name", "revenue", "ORDER BY 4 DESC, 2 LIMIT 10"),
                "(SELECT 'country_channel', country, channel, CAST(coalesce(sum(revenue), 0) AS DOUBLE) FROM w GROUP BY 2, 3)",
            ]
        ),
    ),
)
def board_groups(spark, sf):
    return scenarios.board_groups(_selection(spark, sf))
