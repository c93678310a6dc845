"""Datasets behind the dashboard: scenario columns on every line, indicators, views, scenario series."""

from __future__ import annotations

from pyspark.sql import DataFrame

from orderlens.models.quantity_model import attach_predictions
from orderlens.operators.filters import selected
from orderlens.operators.kpis import calculate_kpis, insight_metrics
from orderlens.operators.scenarios import (
    board_groups,
    build_retrospective_scenarios,
    kpi_board,
    missing_listing,
    scenario_monthly,
    scenario_totals,
)
from orderlens.session import stored


def scenario_lines(orders: DataFrame, predictions: DataFrame | None = None) -> DataFrame:
    """Lines with minimum, maximum and, where there are predictions, forest columns."""
    lines = build_retrospective_scenarios(orders)
    return attach_predictions(lines, predictions) if predictions is not None else lines


def datasets(orders: DataFrame, predictions: DataFrame | None = None, scenario: str = "Original", **dimensions) -> dict[str, DataFrame]:
    """Every view for one scenario and one selection of dimensions; the lines are computed once."""
    lines = stored(scenario_lines(orders, predictions))
    rows = selected(lines, **dimensions)
    return {
        "kpis": calculate_kpis(orders),
        "insights": insight_metrics(orders),
        "board": kpi_board(rows, scenario),
        "groups": board_groups(rows, scenario),
        "scenarios": scenario_totals(rows),
        "scenario_months": scenario_monthly(rows),
        "missing": missing_listing(lines),
    }
