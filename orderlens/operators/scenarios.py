"""What-if scenarios for missing quantities. Source columns are never changed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.fixed_values import (
    ESTIMATION_LEVELS,
    MIN_REFERENCE_COUNT,
    MIN_WHOLESALE_QUANTITY,
    NO_DATA,
    ORIGINAL_VALUE,
    REFERENCE_PERCENTILE,
    SCENARIOS,
)
from orderlens.functions.numbers import line_value, share
from orderlens.operators.filters import with_defaults
from orderlens.operators.kpis import DIMENSIONS, leader_values, rolled_up, shown, total
from orderlens.session import materialize

LEVEL_KEYS = ("user_id", "product_id", "category", "brand")
LISTING_COLUMNS = (
    "order_id", "user_id", "order_date", "order_status", "product_id", "product_name", "category", "brand",
    "unit_price", "quantity", "revenue", "quantity_scenario_min", "quantity_scenario_max", "revenue_scenario_min",
    "revenue_scenario_max", "quantity_estimation_method", "quantity_reference_count", "quantity_reference_p90",
)
ORDER_KEYS = ("order_id", "user_id", "order_date", "order_status", "channel")
FALLBACK = {
    "quantity_scenario_min": "quantity", "quantity_rf_estimated": "quantity", "quantity_scenario_max": "quantity",
    "revenue_scenario_min": "revenue", "revenue_rf_estimated": "revenue", "revenue_scenario_max": "revenue",
}


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str):
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[prefix + k]) for k in keys])


def _level_hits(histogram: DataFrame, keys: Sequence[str], level: int, minimum: int, percentile: float) -> DataFrame:
    """Groups of one level with enough known quantities: (keys, support, exact percentile)."""
    return (
        histogram.groupBy(*[F.col(k).alias(f"_l_{k}") for k in keys])
        .agg(F.sum("n").alias("_n"), F.percentile("quantity", percentile, F.col("n")).alias("_p"))
        .filter(F.col("_n") >= minimum)
        .select(*[f"_l_{k}" for k in keys], F.struct(F.lit(level).alias("level"), "_n", "_p").alias(f"_hit{level}"))
    )


def _resolve(wanted: DataFrame, by_user: DataFrame, by_product: DataFrame, minimum: int, percentile: float) -> DataFrame:
    """Each wanted key combination with the first level that has enough known quantities."""
    resolved = wanted
    grouped = [keys for _, keys in ESTIMATION_LEVELS if keys]
    for level, keys in enumerate(grouped):
        histogram = by_user if "user_id" in keys else by_product
        hits = _level_hits(histogram, keys, level, minimum, percentile)
        resolved = resolved.join(hits, _null_safe(resolved, hits, keys, "_l_"), "left").drop(*[f"_l_{k}" for k in keys])
    return resolved.select(
        *[F.col(k).alias(f"_r_{k}") for k in LEVEL_KEYS], F.coalesce(*[F.col(f"_hit{i}") for i in range(len(grouped))]).alias("_hit")
    )


def build_retrospective_scenarios(
    df: DataFrame,
    minimum: int = MIN_WHOLESALE_QUANTITY,
    percentile: float = REFERENCE_PERCENTILE,
    min_references: int = MIN_REFERENCE_COUNT,
) -> DataFrame:
    """Minimum and hierarchical maximum per line, with the method, its support and its percentile.

    The known lines are read twice, each time into a counted histogram of quantities: one per product for
    the levels without the user, one per user and product for the users that miss a quantity. Every level
    rolls up one of the two, so a hot user or product reaches a task as counts, not as lines. Lines with a
    quantity pass through untouched; only the lines without one are joined.
    """
    quantity = F.col("quantity").cast("double")
    known = df.filter(quantity > 0).select(*LEVEL_KEYS, quantity.alias("quantity"))
    without = df.filter(quantity.isNull())
    wanted = materialize(without.select(*LEVEL_KEYS).distinct())
    count = F.count(F.lit(1)).alias("n")
    by_product = materialize(known.groupBy("product_id", "category", "brand", "quantity").agg(count))
    asked = wanted.select(F.col("user_id").alias("_w_user_id")).distinct()
    near = known.join(asked, _null_safe(known, asked, ["user_id"], "_w_"), "left_semi")
    by_user = materialize(near.groupBy(*LEVEL_KEYS, "quantity").agg(count))

    # one map entry per distinct quantity
    facts = by_product.agg(
        F.max("quantity").alias("largest"), F.coalesce(F.sum("n"), F.lit(0)).alias("references"),
        F.percentile("quantity", percentile, F.col("n")).alias("overall"),
    ).first()
    if facts["references"] < min_references and not wanted.isEmpty():
        raise ValueError("not enough known quantities to estimate the missing ones")
    largest = int(facts["largest"]) if facts["largest"] is not None else None

    resolved = _resolve(wanted, by_user, by_product, min_references, percentile)
    names = F.array(*[F.lit(name) for name, _ in ESTIMATION_LEVELS])
    level = F.coalesce("_hit.level", F.lit(len(ESTIMATION_LEVELS) - 1))
    p = F.coalesce("_hit._p", F.lit(facts["overall"]).cast("double"))
    # rounding removes the noise of interpolation before the ceiling
    ceiling = F.ceil(F.round(p, 6))
    estimated = without.join(resolved, _null_safe(without, resolved, LEVEL_KEYS, "_r_"), "left").select(
        *df.columns,
        F.lit(minimum).cast("long").alias("quantity_scenario_min"),
        F.least(F.greatest(ceiling, F.lit(minimum)), F.lit(largest)).cast("long").alias("quantity_scenario_max"),
        F.element_at(names, level + 1).alias("quantity_estimation_method"),
        F.coalesce("_hit._n", F.lit(facts["references"])).cast("long").alias("quantity_reference_count"),
        p.alias("quantity_reference_p90"),
    )
    original = df.filter(quantity.isNotNull()).select(
        *df.columns,
        F.col("quantity").cast("long").alias("quantity_scenario_min"),
        F.col("quantity").cast("long").alias("quantity_scenario_max"),
        F.lit(ORIGINAL_VALUE).alias("quantity_estimation_method"),
        F.lit(None).cast("long").alias("quantity_reference_count"),
        F.lit(None).cast("double").alias("quantity_reference_p90"),
    )
    money = dict(df.dtypes)["revenue"]
    kind = money if money.startswith("decimal") else None
    return original.unionByName(estimated).withColumns(
        {
            f"revenue_scenario_{s}": line_value(F.col("unit_price"), F.col(f"quantity_scenario_{s}"), kind)
            for s in ("min", "max")
        }
    )


def scenario_ranges(scenarios: DataFrame) -> DataFrame:
    return scenarios.withColumns(
        {
            f"{c}_scenario_range": F.col(f"{c}_scenario_max") - F.col(f"{c}_scenario_min") for c in ("quantity", "revenue")
        }
    )


def scenario_checks(scenarios: DataFrame, minimum: int = MIN_WHOLESALE_QUANTITY) -> DataFrame:
    """Violations of the scenario invariants, in one row; every count must be zero."""
    missing = F.col("quantity").isNull()
    low, high = F.col("quantity_scenario_min"), F.col("quantity_scenario_max")
    largest = scenarios.agg(F.max("quantity").cast("int").alias("_largest"))
    differs = lambda s: F.abs(F.col(f"revenue_scenario_{s}").cast("double") - F.col("revenue").cast("double")) >= 1e-8
    return scenarios.crossJoin(largest).agg(  # one-row frame
        F.count_if(missing).alias("lineas_sin_cantidad"),
        F.count_if(missing & ~low.eqNullSafe(minimum)).alias("minimo_distinto"),
        F.count_if(F.coalesce(high < low, F.lit(True))).alias("maximo_menor_que_minimo"),
        F.count_if(high > F.col("_largest")).alias("maximo_sobre_observado"),
        F.count_if(~missing & ~(low.cast("double").eqNullSafe(F.col("quantity").cast("double")))).alias("minimo_alterado"),
        F.count_if(~missing & ~(high.cast("double").eqNullSafe(F.col("quantity").cast("double")))).alias("maximo_alterado"),
        F.count_if(~missing & differs("min")).alias("revenue_minimo_alterado"),
        F.count_if(~missing & differs("max")).alias("revenue_maximo_alterado"),
    )


def scenario_comparison(scenarios: DataFrame) -> DataFrame:
    """Total value of each scenario against the original, over all lines."""
    columns = [
        ("Original conocido", "revenue"),
        ("Mínimo mayorista", "revenue_scenario_min"),
        ("Random Forest experimental", "revenue_rf_estimated"),
        ("Máximo jerárquico", "revenue_scenario_max"),
    ]
    present = [(label, c) for label, c in columns if c in scenarios.columns]
    row = scenarios.agg(*[total(c).alias(c) for _, c in present])
    stacked = row.select(
        "revenue",
        F.inline(F.array(*[F.struct(F.lit(label).alias("scenario"), shown(c).alias("revenue_total")) for label, c in present])),
    )
    gap = F.col("revenue_total") - shown("revenue")
    return stacked.select(
        "scenario", "revenue_total", gap.alias("difference_vs_original"),
        (share(gap, F.col("revenue")) * 100).alias("change_vs_original_pct"),
    )


def missing_listing(scenarios: DataFrame, columns: Sequence[str] = LISTING_COLUMNS) -> DataFrame:
    """Lines without quantity with their scenario values."""
    return scenarios.filter(F.col("quantity").isNull()).select(*[c for c in columns if c in scenarios.columns])


def affected_orders(scenarios: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Known subtotal and scenario limits of every order with a missing quantity. With the `lines` that the scenarios were
    made of, the orders concerned are read from those, not by making the scenarios twice."""
    missing = F.col("quantity").isNull()
    # the known lines of the affected orders are kept by a semi join, before anything is aggregated
    concerned = (scenarios if lines is None else lines).filter(missing & F.col("order_id").isNotNull()).select("order_id").distinct()
    touched = scenarios.join(concerned, "order_id", "left_semi")
    return (
        touched.groupBy(*ORDER_KEYS)
        .agg(
            F.count(F.lit(1)).alias("product_lines"),
            F.count_if(missing).alias("missing_quantity_lines"),
            shown(total("revenue")).alias("revenue_original_conocido"),
            shown(total("revenue_scenario_min")).alias("revenue_scenario_min"),
            shown(total("revenue_scenario_max")).alias("revenue_scenario_max"),
        )
        .withColumn("estimated_revenue_range", F.col("revenue_scenario_max") - F.col("revenue_scenario_min"))
    )


def _stacked(df: DataFrame, *keys: str) -> DataFrame:
    full = with_defaults(df, FALLBACK)
    money = dict(full.dtypes)["revenue"]
    rows = [
        F.struct(
            F.lit(label).alias("scenario"),
            F.col(r).cast(money).alias("revenue"),
            F.col(q).cast("double").alias("quantity"),
        )
        for label, q, r in SCENARIOS
    ]
    return full.select(*keys, F.inline(F.array(*rows)))


def scenario_totals(df: DataFrame) -> DataFrame:
    """Value and units of the four scenarios; a scenario without its own columns repeats the original."""
    return _stacked(df).groupBy("scenario").agg(
        shown(total("revenue")).alias("revenue"), total("quantity").alias("quantity")
    )


def scenario_monthly(df: DataFrame) -> DataFrame:
    """Monthly value of the four scenarios."""
    return (
        _stacked(df, "year_month").filter("year_month is not null").groupBy("scenario", "year_month")
        .agg(shown(total("revenue")).alias("revenue"))
    )


def kpi_board(df: DataFrame, scenario: str = "Original") -> DataFrame:
    """The ten cards of the dashboard for one scenario, over all selected lines (null measures count as zero)."""
    label, q, r = next(s for s in SCENARIOS if s[0] == scenario)
    full = with_defaults(df, FALLBACK).withColumns({"_q": F.col(q).cast("double"), "_r": F.col(r)})
    labels = [F.coalesce(d, F.lit(NO_DATA)).alias(d) for d in DIMENSIONS]
    cube = materialize(full.groupBy(*labels).agg(total("_r").alias("revenue"), total("_q").alias("quantity")))
    rolled, tests, whole = rolled_up(cube, DIMENSIONS)
    cards = rolled.agg(
        F.coalesce(F.max(F.when(whole, F.col("_revenue"))), F.lit(0)).alias("_total"),
        F.coalesce(F.max(F.when(whole, F.col("_quantity"))), F.lit(0.0)).alias("_units"), *leader_values(tests, DIMENSIONS),
    )
    # here an order counts by its last line
    delivered = F.max_by(F.col("order_status").eqNullSafe("delivered").cast("int"), F.col("line_number"))
    orders = full.groupBy("order_id").agg(delivered.alias("_delivered")).agg(
        F.count("order_id").alias("orders"), F.coalesce(F.avg("_delivered"), F.lit(0.0)).alias("delivered_share")
    )
    customers = full.agg(F.count_distinct("user_id").alias("customers"))
    return cards.crossJoin(orders).crossJoin(customers).select(  # one row each
        F.lit(label).alias("scenario"), shown("_total").alias("revenue"), F.col("_units").alias("units"),
        "orders", "customers",
        share(F.col("_total"), F.greatest("orders", F.lit(1))).alias("value_per_order"),
        share(F.col("_total"), F.when(F.col("_units") == 0, 1.0).otherwise(F.col("_units"))).alias("price_per_unit"),
        *[F.coalesce(F.col(f"_best_{d}.label"), F.lit("—")).alias(f"leading_{d}") for d in DIMENSIONS], "delivered_share",
    )


def board_groups(df: DataFrame, scenario: str = "Original", top: int = 10) -> DataFrame:
    """The nine groupings of the dashboard, one below the other: (view, label, other, value)."""
    _, q, r = next(s for s in SCENARIOS if s[0] == scenario)
    full = with_defaults(df, FALLBACK)
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(NO_DATA))
    # the label views roll up one small cube; products, customers and the matrix keep their own keys
    labels = ("country", "channel", "category", "price_segment", "year_month")
    cube = materialize(
        full.groupBy(*[name(c).alias(c) for c in labels]).agg(
            total(r).alias("_r"), F.coalesce(F.sum(F.col(q).cast("double")), F.lit(0.0)).alias("_q")
        )
    )

    def view(title: str, column: str, value: str) -> DataFrame:
        return cube.groupBy(F.col(column).alias("label")).agg(shown(F.sum(value)).alias("value")).select(
            F.lit(title).alias("view"), "label", F.lit(None).cast("string").alias("other"), "value"
        )

    def best(title: str, column: str, value) -> DataFrame:
        sums = full.groupBy(name(column).alias("label")).agg(shown(F.coalesce(F.sum(value), F.lit(0))).alias("value"))
        return sums.orderBy(F.col("value").desc(), "label").limit(top).select(
            F.lit(title).alias("view"), "label", F.lit(None).cast("string").alias("other"), "value"
        )

    matrix = (
        full.filter("country is not null and channel is not null")
        .groupBy(F.col("country").alias("label"), F.col("channel").alias("other"))
        .agg(shown(total(r)).alias("value"))
        .select(F.lit("country_channel").alias("view"), "label", "other", "value")
    )
    frames = [
        view("monthly_revenue", "year_month", "_r"), view("monthly_units", "year_month", "_q"),
        view("country", "country", "_r"), view("channel", "channel", "_r"), view("price_segment", "price_segment", "_r"),
        view("category", "category", "_r"), best("top_products", "product_name", F.col(q).cast("double")),
        best("top_customers", "customer_name", F.col(r)), matrix,
    ]
    return reduce(DataFrame.unionByName, frames)
