"""Indicators, leaders, summaries by dimension and period series.

Money is summed in its own (decimal) type and shown as a double at the end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.fixed_values import STATUSES
from orderlens.functions.numbers import percent, share
from orderlens.operators.filters import valid_line, valid_sales
from orderlens.session import materialize


def total(c: str) -> Column:
    """Sum that is zero, not null, over nothing."""
    return F.coalesce(F.sum(c), F.lit(0))


def shown(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


DIMENSIONS = ("country", "channel", "category")


def sales_cube(sales: DataFrame, *keys: str) -> DataFrame:
    """Revenue and units per combination of reporting labels, computed once.

    It has one row per combination, so everything that rolls it up is free of the lines.
    """
    measures = [F.sum("revenue").alias("revenue")]
    if "quantity" in sales.columns:
        measures.append(F.sum("quantity").alias("quantity"))
    return materialize(sales.groupBy(*keys).agg(*measures))


def rolled_up(cube: DataFrame, dimensions: Sequence[str]) -> tuple[DataFrame, dict[str, Column], Column]:
    """The cube rolled up over each dimension and as a whole, in one aggregation of few rows; a test that picks each
    dimension's rows, and one for the whole."""
    rolled = cube.groupingSets([[d] for d in dimensions] + [[]], *dimensions).agg(
        *[F.sum(c).alias(f"_{c}") for c in ("revenue", "quantity") if c in cube.columns], F.grouping_id(*dimensions).alias("_g")
    )
    everything = (1 << len(dimensions)) - 1
    tests = {d: F.col("_g") == everything - (1 << (len(dimensions) - 1 - i)) for i, d in enumerate(dimensions)}
    return rolled, tests, F.col("_g") == everything


def leader_values(tests: dict[str, Column], dimensions: Sequence[str]) -> list[Column]:
    """Label with the largest value (ties by label) and that value. A null label takes part."""
    return [
        F.min(F.when(tests[d], F.struct((-F.col("_revenue")).alias("v"), F.col(d).alias("label")))).alias(f"_best_{d}") for d in dimensions
    ]


def leader_columns(dimensions: Sequence[str]) -> dict[str, list[Column]]:
    part = lambda d: F.coalesce(share(-F.col(f"_best_{d}.v"), F.col("_total")), F.lit(0.0))
    return {d: [F.col(f"_best_{d}.label").alias(f"leading_{d}"), part(d).alias(f"leading_{d}_share")] for d in dimensions}


def cube_leaders(cube: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """One row: leading label and its share per dimension."""
    rolled, tests, whole = rolled_up(cube, dimensions)
    row = rolled.agg(F.max(F.when(whole, F.col("_revenue"))).alias("_total"), *leader_values(tests, dimensions))
    columns = leader_columns(dimensions)
    return row.select(*[columns[d][0] for d in dimensions], *[columns[d][1] for d in dimensions])


def leaders(df: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """Leading label and its share of the valid sales per dimension."""
    return cube_leaders(sales_cube(valid_sales(df), *dimensions), dimensions)


def period_change(series: DataFrame, period: Sequence[str], value: str = "revenue", into: str = "change") -> DataFrame:
    """Relative change against the previous observed period. `series` has one row per period."""
    before = F.lag(value).over(Window.orderBy(*period))
    return series.withColumn(into, share(F.col(value) - before, before))


def status_rates(df: DataFrame, pick=F.min_by, **names: str) -> DataFrame:
    """Share of all orders whose first line has a status, one column per status.

    The status becomes a number before it is aggregated, so that Spark can hash instead of sort.
    """
    flags = {s: F.col("order_status").eqNullSafe(s).cast("int") for s in names}
    orders = df.groupBy("order_id").agg(*[pick(flag, F.col("line_number")).alias(f"_{s}") for s, flag in flags.items()])
    return orders.agg(*[F.avg(f"_{s}").alias(name) for s, name in names.items()])


def _latest_change(cube: DataFrame, into: str) -> DataFrame:
    """One row: change of the last observed month."""
    months = cube.filter("year_month is not null").groupBy("year_month").agg(F.sum("revenue").alias("revenue"))
    return period_change(months, ["year_month"]).agg(F.max_by("change", "year_month").alias(into))


def calculate_kpis(df: DataFrame) -> DataFrame:
    """The indicator row: sales totals, leaders, delivered rate over all orders, last monthly change.

    Lines are read three times: into a cube of labels, by order (which gives the number of orders with a valid line and the
    rate of delivered ones together), and by customer. Everything else rolls the cube up once.
    """
    sales = valid_sales(df)
    dimensions = (*DIMENSIONS, "year_month")
    rolled, tests, whole = rolled_up(sales_cube(sales, *dimensions), dimensions)
    month = tests["year_month"] & F.col("year_month").isNotNull()
    before = F.lag("_revenue").over(Window.partitionBy("_g", F.col("year_month").isNull()).orderBy("year_month"))  # one row for each month
    cards = rolled.withColumn("_change", share(F.col("_revenue") - before, before)).agg(
        F.max(F.when(whole, F.col("_revenue"))).alias("_total"), F.max(F.when(whole, F.col("_quantity"))).alias("_units"),
        *leader_values(tests, DIMENSIONS), F.max_by(F.when(month, F.col("_change")), F.when(month, F.col("year_month"))).alias("latest_month_change"),
    )
    delivered = F.min_by(F.col("order_status").eqNullSafe("delivered").cast("int"), F.col("line_number"))
    valid = F.max((valid_line(df) & F.col("order_id").isNotNull()).cast("int"))
    orders = df.groupBy("order_id").agg(delivered.alias("_delivered"), valid.alias("_valid")).agg(
        F.coalesce(F.sum("_valid"), F.lit(0)).alias("orders"), F.avg("_delivered").alias("_rate")
    )
    customers = sales.agg(F.count_distinct("user_id").alias("customers"))
    return cards.crossJoin(orders).crossJoin(customers).select(  # one row each
        shown("_total").alias("total_revenue"),
        shown("_units").alias("units_sold"),
        "orders",
        "customers",
        share(F.col("_total"), F.col("orders")).alias("average_order_revenue"),
        F.coalesce(share(F.col("_total"), F.col("_units")), F.lit(0.0)).alias("average_unit_price"),
        *[c for columns in leader_columns(DIMENSIONS).values() for c in columns],
        F.coalesce("_rate", F.lit(0.0)).alias("delivered_order_rate"),
        "latest_month_change",
    )


def ranked_sums(sales: DataFrame, dimension: str) -> DataFrame:
    """Revenue per non-null label with its rank from the top and from the bottom (ties by label)."""
    sums = sales.filter(F.col(dimension).isNotNull()).groupBy(dimension).agg(F.sum("revenue").alias("revenue"))
    # labels of a reporting dimension: a short list
    top = Window.orderBy(F.col("revenue").desc(), dimension)
    return sums.withColumns(
        {"position": F.row_number().over(top), "labels": F.count(F.lit(1)).over(Window.partitionBy())}
    )


def insight_metrics(df: DataFrame, top: int = 10) -> DataFrame:
    """Numbers behind the findings: first, second and last label per dimension, concentration, rates."""
    sales = valid_sales(df)
    cube = sales_cube(sales, *DIMENSIONS, "year_month")
    out = cube.agg(F.sum("revenue").alias("_total"))
    for d in ("country", "channel", "category"):
        ranked = ranked_sums(cube, d)
        pick = lambda test, c: F.max(F.when(test, F.col(c)))
        out = out.crossJoin(
            ranked.agg(
                pick(F.col("position") == 1, d).alias(f"first_{d}"),
                pick(F.col("position") == 1, "revenue").alias(f"_first_{d}"),
                pick(F.col("position") == 2, d).alias(f"second_{d}"),
                pick(F.col("position") == F.col("labels"), d).alias(f"last_{d}"),
            )
        )
    customers = sales.groupBy("user_id", "customer_name", "country").agg(F.sum("revenue").alias("revenue"))
    best = customers.orderBy(F.col("revenue").desc(), "user_id").limit(top).agg(F.sum("revenue").alias("_top"))
    status = status_rates(df, delivered="delivered_rate", cancelled="cancelled_rate")
    out = out.crossJoin(best).crossJoin(status).crossJoin(_latest_change(cube, "latest_change"))  # one-row frames
    return out.select(
        *[
            c
            for d in ("country", "channel", "category")
            for c in (
                f"first_{d}",
                shown(f"_first_{d}").alias(f"first_{d}_revenue"),
                share(F.col(f"_first_{d}"), F.col("_total")).alias(f"first_{d}_share"),
                f"second_{d}",
                f"last_{d}",
            )
        ],
        share(F.col("_top"), F.col("_total")).alias("top_customer_share"),
        "delivered_rate",
        "cancelled_rate",
        F.coalesce("latest_change", F.lit(0.0)).alias("latest_change"),
    )


def dimension_summary(sales: DataFrame, column: str) -> DataFrame:
    """Revenue, units, orders, customers, share and revenue per order of every label (null kept)."""
    grouped = sales.groupBy(column).agg(
        F.sum("revenue").alias("_revenue"),
        F.sum("quantity").alias("unidades"),
        F.count_distinct("order_id").alias("pedidos"),
        F.count_distinct("user_id").alias("clientes"),
    )
    whole = F.sum("_revenue").over(Window.partitionBy())  # one row per label
    return grouped.select(
        column,
        shown("_revenue").alias("revenue"),
        shown("unidades").alias("unidades"),
        "pedidos",
        "clientes",
        percent(F.col("_revenue"), whole).alias("participacion_revenue_pct"),
        share(F.col("_revenue"), F.col("pedidos")).alias("revenue_por_pedido"),
    )


def status_summary(df: DataFrame) -> DataFrame:
    """All lines by status with the share of orders; lines without status are left out of the groups."""
    orders = df.agg(F.count_distinct("order_id").alias("_orders"))
    return (
        df.filter("order_status is not null")
        .groupBy("order_status")
        .agg(
            F.count_distinct("order_id").alias("pedidos"),
            F.count("line_number").alias("lineas"),
            shown(total("quantity")).alias("unidades"),
            shown(total("revenue")).alias("revenue"),
        )
        .crossJoin(orders)  # one row
        .withColumn("porcentaje_pedidos", percent(F.col("pedidos"), F.col("_orders")))
        .drop("_orders")
    )


def revenue_stage(status: Column) -> Column:
    return (
        F.when(status == "delivered", "realizado")
        .when(status == "cancelled", "cancelado")
        .when(status.isin("confirmed", "shipped"), "en_proceso")
        .otherwise("sin_clasificar")
    )


def revenue_stage_summary(sales: DataFrame) -> DataFrame:
    grouped = sales.groupBy(revenue_stage(F.col("order_status")).alias("revenue_stage")).agg(
        F.count("line_number").alias("lineas"),
        F.count_distinct("order_id").alias("pedidos"),
        F.sum("revenue").alias("_revenue"),
    )
    whole = F.sum("_revenue").over(Window.partitionBy())  # at most four rows
    return grouped.select(
        "revenue_stage", "lineas", "pedidos", shown("_revenue").alias("revenue"),
        percent(F.col("_revenue"), whole).alias("participacion_pct"),
    )


def status_value_split(sales: DataFrame, tolerated: float = 0.09) -> DataFrame:
    """Gross value by state and the value a lower cancellation share would recover."""
    status, revenue = F.col("order_status"), F.col("revenue")
    part = lambda test: F.coalesce(F.sum(F.when(test, revenue)), F.lit(0))
    values = sales.agg(
        F.sum(revenue).alias("gross"),
        part(status == "delivered").alias("delivered"),
        part(status == "cancelled").alias("cancelled"),
        part(status.isin("confirmed", "shipped")).alias("pipeline"),
    )
    shares = {f"{n}_share": share(F.col(n), F.col("gross")) for n in ("delivered", "cancelled", "pipeline")}
    excess = F.greatest(F.col("cancelled_share") - tolerated, F.lit(0.0))
    return (
        values.withColumns(shares)
        .withColumn("potential_recovery", shown("gross") * excess)
        .withColumns({n: shown(n) for n in ("gross", "delivered", "cancelled", "pipeline")})
    )


def pivot_revenue(sales: DataFrame, index: str, columns: str, labels: Sequence[str]) -> DataFrame:
    """Revenue matrix with a listed set of columns, zero filled."""
    wide = sales.filter(F.col(index).isNotNull()).groupBy(index).pivot(columns, list(labels)).agg(F.sum("revenue"))
    return wide.select(index, *[F.coalesce(shown(F.col(f"`{c}`")), F.lit(0.0)).alias(c) for c in labels])


def status_matrix(sales: DataFrame, index: str) -> DataFrame:
    """Revenue by label and status with the total, delivered and cancelled shares."""
    wide = pivot_revenue(sales, index, "order_status", STATUSES)
    whole = sum((F.col(s) for s in STATUSES[1:]), F.col(STATUSES[0]))
    return wide.withColumn("total", whole).withColumns(
        {
            "delivered_share": share(F.col("delivered"), F.col("total")),
            "cancel_share": share(F.col("cancelled"), F.col("total")),
        }
    )


def period_series(sales: DataFrame, *period: str) -> DataFrame:
    """Revenue, units, orders and relative change per observed period (`year_month`, or `year`, `quarter`)."""
    keep = sales.dropna(subset=list(period))
    series = keep.groupBy(*period).agg(
        F.sum("revenue").alias("_revenue"),
        shown(F.sum("quantity")).alias("unidades"),
        F.count_distinct("order_id").alias("pedidos"),
    )
    return period_change(series, period, "_revenue", "_change").select(
        *period, shown("_revenue").alias("revenue"), "unidades", "pedidos",
        (F.col("_change") * 100).alias("variacion_revenue_pct"),
    )


def monthly_variability(sales: DataFrame) -> DataFrame:
    """Sample coefficient of variation of the months, best and lowest month."""
    months = sales.filter("year_month is not null").groupBy("year_month").agg(shown(F.sum("revenue")).alias("value"))
    best = F.min(F.struct((-F.col("value")).alias("v"), F.col("year_month").alias("m")))
    worst = F.min(F.struct(F.col("value").alias("v"), F.col("year_month").alias("m")))
    return months.agg(
        F.count(F.lit(1)).alias("months"),
        share(F.stddev_samp("value"), F.avg("value")).alias("monthly_cv"),
        best.alias("_best"),
        worst.alias("_worst"),
    ).select(
        "months", "monthly_cv",
        F.col("_best.m").alias("best_month"), (-F.col("_best.v")).alias("best_value"),
        F.col("_worst.m").alias("lowest_month"), F.col("_worst.v").alias("lowest_value"),
    )


def quarter_totals(sales: DataFrame) -> DataFrame:
    """Revenue by quarter label, years together."""
    return sales.filter("quarter is not null").groupBy(F.concat(F.lit("Q"), F.col("quarter").cast("string")).alias("period")).agg(
        shown(F.sum("revenue")).alias("value")
    )
