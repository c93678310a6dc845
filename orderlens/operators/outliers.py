"""IQR study: report, line flags, products concerned, price history, sensitivity, distribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.numbers import percent, share
from orderlens.functions.text import joined_labels
from orderlens.operators.filters import semi_lines
from orderlens.operators.integrity import same_key
from orderlens.operators.kpis import shown
from orderlens.operators.ordered import exact_percentiles
from orderlens.operators.quality import Fences, iqr_fences, outside
from orderlens.session import stored

MEASURES = ("unit_price", "quantity", "discount_percentage", "revenue", "inventory", "rating", "reviews", "age")
HISTORY_COLUMNS = (
    "product_id", "product_name", "category", "brand", "order_id", "order_date", "order_status", "country",
    "channel", "unit_price", "catalog_price", "price_difference", "quantity", "revenue", "any_outlier_iqr",
    "outlier_variables",
)
PRODUCT_LABELS = ("product_id", "product_name", "category", "brand")


def iqr_report(df: DataFrame, columns: Sequence[str] = MEASURES) -> DataFrame:
    """Quartiles, fences, outliers and their share per variable."""
    quartiles = exact_percentiles(df, {c: [0.25, 0.75] for c in columns})
    fences = {
        c: None if q1 is None else (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)) for c, (q1, q3) in quartiles.items()
    }
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(outside(c, fences)).alias(f"_n_{c}") for c in columns]
    )
    number = lambda v: F.lit(v).cast("double")
    rows = []
    for c in columns:
        q1, q3 = quartiles[c]
        low, high = fences[c] or (None, None)
        rows.append(
            F.struct(
                F.lit(c).alias("variable"), number(q1).alias("q1"), number(q3).alias("q3"),
                number(None if q1 is None else q3 - q1).alias("iqr"),
                number(low).alias("limite_inferior"), number(high).alias("limite_superior"),
                F.col(f"_n_{c}").alias("outliers"), percent(F.col(f"_n_{c}"), F.col("_rows")).alias("porcentaje"),
            )
        )
    return counts.select(F.inline(F.array(*rows)))


def flag_outliers(df: DataFrame, columns: Sequence[str] = MEASURES, fences: Fences | None = None) -> DataFrame:
    """Every line with one flag per variable, an any-flag and the list of variables."""
    fences = fences if fences is not None else iqr_fences(df, columns)
    flagged = df.withColumns({f"{c}_outlier_iqr": outside(c, fences) for c in columns})
    named = [(c, F.col(f"{c}_outlier_iqr")) for c in columns]
    anything = named[0][1]
    for _, test in named[1:]:
        anything = anything | test
    return flagged.withColumns({"any_outlier_iqr": anything, "outlier_variables": joined_labels(named, ", ")})


def outlier_products_history(flagged: DataFrame) -> DataFrame:
    """All lines of the products that have at least one flagged line."""
    return semi_lines(flagged.filter("product_id is not null"), F.col("any_outlier_iqr"), "product_id")


def product_price_history(flagged: DataFrame) -> DataFrame:
    return outlier_products_history(flagged).select(*[c for c in HISTORY_COLUMNS if c in flagged.columns])


def _distinct_per_product(lines: DataFrame, column: str, into: str) -> DataFrame:
    """Distinct values of a column for each product, from narrow rows of their own; a null is no value."""
    counted = lines.select(*PRODUCT_LABELS, column).distinct().groupBy(*PRODUCT_LABELS).agg(F.count(column).alias(into))
    return counted.withColumnsRenamed({k: f"_k_{k}" for k in PRODUCT_LABELS})


def product_price_summary(flagged: DataFrame) -> DataFrame:
    """Price, quantity and revenue history of each product concerned, with the kind of alert.

    Lines are combined before products without a flagged line are left out, and distinct values are counted apart: together
    they would repeat each line for each of the counts.
    """
    price = F.col("unit_price").cast("double")
    lines = flagged.filter("product_id is not null")
    grouped = lines.groupBy(*PRODUCT_LABELS).agg(
        F.count(F.lit(1)).alias("lineas_historicas"),
        F.count_if("any_outlier_iqr").alias("lineas_con_algun_outlier"),
        F.count_if("unit_price_outlier_iqr").alias("lineas_outlier_precio"),
        F.count_if("revenue_outlier_iqr").alias("lineas_outlier_revenue"),
        F.min(price).alias("precio_minimo"),
        F.max(price).alias("precio_maximo"),
        share(F.sum("unit_price"), F.count("unit_price")).alias("precio_promedio"),
        F.coalesce(F.stddev_samp(price), F.lit(0.0)).alias("desviacion_precio"),
        shown(F.min("catalog_price")).alias("catalog_price_minimo"),
        shown(F.max("catalog_price")).alias("catalog_price_maximo"),
        F.min("quantity").alias("cantidad_minima"),
        F.max("quantity").alias("cantidad_maxima"),
        shown(F.max("revenue")).alias("revenue_maximo"),
        F.max("any_outlier_iqr").alias("any_outlier_iqr"),
    )
    grouped = outlier_products_history(stored(grouped)).drop("any_outlier_iqr")
    for column, into in (("order_id", "pedidos_distintos"), ("unit_price", "precios_historicos_distintos")):
        counts = _distinct_per_product(lines, column, into)
        grouped = grouped.join(counts, same_key(grouped, counts, PRODUCT_LABELS)).select(*grouped.columns, into)
    first = [*PRODUCT_LABELS, "lineas_historicas", "pedidos_distintos", "lineas_con_algun_outlier", "lineas_outlier_precio", "lineas_outlier_revenue", "precios_historicos_distintos"]
    grouped = grouped.select(*first, *[c for c in grouped.columns if c not in first])
    by_price, by_revenue = F.col("lineas_outlier_precio") > 0, F.col("lineas_outlier_revenue") > 0
    change = F.col("precio_maximo") - F.col("precio_minimo")
    return grouped.withColumns(
        {
            "variacion_precio": change,
            "variacion_precio_pct": F.when(F.col("precio_minimo") > 0, change / F.col("precio_minimo") * 100),
            "presenta_variacion_precio": F.col("precios_historicos_distintos") > 1,
            "tipo_alerta": F.when(by_price & by_revenue, "Precio y revenue")
            .when(by_price, "Precio")
            .when(by_revenue, "Revenue sin precio atípico")
            .otherwise("Otra variable"),
        }
    )


def ranked_price_summary(summary: DataFrame) -> DataFrame:
    """Summary in review order."""
    return summary.orderBy(
        F.col("presenta_variacion_precio").desc(), F.col("lineas_con_algun_outlier").desc(),
        F.col("revenue_maximo").desc(), "product_id",
    )


def alert_counts(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count(F.lit(1)).alias("productos"),
        F.count_if("presenta_variacion_precio").alias("con_variacion_precio"),
        F.count_if(F.col("lineas_outlier_precio") > 0).alias("con_outlier_precio"),
        F.count_if(F.col("lineas_outlier_revenue") > 0).alias("con_outlier_revenue"),
    )


def top_outlier_lines(flagged: DataFrame, measure: str = "revenue", n: int = 15) -> DataFrame:
    """The n largest flagged lines of a measure (ties by the line key)."""
    return flagged.filter(F.col(f"{measure}_outlier_iqr")).orderBy(
        F.col(measure).desc(), "order_id", "line_number", "product_id"
    ).limit(n)


def outlier_sensitivity(flagged_sales: DataFrame, measure: str = "revenue") -> DataFrame:
    """Valid lines with and without the measure's outliers, and the outliers' share of the value."""
    keep = ~F.col(f"{measure}_outlier_iqr")
    kept_revenue = F.when(keep, F.col("revenue"))
    row = flagged_sales.agg(
        F.count(F.lit(1)).alias("n_all"), F.sum("revenue").alias("v_all"), F.count("revenue").alias("k_all"),
        F.count_if(keep).alias("n_kept"), F.sum(kept_revenue).alias("v_kept"), F.count(kept_revenue).alias("k_kept"),
    )
    scenario = lambda label, s: F.struct(
        F.lit(label).alias("escenario"),
        F.col(f"n_{s}").alias("lineas"),
        shown(f"v_{s}").alias("revenue"),
        share(F.col(f"v_{s}"), F.col(f"k_{s}")).alias("ticket_medio_linea"),
        ((share(F.col(f"v_{s}"), F.col("v_all")) - 1) * 100).alias("cambio_revenue_vs_completo_pct"),
        (1 - share(F.col(f"v_{s}"), F.col("v_all"))).alias("participacion_outliers"),
    )
    return row.select(
        F.inline(
            F.array(scenario("Líneas válidas completas", "all"), scenario(f"Sin outliers IQR de {measure}", "kept"))
        )
    )


def distribution(df: DataFrame, measure: str = "revenue", bins: int = 30) -> DataFrame:
    """Histogram: equal bins between minimum and maximum, the last one closed. Empty bins are kept."""
    x = F.col(measure).cast("double")
    low, high = df.agg(F.min(x), F.max(x)).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, lineas long")
    width = (high - low) / bins if high > low else 1.0 / bins
    start = low if high > low else low - 0.5
    index = F.least(F.floor((x - start) / width), F.lit(bins - 1)).cast("int")
    counted = df.filter(x.isNotNull()).groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("_n"))
    edges = df.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"),
        (F.lit(start) + F.col("id") * width).alias("lower"),
        (F.lit(start) + (F.col("id") + 1) * width).alias("upper"),
    )
    return edges.join(counted, "bin", "left").select("bin", "lower", "upper", F.coalesce("_n", F.lit(0)).alias("lineas"))


def box_statistics(df: DataFrame, measure: str = "revenue") -> DataFrame:
    """Quartiles, whiskers (furthest values inside the fences) and number of fliers."""
    q1, q2, q3 = exact_percentiles(df, {measure: [0.25, 0.5, 0.75]})[measure]
    x = F.col(measure).cast("double")
    if q1 is None:
        return df.sparkSession.createDataFrame([], "q1 double, mediana double, q3 double, bigote_inferior double, bigote_superior double, atipicos long")
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    return df.agg(
        F.lit(q1).alias("q1"), F.lit(q2).alias("mediana"), F.lit(q3).alias("q3"),
        F.min(F.when(x >= low, x)).alias("bigote_inferior"),
        F.max(F.when(x <= high, x)).alias("bigote_superior"),
        F.count_if((x < low) | (x > high)).alias("atipicos"),
    )
