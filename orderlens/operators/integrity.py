"""De-duplication, key checks and recomputation checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.fixed_values import PRICE_EDGES, REQUIRED_COLUMNS
from orderlens.functions import numbers
from orderlens.operators.shape import column_values

LINE_KEY = ("order_id", "line_number", "product_id")


def first_per_key(df: DataFrame, key: str, position: Sequence[str] = ()) -> DataFrame:
    """One row per key, the first by `position`; without a position, the least row.

    An aggregate, so a hot key is combined before the shuffle.
    """
    others = [c for c in df.columns if c != key]
    order = F.struct(*(list(position) or others))
    return df.groupBy(key).agg(F.min_by(F.struct(*others), order).alias("_row")).select(key, "_row.*")


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def same_key(left: DataFrame, right: DataFrame, key: Sequence[str], prefix: str = "_k_") -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[prefix + k]) for k in key])


def flag_repeated(df: DataFrame, key: Sequence[str], into: str) -> DataFrame:
    """Flag every member of a repeated key (null equals null).

    Only the narrow key is shuffled to find repeats; how the repeated keys then meet the wide rows is left to AQE.
    """
    repeats = repeated_keys(df, key).select(*[F.col(k).alias(f"_k_{k}") for k in key], F.lit(True).alias("_hit"))
    return (
        df.join(repeats, same_key(df, repeats, key), "left")
        .withColumn(into, F.coalesce("_hit", F.lit(False)))
        .select(*df.columns, into)
    )


def unique_key_violations(dimension: DataFrame, key: str) -> DataFrame:
    """Rows here would break the many-to-one check of a dimension join."""
    return repeated_keys(dimension, [key])


def exact_duplicates(df: DataFrame) -> DataFrame:
    """Rows that are members of an exactly repeated record, and the number of such records."""
    repeats = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return repeats.agg(
        F.count(F.lit(1)).alias("registros_repetidos"), F.coalesce(F.sum("_n"), F.lit(0)).alias("filas_duplicadas")
    )


def order_line_check(df: DataFrame) -> DataFrame:
    """Observed lines against the number the order declares."""
    return df.groupBy("order_id").agg(
        F.count("line_number").alias("observed_lines"),
        F.min_by("reported_total_products", F.struct("line_number", "reported_total_products")).alias("reported_lines"),
    ).withColumn("difference", F.col("observed_lines") - F.col("reported_lines"))


def integrity_summary(df: DataFrame) -> DataFrame:
    """One row: exact duplicates, repeated keys, orders whose line count differs."""
    keys = repeated_keys(df, LINE_KEY).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("filas_con_clave_duplicada")
    )
    orders = order_line_check(df).agg(F.count_if(F.col("difference") != 0).alias("pedidos_con_diferencia_en_lineas"))
    exact = exact_duplicates(df).select(F.col("filas_duplicadas").alias("filas_duplicadas_exactas"))
    return exact.crossJoin(keys).crossJoin(orders)  # three one-row frames


def master_validation(df: DataFrame) -> DataFrame:
    """Counts and sums of the master table plus the violations of its contract, in one row."""
    expected = F.round(numbers.line_value(F.col("unit_price"), F.col("quantity")).cast("double"), 8)
    actual = F.round(F.col("revenue").cast("double"), 8)
    totals = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.coalesce(F.sum("quantity"), F.lit(0)).cast("double").alias("quantity_sum"),
        F.coalesce(F.sum("revenue"), F.lit(0)).cast("double").alias("revenue_sum"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in ("order_id", "user_id", "product_id")],
        F.count_if(~actual.eqNullSafe(expected)).alias("revenue_mismatches"),
    )
    repeats = repeated_keys(df, LINE_KEY).agg(F.coalesce(F.sum("rows") - F.count("rows"), F.lit(0)).alias("duplicate_lines"))
    return totals.crossJoin(repeats)  # two one-row frames


def check_master(df: DataFrame) -> dict[str, object]:
    """Strict form: raise on a missing column, an empty table, a repeated line key or a wrong revenue."""
    missing = sorted(set(REQUIRED_COLUMNS).difference(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    result = master_validation(df).first().asDict()
    if result["rows"] == 0:
        raise ValueError("the master table is empty")
    if result["duplicate_lines"]:
        raise ValueError("repeated line keys")
    if result["revenue_mismatches"]:
        raise ValueError("revenue differs from unit_price x quantity")
    result["dtypes"] = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return result


def vocabulary_check(df: DataFrame, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Observed values outside the allowed ones, with their number of rows."""
    observed = column_values(df, list(domains))
    allowed = reduce(
        lambda a, b: a | b, [(F.col("variable") == c) & F.col("value").isin(list(d)) for c, d in domains.items()]
    )
    return observed.filter(F.col("value").isNotNull() & ~allowed)


def vocabularies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values per categorical column."""
    return column_values(df, columns).filter("value is not null").select("variable", "value")


def derived_check(df: DataFrame, price_edges: Sequence[float] = PRICE_EDGES) -> DataFrame:
    """Recompute the derived columns and count agreements and differences in one pass."""
    revenue_ok = numbers.close_to(
        F.col("revenue"), numbers.line_value(F.col("unit_price"), F.col("quantity")), absolute=0.01
    )
    segment_ok = F.col("price_segment") == numbers.price_segment(F.col("unit_price"), price_edges)
    cancelled = F.coalesce(F.col("order_status") == "cancelled", F.lit(False)).cast("int")
    return df.agg(
        F.count_if(revenue_ok).alias("revenue_correcto"),
        F.count_if(~revenue_ok).alias("revenue_incorrecto"),
        F.count_if(segment_ok).alias("segmento_precio_correcto"),
        F.count_if(~segment_ok).alias("segmento_precio_incorrecto"),
        F.count_if(F.col("canceled_flag") != cancelled).alias("flag_cancelacion_incorrecto"),
        F.count_if(F.col("year") != F.year("order_date")).alias("anio_incorrecto"),
        F.count_if(F.col("quarter") != F.quarter("order_date")).alias("trimestre_incorrecto"),
        F.count_if(F.col("month") != F.month("order_date")).alias("mes_incorrecto"),
    )


def price_discount_checks(df: DataFrame) -> DataFrame:
    """Line price and discount against the catalog's (0.01 absolute plus 1e-5 relative)."""
    price = numbers.close_to(F.col("unit_price"), F.col("catalog_price"), 0.01, 1e-5, null_equal=False)
    discount = numbers.close_to(
        F.col("line_discount_percentage"), F.col("catalog_discount_percentage"), 0.01, 1e-5, null_equal=True
    )
    return df.agg(
        F.count_if(price).alias("precio_linea_igual_catalogo"),
        F.count_if(~price).alias("precio_linea_distinto_catalogo"),
        F.count_if(discount).alias("descuento_linea_igual_catalogo"),
        F.count_if(~discount).alias("descuento_linea_distinto_catalogo"),
    )


def first_status_per_order(df: DataFrame) -> DataFrame:
    """The status on the first line; where a line number repeats, the first of its labels."""
    return df.groupBy("order_id").agg(F.min_by("order_status", F.struct("line_number", "order_status")).alias("order_status"))


def order_product_pairs(df: DataFrame, *attributes: str) -> DataFrame:
    """One row per (order, product) with the attributes of its first line; where its number repeats, the least of them."""
    picked = F.min_by(F.struct(*attributes), F.struct("line_number", *attributes)).alias("_row")
    return df.groupBy("order_id", "product_id").agg(picked).select("order_id", "product_id", "_row.*")
