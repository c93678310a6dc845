"""Table profiles: schema report, data dictionary, missing-quantity summary, collection profile."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.operators.enrich import LINE_COLUMNS, PRODUCT_COLUMNS, USER_COLUMNS

LISTED_VALUES = 12
FEW_VALUES = 256  # estimated distinct values up to which a column's values are held as one set


def _distinct_values(df: DataFrame) -> DataFrame:
    """variable, nulos, filas, distintos and, for columns with few values, valores: one row for each column, exact.

    One scan of sketches tells which columns have few values; these are listed in a second scan, in sets as small as the
    sketches say. Of the others each is read on its own and its distinct values are counted after a partial count.
    """
    columns = df.columns
    first = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)],
        *[F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(columns)],
    ).first()
    counts = df.sparkSession.createDataFrame(
        [(c, first["rows"] - first[f"n{i}"], first["rows"]) for i, c in enumerate(columns)], "variable string, nulos long, filas long"
    )
    few = [c for i, c in enumerate(columns) if first[f"d{i}"] <= FEW_VALUES]
    out = []
    if few:
        # whole numbers, flags and days become text in the finished set, once a value and not once a row
        kinds = {f.name: isinstance(f.dataType, (T.IntegralType, T.BooleanType, T.DateType)) for f in df.schema.fields}
        values = [F.collect_set(F.col(c) if kinds[c] else F.col(c).cast("string")).cast("array<string>") for c in few]
        sets = df.agg(*[F.array_sort(v).alias(f"s{i}") for i, v in enumerate(values)])
        rows = [F.struct(F.lit(c).alias("variable"), F.size(f"s{i}").cast("long").alias("distintos"), F.col(f"s{i}").alias("valores")) for i, c in enumerate(few)]
        out.append(sets.select(F.inline(F.array(*rows))))
    for c in columns:
        if c not in few:
            out.append(df.agg(F.count_distinct(c).alias("distintos")).select(F.lit(c).alias("variable"), "distintos", F.lit(None).cast("array<string>").alias("valores")))
    return counts.join(reduce(DataFrame.unionByName, out), "variable")


def schema_report(df: DataFrame) -> DataFrame:
    """Type, nulls, share of nulls and distinct values per column (exact)."""
    types = df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in df.schema.fields], "variable string, tipo string"
    )
    return types.join(_distinct_values(df), "variable").select(  # one row per column
        "variable", "tipo", "nulos",
        F.round(F.col("nulos") * 100.0 / F.col("filas"), 2).cast("double").alias("porcentaje_nulos"),
        F.col("distintos").alias("valores_unicos"),
    )


def _source(column: str) -> str:
    if column in LINE_COLUMNS:
        return "carts"
    if column in PRODUCT_COLUMNS and column != "catalog_duplicate_flag":
        return "products"
    return "users" if column in USER_COLUMNS and column not in ("customer_name", "country_original") else "derived"


def data_dictionary(df: DataFrame, listed: int = LISTED_VALUES) -> DataFrame:
    """Source, type, nulls and the values: a list when few, else a numeric range or a distinct count."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    facts = df.sparkSession.createDataFrame(
        [(f.name, _source(f.name), f.dataType.simpleString()) for f in df.schema.fields],
        "variable string, fuente string, tipo string",
    )
    counted = _distinct_values(df)
    ranges = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"lo_{c}") for c in numeric],
        *[F.max(F.col(c).cast("double")).alias(f"hi_{c}") for c in numeric],
    )
    if numeric:
        spans = ranges.select(
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(c).alias("variable"), F.col(f"lo_{c}").alias("minimo"), F.col(f"hi_{c}").alias("maximo"))
                        for c in numeric
                    ]
                )
            )
        )
    else:
        spans = df.sparkSession.createDataFrame([], "variable string, minimo double, maximo double")
    text = (
        F.when(F.col("distintos") == 0, "Sin valores")
        .when(F.col("distintos") <= listed, F.array_join("valores", ", "))
        .when(
            F.col("minimo").isNotNull(),
            F.concat(
                F.lit("Rango observado: "), F.format_string("%.2f", "minimo"), F.lit(" a "), F.format_string("%.2f", "maximo")
            ),
        )
        .otherwise(F.concat(F.col("distintos").cast("string"), F.lit(" valores observados")))
    )
    # every frame below has one row per column
    return (
        facts.join(counted, "variable")
        .join(spans, "variable", "left")
        .select("variable", "fuente", "tipo", "nulos", "distintos", text.alias("valores"))
    )


def missing_quantity_summary(df: DataFrame) -> DataFrame:
    missing = F.col("quantity").isNull()
    return df.agg(
        F.count(F.lit(1)).alias("lineas_totales"),
        F.count_if(missing).alias("lineas_con_quantity_nula"),
        F.count_distinct(F.when(missing, F.col("user_id"))).alias("usuarios_afectados"),
        F.count_distinct(F.when(missing, F.col("order_id"))).alias("pedidos_afectados"),
    )


def table_profile(products: DataFrame, users: DataFrame, orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Record counts, date range and null quantities, in one row."""
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    facts = lines.agg(
        F.count(F.lit(1)).alias("lines"),
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
        F.count_if(F.col("quantity").isNull()).alias("null_quantity"),
    )
    return count(products, "products").crossJoin(count(users, "users")).crossJoin(count(orders, "orders")).crossJoin(facts)
