"""Eighteen quality rules: flags per line and a report with one row per rule. No row is dropped."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.fixed_values import CHANNELS, COUNTRIES, QUALITY_RULES, STATUSES
from orderlens.functions.text import issue_text
from orderlens.operators.integrity import LINE_KEY, flag_repeated, repeated_keys
from orderlens.operators.ordered import exact_percentiles

DOMAINS = {"country": COUNTRIES, "channel": CHANNELS, "order_status": STATUSES}
Fences = Mapping[str, tuple[float, float] | None]


def iqr_fences(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> Fences:
    """Tukey fences over all lines, as two scalars per column; None for a column without values."""
    quartiles = exact_percentiles(df, {c: [0.25, 0.75] for c in columns})
    return {
        c: None if q1 is None else (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
        for c, (q1, q3) in quartiles.items()
    }


def outside(c: str, fences: Fences) -> Column:
    """Strictly beyond the fences; null values and empty columns are inside."""
    if fences.get(c) is None:
        return F.lit(False)
    low, high = fences[c]
    x = F.col(c).cast("double")
    return F.coalesce((x < low) | (x > high), F.lit(False))


def valid_sale() -> Column:
    """Positive quantity and price with a known value and order; false, never null."""
    return (
        F.coalesce(F.col("quantity") > 0, F.lit(False))
        & F.coalesce(F.col("unit_price") > 0, F.lit(False))
        & F.col("revenue").isNotNull()
        & F.col("order_id").isNotNull()
    )


def _rule_tests(fences: Fences, domains: Mapping[str, Sequence[str]], duplicate: str) -> list[Column]:
    c = F.col
    unknown = [c(k).isNull() | ~c(k).isin(list(domains[k])) for k in ("country", "channel", "order_status")]
    tests = [
        c(duplicate),
        c("order_id").isNull() | c("user_id").isNull() | c("product_id").isNull(),
        c("quantity").isNull(),
        c("quantity") <= 0,
        c("unit_price").isNull(),
        c("unit_price") <= 0,
        *unknown,
        c("order_date").isNull(),
        ~c("product_match_flag"),
        ~c("user_match_flag"),
        F.abs(c("price_difference")) > 0.01,
        outside("revenue", fences),
        outside("quantity", fences),
        c("inventory").isNull(),
        c("rating").isNull(),
        c("catalog_duplicate_flag"),
    ]
    return [F.coalesce(test, F.lit(False)) for test in tests]


def evaluate_quality(
    df: DataFrame, domains: Mapping[str, Sequence[str]] = DOMAINS, fences: Fences | None = None
) -> DataFrame:
    """Every input row plus `data_quality_flag` and `valid_sales_flag`."""
    fences = fences if fences is not None else iqr_fences(df, ["revenue", "quantity"])
    marked = flag_repeated(df, LINE_KEY, "_repeated")
    named = [(rule[0], test) for rule, test in zip(QUALITY_RULES, _rule_tests(fences, domains, "_repeated"))]
    return marked.withColumns({"data_quality_flag": issue_text(named), "valid_sales_flag": valid_sale()}).drop("_repeated")


def quality_report(
    df: DataFrame, domains: Mapping[str, Sequence[str]] = DOMAINS, fences: Fences | None = None
) -> DataFrame:
    """Rows reviewed and affected per rule, from one aggregation; repeated keys are counted apart."""
    fences = fences if fences is not None else iqr_fences(df, ["revenue", "quantity"])
    tests = _rule_tests(fences, domains, "_repeated")
    repeats = repeated_keys(df, LINE_KEY).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("_repeats"))
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(t).alias(f"_n{i}") for i, t in enumerate(tests) if i > 0]
    ).crossJoin(repeats)  # two one-row frames
    rows = [
        F.struct(
            F.lit(i).alias("orden"),
            F.lit(name).alias("regla_evaluada"),
            F.col("_rows").alias("registros_revisados"),
            F.col("_repeats" if i == 0 else f"_n{i}").alias("registros_afectados"),
            F.lit(action).alias("accion_aplicada"),
            F.lit(reason).alias("justificacion"),
            F.lit(severity).alias("severidad"),
        )
        for i, (name, action, reason, severity) in enumerate(QUALITY_RULES)
    ]
    affected = F.coalesce(F.try_divide(F.col("registros_afectados") * 100.0, F.col("registros_revisados")), F.lit(0.0))
    return (
        counts.select(F.inline(F.array(*rows)))
        .withColumn("porcentaje_afectado", F.round(affected.cast("double"), 2))
        .select(
            "orden", "regla_evaluada", "registros_revisados", "registros_afectados", "porcentaje_afectado",
            "accion_aplicada", "justificacion", "severidad",
        )
    )
