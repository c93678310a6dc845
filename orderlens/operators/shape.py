"""Small reshaping helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def long_form(df: DataFrame, columns: Sequence[str], kind: str, ids: Sequence[str] = ()) -> DataFrame:
    """(ids, variable, value): the columns one below the other, all cast to one type."""
    same = df.select(*ids, *[F.col(c).cast(kind).alias(c) for c in columns])
    return same.unpivot(list(ids), list(columns), "variable", "value")


def column_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(variable, value, rows): every value of every column, combined before the shuffle."""
    return long_form(df, columns, "string").groupBy("variable", "value").agg(F.count(F.lit(1)).alias("rows"))
