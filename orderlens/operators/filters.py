"""Filters, lookups and pages over collections and lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.text import same_text


def valid_line(df: DataFrame) -> Column:
    """Whether a line counts for indicators: by the quality flag, or by its conditions where the flag is absent."""
    if "valid_sales_flag" in df.columns:
        return F.col("valid_sales_flag").cast("boolean")
    return (F.col("quantity") > 0) & (F.col("unit_price") > 0) & F.col("revenue").isNotNull()


def valid_sales(df: DataFrame) -> DataFrame:
    """Lines that count for indicators."""
    return df.filter(valid_line(df))


def active_sales(df: DataFrame) -> DataFrame:
    """Valid sales of orders that are not cancelled; an unknown status is kept."""
    return valid_sales(df).filter(F.coalesce(F.col("order_status") != "cancelled", F.lit(True)))


def matching(df: DataFrame, **wanted: str | int | None) -> DataFrame:
    """Optional equality filters; text compares without case, and empty arguments are ignored."""
    tests = [
        same_text(F.col(name), value) if isinstance(value, str) else F.col(name) == value
        for name, value in wanted.items()
        if value
    ]
    return df.filter(reduce(lambda a, b: a & b, tests)) if tests else df


def selected(df: DataFrame, **dimensions: str | None) -> DataFrame:
    """Dashboard selection: exact match on any of the dimensions given."""
    chosen = {name: value for name, value in dimensions.items() if value}
    return reduce(lambda d, kv: d.filter(F.col(kv[0]).cast("string") == str(kv[1])), chosen.items(), df)


PAGE_ROWS = 100_000  # rows that are sorted for a page, at most, unless they share one key
PAGE_CUTS = 64


def _holding(df: DataFrame, order: str, skip: int, limit: int, rows: int) -> tuple[DataFrame, int]:
    """The rows of the key range that holds a page, and how many rows of the table come before that range.

    Each round cuts the range at quantiles of a sketch, counts the rows up to each cut and goes on with the cuts around the
    page: two scans and no shuffle, whatever the depth of the page.
    """
    key, part, before = F.col(order), df, 0
    inside = part.agg(F.count(F.lit(1))).first()[0]
    while inside > rows:
        cuts = part.agg(F.percentile_approx(key, [i / PAGE_CUTS for i in range(1, PAGE_CUTS)], 10_000)).first()[0]
        cuts = sorted(set(cuts or []))
        counts = part.agg(F.count_if(key.isNull()).alias("nulls"), *[F.count_if(key <= F.lit(c)).alias(f"c{i}") for i, c in enumerate(cuts)]).first()
        ends = [counts["nulls"] + counts[f"c{i}"] for i in range(len(cuts))]  # nulls come first
        first = max((i for i, n in enumerate(ends) if n <= skip - before), default=None)
        last = min((i for i, n in enumerate(ends) if n >= skip - before + limit), default=None)
        size = (inside if last is None else ends[last]) - (0 if first is None else ends[first])
        if size == inside:
            break  # one key, or a page as wide as the range
        if last is not None:
            part = part.filter(key.isNull() | (key <= F.lit(cuts[last])))
        if first is not None:
            part, before = part.filter(key > F.lit(cuts[first])), before + ends[first]
        inside = size
    return part, before


def page(df: DataFrame, order: str, skip: int, limit: int, ties: Sequence[str] = (), rows: int = PAGE_ROWS) -> DataFrame:
    """One page in the order of a number or a date (rows that share it, of `ties`), with the total and the page's count on
    every row. Only the key range that holds the page is sorted."""
    total = df.agg(F.count(F.lit(1))).first()[0]
    part, before = _holding(df, order, skip, limit, rows) if skip < total and limit > 0 else (df.limit(0), skip)
    found = part.orderBy(order, *ties).offset(skip - before).limit(limit)
    facts = {"total": total, "count": max(0, min(limit, total - skip))}
    return found.withColumns({k: F.lit(v).cast("long") for k, v in facts.items()}).withColumns({"skip": F.lit(skip), "limit": F.lit(limit)})


def by_id(df: DataFrame, key: str, value: int) -> DataFrame:
    return df.filter(F.col(key) == value)


def one_by_id(df: DataFrame, key: str, value: int) -> DataFrame:
    """Like `by_id`, but an absent record is an error."""
    found = by_id(df, key, value)
    if found.isEmpty():
        raise LookupError(f"{key} {value} not found")
    return found


def categories(products: DataFrame, column: str = "category") -> DataFrame:
    return products.select(column).distinct().orderBy(column)


def rows_with_nulls(df: DataFrame) -> DataFrame:
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in df.columns]))


def trace(df: DataFrame, **keys: int) -> DataFrame:
    """Every line of one order or one user, in order."""
    return reduce(lambda d, kv: d.filter(F.col(kv[0]) == kv[1]), keys.items(), df).orderBy("order_id", "line_number")


def semi_lines(df: DataFrame, condition: Column, key: str) -> DataFrame:
    """All lines of the keys that have at least one line meeting the condition."""
    return df.join(df.filter(condition).select(key).distinct(), key, "left_semi")


def with_defaults(df: DataFrame, fallback: Mapping[str, str]) -> DataFrame:
    """Absent columns repeat another column."""
    missing = {target: F.col(source) for target, source in fallback.items() if target not in df.columns}
    return df.withColumns(missing) if missing else df
