"""Coercion, ratios, bands and tolerant comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens.fixed_values import PRICE_EDGES, PRICE_LABELS, UNCLASSIFIED_PRICE

MONEY = "decimal(18,4)"


def to_number(c: Column, kind: str = "double") -> Column:
    """Lenient coercion: text that is no number becomes null."""
    return c.try_cast(kind)


def to_day(c: Column) -> Column:
    """Lenient day parse: text that is no date becomes null."""
    return c.try_cast("date")


def line_value(unit_price: Column, quantity: Column, kind: str | None = None) -> Column:
    """price x quantity; exact when the price is a decimal, then returned in type `kind`."""
    if kind is None:
        return unit_price * quantity
    return (unit_price * quantity.cast("decimal(12,3)")).cast(kind)


def price_segment(price: Column, edges: Sequence[float] = PRICE_EDGES) -> Column:
    low, high = edges
    return (
        F.when(price < low, PRICE_LABELS[0])
        .when(price <= high, PRICE_LABELS[1])
        .when(price > high, PRICE_LABELS[2])
        .otherwise(UNCLASSIFIED_PRICE)
    )


def share(part: Column, whole: Column) -> Column:
    """Ratio as a double, null when the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return share(part, whole) * 100


def close_to(a: Column, b: Column, absolute: float = 0.01, relative: float = 0.0, null_equal: bool = True) -> Column:
    """|a - b| <= absolute + relative * |b|; two nulls are equal when `null_equal`."""
    a, b = a.cast("double"), b.cast("double")
    near = F.coalesce(F.abs(a - b) <= absolute + relative * F.abs(b), F.lit(False))
    return (near | (a.isNull() & b.isNull())) if null_equal else near


def band(x: Column, bands: tuple) -> tuple[Column, Column]:
    """Right-closed bands -> (label, index). Outside all edges both are null."""
    lower, edges, labels = bands
    inside = F.lit(True) if lower is None else x >= lower
    label = index = None
    for i, (edge, text) in enumerate(zip(edges, labels)):
        test = inside & (x.isNotNull() if edge is None else x <= edge)
        label = F.when(test, text) if label is None else label.when(test, text)
        index = F.when(test, i) if index is None else index.when(test, i)
    return label, index


def quantile_band(x: Column, edges: Sequence[float], labels: Sequence[str]) -> tuple[Column, Column]:
    """Right-closed bands between observed quantiles, lowest value included.

    Repeated edges are dropped; then labels are taken from the front, one per remaining band.
    """
    kept = sorted(set(edges))
    if len(kept) < 2:
        return F.lit(None).cast("string"), F.lit(None).cast("int")
    return band(x, (kept[0], tuple(kept[1:]), tuple(labels[: len(kept) - 1])))


def rounded_clip(x: Column, low: float, high: float) -> Column:
    """Half-to-even rounding of a value held inside [low, high]."""
    return F.rint(F.least(F.greatest(x, F.lit(float(low))), F.lit(float(high))))
