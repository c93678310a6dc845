"""Exact order statistics that never pull a whole column into one task.

* `exact_percentiles`: narrows a bracket around each rank with mergeable sketches until the distinct
  values left fit a bounded aggregation buffer. No row is shuffled; each round is one scan.
* `running_totals`: prefix sums over a total order, cut into value ranges that tasks can hold.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.session import materialize

# A percentile buffer is a value -> count map that one task merges: beyond this size narrowing is faster.
MAX_DISTINCT = 50_000
SKETCH_ACCURACY = 10_000
ROWS_PER_RANGE = 1_000_000
MAX_RANGES = 2_000


def exact_percentiles(
    df: DataFrame,
    wanted: Mapping[str, Sequence[float]],
    max_distinct: int = MAX_DISTINCT,
    accuracy: int = SKETCH_ACCURACY,
) -> dict[str, list[float | None]]:
    """Linear-interpolated percentiles of several columns, as a few driver scalars.

    All columns and probabilities share each scan: one for the sizes, one for the final values, and two
    per narrowing round for the columns with very many distinct values.
    """
    x = {name: F.col(name).cast("double") for name in wanted}
    slim = df.select(*[c.alias(n) for n, c in x.items()])
    quoted = {n: F.col(f"`{n}`") for n in wanted}
    sizes = slim.agg(
        *[F.count(c).alias(f"n_{n}") for n, c in quoted.items()],
        *[F.approx_count_distinct(c).alias(f"d_{n}") for n, c in quoted.items()],
    ).first()
    targets = [
        _Bracket(quoted[n], (sizes[f"n_{n}"] - 1) * p, sizes[f"n_{n}"], sizes[f"d_{n}"], 2.0 / accuracy)
        for n, ps in wanted.items()
        for p in ps
    ]
    while wide := [t for t in targets if t.inside and t.distinct > max_distinct and t.low < t.high]:
        edges = slim.agg(*[t.edges(accuracy).alias(f"e{i}") for i, t in enumerate(wide)]).first()
        trial = [(t, *edges[f"e{i}"]) for i, t in enumerate(wide)]
        counts = slim.agg(
            *[F.count_if(t.x < lo).alias(f"b{i}") for i, (t, lo, _) in enumerate(trial)],
            *[F.count_if(t.x.between(lo, hi)).alias(f"i{i}") for i, (t, lo, hi) in enumerate(trial)],
            *[F.approx_count_distinct(F.when(t.x.between(lo, hi), t.x)).alias(f"d{i}") for i, (t, lo, hi) in enumerate(trial)],
        ).first()
        for i, (t, lo, hi) in enumerate(trial):
            t.narrow(lo, hi, counts[f"b{i}"], counts[f"i{i}"], counts[f"d{i}"], 2.0 / accuracy)
    open_targets = [t for t in targets if t.inside and t.low < t.high]
    if open_targets:
        row = slim.agg(*[t.value().alias(f"v{i}") for i, t in enumerate(open_targets)]).first()
        for i, t in enumerate(open_targets):
            t.low = t.high = row[f"v{i}"]
    answers = iter(targets)
    return {n: [t.low if t.inside else None for t in (next(answers) for _ in ps)] for n, ps in wanted.items()}


@dataclass
class _Bracket:
    """A value range that surely holds one rank, with the rows below and inside it."""

    x: Column
    rank: float
    inside: int
    distinct: int
    slack: float
    low: float = -math.inf
    high: float = math.inf
    below: int = 0

    @property
    def _place(self) -> float:
        return (self.rank - self.below) / max(self.inside - 1, 1)

    @property
    def _held(self) -> Column:
        return self.x if self.low == -math.inf else F.when(self.x.between(self.low, self.high), self.x)

    def edges(self, accuracy: int) -> Column:
        """Sketched values a little before and after the rank."""
        return F.percentile_approx(
            self._held, [max(self._place - self.slack, 0.0), min(self._place + self.slack, 1.0)], accuracy
        )

    def narrow(self, low: float, high: float, below: int, inside: int, distinct: int, slack: float) -> None:
        """Take the smaller range when the counts prove that it holds the rank; else look wider."""
        if below <= math.floor(self.rank) and math.ceil(self.rank) < below + inside and (low, high) != (self.low, self.high):
            self.low, self.high, self.below, self.inside, self.distinct, self.slack = low, high, below, inside, distinct, slack
        else:
            self.slack *= 4

    def value(self) -> Column:
        return F.percentile(self._held, self._place)


def value_ranges(df: DataFrame, column: str, parts: int, into: str) -> tuple[DataFrame, list[float]]:
    """Ascending range number of a numeric column, about one range per part.

    A value at a cut gets a (half-numbered) range of its own, nulls come before all. Values that span whole
    parts are returned as well: they are the ones worth cutting again by another column.
    """
    raw = df.agg(
        F.percentile_approx(column, [i / parts for i in range(1, parts)], max(SKETCH_ACCURACY, 10 * parts)).alias("e")
    ).first()["e"]
    if raw is None:  # no value at all
        return df.withColumn(into, F.lit(-1.0)), []
    cuts = sorted({float(c) for c in raw})
    heavy = [c for c in cuts if raw.count(c) > 1]
    ranged = Bucketizer(
        splits=[-math.inf, *cuts, math.inf], inputCol=column, outputCol=into, handleInvalid="keep"
    ).transform(df)
    starts = F.array(F.lit(-math.inf), *[F.lit(c) for c in cuts])
    at_cut = F.col(column) == F.element_at(starts, F.least(F.col(into), F.lit(len(cuts))).cast("int") + 1)
    number = F.when(F.col(column).isNull(), -1.0).when(at_cut, F.col(into) - 0.5).otherwise(F.col(into))
    return ranged.withColumn(into, number), heavy


def running_totals(
    df: DataFrame,
    order: str,
    totals: Mapping[str, Column],
    tie: str | None = None,
    by: Sequence[str] = (),
    descending: bool = False,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Inclusive prefix sums of `totals` along `order` (then `tie`), per group of the non-null `by`.

    The rows are cut into value ranges, two at least: each range is one window partition, and the sums of the
    earlier ranges come from a frame with one row per range. A value with very many rows is cut again by
    `tie`, so no task holds more than its share. Beyond MAX_RANGES ranges, ranges grow instead.
    """
    names = list(totals)
    base = materialize(
        df.withColumns(
            {
                "_x": F.col(order).cast("double") * (-1 if descending else 1),
                **({"_t": F.col(tie).cast("double")} if tie else {}),
                **{f"_v_{n}": c for n, c in totals.items()},
            }
        )
    )
    order_keys = ["_x", "_t"] if tie else ["_x"]
    parts = min(max(base.count() // rows_per_range, 2), MAX_RANGES)
    ranged, heavy = value_ranges(base, "_x", parts, "_range")
    keys = [*by, "_range"]
    if tie and heavy:
        ranged, _ = value_ranges(ranged, "_t", parts, "_tie_range")
        ranged = ranged.withColumn("_tie_range", F.when(F.col("_x").isin(heavy), F.col("_tie_range")).otherwise(0.0))
        keys.append("_tie_range")
    per_range = ranged.groupBy(*keys).agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in names])
    # one row per range: at most 2 x MAX_RANGES, more only for the tie ranges of heavy values
    earlier = Window.partitionBy(*by).orderBy(*keys[len(by):]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        *keys, *[F.coalesce(F.sum(f"_s_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in names]
    )
    inside = Window.partitionBy(*keys).orderBy(*order_keys).rowsBetween(Window.unboundedPreceding, 0)
    # the join and the window share the keys, so the rows are shuffled once
    return ranged.join(offsets, keys).select(
        *df.columns, *[(F.col(f"_o_{n}") + F.sum(f"_v_{n}").over(inside)).alias(n) for n in names]
    )
