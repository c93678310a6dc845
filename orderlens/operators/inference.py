"""Tests between cancelled and other orders, and rank correlation.

Spark reduces the data to a few numbers per variable; the closed forms then work on those.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions import tails
from orderlens.operators.ordered import exact_percentiles, running_totals
from orderlens.operators.shape import long_form
from orderlens.session import materialize, stored

NUMERIC_VARIABLES = (
    "total_quantity", "order_revenue", "line_count", "avg_unit_price",
    "avg_discount", "avg_inventory", "avg_rating", "age",
)
CATEGORICAL_VARIABLES = (
    "country", "channel", "retailer_type", "dominant_price_segment", "dominant_category", "month", "quarter",
)
EXACT_SAMPLE = 8
FEW_VALUES = 100_000  # ranks of an attribute with so many values at most are sent to every task


def mann_whitney(orders: DataFrame, variables: Sequence[str] = NUMERIC_VARIABLES) -> DataFrame:
    """U of the cancelled group and its z (ties and continuity corrected) for every variable in one pass.

    Values are reduced to (variable, value) counts; mid-ranks come from their running count.
    """
    values = long_form(orders, variables, "double", ["cancelled_flag"]).filter("value is not null")
    counts = values.groupBy("variable", "value").agg(
        F.count(F.lit(1)).alias("_t"), F.sum("cancelled_flag").alias("_t1")
    )
    ranked = running_totals(counts, "value", {"_until": F.col("_t")}, by=["variable"])
    ties = F.col("_t").cast("double")
    mid_rank = F.col("_until") - (F.col("_t") - 1) / 2
    sums = ranked.groupBy("variable").agg(
        F.sum("_t1").cast("double").alias("n1"),
        F.sum(F.col("_t") - F.col("_t1")).cast("double").alias("n0"),
        F.sum(F.col("_t1") * mid_rank).alias("_r1"),
        F.sum(ties * ties * ties - ties).alias("_ties"),
    )
    n, n1, n0 = F.col("n1") + F.col("n0"), F.col("n1"), F.col("n0")
    u = F.col("_r1") - n1 * (n1 + 1) / 2
    spread = F.sqrt(n1 * n0 / 12 * ((n + 1) - F.try_divide(F.col("_ties"), n * (n - 1))))
    z = F.try_divide(F.greatest(F.col("u"), n1 * n0 - F.col("u")) - n1 * n0 / 2 - 0.5, spread)
    return sums.withColumn("u", u).select(
        "variable", n1.cast("long").alias("n1"), n0.cast("long").alias("n0"), "u", z.alias("z"),
        (F.col("_ties") > 0).alias("has_ties"),
    )


def _mann_whitney_p(row, method: str = "auto") -> float | None:
    """`exact` sums over all arrangements, `asymptotic` takes the normal tail, `auto` is exact for at most 8 untied values on a side."""
    if not row["n1"] or not row["n0"] or row["z"] is None:
        return None
    few = min(row["n1"], row["n0"]) <= EXACT_SAMPLE and not row["has_ties"]
    if method == "exact" or (method == "auto" and few):
        return tails.exact_rank_sum_p(row["u"], row["n1"], row["n0"])
    return min(1.0, math.erfc(row["z"] / math.sqrt(2.0)))


def group_comparison(orders: DataFrame, variables: Sequence[str] = NUMERIC_VARIABLES) -> DataFrame:
    """Means, exact medians, point-biserial r and standardized mean difference per variable."""
    flag = F.col("cancelled_flag")
    side = {
        f"{v}|{k}": F.when(flag == k, F.col(v).cast("double")) for v in variables for k in (1, 0)
    }
    split = materialize(orders.select(flag, *[c.alias(n) for n, c in side.items()]))
    medians = exact_percentiles(split.drop("cancelled_flag"), {n: [0.5] for n in side})
    aggregates = []
    for v in variables:
        a, b = F.col(f"`{v}|1`"), F.col(f"`{v}|0`")
        n1, n0 = F.count(a), F.count(b)
        pooled = F.try_divide(
            F.coalesce((n1 - 1) * F.var_samp(a), F.lit(0.0)) + F.coalesce((n0 - 1) * F.var_samp(b), F.lit(0.0)), n1 + n0 - 2
        )
        x = F.coalesce(a, b)
        aggregates.append(
            F.struct(
                F.lit(v).alias("variable"),
                F.avg(a).alias("media_cancelados"),
                F.lit(medians[f"{v}|1"][0]).cast("double").alias("mediana_cancelados"),
                F.avg(b).alias("media_no_cancelados"),
                F.lit(medians[f"{v}|0"][0]).cast("double").alias("mediana_no_cancelados"),
                F.corr(F.when(x.isNotNull(), flag.cast("double")), x).alias("correlacion_punto_biserial"),
                (n1 + n0).alias("pares"),
                F.when(pooled > 0, (F.avg(a) - F.avg(b)) / F.sqrt(pooled)).alias("smd"),
            ).alias(v)
        )
    return split.agg(*aggregates).select(F.inline(F.array(*variables)))


def numeric_tests(orders: DataFrame, variables: Sequence[str] = NUMERIC_VARIABLES) -> DataFrame:
    """The whole numeric table with p values; one row per variable."""
    once = materialize(orders.select("cancelled_flag", *variables))  # one row per order
    ranks = {r["variable"]: r for r in mann_whitney(once, variables).collect()}
    rows = []
    for r in group_comparison(once, variables).collect():
        p = _mann_whitney_p(ranks[r["variable"]]) if r["variable"] in ranks else None
        rows.append(
            (
                r["variable"], r["media_cancelados"], r["mediana_cancelados"], r["media_no_cancelados"],
                r["mediana_no_cancelados"], p, r["correlacion_punto_biserial"],
                tails.correlation_p(r["correlacion_punto_biserial"], r["pares"]), r["smd"], p is not None and p < 0.05,
            )
        )
    return orders.sparkSession.createDataFrame(
        sorted(rows, key=lambda t: (t[5] is None, t[5], t[0])),
        "variable string, media_cancelados double, mediana_cancelados double, media_no_cancelados double, "
        "mediana_no_cancelados double, mann_whitney_p double, correlacion_punto_biserial double, "
        "correlacion_p double, smd double, evidencia_p_menor_005 boolean",
    )


def chi_square(orders: DataFrame, variables: Sequence[str] = CATEGORICAL_VARIABLES) -> DataFrame:
    """Chi-square of independence from the cancelled flag, degrees of freedom and Cramér's V per variable.

    A table with one degree of freedom gets Yates' correction; null labels are left out.
    """
    cells = materialize(  # the totals and the parts both read them; the orders are built once
        long_form(orders, variables, "string", ["cancelled_flag"])
        .filter("value is not null")
        .groupBy("variable", "value")
        .agg(F.sum("cancelled_flag").cast("double").alias("_o1"), F.sum(1 - F.col("cancelled_flag")).cast("double").alias("_o0"))
    )
    tables = cells.groupBy("variable").agg(
        F.sum("_o1").alias("_n1"), F.sum("_o0").alias("_n0"), F.count(F.lit(1)).alias("_rows")
    )
    joined = cells.join(F.broadcast(tables), "variable")  # one row per variable
    n = F.col("_n1") + F.col("_n0")
    row = F.col("_o1") + F.col("_o0")
    columns = (F.col("_n1") > 0).cast("int") + (F.col("_n0") > 0).cast("int")
    freedom = (F.col("_rows") - 1) * (columns - 1)

    def part(observed, column):
        expected = row * F.col(column) / n
        gap = F.abs(F.col(observed) - expected)
        corrected = F.when(freedom == 1, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
        return F.coalesce(F.try_divide(corrected * corrected, expected), F.lit(0.0))

    sums = joined.groupBy("variable").agg(
        F.sum(part("_o1", "_n1") + part("_o0", "_n0")).alias("_chi2"),
        F.first("_n1").alias("_n1"), F.first("_n0").alias("_n0"), F.first("_rows").alias("_rows"),
    )
    usable = (F.col("_rows") >= 2) & (columns >= 2)
    smaller = F.least(F.col("_rows") - 1, columns - 1)
    return sums.select(
        "variable",
        F.when(usable, F.col("_chi2")).alias("chi2"),
        F.when(usable, freedom).cast("int").alias("grados_libertad"),
        F.when(usable, F.sqrt(F.col("_chi2") / n / smaller)).alias("cramers_v"),
    )


def categorical_tests(orders: DataFrame, variables: Sequence[str] = CATEGORICAL_VARIABLES) -> DataFrame:
    """The whole categorical table with p values; one row per variable."""
    found = {r["variable"]: r for r in chi_square(orders, variables).collect()}
    rows = []
    for v in variables:
        r = found.get(v)
        usable = r is not None and r["chi2"] is not None
        p = tails.chi_square_tail(r["chi2"], r["grados_libertad"]) if usable else None
        rows.append(
            (
                v, r["chi2"] if usable else None, r["grados_libertad"] if usable else None, p,
                r["cramers_v"] if usable else None, p is not None and p < 0.05,
            )
        )
    return orders.sparkSession.createDataFrame(
        sorted(rows, key=lambda t: (t[3] is None, t[3], t[0])),
        "variable string, chi2 double, grados_libertad int, p_value double, cramers_v double, evidencia_p_menor_005 boolean",
    )


def _counted_values(rows: DataFrame, attributes: Sequence[str], known: dict[str, str]) -> DataFrame:
    """side, value and the rows that have it: in all (t_all), and with each attribute of `known` beside it."""
    sides = [
        rows.filter(F.col(a).isNotNull()).groupBy(F.col(a).alias("value"))
        .agg(F.count(F.lit(1)).alias("t_all"), *[F.count(k).alias(f"t_{n}") for k, n in known.items()])
        .select(F.lit(i).alias("side"), "*")
        for i, a in enumerate(attributes)
    ]
    return reduce(DataFrame.unionByName, sides)


def spearman(df: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Rank correlation of every pair over its complete rows, in long form (both directions and the diagonal).

    Each value of an attribute is ranked once by the running counts of its values: among all its rows and, for every other
    attribute with nulls, among the rows that have that one. Ranks are taken from their mean, which is that of 1 to n. The rows
    then look up their values, so a pair is a product of two columns and no row comes once for each pair.
    """
    names = [f"x{i}" for i in range(len(attributes))]
    rows = stored(df.select(*[F.col(a).cast("double").alias(x) for a, x in zip(attributes, names, strict=True)]))
    nulls = rows.agg(*[F.count_if(F.col(x).isNull()).alias(x) for x in names]).first()
    known = {x: f"with_{x}" for x in names if nulls[x]}
    kinds = ["all", *known.values()]
    values = stored(_counted_values(rows, names, known))
    totals = values.groupBy("side").agg(F.count(F.lit(1)).alias("values"), *[F.sum(f"t_{k}").alias(f"n_{k}") for k in kinds])
    running = running_totals(values, "value", {f"until_{k}": F.col(f"t_{k}") for k in kinds}, by=["side"])
    rank = lambda k: F.col(f"until_{k}") - (F.col(f"t_{k}") - 1) / 2 - (F.col(f"n_{k}") + 1) / 2
    ranks = stored(running.join(F.broadcast(totals), "side").withColumns({f"r_{k}": rank(k) for k in kinds}))  # one total per attribute
    squares = [F.sum(F.col(f"t_{k}") * F.col(f"r_{k}") * F.col(f"r_{k}")).alias(f"s_{k}") for k in kinds]
    sides = {r["side"]: r for r in ranks.groupBy("side", "values", *[f"n_{k}" for k in kinds]).agg(*squares).collect()}

    met = rows
    for i in sorted(sides, key=lambda i: -sides[i]["values"]):  # the widest rows meet the shortest lists
        wanted = dict.fromkeys(known.get(x, "all") for x in names if x != names[i])
        own = ranks.filter(F.col("side") == i).select(F.col("value").alias(names[i]), *[F.col(f"r_{k}").alias(f"{names[i]}_{k}") for k in wanted])
        met = met.join(F.broadcast(own) if sides[i]["values"] <= FEW_VALUES else own, names[i], "left").drop(names[i])
    products, pairs = [], []
    for i, j in combinations(range(len(names)), 2):
        of_i, of_j = known.get(names[j], "all"), known.get(names[i], "all")
        if i in sides and j in sides and sides[i][f"n_{of_i}"]:
            products.append(F.sum(F.col(f"{names[i]}_{of_i}") * F.col(f"{names[j]}_{of_j}")).alias(f"p{i}_{j}"))
            rho = F.try_divide(F.col(f"p{i}_{j}"), F.lit(math.sqrt(sides[i][f"s_{of_i}"]) * math.sqrt(sides[j][f"s_{of_j}"])))
            pairs += [F.struct(F.lit(attributes[a]).alias("variable"), F.lit(attributes[b]).alias("otra"), rho.alias("rho")) for a, b in ((i, j), (j, i))]
    diagonal = df.sparkSession.createDataFrame([(a, a, 1.0) for a in attributes], "variable string, otra string, rho double")
    return met.agg(*products).select(F.inline(F.array(*pairs))).unionByName(diagonal) if pairs else diagonal
