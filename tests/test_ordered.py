"""Exact order statistics against brute force, through the paths meant for very large columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.functions import tails
from orderlens.operators import inference, ordered

PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


@pytest.mark.parametrize("shape", ["spread", "hot", "few"])
def test_percentiles_by_narrowing(spark, shape):
    draw = np.random.default_rng(3)
    values = draw.normal(100, 30, 5000).round(4)
    if shape == "hot":
        values[draw.random(5000) < 0.4] = 77.0
    if shape == "few":
        values = values.round(-1)
    frame = spark.createDataFrame([(float(v),) for v in values] + [(None,)] * 50, "x double").repartition(5)
    found = ordered.exact_percentiles(frame, {"x": PROBABILITIES}, max_distinct=60, accuracy=200)["x"]
    assert found == pytest.approx(list(np.quantile(values, PROBABILITIES)), abs=1e-9)
    direct = ordered.exact_percentiles(frame, {"x": PROBABILITIES})["x"]
    assert direct == pytest.approx(found, abs=1e-9)


def test_percentiles_of_nothing(spark):
    frame = spark.createDataFrame([(None,)], "x double")
    assert ordered.exact_percentiles(frame, {"x": [0.5]}) == {"x": [None]}


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_cut_a_hot_value(spark, descending):
    draw = np.random.default_rng(5)
    values = draw.integers(0, 400, 3000)
    values[:1200] = 250  # one value holds more than a third of the rows
    rows = [(int(i), int(v), int(i % 7)) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "id long, v long, w long").repartition(6)
    out = ordered.running_totals(
        frame, "v", {"until": F.col("w"), "place": F.lit(1)}, tie="id", descending=descending, rows_per_range=200
    )
    got = {r["id"]: (r["until"], r["place"]) for r in out.collect()}
    total, want = 0, {}
    for place, (i, _, w) in enumerate(sorted(rows, key=lambda r: (-r[1] if descending else r[1], r[0])), 1):
        total += w
        want[i] = (total, place)
    assert got == want


def test_hot_value_is_spread_over_ranges(spark):
    frame = spark.range(4000).select("id", F.when(F.col("id") < 2000, 5.0).otherwise(F.col("id").cast("double")).alias("_x"))
    ranged, heavy = ordered.value_ranges(frame, "_x", 20, "_range")
    assert heavy == [5.0]
    sizes = {r["_range"]: r["count"] for r in ranged.groupBy("_range").count().collect()}
    assert max(n for k, n in sizes.items() if k == int(k)) <= 400


def test_running_totals_by_group(spark):
    rows = [(g, float(v), 1) for g in ("a", "b") for v in range(300)]
    frame = spark.createDataFrame(rows, "g string, v double, n long")
    out = ordered.running_totals(frame, "v", {"c": F.col("n")}, by=["g"], rows_per_range=50)
    assert all(r["c"] == r["v"] + 1 for r in out.collect()) and out.count() == 600


def test_tails_against_known_values():
    assert tails.normal_two_sided(1.959963984540054) == pytest.approx(0.05, rel=1e-12)
    assert tails.student_two_sided(2.2281388519649385, 10) == pytest.approx(0.05, rel=1e-9)
    assert tails.student_two_sided(1.0, 1) == pytest.approx(0.5, rel=1e-12)
    assert tails.chi_square_tail(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-9)
    assert tails.chi_square_tail(18.307038053275146, 10) == pytest.approx(0.05, rel=1e-9)
    assert tails.chi_square_tail(2.0, 2) == pytest.approx(np.exp(-1.0), rel=1e-12)
    # three against three, fully separated: 2 of 20 arrangements
    assert tails.exact_rank_sum_p(0.0, 3, 3) == pytest.approx(0.1)
    assert tails.correlation_p(0.0, 30) == pytest.approx(1.0)


def _orders(spark, n=400):
    draw = np.random.default_rng(11)
    flag = draw.integers(0, 2, n)
    x = (draw.normal(0, 1, n) + flag * 0.4).round(1)
    y = draw.integers(0, 4, n)
    rows = [(int(f), float(a) if i % 17 else None, f"k{b}", "only") for i, (f, a, b) in enumerate(zip(flag, x, y))]
    return rows, spark.createDataFrame(rows, "cancelled_flag int, x double, k string, c string")


def test_rank_sum_against_pairs(spark):
    rows, frame = _orders(spark)
    a = np.array([r[1] for r in rows if r[0] == 1 and r[1] is not None])
    b = np.array([r[1] for r in rows if r[0] == 0 and r[1] is not None])
    u = (a[:, None] > b[None, :]).sum() + 0.5 * (a[:, None] == b[None, :]).sum()
    row = inference.mann_whitney(frame, ["x"]).first()
    assert (row["n1"], row["n0"], row["u"]) == (len(a), len(b), u)
    result = inference.numeric_tests(frame, ["x"]).first()
    assert result["media_cancelados"] == pytest.approx(a.mean()) and result["mediana_no_cancelados"] == pytest.approx(np.median(b))
    pooled = ((len(a) - 1) * a.var(ddof=1) + (len(b) - 1) * b.var(ddof=1)) / (len(a) + len(b) - 2)
    assert result["smd"] == pytest.approx((a.mean() - b.mean()) / np.sqrt(pooled))
    assert 0 < result["mann_whitney_p"] < 0.05 and result["evidencia_p_menor_005"]


def test_small_untied_sample_uses_the_exact_distribution(spark):
    frame = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 3.0), (0, 4.0), (0, 5.0), (0, 6.0)], "cancelled_flag int, x double")
    assert inference.numeric_tests(frame, ["x"]).first()["mann_whitney_p"] == pytest.approx(0.1)


def test_chi_square_with_and_without_correction(spark):
    table = [(1, "a")] * 12 + [(0, "a")] * 5 + [(1, "b")] * 6 + [(0, "b")] * 11
    frame = spark.createDataFrame([(f, v, "x") for f, v in table], "cancelled_flag int, k string, c string")
    found = {r["variable"]: r for r in inference.categorical_tests(frame, ["k", "c"]).collect()}
    observed = np.array([[12, 5], [6, 11]], float)
    expected = observed.sum(1, keepdims=True) * observed.sum(0) / observed.sum()
    chi2 = ((np.abs(observed - expected) - 0.5) ** 2 / expected).sum()
    assert found["k"]["chi2"] == pytest.approx(chi2) and found["k"]["grados_libertad"] == 1
    assert found["k"]["cramers_v"] == pytest.approx(np.sqrt(chi2 / 34))
    assert found["c"]["chi2"] is None and not found["c"]["evidencia_p_menor_005"]


def test_chi_square_builds_its_orders_once(spark):
    """The totals and the parts of the tables share one count of the cells."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    frame = spark.createDataFrame([(i % 2, "ab"[i // 7 % 2]) for i in range(40)], "cancelled_flag int, k string").mapInPandas(counted, "cancelled_flag int, k string")
    chosen = frame.groupBy("k", "cancelled_flag").count()
    assert inference.chi_square(chosen, ["k"]).count() == 1
    plan = inference.chi_square(chosen, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert seen.value == 80 and "MapInPandas" not in plan


def test_spearman_uses_complete_pairs(spark):
    import pandas as pd

    draw = np.random.default_rng(2)
    data = pd.DataFrame({"a": draw.integers(0, 9, 200).astype(float), "b": draw.normal(0, 1, 200).round(1)})
    data["c"] = data["a"] * 2 + draw.normal(0, 3, 200).round(0)
    data.loc[::7, "b"] = np.nan
    rows = [tuple(None if pd.isna(v) else float(v) for v in r) for r in data.itertuples(index=False)]
    frame = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r["variable"], r["otra"]): r["rho"] for r in inference.spearman(frame, ["a", "b", "c"]).collect()}
    for p in ("a", "b", "c"):
        for q in ("a", "b", "c"):
            both = data[[p, q]].dropna() if p != q else data[[p]].dropna()
            want = 1.0 if p == q else both[p].rank().corr(both[q].rank())
            assert got[p, q] == pytest.approx(want, abs=1e-12)


def test_spearman_of_many_values_with_nulls_on_both_sides(spark, monkeypatch):
    """Ranks looked up by a shuffle, gaps that differ, a constant, an empty attribute; no row comes once for each pair."""
    import pandas as pd

    monkeypatch.setattr(inference, "FEW_VALUES", 5)
    draw = np.random.default_rng(8)
    data = pd.DataFrame({"a": draw.normal(0, 1, 300).round(2), "b": draw.integers(0, 4, 300).astype(float)})
    data["c"], data["d"], data["e"] = data["a"] + draw.normal(0, 1, 300).round(1), 3.0, np.nan
    data.loc[::5, "a"], data.loc[1::5, "c"], data.loc[::3, "b"] = np.nan, np.nan, np.nan
    rows = [tuple(None if pd.isna(v) else float(v) for v in r) for r in data.itertuples(index=False)]
    frame = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(3)
    ranked = []
    monkeypatch.setattr(inference, "running_totals", lambda df, *args, **more: ranked.append(df.count()) or ordered.running_totals(df, *args, **more))
    got = {(r["variable"], r["otra"]): r["rho"] for r in inference.spearman(frame, list("abcde")).collect()}
    assert len(got) == 4 * 4 + 1 and got["e", "e"] == 1.0
    for p in "abc":
        assert got[p, "d"] is None and got["d", p] is None
        for q in "abc":
            both = data[[p, q]].dropna() if p != q else data[[p]].dropna()
            assert got[p, q] == pytest.approx(1.0 if p == q else both[p].rank().corr(both[q].rank()), abs=1e-12)
    assert ranked == [data.nunique().sum()]  # a value is ranked once, not once for each pair


def test_shared_folder_follows_the_session(spark, tmp_path):
    from orderlens.session import shared_folder, stored

    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == (named or spark.sparkContext.getCheckpointDir())
    frame = spark.range(20).withColumn("d", F.col("id").cast("decimal(18,4)"))
    assert stored(frame).dtypes == frame.dtypes and stored(frame).count() == 20


def test_running_totals_of_few_rows_nulls_and_none(spark):
    totals = lambda rows: sorted(
        (r["k"], r["c"]) for r in ordered.running_totals(spark.createDataFrame(rows, "k long, v double"), "v", {"c": F.col("k")}, tie="k").collect()
    )
    assert totals([(1, 5.0), (2, None), (4, 3.0), (8, 3.0), (16, None)]) == [(1, 31), (2, 2), (4, 22), (8, 30), (16, 18)]
    assert totals([(1, None), (2, None)]) == [(1, 1), (2, 3)]
    assert totals([(1, 5.0)]) == [(1, 1)]
    assert totals([]) == []


@pytest.mark.parametrize("skip", [0, 3, 495, 990, 1496, 1500, 2000])
def test_pages_of_any_depth(spark, skip):
    """Keys repeat, some are null, one holds a third of all rows; the page is that of a full sort."""
    from orderlens.operators import filters

    rows = [(None if i % 50 == 0 else 7 if i % 3 == 0 else i * 31 % 997, i) for i in range(1500)]
    df = spark.createDataFrame(rows, "k long, t int").repartition(5)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))[skip : skip + 20]
    got = filters.page(df, "k", skip, 20, ties=["t"], rows=40)
    found = got.collect()
    assert [(r["k"], r["t"]) for r in found] == want and all((r["total"], r["count"]) == (1500, len(want)) for r in found)
    part, before = filters._holding(df, "k", 1400, 20, 40)
    assert part.count() <= 200 and before > 1200
