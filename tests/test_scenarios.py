import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.operators import scenarios

SCHEMA = "order_id long, line_number int, user_id long, product_id long, category string, brand string, unit_price double, quantity double, revenue double"


def _line(i, user, product, category, brand, quantity):
    return (i, 1, user, product, category, brand, 10.0, quantity, None if quantity is None else 10.0 * quantity)


LEVELS = [
    # three known lines at the level under test, and one line without quantity
    ("Mismo usuario y producto", [(1, 1, "a", "x", q) for q in (6.0, 7.0, 9.0)], (1, 1, "a", "x")),
    ("Mismo usuario, categoría y marca", [(1, p, "a", "x", 8.0) for p in (2, 3, 4)], (1, 1, "a", "x")),
    ("Mismo usuario y categoría", [(1, p, "a", b, 8.0) for p, b in ((2, "y"), (3, "z"), (4, "x"))], (1, 1, "a", "x")),
    ("Mismo producto", [(u, 1, "a", "x", 8.0) for u in (2, 3, 4)], (1, 1, "a", "x")),
    ("Misma categoría y marca", [(u, u, "a", "x", 8.0) for u in (2, 3, 4)], (1, 1, "a", "x")),
    ("Misma categoría", [(u, u, "a", b, 8.0) for u, b in ((2, "y"), (3, "z"), (4, "w"))], (1, 1, "a", "x")),
    ("Distribución global", [(u, u, c, "y", 8.0) for u, c in ((2, "b"), (3, "c"), (4, "d"))], (1, 1, "a", "x")),
    ("Mismo usuario y categoría", [(None, p, None, b, 8.0) for p, b in ((2, "y"), (3, "z"), (4, "x"))], (None, 1, None, "x")),
]


@pytest.mark.parametrize("method, known, asked", LEVELS)
def test_each_level_of_the_hierarchy(spark, method, known, asked):
    rows = [_line(i, *k) for i, k in enumerate(known)] + [_line(99, *asked, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    row = scenarios.build_retrospective_scenarios(frame).filter("quantity is null").first()
    values = [k[4] for k in known]
    assert row["quantity_estimation_method"] == method and row["quantity_reference_count"] == 3
    assert row["quantity_reference_p90"] == pytest.approx(np.quantile(values, 0.9))
    assert row["quantity_scenario_min"] == 5
    assert row["quantity_scenario_max"] == min(max(np.ceil(np.quantile(values, 0.9)), 5), max(values))
    assert row["quantity"] is None and row["revenue"] is None


def test_brute_force_on_random_lines(spark):
    draw = np.random.default_rng(8)
    rows = []
    for i in range(400):
        q = None if draw.random() < 0.08 else float(draw.integers(-1, 60))
        pick = lambda n: int(draw.integers(0, n))
        user = None if draw.random() < 0.05 else (0 if draw.random() < 0.35 else pick(40))  # one hot user
        rows.append(_line(i, user, pick(25), ["a", "b", None][pick(3)], "xyz"[pick(3)], q))
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {r["order_id"]: r for r in scenarios.build_retrospective_scenarios(frame).collect()}
    assert len(got) == 400
    known = [r for r in rows if r[7] is not None and r[7] > 0]
    top = int(max(r[7] for r in rows if r[7] is not None))
    place = {"user_id": 2, "product_id": 3, "category": 4, "brand": 5}
    for r in rows:
        out = got[r[0]]
        if r[7] is not None:
            assert out["quantity_scenario_max"] == r[7] and out["quantity_estimation_method"] == "Dato original"
            continue
        for name, keys in scenarios.ESTIMATION_LEVELS:
            values = [k[7] for k in known if all(k[place[c]] == r[place[c]] for c in keys)]
            if len(values) >= 3:
                break
        p90 = np.quantile(values, 0.9)
        assert (out["quantity_estimation_method"], out["quantity_reference_count"]) == (name, len(values))
        assert out["quantity_scenario_max"] == min(max(int(np.ceil(round(p90, 6))), 5), top)


def test_too_few_references_is_an_error(spark):
    frame = spark.createDataFrame([_line(1, 1, 1, "a", "x", 4.0), _line(2, 1, 1, "a", "x", None)], SCHEMA)
    with pytest.raises(ValueError):
        scenarios.build_retrospective_scenarios(frame)


def test_source_is_untouched_and_checks_hold(repeated_orders):
    big = repeated_orders.withColumn("quantity", F.col("quantity") + 10).withColumn(
        "revenue", (F.col("unit_price") * F.col("quantity").cast("decimal(12,3)")).cast("decimal(18,4)")
    )
    out = scenarios.build_retrospective_scenarios(big)
    assert out.count() == 60
    check = scenarios.scenario_checks(out).first().asDict()
    assert check.pop("lineas_sin_cantidad") == 1 and set(check.values()) == {0}
    rows = {r["scenario"]: r for r in scenarios.scenario_comparison(out).collect()}
    assert rows["Original conocido"]["difference_vs_original"] == 0
    assert rows["Mínimo mayorista"]["revenue_total"] == pytest.approx(rows["Original conocido"]["revenue_total"] + 5 * 50)
    affected = scenarios.affected_orders(out).collect()
    assert [(r["order_id"], r["product_lines"], r["missing_quantity_lines"]) for r in affected] == [(626, 3, 1)]
    totals = {r["scenario"]: r["revenue"] for r in scenarios.scenario_totals(out).collect()}
    assert totals["Random Forest"] == totals["Original"] < totals["Mínimo mayorista"] <= totals["Máximo jerárquico"]
    assert scenarios.missing_listing(out).count() == 1


def test_board_of_an_empty_selection(repeated_orders):
    row = scenarios.kpi_board(repeated_orders.filter("country = 'nowhere'")).first()
    assert row["revenue"] == 0 and row["leading_country"] == "—" and row["delivered_share"] == 0
