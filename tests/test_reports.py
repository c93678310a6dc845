import datetime

import pytest
from pyspark.sql import functions as F

from orderlens.models.features import build_customer_features
from orderlens.operators import baskets, filters, kpis, order_level, outliers, profile, rankings
from orderlens.plans import dashboard

SCHEMA = (
    "order_id long, line_number int, user_id long, customer_name string, country string, retailer_type string, channel string, category string, "
    "order_status string, order_date date, year_month string, price_segment string, product_id long, product_name string, brand string, "
    "unit_price double, discount_percentage double, inventory double, rating double, age int, city string, quantity double, "
    "revenue double, valid_sales_flag boolean"
)


def line(order, number, user, country, status, month, product, price, quantity, discount=5.0, category="Footwear"):
    revenue = None if quantity is None else price * quantity
    return (
        order, number, user, f"Cliente {user}", country, "Chain", "Distributor", category, status, datetime.date(2024, month, 10),
        f"2024-{month:02d}", "Premium" if price > 200 else "Medio", product, f"P{product}", "Uno", price, discount, 3.0, 4.0, 30, "X",
        quantity, revenue, revenue is not None,
    )


@pytest.fixture
def df(spark):
    rows = [
        line(1, 1, 1, "Chile", "delivered", 1, 1, 100.0, 2.0),
        line(1, 2, 1, "Chile", "delivered", 1, 2, 300.0, 1.0, 30.0, "Apparel"),
        line(2, 1, 1, "Chile", "cancelled", 3, 1, 100.0, 1.0, 0.0),
        line(3, 1, 2, None, "shipped", 4, 1, 100.0, 6.0, None),
        line(4, 1, 3, "Perú", "confirmed", 4, 3, 50.0, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_kpis(df):
    row = kpis.calculate_kpis(df).first()
    assert (row["total_revenue"], row["units_sold"], row["orders"], row["customers"]) == (1200.0, 10.0, 3, 2)
    assert row["average_order_revenue"] == 400 and row["average_unit_price"] == 120
    # equal leaders: the null label comes first, as the smallest
    assert row["leading_country"] is None and row["leading_country_share"] == 0.5
    assert row["delivered_order_rate"] == 0.25
    assert row["latest_month_change"] == 5.0  # April against March: the gap of February is not filled


def test_kpis_of_nothing(df):
    row = kpis.calculate_kpis(df.filter("false")).first()
    assert row["orders"] == 0 and row["delivered_order_rate"] == 0 and row["latest_month_change"] is None


def test_summaries_add_up(df):
    sales = filters.valid_sales(df)
    rows = kpis.dimension_summary(sales, "country").collect()
    assert {r["country"] for r in rows} == {"Chile", None}
    assert sum(r["participacion_revenue_pct"] for r in rows) == pytest.approx(100)
    assert filters.valid_sales(df.drop("valid_sales_flag")).count() == sales.count() == 4
    stages = {r["revenue_stage"]: r["revenue"] for r in kpis.revenue_stage_summary(sales).collect()}
    assert stages == {"realizado": 500.0, "cancelado": 100.0, "en_proceso": 600.0}
    split = kpis.status_value_split(sales).first()
    assert split["potential_recovery"] == 0 and split["pipeline_share"] == 0.5
    assert kpis.status_summary(df).filter("order_status = 'confirmed'").first()["unidades"] == 0
    matrix = kpis.status_matrix(sales, "country").first()
    assert (matrix["total"], matrix["shipped"]) == (600.0, 0.0)


def test_rankings(df, spark):
    sales = filters.valid_sales(df).fillna({"country": "Perú"})
    pareto = rankings.customer_summary(sales)
    rows = {r["user_id"]: r["participacion_acumulada_pct"] for r in pareto.collect()}
    assert rows == {1: 50.0, 2: 100.0}
    assert rankings.customers_to_share(pareto).first()["customers_to_share"] == 2
    active = filters.active_sales(df)
    top = rankings.top_products(active, 1).first()
    assert (top["product_id"], top["unidades"]) == (1, 8.0)
    common = rankings.top_commonality(active, 1).first()
    assert common["participacion_en_unidades_pct"] == pytest.approx(8 / 9 * 100)
    assert common["descuento_promedio_otros"] == 30
    users = spark.createDataFrame([(1,), (2,), (3,), (4,)], "user_id long")
    assert {r["user_id"] for r in rankings.customers_without_sales(users, sales).collect()} == {3, 4}


def test_bands_and_baskets(df):
    sales = filters.valid_sales(df)
    bands = {r["banda_descuento"]: r["lineas"] for r in baskets.discount_bands(sales).collect()}
    assert bands == {"0%": 1, ">0–10%": 1, ">10–20%": 0, ">20%": 1}
    assert {r["discount_band"] for r in baskets.discount_bands_executive(sales).collect()} == {"0–5%"}
    row = baskets.category_baskets(sales, "Footwear", ["Apparel", "Equipment"]).first()
    assert row["multi_category_share"] == pytest.approx(1 / 3) and row["attach_Apparel"] == pytest.approx(1 / 3)
    assert row["attach_Equipment"] == 0
    assert baskets.category_baskets(sales, "Nada", ["Apparel"]).first()["attach_Apparel"] is None


def test_order_level_and_rates(df):
    orders = order_level.order_level(df)
    rows = {r["order_id"]: r for r in orders.collect()}
    assert len(rows) == 4 and rows[1]["dominant_category"] == "Apparel"  # a tie takes the lowest label
    assert rows[4]["total_quantity"] == 0 and rows[4]["order_revenue"] == 0
    assert rows[1]["avg_unit_price"] == 200 and rows[1]["avg_discount"] == 17.5 and rows[3]["avg_discount"] is None
    rates = {r["country"]: r["tasa_cancelacion"] for r in order_level.cancellation_rate(orders, "country").collect()}
    assert rates == {"Chile": 0.5, None: 0.0, "Perú": 0.0}
    bands = order_level.cancellation_by_quantity_band(orders).collect()
    assert sum(r["pedidos"] for r in bands) == 4
    assert order_level.product_cancellation(df, min_orders=3).first()["tasa_cancelacion"] == pytest.approx(1 / 3)
    only = {(r["variable"], r["value"], r["grupo"]) for r in rankings.exclusive_values(orders, ["country"]).collect()}
    assert only == {("country", "Perú", "solo_en_no_cancelados")}


def test_quartile_bands_share_ties(spark):
    orders = spark.createDataFrame([(i, 5.0 if i < 9 else 50.0, int(i % 2)) for i in range(10)], "order_id long, total_quantity double, cancelled_flag int")
    rows = {r["quantity_band"]: r["pedidos"] for r in order_level.cancellation_by_quantity_band(orders).collect()}
    assert rows == {"Q1 - baja": 10}


def test_outlier_study(spark, df):
    df = df.withColumn("catalog_price", F.col("unit_price"))
    copies = df.filter("product_id = 1").crossJoin(spark.range(40)).drop("id")
    many = df.unionByName(copies.withColumn("unit_price", F.col("unit_price") + F.rand(1)))
    flagged = outliers.flag_outliers(many, ["unit_price", "revenue"])
    assert flagged.filter("any_outlier_iqr and outlier_variables = ''").isEmpty()
    summary = outliers.product_price_summary(flagged)
    assert summary.filter("lineas_con_algun_outlier = 0").isEmpty()
    bins = outliers.distribution(df, "revenue", 5).orderBy("bin").collect()
    assert len(bins) == 5 and sum(r["lineas"] for r in bins) == 4
    single = df.filter("order_id = 2")
    assert outliers.product_price_summary(
        outliers.flag_outliers(single, ["unit_price", "revenue"], {"unit_price": (0.0, 1.0), "revenue": None})
    ).first()["desviacion_precio"] == 0


def test_profiles(df):
    report = {r["variable"]: r for r in profile.schema_report(df).collect()}
    assert (report["quantity"]["nulos"], report["quantity"]["valores_unicos"], report["quantity"]["porcentaje_nulos"]) == (1, 3, 20.0)
    words = {r["variable"]: r["valores"] for r in profile.data_dictionary(df, listed=2).collect()}
    assert words["category"] == "Apparel, Footwear" and words["quantity"] == "Rango observado: 1.00 a 6.00"
    assert words["product_name"] == "3 valores observados"
    missing = profile.missing_quantity_summary(df).first()
    assert tuple(missing) == (5, 1, 1, 1)
    assert filters.rows_with_nulls(df).count() == 2


def test_whole_numbers_become_text_once_a_set(spark, monkeypatch):
    df = spark.range(40).selectExpr("cast(id % 3 as int) AS n", "id % 2 = 0 AS flag", "date_add(date'2024-02-28', cast(id % 2 as int)) AS day", "id % 2 - 0.5D AS x")
    sets, collect_set = [], F.collect_set
    monkeypatch.setattr(profile.F, "collect_set", lambda c: sets.append(str(c)) or collect_set(c))
    words = {r["variable"]: (r["distintos"], r["valores"]) for r in profile.data_dictionary(df).collect()}
    assert words == {"n": (3, "0, 1, 2"), "flag": (2, "false, true"), "day": (2, "2024-02-28, 2024-02-29"), "x": (2, "-0.5, 0.5")}
    assert ["CAST" in s.upper() for s in sets] == [False, False, False, True]


def test_customer_features(df):
    rows = {r["user_id"]: r for r in build_customer_features(df).collect()}
    assert set(rows) == {1, 2}
    one = rows[1]
    assert (one["order_count"], one["total_revenue"], one["average_order_revenue"]) == (2, 600.0, 300.0)
    assert one["average_days_between_orders"] == 60 and rows[2]["average_days_between_orders"] is None
    assert one["recency_days"] == 31 and one["category_count"] == 2
    # equal weights: alphabetical
    assert one["top_category"] == "Apparel" and one["premium_revenue_share"] == 0.5
    assert one["category_concentration_hhi"] == pytest.approx(0.5) and rows[2]["country"] == "Sin dato"


def test_lookups(df):
    assert filters.one_by_id(df, "order_id", 2).count() == 1
    with pytest.raises(LookupError):
        filters.one_by_id(df, "order_id", 99)
    assert filters.matching(df, country="CHILE", order_status="Delivered", channel=None).count() == 2
    page = filters.page(df, "order_id", 3, 10).collect()
    assert len(page) == 2 and page[0]["total"] == 5 and page[0]["count"] == 2


def test_dashboard_datasets(df):
    views = dashboard.datasets(df, country="Chile")
    assert views["board"].first()["revenue"] == 600
    assert views["missing"].count() == 1
    assert {r["scenario"] for r in views["scenarios"].collect()} == {"Original", "Mínimo mayorista", "Random Forest", "Máximo jerárquico"}


def test_alerts_by_any_of_the_eight_measures(spark, df):
    """A product whose reviews alone stand out has a history, and an alert of another variable."""
    fences = {m: None for m in outliers.MEASURES} | {"reviews": (0.0, 20.0)}
    lines = df.withColumns({"reviews": F.col("product_id") * 10, "catalog_price": F.col("unit_price")})
    flagged = outliers.flag_outliers(lines, outliers.MEASURES, fences)
    rows = outliers.product_price_summary(flagged).collect()
    high = {r["product_id"] for r in lines.filter("reviews > 20").select("product_id").collect()}
    assert {r["product_id"] for r in rows} == high and high and {r["tipo_alerta"] for r in rows} == {"Otra variable"}


def test_price_summary_counts_distinct_values_apart(spark):
    """Null labels, null orders, repeated prices and a product under two names; lines are not repeated for each count."""
    rows = [
        (1, "a", 10, 5.0, True), (1, "a", 10, 5.0, False), (1, "a", 11, 6.0, False), (1, None, 12, 7.0, False), (1, None, None, None, False),
        (2, "b", 13, 9.0, False), (3, None, None, 8.0, True), (None, "c", 14, 8.0, True),
    ]
    lines = spark.createDataFrame(rows, "product_id long, product_name string, order_id long, unit_price double, any_outlier_iqr boolean")
    flagged = lines.select(
        "*", F.lit(None).cast("string").alias("category"), F.lit("x").alias("brand"), F.col("any_outlier_iqr").alias("unit_price_outlier_iqr"),
        F.lit(False).alias("revenue_outlier_iqr"), F.lit(1.0).alias("quantity"), F.col("unit_price").alias("revenue"), F.col("unit_price").alias("catalog_price"),
    )
    summary = outliers.product_price_summary(flagged)
    columns = ("product_id", "product_name", "lineas_historicas", "pedidos_distintos", "precios_historicos_distintos", "lineas_con_algun_outlier", "tipo_alerta")
    got = {tuple(r[c] for c in columns) for r in summary.collect()}
    assert got == {(1, "a", 3, 2, 2, 1, "Precio"), (1, None, 2, 1, 1, 0, "Otra variable"), (3, None, 1, 0, 1, 1, "Precio")}
    assert "Expand" not in summary._jdf.queryExecution().optimizedPlan().toString()
