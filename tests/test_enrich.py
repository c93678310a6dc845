import copy
import datetime

import pytest
from conftest import CARTS, PRODUCTS, USERS
from pyspark.sql import functions as F

from orderlens.operators import enrich, integrity, quality


def test_one_row_per_order_line(frames):
    lines = enrich.normalize_carts(frames()["carts"])
    assert lines.count() == 3
    assert [r["line_number"] for r in lines.orderBy("line_number").collect()] == [1, 2, 3]


def test_enrichment_keeps_grain_and_calculates_revenue(enriched):
    rows = enriched.orderBy("line_number").collect()
    assert [float(r["revenue"]) for r in rows] == [124.0, 200.0, 2103.0]
    assert [r["price_segment"] for r in rows] == ["Económico", "Medio", "Premium"]
    assert all(r["product_match_flag"] and r["user_match_flag"] for r in rows)
    assert rows[0]["country"] == "Chile" and rows[0]["customer_name"] == "Irma Solís"
    assert rows[0]["year_month"] == "2023-11" and rows[0]["month_name"] == "Noviembre"
    assert rows[0]["order_date"] == datetime.date(2023, 11, 30)
    assert len(enriched.columns) == 46 and not set(enrich.PERSONAL_COLUMNS) & set(enriched.columns)


def test_cleaning_and_fallbacks(frames):
    products, users, carts = copy.deepcopy(PRODUCTS), copy.deepcopy(USERS), copy.deepcopy(CARTS)
    products[2]["price"] = 0
    products.append({**products[0], "id": 24, "sku": "LN-21", "price": 10})
    products.append({**products[0], "title": "segunda aparición"})
    users.append({**users[0], "id": 8, "country": "PERÚ", "firstName": None, "lastName": " Ruiz "})
    users.append({**users[0], "id": 9, "country": "Atlantis", "firstName": " ", "lastName": None})
    carts[0]["products"][0].update(title="  ", category=None, discountPercentage="n/a")
    carts += [
        {**carts[0], "id": 11, "userId": 8, "status": " CANCELED ", "channel": "b2b e-commerce", "orderDate": "no date", "products": carts[0]["products"][:1]},
        {**carts[0], "id": 12, "userId": 99, "status": "Returned", "channel": "Fax", "products": [{"id": 77, "price": "abc", "quantity": "2"}]},
        {**carts[0], "id": 13, "userId": 9, "status": None, "products": [{**carts[0]["products"][2], "quantity": None}]},
        {**carts[0], "id": 14, "products": []},
    ]
    frame = enrich.build_orders_enriched(**frames(products, users, carts), position=())
    rows = {(r["order_id"], r["line_number"]): r for r in frame.collect()}
    assert len(rows) == 6 and not any(k[0] == 14 for k in rows)
    first = rows[40, 1]
    assert (first["product_name"], first["category"], first["discount_percentage"]) == ("Lámpara norte", "Equipment", 7.5)
    assert first["catalog_duplicate_flag"] and not rows[40, 2]["catalog_duplicate_flag"]
    assert rows[40, 3]["price_difference_pct"] is None and float(rows[40, 3]["price_difference"]) == 350.5
    peru = rows[11, 1]
    assert (peru["country"], peru["country_original"], peru["customer_name"]) == ("Perú", "PERÚ", "Ruiz")
    assert (peru["order_status"], peru["status_original"], peru["canceled_flag"]) == ("cancelled", "CANCELED", 1)
    assert peru["channel"] == "E-commerce B2B" and peru["order_date"] is None and peru["year_month"] is None
    odd = rows[12, 1]
    assert (odd["order_status"], odd["channel"], odd["unit_price"], odd["revenue"]) == ("returned", "Fax", None, None)
    assert odd["price_segment"] == "Sin clasificar" and not odd["product_match_flag"] and not odd["user_match_flag"]
    unknown = rows[13, 1]
    assert (unknown["country"], unknown["customer_name"], unknown["order_status"], unknown["delivered_flag"]) == ("Atlantis", "", None, 0)

    flagged = {(r["order_id"], r["line_number"]): r for r in quality.evaluate_quality(frame).collect()}
    assert flagged[12, 1]["valid_sales_flag"] is False and flagged[13, 1]["valid_sales_flag"] is False
    assert "Precio nulo" in flagged[12, 1]["data_quality_flag"] and "Usuario sin correspondencia" in flagged[12, 1]["data_quality_flag"]
    assert "Fecha inválida" in flagged[11, 1]["data_quality_flag"]
    assert {"País inconsistente", "Estado inconsistente", "Cantidad nula"} <= set(flagged[13, 1]["data_quality_flag"].split(" | "))


def test_first_record_follows_the_page_position(spark):
    rows = [(1, "b", 5), (1, "a", 9), (2, "z", 1)]
    frame = spark.createDataFrame(rows, "id long, v string, pos int")
    assert {(r["id"], r["v"]) for r in integrity.first_per_key(frame, "id", ["pos"]).collect()} == {(1, "b"), (2, "z")}


def test_join_invariant(frames, enriched):
    assert enrich.join_invariant(enrich.normalize_carts(frames()["carts"]), enriched).first()["kept"]


def test_null_quantity_is_flagged_not_dropped(frames):
    carts = copy.deepcopy(CARTS)
    carts[0]["products"][0]["quantity"] = None
    frame = enrich.build_orders_enriched(**frames(carts=carts))
    flagged = quality.evaluate_quality(frame)
    assert flagged.count() == 3
    assert "Cantidad nula" in flagged.filter("line_number = 1").first()["data_quality_flag"]
    report = {r["regla_evaluada"]: r for r in quality.quality_report(frame).collect()}
    assert report["Cantidad nula"]["registros_afectados"] == 1 and report["Cantidad nula"]["porcentaje_afectado"] == 33.33
    assert sum(r["registros_afectados"] for n, r in report.items() if n in ("Inventario nulo", "Calificación nula")) == 2


def test_report_agrees_with_flags(frames, repeated_orders):
    doubled = repeated_orders.unionByName(repeated_orders.filter("order_id = 535")).drop("data_quality_flag", "valid_sales_flag")
    flagged = quality.evaluate_quality(doubled)
    for row in quality.quality_report(doubled).collect():
        holds = F.array_contains(F.split("data_quality_flag", r" \| "), row["regla_evaluada"])
        assert flagged.filter(holds).count() == row["registros_afectados"], row
    assert flagged.filter(F.col("data_quality_flag").contains("Línea duplicada")).count() == 6


def test_quality_of_an_empty_table(enriched):
    report = quality.quality_report(enriched.filter("false")).collect()
    assert len(report) == 18 and all(r["registros_afectados"] == 0 and r["porcentaje_afectado"] == 0 for r in report)


def test_repeated_null_keys_are_equal(spark):
    frame = spark.createDataFrame([(1, None), (1, None), (2, None), (None, None)], "a int, b int")
    flags = [(r["a"], r["f"]) for r in integrity.flag_repeated(frame, ["a", "b"], "f").collect()]
    assert sorted(flags, key=str) == sorted([(1, True), (1, True), (2, False), (None, False)], key=str)


def test_integrity_checks(spark, repeated_orders):
    assert integrity.integrity_summary(repeated_orders).first().asDict() == {
        "filas_duplicadas_exactas": 0, "filas_con_clave_duplicada": 0, "pedidos_con_diferencia_en_lineas": 0,
    }
    assert integrity.check_master(repeated_orders)["rows"] == 60
    wrong = repeated_orders.withColumn("revenue", F.col("revenue") + F.when(F.col("order_id") == 521, 1).otherwise(0).cast("decimal(18,4)"))
    with pytest.raises(ValueError):
        integrity.check_master(wrong)
    with pytest.raises(ValueError):
        integrity.check_master(repeated_orders.drop("country"))
    outside = integrity.vocabulary_check(repeated_orders, {"country": ["Bolivia"], "channel": ["Distributor"]}).collect()
    assert [(r["variable"], r["value"], r["rows"]) for r in outside] == [("country", "Chile", 60)]
    check = integrity.derived_check(wrong).first()
    assert check["revenue_incorrecto"] == 3 and check["segmento_precio_incorrecto"] == 0
