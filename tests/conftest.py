"""One local session and the small collections every test starts from."""

from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from orderlens import schemas  # noqa: E402
from orderlens.operators.enrich import build_orders_enriched  # noqa: E402
from orderlens.operators.quality import evaluate_quality  # noqa: E402
from orderlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return session


# three lines on the edges of the price segments, one product without stock, one without rating
PRODUCTS = [
    {"id": 21, "title": "Lámpara norte", "category": "Equipment", "brand": "Faro", "price": 12.4, "discountPercentage": 7.5, "stock": 140, "rating": 3.6, "reviews": 18, "sku": "LN-21"},
    {"id": 22, "title": "Botín sierra", "category": "Footwear", "brand": "Cumbre", "price": 50, "discountPercentage": 0, "stock": None, "rating": 4.9, "reviews": 0, "sku": "BS-22"},
    {"id": 23, "title": "Abrigo lluvia", "category": "Apparel", "brand": "Cumbre", "price": 350.5, "discountPercentage": 12, "stock": 31, "rating": None, "reviews": 41, "sku": "AL-23"},
]
USERS = [
    {"id": 31, "firstName": "Irma", "lastName": "Solís", "email": None, "age": 52, "country": "Chile  ", "city": "Arica", "phone": "0", "address": "-", "retailerType": "Chain"}
]


def _line(product: dict, quantity: int | None) -> dict:
    return {k: product[k] for k in ("id", "title", "price", "category", "discountPercentage")} | {"quantity": quantity}


CARTS = [
    {"id": 40, "userId": 31, "totalProducts": 3, "orderDate": "2023-11-30", "status": "shipped", "channel": "Distributor",
     "products": [_line(p, n) for p, n in zip(PRODUCTS, (10, 4, 6), strict=True)]}
]


def write_pages(folder: Path, key: str, records: list[dict], size: int = 2, **changes) -> Path:
    """Landed pages of a collection; `changes` overrides fields of the last page."""
    folder.mkdir(parents=True, exist_ok=True)
    starts = list(range(0, max(len(records), 1), size))
    for n, skip in enumerate(starts):
        page = {"total": len(records), "skip": skip, "limit": size, key: records[skip : skip + size]}
        page["count"] = len(page[key])
        if n == len(starts) - 1:
            page.update(changes)
        (folder / f"page-{n:04d}.json").write_text(json.dumps(page, ensure_ascii=False), encoding="utf-8")
    return folder


@pytest.fixture
def frames(spark):
    """Collection frames from records, through the explicit schemas."""

    def build(products=PRODUCTS, users=USERS, carts=CARTS):
        def frame(records, schema):
            lines = [json.dumps(r, ensure_ascii=False) for r in records]
            text = spark.createDataFrame([(line,) for line in lines], "value string")
            from pyspark.sql import functions as F

            return text.select(F.from_json("value", schema).alias("r")).select("r.*")

        return {
            "products": frame(products, schemas.PRODUCT), "users": frame(users, schemas.USER), "carts": frame(carts, schemas.CART)
        }

    return build


@pytest.fixture
def enriched(frames):
    return build_orders_enriched(**frames())


@pytest.fixture
def repeated_orders(spark, enriched):
    """Orders 500, 507, ... 633 of three lines, whose quantities go up and down; order 626 lacks its second quantity."""
    from pyspark.sql import functions as F

    number = F.explode(F.sequence(F.lit(500).cast("long"), F.lit(633).cast("long"), F.lit(7).cast("long")))
    step = (F.col("order_id") * F.col("line_number")) % 9 - 3
    quantity = F.when((F.col("order_id") != 626) | (F.col("line_number") != 2), F.col("quantity") + step)
    money = (F.col("unit_price") * F.col("quantity").cast("decimal(12,3)")).cast("decimal(18,4)")
    return evaluate_quality(enriched).withColumn("order_id", number).withColumn("quantity", quantity).withColumn("revenue", money)
