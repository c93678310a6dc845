"""Explicit schemas of the landed collections. Numbers arrive as text, so that coercion stays lenient."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(text: str) -> T.StructType:
    return T.StructType([T.StructField(*_pair(part)) for part in text.split(",")])


def _pair(part: str) -> tuple[str, T.DataType, bool]:
    kinds = {"long": T.LongType(), "int": T.IntegerType(), "string": T.StringType()}
    name, kind = part.split(":")
    return name.strip(), kinds[kind.strip()], True


PRODUCT = _fields(
    "id:long, title:string, category:string, brand:string, price:string, discountPercentage:string, stock:string, "
    "rating:string, reviews:string, sku:string"
)
USER = _fields(
    "id:long, firstName:string, lastName:string, email:string, age:int, country:string, city:string, phone:string, "
    "address:string, retailerType:string"
)
CART_LINE = _fields("id:long, title:string, price:string, quantity:string, category:string, discountPercentage:string")
CART = T.StructType(
    [
        *_fields("id:long, userId:long, totalProducts:int, orderDate:string, status:string, channel:string").fields,
        T.StructField("products", T.ArrayType(CART_LINE), True),
    ]
)
COLLECTIONS = {"products": PRODUCT, "users": USER, "carts": CART}


def page(key: str, item: T.StructType) -> T.StructType:
    """Envelope of one landed page."""
    return T.StructType([*_fields("total:long, skip:long, limit:long, count:long").fields, T.StructField(key, T.ArrayType(item))])
