"""Collections -> one enriched row per order line (48 columns with the two quality columns)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.fixed_values import CHANNEL_NAMES, COUNTRY_NAMES, PRICE_EDGES, STATUS_NAMES
from orderlens.functions import numbers, text
from orderlens.operators.integrity import first_per_key, flag_repeated

LINE_COLUMNS = (
    "order_id", "user_id", "order_date", "order_status", "channel", "reported_total_products", "line_number",
    "product_id", "line_product_name", "line_category", "unit_price", "quantity", "line_discount_percentage",
)
PRODUCT_COLUMNS = (
    "catalog_product_name", "category", "brand", "catalog_price", "catalog_discount_percentage", "inventory",
    "rating", "reviews", "sku", "catalog_duplicate_flag",
)
USER_COLUMNS = ("age", "country", "city", "retailer_type", "customer_name", "country_original")
DERIVED_COLUMNS = (
    "product_name", "channel_original", "status_original", "discount_percentage", "revenue",
    "price_segment", "year", "quarter", "month", "month_name", "year_month", "delivered_flag", "canceled_flag",
    "product_match_flag", "user_match_flag", "price_difference", "price_difference_pct",
)
QUALITY_COLUMNS = ("data_quality_flag", "valid_sales_flag")
PERSONAL_COLUMNS = ("email", "phone", "address", "first_name", "last_name")
ENRICHED_COLUMNS = LINE_COLUMNS + PRODUCT_COLUMNS + USER_COLUMNS + DERIVED_COLUMNS + QUALITY_COLUMNS


def normalize_carts(carts: DataFrame) -> DataFrame:
    """Unnest order lines with their 1-based position; orders without lines vanish."""
    return carts.select(
        F.col("id").alias("order_id"),
        F.col("userId").alias("user_id"),
        F.col("orderDate").alias("order_date"),
        F.col("status").alias("order_status"),
        "channel",
        F.col("totalProducts").alias("reported_total_products"),
        F.posexplode("products").alias("_position", "_line"),
    ).select(
        "order_id", "user_id", "order_date", "order_status", "channel", "reported_total_products",
        (F.col("_position") + 1).alias("line_number"),
        F.col("_line.id").alias("product_id"),
        F.col("_line.title").alias("line_product_name"),
        F.col("_line.category").alias("line_category"),
        F.col("_line.price").alias("unit_price"),
        F.col("_line.quantity").alias("quantity"),
        F.col("_line.discountPercentage").alias("line_discount_percentage"),
    )


def prepare_products(
    products: DataFrame, position: Sequence[str] = (), unique: bool = False, flag_sku: bool = True
) -> DataFrame:
    """Product dimension: canonical names, clean text, first record per id, members of a repeated SKU flagged.

    `unique` skips the de-duplication for a catalog whose key is known to be unique.
    """
    dimension = products.withColumnsRenamed(
        {
            "id": "product_id", "title": "catalog_product_name", "price": "catalog_price",
            "discountPercentage": "catalog_discount_percentage", "stock": "inventory",
        }
    )
    if not unique:
        dimension = first_per_key(dimension, "product_id", position).drop(*position)
    if flag_sku:
        dimension = flag_repeated(dimension, ["sku"], "catalog_duplicate_flag")
    return dimension.withColumns(
        {c: text.clean_text(F.col(c)) for c in ("catalog_product_name", "category", "brand", "sku")}
    )


def prepare_users(
    users: DataFrame,
    position: Sequence[str] = (),
    unique: bool = False,
    countries: Mapping[str, str] = COUNTRY_NAMES,
) -> DataFrame:
    """User dimension: canonical names and country, first record per id, full name; contact data leaves here."""
    dimension = users.withColumnsRenamed(
        {"id": "user_id", "firstName": "first_name", "lastName": "last_name", "retailerType": "retailer_type"}
    )
    if not unique:
        dimension = first_per_key(dimension, "user_id", position).drop(*position)
    original = text.clean_text(F.col("country"))
    return dimension.withColumns(
        {
            "customer_name": text.full_name(F.col("first_name"), F.col("last_name")),
            "country_original": original,
            "country": text.canonical(original, countries),
            "city": text.clean_text(F.col("city")),
            "retailer_type": text.clean_text(F.col("retailer_type")),
        }
    ).drop(*PERSONAL_COLUMNS)


def attach_dimension(lines: DataFrame, dimension: DataFrame, key: str, columns: Sequence[str], flag: str) -> DataFrame:
    """Left join on a unique key with a match flag.

    No hint is given: Spark broadcasts by measured size, and beyond that AQE splits hot keys.
    """
    marked = dimension.select(key, *columns, F.lit(True).alias(flag))
    return lines.join(marked, key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def join_dimensions(lines: DataFrame, products: DataFrame | None, users: DataFrame | None) -> DataFrame:
    """Lines with their dimensions; one that a query does not need may be left out."""
    out = lines
    if products is not None:
        columns = [c for c in PRODUCT_COLUMNS if c in products.columns]
        out = attach_dimension(out, products, "product_id", columns, "product_match_flag")
    if users is not None:
        columns = [c for c in USER_COLUMNS if c in users.columns]
        out = attach_dimension(out, users, "user_id", columns, "user_match_flag")
    return out


# column -> the columns it is derived from
_DERIVED_FROM = {
    "discount_percentage": ("line_discount_percentage", "catalog_discount_percentage"),
    "revenue": ("unit_price", "quantity"),
    "price_segment": ("unit_price",),
    "price_difference": ("unit_price", "catalog_price"),
    "price_difference_pct": ("unit_price", "catalog_price"),
    "delivered_flag": ("order_status",),
    "canceled_flag": ("order_status",),
    **{c: ("order_date",) for c in ("year", "quarter", "month", "month_name", "year_month")},
}


def derive_columns(
    joined: DataFrame,
    only: Sequence[str] | None = None,
    price_edges: Sequence[float] = PRICE_EDGES,
    money: str = numbers.MONEY,
    channels: Mapping[str, str] = CHANNEL_NAMES,
    statuses: Mapping[str, str] = STATUS_NAMES,
) -> DataFrame:
    """Canonical vocabularies, lenient types and derived columns, as projections only.

    `only` names the columns a query needs; nothing else is built.
    """
    col = F.col
    number = {
        c: (lambda c=c: numbers.to_number(col(c)))
        for c in ("quantity", "inventory", "rating", "reviews", "line_discount_percentage", "catalog_discount_percentage")
    }
    channel = lambda: text.clean_text(col("channel"))
    status = lambda: text.clean_text(col("order_status"))
    cleaned = {
        "product_name": lambda: F.coalesce(text.clean_text(col("line_product_name")), "catalog_product_name"),
        "category": lambda: F.coalesce(text.clean_text(col("line_category")), "category"),
        "channel_original": channel,
        "status_original": status,
        "channel": lambda: text.canonical(channel(), channels),
        "order_status": lambda: text.canonical(status(), statuses, keep_case=False),
        "unit_price": lambda: numbers.to_number(col("unit_price"), money),
        "catalog_price": lambda: numbers.to_number(col("catalog_price"), money),
        **number,
        "order_date": lambda: numbers.to_day(col("order_date")),
    }
    day = col("order_date")
    difference = lambda: col("unit_price") - col("catalog_price")
    has_status = lambda s: F.coalesce(col("order_status") == s, F.lit(False)).cast("int")
    derived = {
        "discount_percentage": lambda: F.coalesce("line_discount_percentage", "catalog_discount_percentage"),
        "revenue": lambda: numbers.line_value(col("unit_price"), col("quantity"), money),
        "price_segment": lambda: numbers.price_segment(col("unit_price"), price_edges),
        "year": lambda: F.year(day),
        "quarter": lambda: F.quarter(day),
        "month": lambda: F.month(day),
        "month_name": lambda: text.month_name(F.month(day)),
        "year_month": lambda: F.date_format(day, "yyyy-MM"),
        "delivered_flag": lambda: has_status("delivered"),
        "canceled_flag": lambda: has_status("cancelled"),
        "price_difference": difference,
        "price_difference_pct": lambda: numbers.share(difference(), col("catalog_price")),
    }
    wanted = set(only) if only is not None else {*cleaned, *derived}
    needed = wanted.union(*(_DERIVED_FROM.get(c, ()) for c in wanted))
    first = joined.withColumns({c: make() for c, make in cleaned.items() if c in needed})
    return first.withColumns({c: make() for c, make in derived.items() if c in wanted})


def build_orders_enriched(
    products: DataFrame, users: DataFrame, carts: DataFrame, position: Sequence[str] = (), **options
) -> DataFrame:
    """The whole enrichment: unnest, dimensions, joins, derived columns (46; quality adds two)."""
    joined = join_dimensions(normalize_carts(carts), prepare_products(products, position), prepare_users(users, position))
    return derive_columns(joined, **options).select(*[c for c in ENRICHED_COLUMNS if c not in QUALITY_COLUMNS])


def join_invariant(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts around the dimension joins; they must be equal."""
    left = before.agg(F.count(F.lit(1)).alias("lines_before"))
    right = after.agg(F.count(F.lit(1)).alias("lines_after"))
    return left.crossJoin(right).withColumn("kept", F.col("lines_before") == F.col("lines_after"))
