"""Sources, enrichment, integrity, quality, filters and profiles."""

from __future__ import annotations

import uuid
from contextlib import ExitStack

from pyspark.sql import functions as F

from orderlens.fixed_values import QUALITY_RULES
from orderlens.functions import numbers
from orderlens.operators import enrich, filters, integrity, profile, quality
from orderlens.session import scratch, shared_folder, shuffles_removed
from orderlens.sources import files, pages
from orderlens.sources import star_tables as star
from registry import lines, lines_with, register

UNFLAGGED = [c for c in enrich.ENRICHED_COLUMNS if c not in enrich.QUALITY_COLUMNS]


# ---------------------------------------------------------------- sources
PAGE_SIZE = 30


def _landed_pages(frame, key, collection, record):
    """A table landed as JSON lines in the shared folder, PAGE_SIZE records a page by their number `key`. Returns the folder."""
    folder = f"{shared_folder(frame.sparkSession)}/pages-{uuid.uuid4().hex}"
    skip = F.floor(F.col(key) / PAGE_SIZE) * PAGE_SIZE
    frame.groupBy(skip.alias("skip")).agg(F.array_sort(F.collect_list(record)).alias(collection)).select(  # one page
        F.lit(frame.count()).alias("total"), "skip", F.lit(PAGE_SIZE).alias("limit"), collection
    ).write.json(folder)
    return folder


def _customer_pages(spark, sf):
    """The customers, whose ids count up from 0."""
    record = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("firstName"))
    return _landed_pages(star.table(spark, sf, "customer"), "c_custkey", "users", record)


@register(
    "page_contract_users",
    f"SELECT CAST(ceil(count(*) / {PAGE_SIZE}) AS BIGINT) AS pages, count(*) AS records, count(*) AS total, 0 AS missing_fields, "
    "0 AS repeated_offsets, 0 AS first_offset, 0 AS broken_offsets, 0 AS missing_records, 0 AS violations FROM customer",
)
def page_contract_users(spark, sf):
    return pages.page_contract(pages.read_pages(spark, _customer_pages(spark, sf), "users"), "users").select(
        "pages", "records", "total", "missing_fields", "repeated_offsets", "first_offset", "broken_offsets",
        "missing_records", "violations",
    )


_LANDED = (
    f"SELECT c_custkey AS id, c_name AS \"firstName\", c_custkey // {PAGE_SIZE} * {PAGE_SIZE} AS _page_skip, "
    f"CAST(c_custkey % {PAGE_SIZE} AS INTEGER) AS _page_item FROM customer"
)


@register("page_records_users", _LANDED)
def page_records_users(spark, sf):
    landed = pages.read_pages(spark, _customer_pages(spark, sf), "users")
    return pages.page_records(landed, "users").select("id", "firstName", *pages.POSITION)


@register("read_collection_users", _LANDED)
def read_collection_users(spark, sf):
    """The same through the contract check, which raises where a page is missing."""
    return pages.read_collection(spark, _customer_pages(spark, sf), "users").select("id", "firstName", *pages.POSITION)


@register(
    "first_product_record",
    "SELECT p_partkey AS product_id, p_name AS catalog_product_name, p_brand AS brand FROM part",
)
def first_product_record(spark, sf):
    """Every seventh product comes again on a later page under a name that sorts first; the earlier record stays."""
    catalog = star.products(spark, sf).withColumns({pages.PAGE: F.col("id"), pages.ITEM: F.lit(0)})
    again = catalog.filter("id % 7 = 0").withColumns({"title": F.lit("!"), "brand": F.lit("!"), pages.PAGE: F.col("id") + 1_000_000_000_000})
    dimension = enrich.prepare_products(catalog.unionByName(again), pages.POSITION, flag_sku=False)
    return dimension.select("product_id", "catalog_product_name", "brand")


@register(
    "collection_counts",
    "SELECT 'products' AS collection, count(*) AS records, count(*) AS declared, TRUE AS agrees FROM part UNION ALL SELECT 'users', "
    f"count(*) FILTER (c_custkey // {PAGE_SIZE} % 11 <> 3), count(*), count(*) FILTER (c_custkey // {PAGE_SIZE} % 11 = 3) = 0 FROM customer "
    "UNION ALL SELECT 'carts', count(*), count(*), TRUE FROM orders",
)
def collection_counts(spark, sf):
    """The totals are those of the landed envelopes; every eleventh page of the users, from the fourth on, did not arrive."""
    product = F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"))
    cart = F.struct(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("userId"))
    users = pages.read_pages(spark, _customer_pages(spark, sf), "users")
    return pages.landed_counts(
        products=pages.read_pages(spark, _landed_pages(star.table(spark, sf, "part"), "p_partkey", "products", product), "products"),
        users=users.filter(F.floor(F.col("skip") / PAGE_SIZE) % 11 != 3),
        carts=pages.read_pages(spark, _landed_pages(star.table(spark, sf, "orders"), "o_orderkey", "carts", cart), "carts"),
    )


@register("page_snapshot", "SELECT 'users' AS source, count(*) AS count FROM customer")
def page_snapshot(spark, sf):
    """Raw copy of a checked collection as JSON lines, counted where it was written."""
    records = pages.read_collection(spark, _customer_pages(spark, sf), "users")
    return pages.write_snapshot(records, f"{shared_folder(spark)}/snapshot-{uuid.uuid4().hex}", "users")


@register(
    "detail_mismatches_orders",
    "SELECT DISTINCT o_orderkey AS order_id, 'listing' AS side FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) "
    "UNION ALL SELECT DISTINCT l_orderkey, 'detail' FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)",
)
def detail_mismatches_orders(spark, sf):
    listing = star.table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"))
    detail = star.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_id"))
    return pages.detail_mismatches(listing, detail, "order_id")


PASSES = 4  # over the lines, for each format that shuffles them


@register(
    "reconcile_formats",
    lines(
        f"SELECT f.formato, {len(enrich.ENRICHED_COLUMNS)} AS columnas, count(*) AS filas, count(*) - count(quantity) AS quantity_nula, "
        "sum(quantity) AS suma_quantity, CAST(sum(revenue) AS DOUBLE) AS suma_revenue "
        "FROM e CROSS JOIN (VALUES ('CSV'), ('Parquet'), ('SQL')) AS f(formato) GROUP BY f.formato"
    ),
)
def reconcile_formats(spark, sf):
    """Writes the table in three formats into the shared folder and reads each one back."""
    run = uuid.uuid4().hex
    folder = f"{shared_folder(spark)}/formats-{run}"
    with shuffles_removed(spark), ExitStack() as made:
        made.enter_context(scratch(spark))
        df = star.enriched(spark, sf)
        files.write_formats(df, folder, f"orders_{run}", passes=PASSES, release=made.close)
    return files.reconcile(spark, folder, df.schema, f"orders_{run}")


# ---------------------------------------------------------------- enrichment
@register(
    "normalize_carts",
    "SELECT o_orderkey AS order_id, o_custkey AS user_id, strftime(o_orderdate, '%Y-%m-%d') AS order_date, "
    "CAST(row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice, l_quantity, l_discount) "
    "AS INTEGER) AS line_number, CAST(count(*) OVER (PARTITION BY o_orderkey) AS INTEGER) AS reported_total_products, "
    "l_partkey AS product_id, l_extendedprice AS unit_price, CAST(l_quantity AS INTEGER) AS quantity "
    "FROM orders JOIN lineitem ON l_orderkey = o_orderkey",
)
def normalize_carts(spark, sf):
    return enrich.normalize_carts(star.carts(spark, sf)).select(
        "order_id", "user_id", "order_date", "line_number", "reported_total_products", "product_id", "unit_price", "quantity"
    )


@register(
    "product_dimension",
    lines(
        "SELECT id AS product_id, p_name AS catalog_product_name, p_type AS category, p_brand AS brand, sku, inventory, "
        "rating, catalog_duplicate_flag FROM parts"
    ),
)
def product_dimension(spark, sf):
    """Whole catalog de-duplicated by id, with the members of a repeated SKU flagged."""
    return enrich.prepare_products(star.products(spark, sf)).select(
        "product_id", "catalog_product_name", "category", "brand", "sku", F.col("inventory").cast("double").alias("inventory"),
        "rating", "catalog_duplicate_flag",
    )


@register(
    "user_dimension",
    lines(
        "SELECT id AS user_id, c_name AS customer_name, r_name AS country, r_name AS country_original, n_name AS city, "
        "c_mktsegment AS retailer_type, age FROM buyers"
    ),
)
def user_dimension(spark, sf):
    return enrich.prepare_users(star.users(spark, sf)).select(
        "user_id", "customer_name", "country", "country_original", "city", "retailer_type", "age"
    )


@register("orders_enriched", lines(f"SELECT {', '.join(UNFLAGGED)}, valid_sales_flag FROM e"))
def orders_enriched(spark, sf):
    """Every line with all columns but the issue text, which has its own query."""
    return star.enriched(spark, sf, *UNFLAGGED, "valid_sales_flag")


@register(
    "vocabulary_normalization",
    lines("SELECT status_original, order_status, channel_original, channel, count(*) AS lineas FROM e GROUP BY ALL"),
)
def vocabulary_normalization(spark, sf):
    columns = ("status_original", "order_status", "channel_original", "channel")
    return star.enriched(spark, sf, *columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("lineas"))


@register(
    "join_invariant",
    "SELECT count(*) AS lines_before, count(*) AS lines_after, TRUE AS kept FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)
def join_invariant(spark, sf):
    after = star.enriched(spark, sf, "order_id", "product_match_flag", "user_match_flag")
    return enrich.join_invariant(star.lines(spark, sf, declared=False), after)


@register(
    "dimension_key_violations",
    "SELECT 'part' AS dimension, count(*) - count(DISTINCT p_partkey) AS violations FROM part "
    "UNION ALL SELECT 'customer', count(*) - count(DISTINCT c_custkey) FROM customer",
)
def dimension_key_violations(spark, sf):
    def count(name, key):
        repeated = integrity.unique_key_violations(star.table(spark, sf, name), key)
        return repeated.agg(F.lit(name).alias("dimension"), F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("violations"))

    return count("part", "p_partkey").unionByName(count("customer", "c_custkey"))


# ---------------------------------------------------------------- integrity
@register(
    "duplicate_line_keys",
    lines("SELECT order_id, line_number, product_id, count(*) AS rows FROM e GROUP BY ALL HAVING count(*) > 1"),
)
def duplicate_line_keys(spark, sf):
    return integrity.repeated_keys(star.enriched(spark, sf, *integrity.LINE_KEY), integrity.LINE_KEY)


@register(
    "flag_repeated_lines",
    lines(
        "SELECT order_id, line_number, product_id, revenue, count(*) OVER (PARTITION BY order_id, line_number, product_id) > 1 "
        "AS repeated FROM e"
    ),
)
def flag_repeated_lines(spark, sf):
    df = star.enriched(spark, sf, *integrity.LINE_KEY, "revenue")
    return integrity.flag_repeated(df, integrity.LINE_KEY, "repeated")


@register(
    "exact_duplicates",
    lines_with(
        "d AS (SELECT *, count(*) AS n FROM e GROUP BY ALL HAVING count(*) > 1)",
        "SELECT count(*) AS registros_repetidos, CAST(coalesce(sum(n), 0) AS BIGINT) AS filas_duplicadas FROM d",
    ),
)
def exact_duplicates(spark, sf):
    return integrity.exact_duplicates(star.enriched(spark, sf, *UNFLAGGED))


@register(
    "order_line_check",
    lines(
        "SELECT order_id, count(line_number) AS observed_lines, min(reported_total_products) AS reported_lines, "
        "count(line_number) - min(reported_total_products) AS difference FROM e GROUP BY order_id"
    ),
)
def order_line_check(spark, sf):
    return integrity.order_line_check(star.enriched(spark, sf, "order_id", "line_number", "reported_total_products"))


@register(
    "integrity_summary",
    lines_with(
        """k AS (SELECT count(*) AS n FROM e GROUP BY order_id, line_number, product_id HAVING count(*) > 1),
        x AS (SELECT *, count(*) AS n FROM e GROUP BY ALL HAVING count(*) > 1),
        o AS (SELECT order_id FROM e GROUP BY order_id HAVING count(line_number) <> min(reported_total_products))""",
        "SELECT CAST(coalesce((SELECT sum(n) FROM x), 0) AS BIGINT) AS filas_duplicadas_exactas, "
        "CAST(coalesce((SELECT sum(n) FROM k), 0) AS BIGINT) AS filas_con_clave_duplicada, "
        "(SELECT count(*) FROM o) AS pedidos_con_diferencia_en_lineas",
    ),
)
def integrity_summary(spark, sf):
    return integrity.integrity_summary(
        star.enriched(spark, sf, *UNFLAGGED)
    )


@register(
    "master_validation",
    lines_with(
        "k AS (SELECT count(*) AS n FROM e GROUP BY order_id, line_number, product_id HAVING count(*) > 1)",
        f"SELECT count(*) AS rows, {len(enrich.ENRICHED_COLUMNS)} AS columns, sum(quantity) AS quantity_sum, CAST(sum(revenue) AS DOUBLE) AS revenue_sum, "
        "count(*) FILTER (order_id IS NULL) AS missing_order_id, count(*) FILTER (user_id IS NULL) AS missing_user_id, "
        "count(*) FILTER (product_id IS NULL) AS missing_product_id, 0 AS revenue_mismatches, "
        "CAST(coalesce((SELECT sum(n) - count(n) FROM k), 0) AS BIGINT) AS duplicate_lines FROM e",
    ),
)
def master_validation(spark, sf):
    return integrity.master_validation(star.enriched(spark, sf))


@register(
    "vocabulary_check",
    lines(
        "SELECT 'country' AS variable, country AS value, count(*) AS rows FROM e WHERE country NOT IN "
        "('AFRICA','AMERICA','ASIA','EUROPE') GROUP BY ALL UNION ALL SELECT 'channel', channel, count(*) FROM e WHERE channel NOT IN "
        "('1-URGENT','2-HIGH','3-MEDIUM','4-NOT SPECIFIED') GROUP BY ALL UNION ALL SELECT 'order_status', order_status, count(*) "
        "FROM e WHERE order_status NOT IN ('confirmed','shipped','delivered','cancelled') GROUP BY ALL"
    ),
)
def vocabulary_check(spark, sf):
    return integrity.vocabulary_check(star.enriched(spark, sf, *star.DOMAINS), star.DOMAINS)


@register(
    "vocabularies",
    lines(
        "SELECT DISTINCT unnest(['order_status','channel','country','retailer_type','category','brand','price_segment']) AS variable, "
        "unnest([order_status, channel, country, retailer_type, category, brand, price_segment]) AS value FROM e"
    ),
)
def vocabularies(spark, sf):
    columns = ("order_status", "channel", "country", "retailer_type", "category", "brand", "price_segment")
    return integrity.vocabularies(star.enriched(spark, sf, *columns), columns)


@register(
    "derived_check",
    lines(
        "SELECT count(*) AS revenue_correcto, 0 AS revenue_incorrecto, count(*) AS segmento_precio_correcto, "
        "0 AS segmento_precio_incorrecto, 0 AS flag_cancelacion_incorrecto, 0 AS anio_incorrecto, 0 AS trimestre_incorrecto, "
        "0 AS mes_incorrecto FROM e"
    ),
)
def derived_check(spark, sf):
    df = star.enriched(
        spark, sf, "unit_price", "quantity", "revenue", "price_segment", "order_status", "canceled_flag", "order_date",
        "year", "quarter", "month",
    )
    return integrity.derived_check(df, star.PRICE_EDGES)


@register(
    "price_discount_checks",
    lines_with(
        """m AS (SELECT CAST(unit_price AS DOUBLE) AS a, CAST(catalog_price AS DOUBLE) AS b, line_discount_percentage AS c,
               catalog_discount_percentage AS d FROM e),
        t AS (SELECT coalesce(abs(a - b) <= 0.01 + 1e-5 * abs(b), FALSE) AS p,
               coalesce(abs(c - d) <= 0.01 + 1e-5 * abs(d), c IS NULL AND d IS NULL) AS q FROM m)""",
        "SELECT count(*) FILTER (p) AS precio_linea_igual_catalogo, count(*) FILTER (NOT p) AS precio_linea_distinto_catalogo, "
        "count(*) FILTER (q) AS descuento_linea_igual_catalogo, count(*) FILTER (NOT q) AS descuento_linea_distinto_catalogo FROM t",
    ),
)
def price_discount_checks(spark, sf):
    return integrity.price_discount_checks(
        star.enriched(
            spark, sf, "unit_price", "catalog_price", "line_discount_percentage", "catalog_discount_percentage"
        )
    )


@register("order_status_first", lines("SELECT order_id, min(order_status) AS order_status FROM e GROUP BY order_id"))
def order_status_first(spark, sf):
    return integrity.first_status_per_order(star.enriched(spark, sf, "order_id", "line_number", "order_status"))


@register("order_product_pairs", lines("SELECT DISTINCT order_id, product_id, product_name, order_status FROM e"))
def order_product_pairs(spark, sf):
    df = star.enriched(spark, sf, "order_id", "line_number", "product_id", "product_name", "order_status")
    return integrity.order_product_pairs(df, "product_name", "order_status")


# ---------------------------------------------------------------- quality
_RULES = [
    "count(*) OVER (PARTITION BY order_id, line_number, product_id) > 1",
    "order_id IS NULL OR user_id IS NULL OR product_id IS NULL",
    "quantity IS NULL", "quantity <= 0", "unit_price IS NULL", "unit_price <= 0",
    "country IS NULL OR country NOT IN ('AFRICA','AMERICA','ASIA','EUROPE')",
    "channel IS NULL OR channel NOT IN ('1-URGENT','2-HIGH','3-MEDIUM','4-NOT SPECIFIED')",
    "order_status IS NULL OR order_status NOT IN ('confirmed','shipped','delivered','cancelled')",
    "order_date IS NULL", "NOT product_match_flag", "NOT user_match_flag", "abs(price_difference) > 0.01",
    "CAST(revenue AS DOUBLE) < r1 - 1.5 * (r3 - r1) OR CAST(revenue AS DOUBLE) > r3 + 1.5 * (r3 - r1)",
    "quantity < q1 - 1.5 * (q3 - q1) OR quantity > q3 + 1.5 * (q3 - q1)",
    "inventory IS NULL", "rating IS NULL", "catalog_duplicate_flag",
]
_FLAGS = "m AS (SELECT e.*, " + ", ".join(f"coalesce({t}, FALSE) AS f{i}" for i, t in enumerate(_RULES)) + " FROM e CROSS JOIN fences)"


@register(
    "quality_report",
    lines_with(
        _FLAGS,
        " UNION ALL ".join(
            f"SELECT {i} AS orden, '{name}' AS regla_evaluada, count(*) AS registros_revisados, count(*) FILTER (f{i}) AS "
            f"registros_afectados, round(count(*) FILTER (f{i}) * 100.0 / count(*), 2) AS porcentaje_afectado, "
            f"'{action}' AS accion_aplicada, '{reason}' AS justificacion, '{severity}' AS severidad FROM m"
            for i, (name, action, reason, severity) in enumerate(QUALITY_RULES)
        ),
    ),
)
def quality_report(spark, sf):
    df = star.master(
        spark, sf, *integrity.LINE_KEY, "user_id", "quantity", "unit_price", "country", "channel", "order_status", "order_date",
        "product_match_flag", "user_match_flag", "price_difference", "revenue", "inventory", "rating", "catalog_duplicate_flag",
    )
    return quality.quality_report(df, star.DOMAINS)


@register(
    "quality_flags",
    lines_with(
        _FLAGS,
        "SELECT order_id, line_number, product_id, unit_price, valid_sales_flag, coalesce(nullif(concat_ws(' | ', "
        + ", ".join(f"CASE WHEN f{i} THEN '{rule[0]}' END" for i, rule in enumerate(QUALITY_RULES))
        + "), ''), 'OK') AS data_quality_flag FROM m",
    ),
)
def quality_flags(spark, sf):
    return star.enriched(
        spark, sf, "order_id", "line_number", "product_id", "unit_price", "valid_sales_flag", "data_quality_flag"
    )


# ---------------------------------------------------------------- filters and lookups
_KEY_SQL = "order_id, line_number, product_id, revenue"


@register("valid_sales", lines(f"SELECT {_KEY_SQL} FROM sales"))
def valid_sales(spark, sf):
    """Without the flag column: the conditions themselves select the lines."""
    df = star.enriched(spark, sf, *integrity.LINE_KEY, "revenue", "quantity", "unit_price")
    return filters.valid_sales(df).drop("quantity", "unit_price")


@register("active_sales", lines(f"SELECT {_KEY_SQL} FROM sales WHERE order_status <> 'cancelled'"))
def active_sales(spark, sf):
    df = star.enriched(spark, sf, *integrity.LINE_KEY, "revenue", "order_status", "valid_sales_flag")
    return filters.active_sales(df).drop("order_status", "valid_sales_flag")


@register(
    "products_filtered",
    "SELECT p_partkey AS id, p_name AS title, p_type AS category, p_brand AS brand FROM part "
    "WHERE lower(p_type) = 'economy' AND lower(p_brand) = 'brand#7'",
)
def products_filtered(spark, sf):
    found = filters.matching(star.products(spark, sf), category="Economy", brand="BRAND#7")
    return found.select("id", "title", "category", "brand")


@register(
    "users_filtered",
    lines("SELECT id AS user_id, c_name AS customer_name FROM buyers WHERE lower(r_name) = 'asia' AND lower(c_mktsegment) = 'building'"),
)
def users_filtered(spark, sf):
    users = enrich.prepare_users(star.users(spark, sf), unique=True)
    return filters.matching(users, country="asia", retailer_type="Building").select("user_id", "customer_name")


@register(
    "orders_filtered",
    "SELECT o_orderkey AS order_id, o_custkey AS user_id FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'",
)
def orders_filtered(spark, sf):
    orders = star.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("channel"),
    )
    return filters.matching(orders, status="f", channel="2-high", user_id=None).select("order_id", "user_id")


@register(
    "page_of_orders",
    "SELECT o_orderkey AS order_id, o_custkey AS user_id, (SELECT count(*) FROM orders) AS total, 37 AS count, 100 AS skip, "
    "37 AS \"limit\" FROM orders ORDER BY o_orderkey LIMIT 37 OFFSET 100",
)
def page_of_orders(spark, sf):
    orders = star.table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"))
    return filters.page(orders, "order_id", 100, 37)


@register(
    "deep_page_of_lines",
    "WITH r AS (SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id, row_number() OVER (ORDER BY l_orderkey, "
    "l_linenumber, l_partkey) AS place, count(*) OVER () AS total FROM lineitem) SELECT order_id, line_number, product_id, total, 50 AS count, "
    "CAST(total // 10 * 9 AS INTEGER) AS skip, 50 AS \"limit\" FROM r WHERE place > total // 10 * 9 AND place <= total // 10 * 9 + 50",
)
def deep_page_of_lines(spark, sf):
    """A page behind nine tenths of all lines; only the key range that holds it is sorted."""
    rows = star.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"), F.col("l_partkey").alias("product_id")
    )
    return filters.page(rows, "order_id", rows.count() // 10 * 9, 50, ties=("line_number", "product_id"), rows=1_000)


@register(
    "lenient_values",
    "WITH t AS (SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id, CASE WHEN l_orderkey % 5 = 0 THEN 'n/a' WHEN "
    "l_orderkey % 7 = 0 THEN '' WHEN l_orderkey % 11 = 0 THEN NULL ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity, CASE WHEN l_partkey "
    "% 3 = 0 THEN 'pronto' WHEN l_partkey % 4 = 0 THEN '2024-02-30' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS day FROM lineitem) "
    "SELECT order_id, line_number, product_id, TRY_CAST(quantity AS DOUBLE) AS quantity, TRY_CAST(day AS DATE) AS day FROM t",
)
def lenient_values(spark, sf):
    """Landed text that is no number or no day becomes null, the rest is read."""
    key = F.col("l_orderkey")
    quantity = F.when(key % 5 == 0, "n/a").when(key % 7 == 0, "").when(key % 11 == 0, F.lit(None)).otherwise(F.col("l_quantity").cast("int").cast("string"))
    day = F.when(F.col("l_partkey") % 3 == 0, "pronto").when(F.col("l_partkey") % 4 == 0, "2024-02-30").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    return star.table(spark, sf, "lineitem").select(
        key.alias("order_id"), F.col("l_linenumber").alias("line_number"), F.col("l_partkey").alias("product_id"),
        numbers.to_number(quantity).alias("quantity"), numbers.to_day(day).alias("day"),
    )


@register(
    "line_values",
    lines(
        "SELECT order_id, line_number, product_id, CASE WHEN product_id % 17 = 0 THEN 'Pieza ' || product_id ELSE product_name END AS product_name, CASE WHEN "
        "product_id % 19 = 0 THEN 'LINE' ELSE category END AS category, discount_percentage FROM e"
    ),
)
def line_values(spark, sf):
    """The line's own name and category stand before those of the catalog, once they are more than spaces."""
    fact = star.lines(spark, sf, declared=False).withColumns({
        "line_product_name": F.when(F.col("product_id") % 17 == 0, F.concat(F.lit(" Pieza "), F.col("product_id").cast("string"))).when(F.col("product_id") % 2 == 0, "  "),
        "line_category": F.when(F.col("product_id") % 19 == 0, "LINE\t").when(F.col("product_id") % 3 == 0, ""),
    })
    joined = enrich.join_dimensions(fact, enrich.prepare_products(star.products(spark, sf), unique=True, flag_sku=False), None)
    columns = ["order_id", "line_number", "product_id", "product_name", "category", "discount_percentage"]
    return enrich.derive_columns(joined, columns).select(*columns)


@register(
    "lines_with_gaps",
    lines(
        "SELECT order_id, line_number, product_id, quantity, rating, inventory, discount_percentage FROM e WHERE quantity IS NULL OR rating IS NULL OR "
        "inventory IS NULL OR discount_percentage IS NULL"
    ),
)
def lines_with_gaps(spark, sf):
    """Lines that lack one of four measures; others have them all."""
    return filters.rows_with_nulls(star.enriched(spark, sf, *integrity.LINE_KEY, "quantity", "rating", "inventory", "discount_percentage"))


@register("report_file", lines("SELECT country, channel, count(*) AS lineas, CAST(sum(revenue) AS DOUBLE) AS revenue FROM e GROUP BY 1, 2"))
def report_file(spark, sf):
    """A report of one row a country and channel, written as one CSV file and read back."""
    report = star.enriched(spark, sf, "country", "channel", "revenue").groupBy("country", "channel").agg(
        F.count(F.lit(1)).alias("lineas"), F.sum("revenue").cast("double").alias("revenue")
    )
    path = f"{shared_folder(spark)}/report-{uuid.uuid4().hex}"
    files.write_report(report, path)
    return files.read_csv(spark, path, report.schema)


@register("order_lookup", "SELECT o_orderkey AS order_id, o_totalprice AS value FROM orders WHERE o_orderkey = 48")
def order_lookup(spark, sf):
    orders = star.table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("value"))
    return filters.one_by_id(orders, "order_id", 48)


@register("user_orders", "SELECT o_orderkey AS order_id, o_custkey AS user_id FROM orders WHERE o_custkey = 23")
def user_orders(spark, sf):
    orders = star.table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"))
    return filters.by_id(orders, "user_id", 23)


@register("categories", "SELECT DISTINCT p_type AS category FROM part")
def categories(spark, sf):
    return filters.categories(star.products(spark, sf))


@register(
    "rows_with_nulls",
    lines(f"SELECT {', '.join(UNFLAGGED)} FROM e WHERE {' OR '.join(f'{c} IS NULL' for c in UNFLAGGED)}"),
)
def rows_with_nulls(spark, sf):
    return filters.rows_with_nulls(star.enriched(spark, sf, *UNFLAGGED))


@register("user_trace", lines("SELECT order_id, line_number, product_id, user_id, quantity, revenue FROM e WHERE user_id = 23"))
def user_trace(spark, sf):
    return filters.trace(star.enriched(spark, sf, *integrity.LINE_KEY, "user_id", "quantity", "revenue"), user_id=23)


# ---------------------------------------------------------------- profiles
_PROFILED = UNFLAGGED
_SQL_TYPES = dict.fromkeys(_PROFILED, "string")
_SQL_TYPES |= dict.fromkeys(("order_id", "user_id", "product_id"), "bigint")
_SQL_TYPES |= dict.fromkeys(
    ("line_number", "reported_total_products", "age", "year", "quarter", "month", "delivered_flag", "canceled_flag"), "int"
)
_SQL_TYPES |= dict.fromkeys(
    ("quantity", "line_discount_percentage", "catalog_discount_percentage", "discount_percentage", "inventory", "rating",
     "reviews", "price_difference_pct"), "double",
)
_SQL_TYPES |= dict.fromkeys(("catalog_duplicate_flag", "product_match_flag", "user_match_flag"), "boolean")
_SQL_TYPES |= {"order_date": "date"} | dict.fromkeys(("unit_price", "catalog_price", "revenue"), star.MONEY)
_SQL_TYPES["price_difference"] = "decimal(19,2)"


@register(
    "schema_report",
    lines(
        " UNION ALL ".join(
            f"SELECT '{c}' AS variable, '{_SQL_TYPES[c]}' AS tipo, count(*) - count({c}) AS nulos, "
            f"round((count(*) - count({c})) * 100.0 / count(*), 2) AS porcentaje_nulos, count(DISTINCT {c}) AS valores_unicos FROM e"
            for c in _PROFILED
        )
    ),
)
def schema_report(spark, sf):
    return profile.schema_report(star.master(spark, sf, *_PROFILED))


_SOURCES = dict.fromkeys(enrich.LINE_COLUMNS, "carts")
_SOURCES |= dict.fromkeys(set(enrich.PRODUCT_COLUMNS) - {"catalog_duplicate_flag"}, "products")
_SOURCES |= dict.fromkeys(set(enrich.USER_COLUMNS) - {"customer_name", "country_original"}, "users")


def _dictionary_sql(c: str) -> str:
    numeric = _SQL_TYPES[c].startswith(("int", "bigint", "double", "decimal"))
    listed = f"(SELECT string_agg(v, ', ' ORDER BY v) FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM e WHERE {c} IS NOT NULL))"
    wide = (
        f"printf('Rango observado: %.2f a %.2f', CAST(min({c}) AS DOUBLE), CAST(max({c}) AS DOUBLE))"
        if numeric
        else f"count(DISTINCT {c}) || ' valores observados'"
    )
    return (
        f"SELECT '{c}' AS variable, '{_SOURCES.get(c, 'derived')}' AS fuente, '{_SQL_TYPES[c]}' AS tipo, count(*) - count({c}) AS nulos, "
        f"count(DISTINCT {c}) AS distintos, CASE WHEN count(DISTINCT {c}) = 0 THEN 'Sin valores' WHEN count(DISTINCT {c}) <= 12 "
        f"THEN {listed} ELSE {wide} END AS valores FROM e"
    )


@register("data_dictionary", lines(" UNION ALL ".join(_dictionary_sql(c) for c in _PROFILED)))
def data_dictionary(spark, sf):
    return profile.data_dictionary(star.master(spark, sf, *_PROFILED))


@register(
    "missing_quantity_summary",
    lines(
        "SELECT count(*) AS lineas_totales, count(*) FILTER (quantity IS NULL) AS lineas_con_quantity_nula, "
        "count(DISTINCT user_id) FILTER (quantity IS NULL) AS usuarios_afectados, "
        "count(DISTINCT order_id) FILTER (quantity IS NULL) AS pedidos_afectados FROM e"
    ),
)
def missing_quantity_summary(spark, sf):
    return profile.missing_quantity_summary(star.enriched(spark, sf, "user_id", "order_id", "quantity"))


@register(
    "table_profile",
    lines(
        "SELECT (SELECT count(*) FROM part) AS products, (SELECT count(*) FROM customer) AS users, (SELECT count(*) FROM orders) "
        "AS orders, count(*) AS lines, min(order_date) AS first_date, max(order_date) AS last_date, "
        "count(*) FILTER (quantity IS NULL) AS null_quantity FROM e"
    ),
)
def table_profile(spark, sf):
    table = lambda n: star.table(spark, sf, n)
    return profile.table_profile(
        table("part"), table("customer"), table("orders"), star.enriched(spark, sf, "order_date", "quantity")
    )
