"""Values that define the published results. All are fixed values: vocabularies, labels, edges, texts."""

# --- fixed values: vocabularies (lower-case spelling -> canonical value) ---
COUNTRY_NAMES = {
    "colombia": "Colombia",
    "méxico": "México",
    "mexico": "México",
    "argentina": "Argentina",
    "chile": "Chile",
    "perú": "Perú",
    "peru": "Perú",
}
CHANNEL_NAMES = {
    "direct sales": "Direct Sales",
    "distributor": "Distributor",
    "e-commerce b2b": "E-commerce B2B",
    "b2b e-commerce": "E-commerce B2B",
}
STATUS_NAMES = {
    "confirmed": "confirmed",
    "shipped": "shipped",
    "delivered": "delivered",
    "cancelled": "cancelled",
    "canceled": "cancelled",
}

# --- fixed values: expected domains ---
COUNTRIES = ("Colombia", "México", "Argentina", "Chile", "Perú")
CHANNELS = ("Direct Sales", "Distributor", "E-commerce B2B")
STATUSES = ("confirmed", "shipped", "delivered", "cancelled")

# --- fixed values: labels ---
MONTH_NAMES = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)
PRICE_EDGES = (50, 200)
PRICE_LABELS = ("Económico", "Medio", "Premium")
UNCLASSIFIED_PRICE = "Sin clasificar"
NO_DATA = "Sin dato"

# --- fixed values: right-closed bands, (lower bound or None, edges, labels, open top) ---
DISCOUNT_BANDS_EXECUTIVE = (-0.01, (5, 10, 15, 20, 25), ("0–5%", "5–10%", "10–15%", "15–20%", "20–25%"))
DISCOUNT_BANDS_ANALYSIS = (None, (0, 10, 20, None), ("0%", ">0–10%", ">10–20%", ">20%"))
DISCOUNT_BANDS_CANCELLATION = (None, (5, 10, 15, 20, 25, None), ("<=5", "5-10", "10-15", "15-20", "20-25", ">25"))
QUANTITY_BAND_LABELS = ("Q1 - baja", "Q2", "Q3", "Q4 - alta")

# --- fixed values: columns every persisted master table must have ---
REQUIRED_COLUMNS = (
    "order_id", "user_id", "country", "product_id", "product_name",
    "category", "price_segment", "quantity", "unit_price", "revenue",
)

# --- fixed values: quality rules (name, action, justification, severity), in report order ---
QUALITY_RULES = (
    ("Línea duplicada", "Conservar y marcar", "La clave compuesta debe ser única; no se elimina sin evidencia.", "Alta"),
    ("Identificador faltante", "Conservar y marcar", "La trazabilidad incompleta impide uniones confiables.", "Alta"),
    ("Cantidad nula", "Conservar; revenue queda nulo", "Imputar cantidad inventaría ventas no observadas.", "Alta"),
    ("Cantidad no positiva", "Conservar y excluir de KPIs", "No representa una venta válida sin nota de crédito.", "Alta"),
    ("Precio nulo", "Conservar; revenue queda nulo", "Se prioriza el precio histórico de la línea.", "Alta"),
    ("Precio no positivo", "Conservar y excluir de KPIs", "Un precio no positivo requiere revisión de negocio.", "Alta"),
    ("País inconsistente", "Normalizar variantes conocidas", "Mantiene comparabilidad geográfica sin inventar país.", "Media"),
    ("Canal inconsistente", "Normalizar variantes conocidas", "Evita fragmentar el análisis comercial.", "Media"),
    ("Estado inconsistente", "Normalizar variantes conocidas", "Los estados controlan KPIs de cumplimiento.", "Media"),
    ("Fecha inválida", "Conservar y marcar", "No se imputa una fecha de pedido sin evidencia.", "Alta"),
    ("Producto sin correspondencia", "Conservar atributos de línea", "La línea sigue siendo evidencia transaccional.", "Alta"),
    ("Usuario sin correspondencia", "Conservar y marcar", "Evita perder ventas por fallas de dimensión.", "Alta"),
    ("Precio distinto al catálogo", "Conservar ambos precios", "La línea refleja la venta histórica; el catálogo es referencia.", "Baja"),
    ("Revenue extremo por IQR", "Conservar y monitorear", "En mayoristas, valores altos pueden ser compras legítimas.", "Media"),
    ("Cantidad extrema por IQR", "Conservar y monitorear", "No se eliminan outliers automáticamente.", "Baja"),
    ("Inventario nulo", "Conservar nulo", "No afecta el cálculo histórico del valor bruto de pedidos.", "Baja"),
    ("Calificación nula", "Conservar nulo", "No se inventa percepción de producto.", "Baja"),
    ("Duplicado de catálogo por SKU", "Conservar y marcar", "Los IDs son distintos; deduplicar SKU rompería trazabilidad.", "Media"),
)
NO_ISSUE = "OK"

# --- fixed values: missing-quantity scenarios ---
MIN_WHOLESALE_QUANTITY = 5
REFERENCE_PERCENTILE = 0.90
MIN_REFERENCE_COUNT = 3
ORIGINAL_VALUE = "Dato original"
ESTIMATION_LEVELS = (
    ("Mismo usuario y producto", ("user_id", "product_id")),
    ("Mismo usuario, categoría y marca", ("user_id", "category", "brand")),
    ("Mismo usuario y categoría", ("user_id", "category")),
    ("Mismo producto", ("product_id",)),
    ("Misma categoría y marca", ("category", "brand")),
    ("Misma categoría", ("category",)),
    ("Distribución global", ()),
)

# --- fixed values: quantity model contract ---
QUANTITY_CATEGORICAL = (
    "order_id", "user_id", "product_id", "order_status", "channel",
    "product_name", "category", "brand", "sku", "price_segment", "country",
    "city", "retailer_type", "quarter", "month_name", "year_month",
)
QUANTITY_NUMERIC = (
    "reported_total_products", "line_number", "unit_price",
    "line_discount_percentage", "catalog_price", "catalog_discount_percentage",
    "discount_percentage", "inventory", "rating", "reviews", "age", "year",
    "month", "delivered_flag", "canceled_flag", "price_difference",
    "price_difference_pct",
)
QUANTITY_LEAKAGE = ("quantity", "revenue", "valid_sales_flag", "data_quality_flag")

# --- fixed values: segmentation ---
SEGMENT_LOG_NUMERIC = ("total_revenue", "average_order_revenue", "units")
SEGMENT_NUMERIC = (
    "order_count", "total_revenue", "average_order_revenue", "units",
    "average_days_between_orders", "recency_days", "category_count",
    "premium_revenue_share", "category_concentration_hhi",
)
SEGMENT_CATEGORICAL = ("country", "retailer_type", "top_category", "top_channel", "dominant_price_segment")
MIN_CUSTOMERS = 12
MIN_SEGMENT_SHARE = 0.08
SEGMENT_ACTIONS = {
    "Socios estratégicos": "Retención ejecutiva, acuerdos de surtido y plan conjunto de crecimiento.",
    "Compradores de alto ticket": "Aumentar frecuencia con reposición programada y beneficios por recurrencia.",
    "Reactivación prioritaria": "Campaña de reactivación con contacto comercial y diagnóstico de abandono.",
    "Desarrollo de potencial": "Venta cruzada gradual y educación sobre categorías complementarias.",
}

# --- fixed values: dashboard scenarios (label, quantity column, revenue column) ---
SCENARIOS = (
    ("Original", "quantity", "revenue"),
    ("Mínimo mayorista", "quantity_scenario_min", "revenue_scenario_min"),
    ("Random Forest", "quantity_rf_estimated", "revenue_rf_estimated"),
    ("Máximo jerárquico", "quantity_scenario_max", "revenue_scenario_max"),
)

RANDOM_STATE = 42
