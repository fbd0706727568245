"""Star schema tables."""

from __future__ import annotations

from arrivo.plans import star
from arrivo.queries.binding import EXTRA_TRANSLATIONS, STAR_BOX
from arrivo.queries.registry import EXACT, register

(SOUTH, NORTH), (WEST, EAST) = STAR_BOX

VIEWS = {
    "m_item_totals": """SELECT order_id, count(*) AS n_items, count(DISTINCT seller_id) AS n_vendedores,
  sum(price) AS total_price, sum(freight_value) AS total_freight FROM m_items GROUP BY order_id""",
    "m_payment_totals": """SELECT order_id, sum(payment_value) AS pago_total,
  count(DISTINCT payment_type) AS n_metodos_pago, max(payment_installments) AS cuotas_max,
  max(payment_type) FILTER (WHERE rn = 1) AS tipo_pago_principal
FROM (SELECT *, row_number() OVER (PARTITION BY order_id
  ORDER BY payment_value DESC NULLS LAST, payment_sequential, payment_type) AS rn FROM m_payments)
GROUP BY order_id""",
    "m_review_last": """SELECT order_id,
  list(review_score ORDER BY review_answer_timestamp ASC NULLS LAST, review_id)
    FILTER (WHERE review_score IS NOT NULL)[-1] AS review_score,
  list(review_comment_message ORDER BY review_answer_timestamp ASC NULLS LAST, review_id)
    FILTER (WHERE review_comment_message IS NOT NULL)[-1] AS review_comment_message,
  list(review_creation_date ORDER BY review_answer_timestamp ASC NULLS LAST, review_id)
    FILTER (WHERE review_creation_date IS NOT NULL)[-1] AS review_creation_date,
  count(*) AS n_reviews FROM m_reviews GROUP BY order_id""",
    "m_fact_orders": """SELECT o.*, c.customer_unique_id, c.customer_zip_code_prefix, c.customer_city,
  c.customer_state, i.n_items, i.n_vendedores, i.total_price, i.total_freight,
  p.pago_total, p.n_metodos_pago, p.cuotas_max, p.tipo_pago_principal,
  r.review_score, r.review_comment_message, r.review_creation_date, r.n_reviews,
  date_diff('microsecond', order_purchase_timestamp, order_approved_at) / 86400000000.0 AS dias_aprobacion,
  date_diff('microsecond', order_purchase_timestamp, order_delivered_carrier_date) / 86400000000.0
    AS dias_a_transportista,
  date_diff('microsecond', order_purchase_timestamp, order_delivered_customer_date) / 86400000000.0
    AS dias_entrega_total,
  date_diff('microsecond', order_purchase_timestamp, order_estimated_delivery_date) / 86400000000.0
    AS dias_entrega_estimada,
  date_diff('microsecond', order_estimated_delivery_date, order_delivered_customer_date) / 86400000000.0
    AS dias_retraso,
  CASE WHEN order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL
      AND order_estimated_delivery_date IS NOT NULL
    THEN CAST(CAST(order_delivered_customer_date AS DATE) > CAST(order_estimated_delivery_date AS DATE)
      AS DOUBLE) END AS entrega_tardia,
  date_trunc('day', order_purchase_timestamp) AS fecha_compra,
  i.n_items IS NOT NULL AS tiene_items, r.review_score IS NOT NULL AS tiene_review
FROM m_orders o LEFT JOIN m_customers c ON c.customer_id = o.customer_id
  LEFT JOIN m_item_totals i ON i.order_id = o.order_id
  LEFT JOIN m_payment_totals p ON p.order_id = o.order_id
  LEFT JOIN m_review_last r ON r.order_id = o.order_id""",
    "m_fact_items": """SELECT i.*, o.customer_id, o.order_status, o.order_purchase_timestamp,
  o.order_delivered_customer_date, o.order_estimated_delivery_date, c.customer_unique_id,
  i.price + i.freight_value AS monto_item, date_trunc('day', o.order_purchase_timestamp) AS fecha_compra
FROM m_items i LEFT JOIN m_orders o ON o.order_id = i.order_id
  LEFT JOIN m_customers c ON c.customer_id = o.customer_id""",
    "m_dim_products": """SELECT p.product_id,
  coalesce(p.product_category_name, 'desconocida') AS product_category_name,
  p.product_name_lenght AS product_name_length,
  p.product_description_lenght AS product_description_length, p.product_photos_qty, p.product_weight_g,
  p.product_length_cm, p.product_height_cm, p.product_width_cm,
  coalesce(t.product_category_name_english, 'unknown') AS product_category_name_english,
  p.product_length_cm * p.product_height_cm * p.product_width_cm AS product_volume_cm3
FROM m_products p LEFT JOIN (SELECT * FROM m_translation UNION ALL SELECT 'large', 'large goods'
  UNION ALL SELECT 'promo', 'promotion') t ON t.product_category_name = p.product_category_name""",
}
DAYS = ["dias_aprobacion", "dias_a_transportista", "dias_entrega_total", "dias_entrega_estimada", "dias_retraso"]
ITEM_REAL = ["price", "freight_value", "monto_item"]

register(
    "dim_customers",
    lambda b: star.dim_customers(b["customers"]),
    "SELECT customer_id, customer_unique_id, customer_zip_code_prefix AS zip_prefix, customer_city,"
    " customer_state FROM m_customers",
)
register(
    "dim_sellers",
    lambda b: star.dim_sellers(b["sellers"]),
    "SELECT seller_id, seller_zip_code_prefix AS zip_prefix, seller_city, seller_state FROM m_sellers",
)
register(
    "dim_products",
    lambda b: star.dim_products(b["products"], b["translation"], EXTRA_TRANSLATIONS),
    "SELECT * FROM m_dim_products",
    real=["product_volume_cm3"],
    **VIEWS,
)
register(
    "dim_geolocation",
    lambda b: star.dim_geolocation(b["geolocation"], STAR_BOX),
    "SELECT * FROM m_geo_points FULL JOIN m_geo_city USING (zip_prefix) FULL JOIN m_geo_state USING (zip_prefix)",
    real=["lat", "lng"],
    m_geo_inside=f"""SELECT geolocation_zip_code_prefix AS zip_prefix, * FROM m_geolocation
WHERE geolocation_lat BETWEEN {SOUTH} AND {NORTH} AND geolocation_lng BETWEEN {WEST} AND {EAST}""",
    m_geo_points="""SELECT zip_prefix, median(geolocation_lat) AS lat, median(geolocation_lng) AS lng
FROM m_geo_inside GROUP BY 1""",
    m_geo_city="""SELECT zip_prefix, geolocation_city AS ciudad FROM (SELECT zip_prefix, geolocation_city,
  row_number() OVER (PARTITION BY zip_prefix ORDER BY count(*) DESC, geolocation_city) AS rn
  FROM m_geo_inside GROUP BY 1, 2) WHERE rn = 1""",
    m_geo_state="""SELECT zip_prefix, geolocation_state AS estado FROM (SELECT zip_prefix, geolocation_state,
  row_number() OVER (PARTITION BY zip_prefix ORDER BY count(*) DESC, geolocation_state) AS rn
  FROM m_geo_inside GROUP BY 1, 2) WHERE rn = 1""",
)
register(
    "dim_calendar",
    lambda b: star.dim_calendar(b["orders"]),
    """SELECT fecha, year(fecha) AS anio, month(fecha) AS mes, strftime(fecha, '%Y-%m') AS anio_mes,
  quarter(fecha) AS trimestre, isodow(fecha) - 1 AS dia_semana, dayname(fecha) AS nombre_dia
FROM (SELECT unnest(generate_series(date_trunc('day', min(order_purchase_timestamp))::TIMESTAMP,
  date_trunc('day', max(order_purchase_timestamp))::TIMESTAMP, INTERVAL 1 DAY)) AS fecha FROM m_orders)""",
    whole=["anio", "mes", "trimestre", "dia_semana"],
)
register(
    "payment_rollup",
    lambda b: star.payment_rollup(b["payments"]),
    "SELECT * FROM m_payment_totals",
    real=["pago_total"],
    **VIEWS,
)
register(
    "review_last",
    lambda b: star.review_rollup(b["reviews"]),
    "SELECT * FROM m_review_last",
    **VIEWS,
)
register(
    "item_rollup",
    lambda b: star.item_rollup(b["items"]),
    "SELECT * FROM m_item_totals",
    real=["total_price", "total_freight"],
    **VIEWS,
)
register(
    "fact_orders",
    lambda b: star.fact_orders(b["orders"], b["customers"], b["items"], b["payments"], b["reviews"]),
    "SELECT * FROM m_fact_orders",
    real=["total_price", "total_freight", "pago_total", *DAYS],
    digits=EXACT,
    **VIEWS,
)
register(
    "fact_order_items",
    lambda b: star.fact_items(b["items"], b["orders"], b["customers"]),
    "SELECT * FROM m_fact_items",
    real=ITEM_REAL,
    **VIEWS,
)
register(
    "fact_order_payments",
    lambda b: b["payments"],
    "SELECT * FROM m_payments",
    real=["payment_value"],
)
register(
    "items_flat",
    lambda b: star.flat_in_shares(b.all(), EXTRA_TRANSLATIONS),
    """SELECT i.*, p.* EXCLUDE (product_id), s.seller_zip_code_prefix AS seller_zip_prefix, s.seller_city,
  s.seller_state, o.customer_zip_code_prefix, o.customer_city, o.customer_state, o.review_score,
  o.tiene_review, o.dias_entrega_total, o.dias_retraso, o.entrega_tardia, o.n_items, o.n_vendedores
FROM m_fact_items i LEFT JOIN m_dim_products p ON p.product_id = i.product_id
  LEFT JOIN m_sellers s ON s.seller_id = i.seller_id LEFT JOIN m_fact_orders o ON o.order_id = i.order_id""",
    real=[*ITEM_REAL, "product_volume_cm3", "dias_entrega_total", "dias_retraso"],
    digits=EXACT,
    **VIEWS,
)
