"""Shared SQL pieces of the comparison queries."""

from __future__ import annotations

import re

from arrivo.queries.binding import BOX, FOCUS, PERIOD, SQL_TABLES

START, STOP = PERIOD
(SOUTH, NORTH), (WEST, EAST) = BOX

HAVERSINE = (
    "2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians({b} - {a}) / 2), 2)"
    " + cos(radians({a})) * cos(radians({b})) * pow(sin(radians({d} - {c}) / 2), 2))))"
)


VIEWS: dict[str, str] = {
    **{name: text for name, (_, text) in SQL_TABLES.items()},
    "m_labelled_all": """SELECT *,
  CAST(CAST(order_delivered_customer_date AS DATE) > CAST(order_estimated_delivery_date AS DATE) AS INTEGER)
    AS pedido_retrasado
FROM m_orders WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL
  AND order_estimated_delivery_date IS NOT NULL""",
    "m_labelled": f"""SELECT * FROM m_labelled_all
WHERE order_purchase_timestamp >= TIMESTAMP '{START}' AND order_purchase_timestamp < TIMESTAMP '{STOP}'""",
    "m_parts": """SELECT product_id, CASE WHEN product_weight_g > 0 THEN product_weight_g END AS w,
  CASE WHEN product_length_cm > 0 AND product_height_cm > 0 AND product_width_cm > 0
    THEN product_length_cm * product_height_cm * product_width_cm END AS v
FROM m_products""",
    "m_cart": """SELECT i.order_id, count(order_item_id) AS n_items, count(DISTINCT i.seller_id) AS n_sellers,
  coalesce(sum(price), 0) AS total_price, coalesce(sum(freight_value), 0) AS total_freight,
  CASE WHEN count(w) = count(*) THEN sum(w) END AS total_weight_g,
  CASE WHEN count(v) = count(*) THEN sum(v) END AS total_volume_cm3,
  list(DISTINCT seller_state) FILTER (WHERE seller_state IS NOT NULL) AS seller_states
FROM m_items i LEFT JOIN m_parts p ON p.product_id = i.product_id
  LEFT JOIN m_sellers s ON s.seller_id = i.seller_id
GROUP BY i.order_id""",
    "m_paid": """SELECT order_id, max(payment_type) FILTER (WHERE rn = 1) AS main_payment_type,
  max(CASE WHEN payment_installments > 0 THEN payment_installments END) AS max_installments
FROM (SELECT *, row_number() OVER (PARTITION BY order_id
  ORDER BY payment_value DESC NULLS LAST, payment_sequential, payment_type) AS rn FROM m_payments)
GROUP BY order_id""",
    "m_features": """SELECT o.order_id, o.order_purchase_timestamp, o.order_approved_at AS prediction_time,
  month(o.order_purchase_timestamp) AS purchase_month,
  isodow(o.order_purchase_timestamp) - 1 AS purchase_dayofweek,
  hour(o.order_purchase_timestamp) AS purchase_hour,
  date_diff('day', CAST(o.order_purchase_timestamp AS DATE), CAST(o.order_estimated_delivery_date AS DATE))
    AS promised_days,
  date_diff('microsecond', o.order_purchase_timestamp, o.order_approved_at) / 3600000000.0 AS approval_hours,
  o.pedido_retrasado, c.customer_state, k.n_items, k.n_sellers, k.total_price, k.total_freight,
  k.total_weight_g, k.total_volume_cm3, p.main_payment_type, p.max_installments,
  CASE WHEN k.total_price > 0 THEN k.total_freight / k.total_price END AS freight_ratio,
  CASE WHEN k.seller_states IS NULL OR len(k.seller_states) = 0 THEN 'unknown'
    WHEN len(list_filter(k.seller_states, lambda s: s IS DISTINCT FROM c.customer_state)) > 0 THEN 'True'
    ELSE 'False' END AS seller_other_state
FROM m_labelled o LEFT JOIN m_customers c ON c.customer_id = o.customer_id
  LEFT JOIN m_cart k ON k.order_id = o.order_id LEFT JOIN m_paid p ON p.order_id = o.order_id
WHERE o.order_approved_at IS NOT NULL""",
    "m_features_purchase": """SELECT o.order_id, o.order_purchase_timestamp,
  o.order_purchase_timestamp AS prediction_time,
  month(o.order_purchase_timestamp) AS purchase_month,
  isodow(o.order_purchase_timestamp) - 1 AS purchase_dayofweek,
  hour(o.order_purchase_timestamp) AS purchase_hour,
  date_diff('day', CAST(o.order_purchase_timestamp AS DATE), CAST(o.order_estimated_delivery_date AS DATE))
    AS promised_days,
  o.pedido_retrasado, c.customer_state, k.n_items, k.n_sellers, k.total_price, k.total_freight,
  k.total_weight_g, k.total_volume_cm3, p.main_payment_type, p.max_installments,
  CASE WHEN k.total_price > 0 THEN k.total_freight / k.total_price END AS freight_ratio,
  CASE WHEN k.seller_states IS NULL OR len(k.seller_states) = 0 THEN 'unknown'
    WHEN len(list_filter(k.seller_states, lambda s: s IS DISTINCT FROM c.customer_state)) > 0 THEN 'True'
    ELSE 'False' END AS seller_other_state
FROM m_labelled o LEFT JOIN m_customers c ON c.customer_id = o.customer_id
  LEFT JOIN m_cart k ON k.order_id = o.order_id LEFT JOIN m_paid p ON p.order_id = o.order_id""",
    "m_main": """SELECT order_id, seller_id, product_id FROM (SELECT *, row_number() OVER (
  PARTITION BY order_id ORDER BY price DESC NULLS LAST, order_item_id, product_id, seller_id) AS rn
  FROM m_items) WHERE rn = 1""",
    "m_centroids": f"""SELECT geolocation_zip_code_prefix AS zip, median(geolocation_lat) AS lat,
  median(geolocation_lng) AS lng
FROM m_geolocation WHERE geolocation_lat BETWEEN {SOUTH} AND {NORTH}
  AND geolocation_lng BETWEEN {WEST} AND {EAST} GROUP BY 1""",
    "m_centroids_mean": """SELECT geolocation_zip_code_prefix AS zip, avg(geolocation_lat) AS lat,
  avg(geolocation_lng) AS lng FROM m_geolocation GROUP BY 1""",
    "m_distance": f"""SELECT i.order_id, max({HAVERSINE.format(a='c.lat', b='s.lat', c='c.lng', d='s.lng')})
    AS max_distance_km
FROM (SELECT DISTINCT order_id, seller_id FROM m_items) i JOIN m_orders o ON o.order_id = i.order_id
  LEFT JOIN m_customers u ON u.customer_id = o.customer_id
  LEFT JOIN m_sellers v ON v.seller_id = i.seller_id
  LEFT JOIN m_centroids c ON c.zip = u.customer_zip_code_prefix
  LEFT JOIN m_centroids s ON s.zip = v.seller_zip_code_prefix
WHERE c.lat IS NOT NULL AND s.lat IS NOT NULL GROUP BY i.order_id""",
    "m_route": """SELECT order_id, max_distance_km, customer_region, seller_region,
  CASE WHEN customer_region = 'unknown' OR seller_region = 'unknown' THEN 'unknown'
    WHEN customer_region <> seller_region THEN 'True' ELSE 'False' END AS cross_region
FROM (SELECT o.order_id, d.max_distance_km, coalesce(cr.region, 'unknown') AS customer_region,
    coalesce(sr.region, 'unknown') AS seller_region
  FROM m_orders o LEFT JOIN m_customers c ON c.customer_id = o.customer_id
    LEFT JOIN m_main m ON m.order_id = o.order_id LEFT JOIN m_sellers s ON s.seller_id = m.seller_id
    LEFT JOIN m_distance d ON d.order_id = o.order_id
    LEFT JOIN m_regions cr ON cr.state = c.customer_state
    LEFT JOIN m_regions sr ON sr.state = s.seller_state)""",
    "m_category": """SELECT m.order_id, coalesce(p.product_category_name, 'unknown') AS main_category
FROM m_main m LEFT JOIN m_products p ON p.product_id = m.product_id""",
    "m_deliveries": """SELECT m.seller_id, o.order_delivered_customer_date AS t,
  count(*) OVER w AS n, sum(o.pedido_retrasado) OVER w AS late
FROM m_labelled_all o JOIN m_main m ON m.order_id = o.order_id
WINDOW w AS (PARTITION BY m.seller_id ORDER BY o.order_delivered_customer_date
  RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "m_history": """SELECT q.order_id, CAST(coalesce(d.n, 0) AS DOUBLE) AS seller_prev_orders,
  CASE WHEN d.n >= 5 THEN d.late / CAST(d.n AS DOUBLE) END AS seller_prev_late_rate
FROM (SELECT f.order_id, f.prediction_time, m.seller_id FROM m_features f
    LEFT JOIN m_main m ON m.order_id = f.order_id) q
  ASOF LEFT JOIN (SELECT DISTINCT * FROM m_deliveries) d
    ON d.seller_id = q.seller_id AND d.t < q.prediction_time""",
    "m_dataset": """SELECT f.*, r.max_distance_km, r.customer_region, r.seller_region, r.cross_region,
  c.main_category, h.seller_prev_orders, h.seller_prev_late_rate
FROM m_features f LEFT JOIN m_route r ON r.order_id = f.order_id
  LEFT JOIN m_category c ON c.order_id = f.order_id LEFT JOIN m_history h ON h.order_id = f.order_id""",
    "m_scored": """SELECT order_id, prediction_time, pedido_retrasado,
  round(1 / (1 + promised_days / 8.0 + approval_hours / 96.0), 4) AS score FROM m_moments""",
    "m_moments": """SELECT order_id, order_purchase_timestamp, order_approved_at AS prediction_time,
  pedido_retrasado,
  date_diff('day', CAST(order_purchase_timestamp AS DATE), CAST(order_estimated_delivery_date AS DATE))
    AS promised_days,
  date_diff('microsecond', order_purchase_timestamp, order_approved_at) / 3600000000.0 AS approval_hours
FROM m_labelled WHERE order_approved_at IS NOT NULL""",
    "m_region_features": f"""SELECT *, CASE WHEN customer_state = '{FOCUS}' THEN '{FOCUS}'
  ELSE 'Resto de Brasil' END AS region FROM m_features""",
}


def query(text: str, **views: str) -> str:
    """Prefix a query with the views it needs, directly or through other views, in order."""
    known = {**VIEWS, **views}
    ordered: list[str] = []

    def need(sql: str) -> None:
        for name in re.findall(r"\bm_[a-z_]+\b", sql):
            if name in known and name not in ordered:
                need(known[name])
                if name not in ordered:
                    ordered.append(name)

    need(text)
    if not ordered:
        return text
    return "WITH " + ",\n".join(f"{n} AS ({known[n]})" for n in ordered) + "\n" + text
