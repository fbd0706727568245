"""Labels, features and the model dataset."""

from __future__ import annotations

from pyspark.sql import functions as F

from arrivo.functions.scalars import logit
from arrivo.operators import eda, metrics
from arrivo.operators.label import build_target, compare_label_rules
from arrivo.operators.running import asof_history
from arrivo.plans import builders, features
from arrivo.plans.view import analytic_view
from arrivo.queries.binding import BOX, PERIOD
from arrivo.queries.registry import EXACT, register
from arrivo.schemas import DELIVERED, ESTIMATED, PREDICTION_TIME, TARGET


def labelled(b):
    return build_target(b["orders"], period=PERIOD)


def base(b, anchor="aprobacion"):
    return features.build_features_from(b, labelled(b), anchor)


def context(b):
    return builders.Inputs(b, moments(b), b.regions(), BOX)


def dataset(b):
    return builders.build_model_dataset(b, regions=b.regions(), period=PERIOD, box=BOX)


def moments(b):
    return features.order_moments(labelled(b), "aprobacion")


def scored(b):
    """A score per labelled order, made from two of its features, with many ties."""
    return moments(b).select(
        "order_id",
        PREDICTION_TIME,
        TARGET,
        F.round(1 / (1 + F.col("promised_days") / 8.0 + F.col("approval_hours") / 96.0), 4).alias("score"),
    )


LABEL_COLUMNS = (
    "order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,"
    " order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date"
)

register("label_day", labelled, "SELECT * FROM m_labelled", whole=["pedido_retrasado"])
register(
    "label_timestamp",
    lambda b: build_target(b["orders"], by_calendar_day=False, period=PERIOD),
    f"SELECT {LABEL_COLUMNS}, CAST(order_delivered_customer_date > order_estimated_delivery_date AS BIGINT)"
    " AS pedido_retrasado FROM m_labelled",
)
register(
    "label_all_periods",
    lambda b: build_target(b["orders"], only_study_period=False),
    "SELECT * FROM m_labelled_all",
    whole=["pedido_retrasado"],
)


def text_dates(b):
    """The same label from dates held as text, where some do not parse."""
    as_text = {
        c: F.when(F.col("order_approved_at").isNull(), "sin fecha").otherwise(
            F.date_format(F.col(c).cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
        )
        for c in (DELIVERED, ESTIMATED)
    }
    return build_target(b["orders"].withColumns(as_text), period=PERIOD).select(
        "order_id", DELIVERED, ESTIMATED, TARGET
    )


register(
    "label_lenient_parse",
    text_dates,
    "SELECT order_id, order_delivered_customer_date, order_estimated_delivery_date, pedido_retrasado"
    " FROM m_labelled WHERE order_approved_at IS NOT NULL",
    whole=["pedido_retrasado"],
)
PAIRS = """SELECT order_id, pedido_retrasado AS regla_por_dia,
  CAST(order_delivered_customer_date > order_estimated_delivery_date AS INTEGER) AS regla_por_fecha_y_hora
FROM m_labelled_all"""
register(
    "label_rules_compared",
    lambda b: compare_label_rules(b["orders"]),
    "SELECT * FROM m_pairs",
    whole=["regla_por_dia", "regla_por_fecha_y_hora"],
    m_pairs=PAIRS,
)
register(
    "label_rule_rates",
    lambda b: metrics.label_rates(compare_label_rules(b["orders"])),
    "SELECT count(*) AS n, avg(regla_por_dia) AS tasa_dia, avg(regla_por_fecha_y_hora) AS tasa_fecha_y_hora"
    " FROM m_pairs",
    real=["tasa_dia", "tasa_fecha_y_hora"],
    m_pairs=PAIRS,
)
register(
    "label_crosstab",
    lambda b: eda.label_crosstab(compare_label_rules(b["orders"])),
    "SELECT regla_por_dia, count(*) FILTER (WHERE regla_por_fecha_y_hora = 0) AS a_tiempo,"
    " count(*) FILTER (WHERE regla_por_fecha_y_hora = 1) AS tarde FROM m_pairs GROUP BY 1",
    whole=["regla_por_dia"],
    m_pairs=PAIRS,
)
register(
    "label_distribution",
    lambda b: eda.label_distribution(labelled(b)),
    "SELECT pedido_retrasado, count(*) AS cantidad,"
    " round(100.0 * count(*) / (SELECT count(*) FROM m_labelled), 2) AS porcentaje FROM m_labelled GROUP BY 1",
    whole=["pedido_retrasado"],
)

register(
    "cart_features",
    lambda b: features.cart_features(b["items"], b["products"], b["sellers"]),
    "SELECT order_id, n_items, n_sellers, total_price, total_freight, total_weight_g, total_volume_cm3,"
    " list_min(seller_states) AS first_seller_state, list_max(seller_states) AS last_seller_state FROM m_cart",
    real=["total_price", "total_freight", "total_weight_g", "total_volume_cm3"],
)
register(
    "payment_features",
    lambda b: features.payment_features(b["payments"]),
    "SELECT * FROM m_paid",
)
FEATURE_REAL = [
    "total_price",
    "total_freight",
    "total_weight_g",
    "total_volume_cm3",
    "freight_ratio",
]
FEATURE_WHOLE = ["purchase_month", "purchase_dayofweek", "purchase_hour", "promised_days", "pedido_retrasado"]
register(
    "order_features_approval",
    base,
    "SELECT * FROM m_features",
    real=[*FEATURE_REAL, "approval_hours"],
    whole=FEATURE_WHOLE,
    digits=EXACT,
)
register(
    "order_features_purchase",
    lambda b: base(b, "compra"),
    "SELECT * FROM m_features_purchase",
    real=FEATURE_REAL,
    whole=FEATURE_WHOLE,
)
register("main_item", lambda b: builders.main_items(b["items"]), "SELECT * FROM m_main")
register(
    "zip_centroids",
    lambda b: builders.zip_centroids(b["geolocation"], BOX),
    "SELECT * FROM m_centroids",
    real=["lat", "lng"],
)
register(
    "route_features",
    lambda b: builders.route_features(context(b)),
    "SELECT * FROM m_route",
    real=["max_distance_km"],
)
register("main_category", lambda b: builders.product_features(context(b)), "SELECT * FROM m_category")
register(
    "seller_history",
    lambda b: builders.seller_history_features(context(b)),
    "SELECT * FROM m_history",
    real=["seller_prev_late_rate"],
)


def purchases_before_click(b):
    """The as-of operator on the event log: each click against the user's earlier purchases."""
    log = b.raw("events")
    clicks = log.filter("event_type = 'click'").select("event_id", "user_id", "ts")
    bought = log.filter("event_type = 'purchase'").select(
        "user_id", "ts", F.lit(1).alias("one"), (F.col("value") > 50).cast("int").alias("large")
    )
    return asof_history(
        clicks, bought, "user_id", "ts", "ts", {"compras": "one", "grandes": "large"}
    )


register(
    "asof_event_history",
    purchases_before_click,
    """SELECT c.event_id, c.user_id, c.ts, count(p.event_id) AS compras,
  coalesce(sum(CAST(p.value > 50 AS INTEGER)), 0) AS grandes
FROM events c LEFT JOIN events p ON p.user_id = c.user_id AND p.event_type = 'purchase' AND p.ts < c.ts
WHERE c.event_type = 'click' GROUP BY ALL""",
    whole=["grandes"],
)
register(
    "model_dataset",
    dataset,
    "SELECT * FROM m_dataset",
    real=[*FEATURE_REAL, "approval_hours", "max_distance_km", "seller_prev_late_rate"],
    whole=FEATURE_WHOLE,
    digits=EXACT,
)
register(
    "analytic_view",
    lambda b: analytic_view(b, PERIOD),
    """SELECT f.order_id, f.order_purchase_timestamp, f.prediction_time, f.purchase_month,
  f.purchase_dayofweek, f.purchase_hour, f.promised_days,
  date_sub('second', f.order_purchase_timestamp, f.prediction_time) / 3600.0 AS approval_hours,
  f.customer_state, f.n_items, f.n_sellers, k.total_price, k.total_freight, f.freight_ratio,
  k.total_weight_g, k.total_volume_cm3, f.main_payment_type, k.max_installments,
  CASE WHEN f.seller_other_state = 'True' AND f.customer_state IS NULL THEN 'False'
    ELSE f.seller_other_state END AS seller_other_state, f.pedido_retrasado
FROM m_features f LEFT JOIN m_plain k ON k.order_id = f.order_id""",
    real=[*FEATURE_REAL, "approval_hours"],
    whole=FEATURE_WHOLE,
    m_plain="""SELECT i.*, p.max_installments FROM (
  SELECT order_id, sum(price) AS total_price, sum(freight_value) AS total_freight,
    sum(product_weight_g) AS total_weight_g,
    sum(product_length_cm * product_height_cm * product_width_cm) AS total_volume_cm3
  FROM m_items JOIN m_products USING (product_id) GROUP BY order_id) i
  LEFT JOIN (SELECT order_id, max(payment_installments) AS max_installments FROM m_payments
    GROUP BY order_id) p ON p.order_id = i.order_id""",
)
register(
    "early_deliveries",
    lambda b: eda.early_deliveries(moments(b), b["orders"]),
    "SELECT count(*) FILTER (WHERE order_delivered_customer_date < order_approved_at) AS entregados_antes"
    " FROM m_labelled WHERE order_approved_at IS NOT NULL",
)
register(
    "score_logit",
    lambda b: scored(b).select("order_id", logit("score").alias("logit")),
    "SELECT order_id, ln(p / (1 - p)) AS logit FROM (SELECT order_id,"
    " greatest(0.000001, least(1 - 0.000001, score)) AS p FROM m_scored)",
    real=["logit"],
)
