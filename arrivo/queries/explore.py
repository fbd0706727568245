"""Exploration tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from arrivo.operators import eda, temporal
from arrivo.plans import builders
from arrivo.queries.binding import BOX, FOCUS
from arrivo.queries.features import base, context, labelled, moments
from arrivo.queries.registry import register
from arrivo.queries.sql import HAVERSINE

MIN_N = 300
MONTH = "CAST(date_trunc('month', order_purchase_timestamp) AS DATE)"
RATE = "count(*) AS n, avg(pedido_retrasado) AS tasa"


def edge_case(column: str, edges, out: str) -> str:
    cases = " ".join(
        f"WHEN {column} > {lo} AND {column} <= {hi} THEN {i}" if hi != float("inf") else f"WHEN {column} > {lo} THEN {i}"
        for i, (lo, hi) in enumerate(zip(edges, edges[1:]))
    )
    return f"CASE {cases} END AS {out}"


def label_case(column: str, labels) -> str:
    return "CASE " + column + " " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(labels)) + " END"


register(
    "context_numbers",
    lambda b: eda.context_numbers(base(b)),
    "SELECT count(*) AS pedidos, sum(pedido_retrasado) AS retrasados, avg(pedido_retrasado) AS tasa FROM m_features",
    real=["tasa"],
    whole=["retrasados"],
)
LATE_DAYS = """SELECT date_diff('day', CAST(order_estimated_delivery_date AS DATE),
  CAST(order_delivered_customer_date AS DATE)) AS d FROM m_labelled WHERE pedido_retrasado = 1"""
register(
    "delay_quantiles",
    lambda b: eda.delay_quantiles(labelled(b)),
    "SELECT quantile_cont(d, 0.5) AS mediana, quantile_cont(d, 0.9) AS p90 FROM m_late_days",
    real=["mediana", "p90"],
    m_late_days=LATE_DAYS,
)
register(
    "delay_histogram",
    lambda b: eda.delay_histogram(labelled(b), 20),
    "SELECT least(d, 20) AS dias, count(*) AS n FROM m_late_days GROUP BY 1",
    whole=["dias"],
    m_late_days=LATE_DAYS,
)
register(
    "delay_describe",
    lambda b: _describe_delay(b),
    """SELECT 'dias_tarde' AS columna, count(*) AS count, avg(d) AS mean, stddev_samp(d) AS std,
  CAST(min(d) AS DOUBLE) AS min, quantile_cont(d, 0.25) AS p25, quantile_cont(d, 0.5) AS p50,
  quantile_cont(d, 0.75) AS p75, CAST(max(d) AS DOUBLE) AS max FROM m_late_days""",
    real=["mean", "std", "p25", "p50", "p75"],
    m_late_days=LATE_DAYS,
)


def _describe_delay(b):
    from arrivo.operators.profile import describe

    return describe(eda.late_days(labelled(b)), ["dias_tarde"])


register(
    "monthly_rates",
    lambda b: eda.monthly_rates(base(b)),
    f"SELECT {MONTH} AS anio_mes, {RATE}, quantile_cont(promised_days, 0.5) AS plazo_mediano"
    " FROM m_features GROUP BY 1",
    real=["tasa", "plazo_mediano"],
)
register(
    "monthly_volume_change",
    lambda b: eda.monthly_volume_change(moments(b)),
    f"""SELECT anio_mes, n, n / CAST(lag(n) OVER (ORDER BY anio_mes) AS DOUBLE) - 1 AS cambio
FROM (SELECT {MONTH} AS anio_mes, count(*) AS n FROM m_moments GROUP BY 1)""",
    real=["cambio"],
)
register(
    "monthly_rates_by_region",
    lambda b: eda.monthly_rates_by_region(base(b), FOCUS),
    f"SELECT {MONTH} AS anio_mes, region, {RATE} FROM m_region_features GROUP BY 1, 2",
    real=["tasa"],
)
register(
    "late_rate_by_state",
    lambda b: eda.rates_by_state(base(b), MIN_N),
    f"SELECT customer_state, {RATE} FROM m_features WHERE customer_state IS NOT NULL GROUP BY 1"
    f" HAVING count(*) >= {MIN_N}",
    real=["tasa"],
)
register(
    "states_left_out",
    lambda b: eda.small_states(base(b), MIN_N),
    f"SELECT customer_state, {RATE} FROM m_features WHERE customer_state IS NOT NULL GROUP BY 1"
    f" HAVING count(*) < {MIN_N}",
    real=["tasa"],
)
register(
    "state_shares_top5",
    lambda b: eda.state_shares(base(b), 5),
    """SELECT customer_state, round(100.0 * n / sum(n) OVER (), 1) AS pct_pedidos,
  round(100.0 * late / sum(late) OVER (), 1) AS pct_retrasos
FROM (SELECT customer_state, count(*) AS n, sum(pedido_retrasado) AS late FROM m_features
  WHERE customer_state IS NOT NULL GROUP BY 1)
ORDER BY late DESC, customer_state LIMIT 5""",
)
register(
    "rate_by_seller_place",
    lambda b: eda.rates_by_seller_place(base(b)),
    f"SELECT seller_other_state, {RATE} FROM m_features GROUP BY 1",
    real=["tasa"],
)
register(
    "rate_by_region_and_seller_place",
    lambda b: eda.rates_by_region_and_seller_place(base(b), FOCUS),
    f"SELECT region, seller_other_state, {RATE} FROM m_region_features GROUP BY 1, 2",
    real=["tasa"],
)
TRAMO = f"SELECT *, {edge_case('promised_days', eda.PROMISE_EDGES, 'tramo')} FROM m_region_features"
register(
    "rate_by_promise",
    lambda b: eda.rates_by_promise(base(b), FOCUS),
    f"SELECT tramo, {RATE}, avg(CAST(region = '{FOCUS}' AS INTEGER)) AS proporcion_foco,"
    f" {label_case('tramo', eda.PROMISE_LABELS)} AS tramo_plazo FROM m_tramo WHERE tramo IS NOT NULL GROUP BY 1",
    real=["tasa", "proporcion_foco"],
    whole=["tramo"],
    m_tramo=TRAMO,
)
register(
    "rate_by_promise_and_region",
    lambda b: eda.rates_by_promise_and_region(base(b), FOCUS),
    f"""SELECT tramo, count(*) FILTER (WHERE region = '{FOCUS}') AS n_foco,
  avg(pedido_retrasado) FILTER (WHERE region = '{FOCUS}') AS tasa_foco,
  count(*) FILTER (WHERE region <> '{FOCUS}') AS n_resto,
  avg(pedido_retrasado) FILTER (WHERE region <> '{FOCUS}') AS tasa_resto,
  {label_case('tramo', eda.PROMISE_LABELS)} AS tramo_plazo FROM m_tramo WHERE tramo IS NOT NULL GROUP BY 1""",
    real=["tasa_foco", "tasa_resto"],
    whole=["tramo"],
    m_tramo=TRAMO,
)
register(
    "promise_by_outcome",
    lambda b: eda.promise_by_outcome(base(b), FOCUS),
    """SELECT region, puntual, retrasado, puntual - retrasado AS diferencia FROM (SELECT region,
  avg(promised_days) FILTER (WHERE pedido_retrasado = 0) AS puntual,
  avg(promised_days) FILTER (WHERE pedido_retrasado = 1) AS retrasado FROM m_region_features GROUP BY 1)""",
    real=["puntual", "retrasado", "diferencia"],
)
register(
    "rate_by_approval_hours",
    lambda b: eda.rates_by_approval(moments(b)),
    f"SELECT tramo, {RATE}, {label_case('tramo', eda.APPROVAL_LABELS)} AS tramo_aprobacion"
    " FROM m_approval WHERE tramo IS NOT NULL GROUP BY 1",
    real=["tasa"],
    whole=["tramo"],
    m_approval=f"SELECT *, {edge_case('approval_hours', (*eda.APPROVAL_EDGES, float('inf')), 'tramo')} FROM m_moments",
)


def bins_sql(view: str, column: str, bins: int, out: str) -> str:
    """Right-closed equal-frequency bins: number of distinct inner edges below the value."""
    edges = ", ".join(repr(i / bins) for i in range(bins + 1))
    return f"""SELECT *, CASE WHEN {column} IS NOT NULL THEN
  len(list_filter(inner_edges, lambda e: e < {column})) END AS {out}
FROM {view}, (SELECT CASE WHEN len(e) > 2 THEN e[2:len(e) - 1] ELSE CAST([] AS DOUBLE[]) END AS inner_edges
  FROM (SELECT list_sort(list_distinct(quantile_cont(CAST({column} AS DOUBLE), [{edges}]))) AS e FROM {view}))"""


register(
    "rate_by_freight_quintile",
    lambda b: eda.rates_by_freight_quintile(base(b)),
    f"SELECT quintil, {RATE}, {label_case('quintil', eda.FREIGHT_LABELS)} AS quintil_flete FROM m_quintil"
    " WHERE quintil IS NOT NULL GROUP BY 1",
    real=["tasa"],
    whole=["quintil"],
    m_quintil=bins_sql("m_features", "freight_ratio", 5, "quintil"),
)
register(
    "seller_count_table",
    lambda b: eda.seller_count_table(base(b), FOCUS),
    f"""SELECT CASE WHEN n_sellers >= 2 THEN '2 o más' ELSE '1' END AS n_vendedores, {RATE},
  avg(CAST(region = '{FOCUS}' AS INTEGER)) AS proporcion_foco, quantile_cont(promised_days, 0.5) AS plazo_mediano
FROM m_region_features GROUP BY 1""",
    real=["tasa", "proporcion_foco", "plazo_mediano"],
)
register(
    "delivery_days_p99",
    lambda b: eda.delivery_days_p99(b["orders"]),
    """SELECT quantile_cont(date_diff('day', CAST(order_purchase_timestamp AS DATE),
  CAST(order_delivered_customer_date AS DATE)), 0.99) AS dias_entrega FROM m_labelled_all""",
    real=["dias_entrega"],
)
register(
    "delivered_share_by_month",
    lambda b: eda.delivered_share_by_month(b["orders"]),
    f"""SELECT {MONTH} AS anio_mes, count(*) AS pedidos, avg(CAST(order_status = 'delivered'
  AND order_delivered_customer_date IS NOT NULL AND order_estimated_delivery_date IS NOT NULL AS INTEGER))
  AS proporcion_entregada FROM m_orders GROUP BY 1""",
    real=["proporcion_entregada"],
)
register(
    "median_approval_hours",
    lambda b: eda.median_approval(moments(b)),
    "SELECT quantile_cont(approval_hours, 0.5) AS horas_mediana FROM m_moments",
    real=["horas_mediana"],
)
COHORT = """SELECT s.*, CASE WHEN prediction_time >= test_start THEN 'test'
  WHEN prediction_time >= validation_start THEN 'validation' ELSE 'train' END AS cohort
FROM m_moments s, m_cuts"""
CUTS = """SELECT test_start, (SELECT date_trunc('day', quantile_cont(prediction_time, 0.8))::TIMESTAMP
  FROM m_moments WHERE prediction_time < test_start) AS validation_start
FROM (SELECT date_trunc('day', quantile_cont(prediction_time, 0.8))::TIMESTAMP AS test_start FROM m_moments)"""
register(
    "promise_drift",
    lambda b: eda.median_by_cohort(temporal.three_way_split(moments(b)), "promised_days"),
    "SELECT cohort, quantile_cont(promised_days, 0.5) AS mediana FROM m_cohort GROUP BY 1",
    real=["mediana"],
    m_cohort=COHORT,
    m_cuts=CUTS,
)


def distance_versions(b):
    """Distance from the mean of all points against the median of the points inside the box."""
    ctx = context(b)
    means = ctx.tables["geolocation"].groupBy(F.col("geolocation_zip_code_prefix").alias("zip")).agg(
        F.avg("geolocation_lat").alias("lat"), F.avg("geolocation_lng").alias("lng")
    )
    versions = []
    for centroids in (means, builders.zip_centroids(b["geolocation"], BOX)):
        places = builders.order_places(b["orders"], b["customers"], centroids)
        versions.append(builders.order_distances(b["items"], builders.seller_places(b["sellers"], centroids), places))
    cohorts = temporal.three_way_split(moments(b))
    return eda.compare_versions(*versions, cohorts, "max_distance_km", moved=50.0, far=3000.0)


def distance_sql(centroids: str) -> str:
    return f"""SELECT i.order_id, max({HAVERSINE.format(a='c.lat', b='s.lat', c='c.lng', d='s.lng')}) AS km
FROM m_items i JOIN m_orders o ON o.order_id = i.order_id
  JOIN m_customers u ON u.customer_id = o.customer_id JOIN m_sellers v ON v.seller_id = i.seller_id
  JOIN {centroids} c ON c.zip = u.customer_zip_code_prefix
  JOIN {centroids} s ON s.zip = v.seller_zip_code_prefix GROUP BY i.order_id"""


register(
    "distance_versions",
    distance_versions,
    """SELECT cohort, count(*) AS pedidos, count(*) FILTER (WHERE abs(n.km - a.km) > 50) AS cambian,
  count(*) FILTER (WHERE a.km > 3000) AS lejanos,
  count(*) FILTER (WHERE a.km IS NOT NULL AND n.km IS NULL) AS quedan_sin_valor
FROM m_cohort h LEFT JOIN m_old a ON a.order_id = h.order_id LEFT JOIN m_new n ON n.order_id = h.order_id
GROUP BY 1""",
    m_cohort=COHORT,
    m_cuts=CUTS,
    m_old=distance_sql("m_centroids_mean"),
    m_new=distance_sql("m_centroids"),
)
