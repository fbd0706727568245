"""Data checks and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from arrivo.operators import checks, profile
from arrivo.plans import star
from arrivo.plans.view import analytic_view
from arrivo.queries.binding import BINDERS, EXTRA_TRANSLATIONS, PERIOD, STAR_BOX
from arrivo.queries.features import base, labelled
from arrivo.queries.registry import register
from arrivo.plans.features import inputs_of
from arrivo.schemas import TABLES

# rows expected of a table: those of the file behind it; one expectation is off on purpose, so that a check fails
EXPECTED_FROM = {"sellers": ("supplier", 0), "orders": ("orders", 0), "items": ("lineitem", 0), "products": ("part", 1)}


def expected_rows(b) -> dict[str, int]:
    return {name: b.raw(file).count() + off for name, (file, off) in EXPECTED_FROM.items()}


NUMERIC_REVIEW = (
    "promised_days",
    "approval_hours",
    "n_items",
    "n_sellers",
    "total_price",
    "total_freight",
    "freight_ratio",
    "total_weight_g",
    "total_volume_cm3",
    "max_installments",
)


def union_all(parts) -> str:
    return "\nUNION ALL ".join(parts)


register(
    "loaded_row_counts",
    lambda b: checks.row_counts(b.all()),
    union_all(f"SELECT '{n}' AS tabla, count(*) AS filas FROM m_{n}" for n in BINDERS),
)
register(
    "check_row_counts",
    lambda b: checks.check_row_counts(b.all(), expected_rows(b)),
    union_all(
        f"SELECT '{n}' AS tabla, (SELECT count(*) + {off} FROM {file}) AS esperado, count(*) AS obtenido,"
        f" count(*) = (SELECT count(*) + {off} FROM {file}) AS ok FROM m_{n}"
        for n, (file, off) in EXPECTED_FROM.items()
    ),
)


def key_sql(name: str, keys) -> str:
    row = f"({', '.join(keys)})"
    return (
        f"SELECT '{name}({', '.join(keys)})' AS prueba, count(*) AS filas, count(DISTINCT {row}) AS claves,"
        f" count(*) = count(DISTINCT {row}) AS ok FROM m_{name}"
    )


register(
    "check_keys",
    lambda b: checks.check_keys(b.all()),
    union_all(key_sql(n, TABLES[n].key) for n in TABLES if TABLES[n].key),
)
def orphans_sql(views: dict[str, str]) -> str:
    return union_all(
        f"SELECT '{n}.{c}' AS prueba, count(*) AS huerfanos, count(*) = 0 AS ok FROM {views.get(n, f'm_{n}')} a"
        f" LEFT JOIN {views.get(p, f'm_{p}')} p ON p.{c} = a.{c} WHERE p.{c} IS NULL"
        for n in TABLES
        for c, p in TABLES[n].references
    )


ORPHANS_SQL = orphans_sql({})
register(
    "check_references",
    lambda b: checks.check_references(b.all()),
    ORPHANS_SQL,
)
SOME_SELLERS = "seller_id % 5 <> 0"
register(
    "check_references_broken",
    lambda b: checks.check_references(dict(b.all()) | {"sellers": b["sellers"].where(SOME_SELLERS)}),
    orphans_sql({"sellers": f"(SELECT * FROM m_sellers WHERE {SOME_SELLERS})"}),
)
REQUIRED_SQL = union_all(
    f"SELECT '{n}' AS tabla, '{c}' AS columna, count(*) - count({c}) AS nulos, count(*) = count({c}) AS ok"
    f" FROM m_{n}"
    for n in TABLES
    for c in TABLES[n].required
)
register("check_required", lambda b: checks.check_required(b.all()), REQUIRED_SQL)
EXPECTED_LABELLED = 9743
register(
    "label_audit",
    lambda b: checks.label_audit(b["orders"], EXPECTED_LABELLED),
    f"""SELECT count(*) AS entregados, round(100 * avg(pedido_retrasado), 2) AS pct_tarde_dia_calendario,
  round(100 * avg(CAST(order_delivered_customer_date > order_estimated_delivery_date AS INTEGER)), 2)
    AS pct_tarde_timestamp, count(*) = {EXPECTED_LABELLED} AS ok_conteo FROM m_labelled_all""",
)
register(
    "label_audit_period",
    lambda b: checks.label_audit_period(b["orders"], PERIOD),
    """SELECT count(*) AS entregados_periodo, round(100 * avg(pedido_retrasado), 2) AS pct_tarde_periodo,
  CAST(min(order_purchase_timestamp) AS DATE) AS primera_compra,
  CAST(max(order_purchase_timestamp) AS DATE) AS ultima_compra FROM m_labelled""",
)
register(
    "view_audit",
    lambda b: checks.view_audit(analytic_view(b, PERIOD)),
    """SELECT count(*) AS filas, round(100 * avg(pedido_retrasado), 2) AS pct_tarde,
  count(*) FILTER (WHERE n_items IS NULL) AS pedidos_sin_items,
  count(*) FILTER (WHERE main_payment_type IS NULL) AS pedidos_sin_pago FROM m_features""",
)


def bound_star(b):
    return star.build_star(b.all(), EXTRA_TRANSLATIONS, STAR_BOX)


# The star is held against its own sources, and against sources that lost the first item of every order: the second
# comparison has to fail wherever items count.
LATER_ITEMS = "order_item_id > 1"


def short_of_items(b) -> dict:
    return dict(b.all()) | {"items": b["items"].where(LATER_ITEMS)}


def sums_sql(items: str) -> str:
    """Totals of the star, recomputed order by order, against those of the source."""
    sides = {
        "precio por item": ("m_star_items", "price", items, "price"),
        "pagos por orden": ("m_star_orders", "paid", "m_payments", "payment_value"),
        "precio por orden": ("m_star_orders", "price", items, "price"),
    }
    return union_all(
        f"SELECT '{n}' AS prueba, a AS obtenido, e AS esperado, abs(a - e) <= 0.00001 * abs(e) AS ok"
        f" FROM (SELECT (SELECT sum({c}) FROM {t}) AS a, (SELECT sum({d}) FROM {u}) AS e)"
        for n, (t, c, u, d) in sides.items()
    )


STAR_SQL = {
    "m_star_items": """SELECT i.* FROM m_items i JOIN m_orders o ON o.order_id = i.order_id
  LEFT JOIN m_customers c ON c.customer_id = o.customer_id""",
    "m_star_orders": """SELECT o.order_id, i.price, p.paid FROM m_orders o
  LEFT JOIN (SELECT order_id, sum(price) AS price FROM m_items GROUP BY 1) i ON i.order_id = o.order_id
  LEFT JOIN (SELECT order_id, sum(payment_value) AS paid FROM m_payments GROUP BY 1) p ON p.order_id = o.order_id""",
    "m_later_items": f"SELECT * FROM m_items WHERE {LATER_ITEMS}",
}
UNIQUE = {"fact_orders": ("m_star_orders", "order_id"), "dim_products": ("m_products", "product_id"), "dim_customers": ("m_customers", "customer_id"), "dim_sellers": ("m_sellers", "seller_id")}


def fan_out_sql(items: str) -> str:
    return (
        "SELECT 'items_flat filas' AS prueba, a AS obtenido, e AS esperado, a = e AS ok"
        f" FROM (SELECT (SELECT count(*) FROM m_star_items) AS a, (SELECT count(*) FROM {items}) AS e)"
    )


def star_sql(items: str) -> str:
    unique = [
        f"SELECT '{n} clave' AS prueba, (SELECT count(*) = count(DISTINCT {key}) FROM {view}) AS ok"
        for n, (view, key) in UNIQUE.items()
    ]
    rest = [f"SELECT prueba, ok FROM ({text})" for text in (fan_out_sql(items), sums_sql(items))]
    return union_all([*unique, *rest])


for suffix, sources, view in (("", lambda b: b, "m_items"), ("_broken", short_of_items, "m_later_items")):
    register(
        f"sum_reconciliation{suffix}",
        lambda b, s=sources: checks.check_sums(star.star_sums(bound_star(b), s(b))),
        sums_sql(view),
        real=["obtenido", "esperado"],
        digits=0,
        **STAR_SQL,
    )
    register(
        f"fan_out_check{suffix}",
        lambda b, s=sources: checks.check_fan_out(bound_star(b)["items_flat"], s(b)["items"], "items_flat filas"),
        fan_out_sql(view),
        **STAR_SQL,
    )
    register(
        f"star_checks{suffix}",
        lambda b, s=sources: star.check_star(bound_star(b), s(b)),
        star_sql(view),
        **STAR_SQL,
    )
register(
    "checks_verdict",
    lambda b: checks.verdict(
        {
            "claves": checks.check_keys(b.all()),
            "huerfanos": checks.check_references(b),
            "obligatorias": checks.check_required(b),
            "periodo": checks.label_audit_period(b["orders"], PERIOD),
        }
    ),
    """SELECT 'claves' AS prueba, (SELECT bool_and(ok) FROM m_keys) AS ok
UNION ALL SELECT 'huerfanos', (SELECT bool_and(ok) FROM m_orphans)
UNION ALL SELECT 'obligatorias', (SELECT bool_and(ok) FROM m_required)
UNION ALL SELECT 'periodo', (SELECT count(*) > 0 FROM m_labelled)""",
    m_keys=union_all(key_sql(n, TABLES[n].key) for n in TABLES if TABLES[n].key),
    m_required=REQUIRED_SQL,
    m_orphans=ORPHANS_SQL,
)


def nulls_sql(view: str, columns) -> str:
    return union_all(
        f"SELECT '{c}' AS columna, count(*) - count({c}) AS cantidad_nulos,"
        f" round(100.0 * (count(*) - count({c})) / count(*), 3) AS porcentaje_nulos FROM {view}"
        for c in columns
    )


ORDER_COLUMNS = [c for c, _ in TABLES["orders"].columns]
register(
    "null_profile_orders",
    lambda b: profile.null_profile(b["orders"]),
    nulls_sql("m_orders", ORDER_COLUMNS),
)
register(
    "null_profile_features",
    lambda b: profile.null_profile(base(b), inputs_of()),
    nulls_sql("m_features", inputs_of()),
)
REALS = ("approval_hours", "total_price", "total_freight", "total_weight_g", "total_volume_cm3", "freight_ratio")


def odd(b):
    """The features with both infinities and with unknown prices, by the size of the cart."""
    price = F.when(F.col("n_items") == 1, float("inf")).when(F.col("n_items") == 2, -float("inf"))
    return base(b).withColumn("total_price", price.when(F.col("n_items") != 3, F.col("total_price")))


ODD = {
    "m_odd": """SELECT * REPLACE (CASE n_items WHEN 1 THEN 'inf'::DOUBLE WHEN 2 THEN '-inf'::DOUBLE WHEN 3 THEN NULL
  ELSE total_price END AS total_price) FROM m_features"""
}
register(
    "infinity_profile",
    lambda b: profile.infinity_profile(odd(b)),
    union_all(
        f"SELECT '{c}' AS columna, count(*) FILTER (WHERE isinf({c})) AS cantidad_infinitos FROM m_odd"
        for c in REALS
    ),
    **ODD,
)
register(
    "describe_infinities",
    lambda b: profile.describe(odd(b), ["total_price"]).select("columna", "count", "min", "p25", "p50", "p75", "max"),
    """SELECT 'total_price' AS columna, count(total_price) AS count, min(total_price) AS min,
  quantile_cont(total_price, 0.25) AS p25, quantile_cont(total_price, 0.5) AS p50,
  quantile_cont(total_price, 0.75) AS p75, max(total_price) AS max FROM m_odd""",
    real=["min", "p25", "p50", "p75", "max"],
    **ODD,
)
def duplicates(b):
    """Whole rows of every table, and of one table that holds a part of its rows twice."""
    tables = dict(b.all()) | {"items_doubled": b["items"].unionByName(b["items"].where(LATER_ITEMS))}
    return checks.stack([profile.duplicate_profile(df).withColumn("tabla", F.lit(n)) for n, df in tables.items()])


DOUBLED = f"SELECT * FROM m_items UNION ALL SELECT * FROM m_items WHERE {LATER_ITEMS}"
register(
    "duplicate_rows",
    duplicates,
    union_all(
        f"SELECT count(*) AS filas, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {source})) AS duplicadas,"
        f" '{n}' AS tabla FROM {source}"
        for n, source in [*((n, f"m_{n}") for n in BINDERS), ("items_doubled", "m_doubled")]
    ),
    m_doubled=DOUBLED,
)
register(
    "grain_orders",
    lambda b: profile.grain(b["orders"], "order_id"),
    """SELECT count(*) AS filas, count(DISTINCT order_id) AS unicos,
  count(*) - count(DISTINCT order_id) AS repetidos, count(*) = count(DISTINCT order_id) AS una_fila_por_clave
FROM m_orders""",
)
register(
    "grain_items",
    lambda b: profile.grain(b["items"], "order_id"),
    """SELECT count(*) AS filas, count(DISTINCT order_id) AS unicos,
  count(*) - count(DISTINCT order_id) AS repetidos, count(*) = count(DISTINCT order_id) AS una_fila_por_clave
FROM m_items""",
)
MISSING = " OR ".join(f"{c} IS NULL" for c in profile.MEASURES)
NONPOSITIVE = " OR ".join(f"coalesce({c} <= 0, false)" for c in profile.MEASURES)
register(
    "invalid_value_counts",
    lambda b: profile.invalid_value_counts(b["products"], b["payments"]),
    f"""SELECT count(*) FILTER (WHERE {MISSING}) AS productos_con_faltantes,
  count(*) FILTER (WHERE {NONPOSITIVE}) AS productos_con_no_positivos,
  (SELECT count(*) FROM m_payments WHERE payment_installments <= 0) AS pagos_con_cuotas_no_positivas
FROM m_products""",
)
register(
    "invalid_products",
    lambda b: profile.invalid_products(b["products"]),
    f"SELECT product_id, {', '.join(profile.MEASURES)} FROM m_products WHERE {MISSING} OR {NONPOSITIVE}",
)
register(
    "invalid_payments",
    lambda b: profile.invalid_payments(b["payments"]),
    "SELECT * FROM m_payments WHERE payment_installments <= 0",
    real=["payment_value"],
)
DESCRIBE = "SELECT * FROM m_describe"
register(
    "describe_features",
    lambda b: profile.describe(base(b), NUMERIC_REVIEW),
    DESCRIBE,
    real=["mean", "std", "min", "p25", "p50", "p75", "max"],
    m_describe=union_all(
        f"""SELECT '{c}' AS columna, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
  CAST(min({c}) AS DOUBLE) AS min, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS p25,
  quantile_cont(CAST({c} AS DOUBLE), 0.5) AS p50, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS p75,
  CAST(max({c}) AS DOUBLE) AS max FROM m_features"""
        for c in NUMERIC_REVIEW
    ),
)
register(
    "promise_by_label",
    lambda b: profile.group_stats(base(b), "pedido_retrasado", "promised_days"),
    """SELECT pedido_retrasado, count(promised_days) AS count, avg(promised_days) AS mean,
  median(promised_days) AS median, min(promised_days) AS min, max(promised_days) AS max
FROM m_features GROUP BY 1""",
    real=["mean", "median"],
    whole=["pedido_retrasado", "min", "max"],
)


def counts_sql(view: str, column: str, keep_null: bool = False) -> str:
    where = "" if keep_null else f" WHERE {column} IS NOT NULL"
    return (
        f"SELECT {column}, count(*) AS cantidad, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS proporcion"
        f" FROM {view}{where} GROUP BY 1"
    )


register(
    "value_counts_status",
    lambda b: profile.value_counts(b["orders"], "order_status", keep_null=True),
    counts_sql("m_orders", "order_status", True),
    real=["proporcion"],
)
register(
    "value_counts_state",
    lambda b: profile.value_counts(base(b), "customer_state"),
    counts_sql("m_features", "customer_state"),
    real=["proporcion"],
)
register(
    "value_counts_month",
    lambda b: profile.value_counts(base(b), "purchase_month"),
    counts_sql("m_features", "purchase_month"),
    real=["proporcion"],
    whole=["purchase_month"],
)
register(
    "value_counts_weekday",
    lambda b: profile.value_counts(base(b), "purchase_dayofweek"),
    counts_sql("m_features", "purchase_dayofweek"),
    real=["proporcion"],
    whole=["purchase_dayofweek"],
)
TOP_COLUMNS = (
    "order_id",
    "order_purchase_timestamp",
    "promised_days",
    "total_price",
    "total_freight",
    "customer_state",
    "pedido_retrasado",
)
register(
    "longest_promises",
    lambda b: profile.top_rows(base(b), "promised_days", 10, ["order_id"], TOP_COLUMNS),
    f"SELECT {', '.join(TOP_COLUMNS)} FROM m_features ORDER BY promised_days DESC, order_id LIMIT 10",
    real=["total_price", "total_freight"],
    whole=["promised_days", "pedido_retrasado"],
)
register(
    "nonpositive_promises",
    lambda b: base(b).agg(F.count_if(F.col("promised_days") <= 0).alias("pedidos")),
    "SELECT count(*) FILTER (WHERE promised_days <= 0) AS pedidos FROM m_features",
)
register(
    "sample_orders",
    lambda b: profile.seeded_sample(b["orders"], "order_id", 5).select("order_id", "order_purchase_timestamp"),
    """SELECT order_id, order_purchase_timestamp FROM m_orders
ORDER BY md5(CAST(order_id AS VARCHAR) || '/42'), order_id LIMIT 5""",
)
register(
    "model_population",
    lambda b: checks.check_row_counts({"orders": labelled(b)}, {"orders": b.raw("orders").count()}),
    """SELECT 'orders' AS tabla, (SELECT count(*) FROM orders) AS esperado, count(*) AS obtenido,
  count(*) = (SELECT count(*) FROM orders) AS ok FROM m_labelled""",
)
