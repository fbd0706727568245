"""Star schema: dimensions, facts and the flat item table.

Fixed values: the names of the output columns are those of the published tables.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from arrivo.functions.aggregates import at_largest, last_known, sum_or_zero
from arrivo.functions.scalars import days_between
from arrivo.operators.checks import check_fan_out, check_sums, check_unique, require_ok, stack
from arrivo.operators.label import late_flag, observable
from arrivo.operators.quantiles import quantiles
from arrivo.plans.builders import in_box
from arrivo.plans.features import payment_ties
from arrivo.schemas import (
    APPROVED,
    CARRIER,
    DELIVERED,
    ESTIMATED,
    EXTRA_TRANSLATIONS,
    PURCHASE,
    STAR_BOX,
)
from arrivo.session import discard, fits_every_task, materialize

SHARE_ROWS = 40_000_000  # items whose shuffle files are on disk at a time


def purchase_day() -> F.Column:
    return F.to_date(PURCHASE).cast("timestamp_ntz")




def dim_geolocation(geolocation: DataFrame, box: tuple = STAR_BOX) -> DataFrame:
    """One row per zip: median point, commonest city and state, points inside the box only."""
    points = geolocation.filter(
        in_box(F.col("geolocation_lat"), F.col("geolocation_lng"), box)
        & F.col("geolocation_zip_code_prefix").isNotNull()
    ).withColumnsRenamed(
        {
            "geolocation_zip_code_prefix": "zip_prefix",
            "geolocation_lat": "lat",
            "geolocation_lng": "lng",
            "geolocation_city": "ciudad",
            "geolocation_state": "estado",
        }
    )
    numbers = quantiles(
        points.select(
            "zip_prefix",
            F.explode(F.create_map(F.lit("lat"), "lat", F.lit("lng"), "lng")).alias("axis", "v"),
        ),
        "v",
        [0.5],
        ["zip_prefix", "axis"],
        ["m"],
    )
    # text values are counted the same way: one (zip, column, value) count, then the top one
    names = (
        points.select(
            "zip_prefix",
            F.explode(F.create_map(F.lit("ciudad"), "ciudad", F.lit("estado"), "estado")).alias(
                "axis", "v"
            ),
        )
        .filter(F.col("v").isNotNull())
        .groupBy("zip_prefix", "axis", "v")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("zip_prefix", "axis")
        .agg(F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("m"))
    )
    wide = [
        df.groupBy("zip_prefix").agg(
            *[F.max(F.when(F.col("axis") == c, F.col("m"))).alias(c) for c in columns]
        )
        for df, columns in ((numbers, ("lat", "lng")), (names, ("ciudad", "estado")))
    ]
    return wide[0].join(wide[1], "zip_prefix", "outer")


def dim_products(
    products: DataFrame, translation: DataFrame, extra: Sequence[tuple[str, str]] = EXTRA_TRANSLATIONS
) -> DataFrame:
    """Products with the English category and the raw volume (no masking of odd measures here)."""
    spark = products.sparkSession
    names = translation.select("product_category_name", "product_category_name_english").unionByName(
        spark.createDataFrame(
            list(extra), "product_category_name string, product_category_name_english string"
        )
    )
    return (
        products.join(names, "product_category_name", "left")
        .withColumnsRenamed(
            {
                "product_name_lenght": "product_name_length",
                "product_description_lenght": "product_description_length",
            }
        )
        .withColumns(
            {
                "product_category_name_english": F.coalesce(
                    "product_category_name_english", F.lit("unknown")
                ),
                "product_category_name": F.coalesce("product_category_name", F.lit("desconocida")),
                "product_volume_cm3": F.col("product_length_cm")
                * F.col("product_height_cm")
                * F.col("product_width_cm"),
            }
        )
    )


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.withColumnRenamed("customer_zip_code_prefix", "zip_prefix")


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.withColumnRenamed("seller_zip_code_prefix", "zip_prefix")


def dim_calendar(orders: DataFrame) -> DataFrame:
    """One row per day between the first and the last purchase."""
    span = orders.agg(F.min(F.to_date(PURCHASE)).alias("a"), F.max(F.to_date(PURCHASE)).alias("b"))
    day = F.col("fecha")
    return span.select(F.explode(F.sequence("a", "b")).alias("fecha")).select(
        day.cast("timestamp_ntz").alias("fecha"),
        F.year(day).alias("anio"),
        F.month(day).alias("mes"),
        F.date_format(day, "yyyy-MM").alias("anio_mes"),
        F.quarter(day).alias("trimestre"),
        F.weekday(day).alias("dia_semana"),
        F.date_format(day, "EEEE").alias("nombre_dia"),
    )


def payment_rollup(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        sum_or_zero("payment_value").alias("pago_total"),
        F.count_distinct("payment_type").alias("n_metodos_pago"),
        F.max("payment_installments").alias("cuotas_max"),
        at_largest(F.col("payment_type"), "payment_value", payment_ties(payments)).alias(
            "tipo_pago_principal"
        ),
    )


def review_rollup(reviews: DataFrame) -> DataFrame:
    """Per column the last known value by answer time; columns may come from different reviews."""

    def latest(column: str) -> F.Column:
        return last_known(column, "review_answer_timestamp", ["review_id"]).alias(column)

    return reviews.groupBy("order_id").agg(
        latest("review_score"),
        latest("review_comment_message"),
        latest("review_creation_date"),
        F.count(F.lit(1)).alias("n_reviews"),
    )


def item_rollup(items: DataFrame) -> DataFrame:
    """Totals per order. Items move once: those of an order lie together when its sellers are counted, so no second exchange does."""
    of_order = items.select("order_id", "seller_id", "price", "freight_value").repartition("order_id")
    by_seller = of_order.groupBy("order_id", "seller_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("price").alias("price"), F.sum("freight_value").alias("freight")
    )
    return by_seller.groupBy("order_id").agg(
        F.sum("n").alias("n_items"),
        F.count("seller_id").alias("n_vendedores"),
        sum_or_zero("price").alias("total_price"),
        sum_or_zero("freight").alias("total_freight"),
    )


def nullable_label(orders: DataFrame) -> F.Column:
    """1.0/0.0 where lateness is observable, null elsewhere: the population is kept whole."""
    late = late_flag(F.col(DELIVERED), F.col(ESTIMATED)).cast("double")
    return F.when(observable(orders), late)


def fact_orders(
    orders: DataFrame, customers: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    """All orders with customer, item, payment and review totals, durations and label."""
    joined = (
        orders.join(
            customers.select(
                "customer_id",
                "customer_unique_id",
                "customer_zip_code_prefix",
                "customer_city",
                "customer_state",
            ),
            "customer_id",
            "left",
        )
        .join(item_rollup(items), "order_id", "left")
        .join(payment_rollup(payments), "order_id", "left")
        .join(review_rollup(reviews), "order_id", "left")
    )
    return joined.withColumns(
        {
            "dias_aprobacion": days_between(PURCHASE, APPROVED),
            "dias_a_transportista": days_between(PURCHASE, CARRIER),
            "dias_entrega_total": days_between(PURCHASE, DELIVERED),
            "dias_entrega_estimada": days_between(PURCHASE, ESTIMATED),
            "dias_retraso": days_between(ESTIMATED, DELIVERED),
            "entrega_tardia": nullable_label(orders),
            "fecha_compra": purchase_day(),
            "tiene_items": F.col("n_items").isNotNull(),
            "tiene_review": F.col("review_score").isNotNull(),
        }
    )


def item_measures() -> dict[str, F.Column]:
    """What an item and the dates of its order give."""
    return {"monto_item": F.col("price") + F.col("freight_value"), "fecha_compra": purchase_day()}


def fact_items(items: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Item grain with order dates, customer and amount. Customers meet the orders, so items move once, by order."""
    dated = orders.select("order_id", "customer_id", "order_status", PURCHASE, DELIVERED, ESTIMATED)
    named = dated.join(customers.select("customer_id", "customer_unique_id"), "customer_id", "left")
    shown = ["customer_id", "order_id", *[c for c in items.columns if c != "order_id"], *dated.columns[2:], "customer_unique_id"]
    return items.join(named, "order_id", "left").select(*shown).withColumns(item_measures())


FLAT_OF_ORDER = [
    "customer_zip_code_prefix",
    "customer_city",
    "customer_state",
    "review_score",
    "tiene_review",
    "dias_entrega_total",
    "dias_retraso",
    "entrega_tardia",
    "n_items",
    "n_vendedores",
]


def items_flat(
    items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    products_dim: DataFrame,
    sellers_dim: DataFrame,
    orders_fact: DataFrame,
    few_sellers: bool = False,
) -> DataFrame:
    """Item grain with everything for exploration; payment totals would repeat per item, so none.

    Products and sellers come first, while items are narrow; all that is known of the order then meets them in one exchange.
    With `few_sellers`, which are sent to every task, their names do not travel in that exchange and come last.
    """
    homes = sellers_dim.withColumnRenamed("zip_prefix", "seller_zip_prefix")
    described = items.join(products_dim, "product_id", "left")
    if not few_sellers:
        described = described.join(homes, "seller_id", "left")
    flat = fact_items(described, orders, customers).join(orders_fact.select("order_id", *FLAT_OF_ORDER), "order_id", "left")
    if few_sellers:
        flat = flat.join(homes, "seller_id", "left")
    known = [*fact_items(items, orders, customers).columns, *products_dim.columns, *homes.columns, *FLAT_OF_ORDER]
    return flat.select(*dict.fromkeys(["order_id", "seller_id", "product_id", *known]))


def flat_in_shares(
    tables: Mapping[str, DataFrame], extra_translations: Sequence[tuple[str, str]] = EXTRA_TRANSLATIONS, share_rows: int = SHARE_ROWS
) -> DataFrame:
    """The flat items of all orders; where there are many, those of a share of the orders at a time.

    All that meets an item by its order is in the share of that order, so the rows are those of the whole at once. Each share is
    written and its shuffle files are deleted before the next begins: disk holds the rows found so far and the shuffles of one
    share, of at most about `share_rows` items.
    """
    t = tables
    shares = math.ceil(t["items"].count() / share_rows)
    products_dim, sellers_dim = dim_products(t["products"], t["translation"], extra_translations), dim_sellers(t["sellers"])
    if shares < 2:
        facts = fact_orders(t["orders"], t["customers"], t["items"], t["payments"], t["reviews"])
        return items_flat(t["items"], t["orders"], t["customers"], products_dim, sellers_dim, facts)
    # read in every share; of written tables the planner knows whether they are small enough for every task
    orders = materialize(t["orders"], "orders")
    products_dim, sellers_dim = materialize(products_dim, "products"), materialize(sellers_dim, "sellers")
    few_sellers, key = fits_every_task(sellers_dim), t["items"].schema["order_id"].dataType
    written = []
    for number in range(shares):
        # not the hash that exchanges use, which would leave most of their parts empty
        mine = F.pmod(F.xxhash64(F.col("order_id").cast(key)), F.lit(shares)) == number
        own = {name: (orders if name == "orders" else t[name]).where(mine) for name in ("orders", "items", "payments", "reviews")}
        facts = fact_orders(own["orders"], t["customers"], own["items"], own["payments"], own["reviews"])
        flat = items_flat(own["items"], own["orders"], t["customers"], products_dim, sellers_dim, facts, few_sellers)
        written.append(materialize(flat.drop(*item_measures()), f"flat-{number}", codec="zstd"))
    discard(orders, products_dim, sellers_dim)
    return reduce(DataFrame.unionByName, written).withColumns(item_measures()).select(*flat.columns)


def build_star(
    tables: Mapping[str, DataFrame],
    extra_translations: Sequence[tuple[str, str]] = EXTRA_TRANSLATIONS,
    box: tuple = STAR_BOX,
) -> dict[str, DataFrame]:
    """The nine output tables, by name."""
    t = tables
    orders_fact = fact_orders(t["orders"], t["customers"], t["items"], t["payments"], t["reviews"])
    items_fact = fact_items(t["items"], t["orders"], t["customers"])
    products_dim = dim_products(t["products"], t["translation"], extra_translations)
    sellers_dim = dim_sellers(t["sellers"])
    return {
        "fact_orders": orders_fact,
        "fact_order_items": items_fact,
        "dim_customers": dim_customers(t["customers"]),
        "dim_sellers": sellers_dim,
        "dim_products": products_dim,
        "dim_geolocation": dim_geolocation(t["geolocation"], box),
        "dim_calendario": dim_calendar(t["orders"]),
        "fact_order_payments": t["payments"],
        "items_flat": items_flat(t["items"], t["orders"], t["customers"], products_dim, sellers_dim, orders_fact),
    }


def check_star(star: Mapping[str, DataFrame], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Fan-out, uniqueness and sum checks over the star, as one (prueba, ok) table."""
    parts = [
        check_fan_out(star["items_flat"], tables["items"], "items_flat filas"),
        check_unique(star["fact_orders"], ["order_id"], "fact_orders clave"),
        check_unique(star["dim_products"], ["product_id"], "dim_products clave"),
        check_unique(star["dim_customers"], ["customer_id"], "dim_customers clave"),
        check_unique(star["dim_sellers"], ["seller_id"], "dim_sellers clave"),
        check_sums(star_sums(star, tables)),
    ]
    return stack([p.select("prueba", "ok") for p in parts])


def star_sums(star: Mapping[str, DataFrame], tables: Mapping[str, DataFrame]) -> dict:
    return {
        "precio por item": (star["fact_order_items"], "price", tables["items"], "price"),
        "pagos por orden": (star["fact_orders"], "pago_total", tables["payments"], "payment_value"),
        "precio por orden": (star["fact_orders"], "total_price", tables["items"], "price"),
    }


def export_star(
    star: Mapping[str, DataFrame], tables: Mapping[str, DataFrame], folder: str, fmt: str = "csv", as_release: bool = False
) -> DataFrame:
    """Check first, then write all tables; nothing is written when a check fails.

    The star is computed once, into written tables that both the checks and the export read. As a release its readers see
    all nine tables or those of the release before; else each table is replaced in its own folder.
    """
    from arrivo.sources.releases import publish
    from arrivo.sources.sinks import write_tables

    computed = {name: materialize(df, name) for name, df in star.items()}
    require_ok(check_star(computed, tables))
    return (publish if as_release else write_tables)(computed, folder, fmt)
