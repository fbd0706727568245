"""The given tables in marketplace roles, once for Spark and once as SQL for the comparison.

All rows of the given tables take part; columns the marketplace has and the given tables lack are
computed from other columns of the same row, the same way on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from arrivo.session import configure

PERIOD = ("1996-01-01", "2001-01-01")
FOCUS = "NATION_3"
EXTRA_TRANSLATIONS = [("large", "large goods"), ("promo", "promotion")]
BOX = ((-33.8, 5.3), (-74.0, -34.7))
STAR_BOX = ((-34.0, 6.0), (-74.0, -34.0))


# Columns of the given tables; naming them spares a schema job per read.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
}


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def customers(spark, d) -> DataFrame:
    nation = read(spark, d, "nation").select("n_nationkey", "n_name")
    return (
        read(spark, d, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "c_custkey AS customer_id",
            "c_name AS customer_unique_id",
            "concat(lpad(cast(c_nationkey AS string), 2, '0'), '-', substr(c_mktsegment, 1, 3))"
            " AS customer_zip_code_prefix",
            "lower(c_mktsegment) AS customer_city",
            "CASE WHEN c_acctbal >= -900 THEN n_name END AS customer_state",
        )
    )


def sellers(spark, d) -> DataFrame:
    nation = read(spark, d, "nation").select("n_nationkey", "n_name")
    return (
        read(spark, d, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "s_suppkey AS seller_id",
            "concat(lpad(cast(s_nationkey AS string), 2, '0'), '-', CASE WHEN s_acctbal < 0 THEN 'NON'"
            " WHEN s_acctbal < 2500 THEN 'AUT' WHEN s_acctbal < 5000 THEN 'BUI'"
            " WHEN s_acctbal < 7500 THEN 'FUR' ELSE 'HOU' END) AS seller_zip_code_prefix",
            "lower(s_name) AS seller_city",
            "CASE WHEN s_acctbal >= -700 THEN n_name END AS seller_state",
        )
    )


def products(spark, d) -> DataFrame:
    return read(spark, d, "part").selectExpr(
        "p_partkey AS product_id",
        "CASE WHEN p_type <> 'PROMO' THEN lower(p_type) END AS product_category_name",
        "cast(length(p_name) AS bigint) AS product_name_lenght",
        "cast(length(p_brand) AS bigint) AS product_description_lenght",
        "cast(p_size % 5 AS bigint) AS product_photos_qty",
        "CASE WHEN p_size < 50 THEN (p_size - 2) * 50.0D END AS product_weight_g",
        "p_size + 5.0D AS product_length_cm",
        "p_size - 1.0D AS product_height_cm",
        "p_size / 2.0D + 1.0D AS product_width_cm",
    )


def translation(spark, d) -> DataFrame:
    return (
        read(spark, d, "part")
        .filter("p_type NOT IN ('LARGE', 'PROMO')")
        .select(F.lower("p_type").alias("product_category_name"), F.initcap("p_type").alias("e"))
        .distinct()
        .withColumnRenamed("e", "product_category_name_english")
    )


def geolocation(spark, d) -> DataFrame:
    nation = read(spark, d, "nation").select("n_nationkey", "n_name")
    return (
        read(spark, d, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "concat(lpad(cast(c_nationkey AS string), 2, '0'), '-', substr(c_mktsegment, 1, 3))"
            " AS geolocation_zip_code_prefix",
            "c_acctbal / 250.0D - 33.0D AS geolocation_lat",
            "-75.0D + (c_custkey % 4200) / 100.0D AS geolocation_lng",
            "concat('city ', right(c_name, 1)) AS geolocation_city",
            "n_name AS geolocation_state",
        )
    )


def placed(rows: DataFrame, *keep: str) -> DataFrame:
    """What an order row says by itself, before anything is shipped; also for a stream of such rows."""
    return rows.selectExpr(
        "*",
        "cast(round(o_totalprice * 100) AS bigint) AS cents",
        "8 * cast(substr(o_orderpriority, 1, 1) AS int) - 8 + cast(o_custkey % 13 AS int) AS promise",
    ).selectExpr(
        "*", "o_orderdate + make_dt_interval(0, 0, 0, cast(cents % 86400 AS decimal(18, 6))) AS bought"
    ).selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        "CASE WHEN o_orderstatus IN ('F', 'O') THEN 'delivered' ELSE 'shipped' END AS order_status",
        "bought AS order_purchase_timestamp",
        "CASE WHEN o_totalprice >= 5000 THEN bought + make_dt_interval(0, 0, 0,"
        " cast((cents * 1000 % 172800000) / 1000.0 AS decimal(18, 6))) END AS order_approved_at",
        "o_orderdate + make_dt_interval(promise) AS order_estimated_delivery_date",
        "cents",
        *keep,
    )


def orders(spark, d) -> DataFrame:
    shipped = (
        read(spark, d, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.max("l_shipdate").alias("shipped"))
    )
    dated = (
        placed(read(spark, d, "orders"), "o_orderdate")
        .join(shipped, F.col("order_id") == F.col("o_orderkey"), "left")
        .selectExpr("*", "pmod(datediff(shipped, o_orderdate), 45) AS m", "order_purchase_timestamp AS bought")
        .selectExpr("*", "2 + m * m div 60 AS trip")
    )
    return dated.selectExpr(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "bought + make_dt_interval(cast(1 + trip div 3 AS int)) AS order_delivered_carrier_date",
        "o_orderdate + make_dt_interval(cast(trip AS int), 0, 0, cast(cents * 7 % 86400 AS decimal(18, 6)))"
        " AS order_delivered_customer_date",
        "order_estimated_delivery_date",
    )


def items(spark, d) -> DataFrame:
    return read(spark, d, "lineitem").selectExpr(
        "l_orderkey AS order_id",
        "cast(l_linenumber AS bigint) AS order_item_id",
        "l_partkey AS product_id",
        "l_suppkey AS seller_id",
        "l_shipdate AS shipping_limit_date",
        "l_extendedprice AS price",
        "abs(l_extendedprice * l_tax) AS freight_value",
    )


def payments(spark, d) -> DataFrame:
    return read(spark, d, "lineitem").selectExpr(
        "l_orderkey AS order_id",
        "cast(l_linenumber AS bigint) AS payment_sequential",
        "CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto' ELSE 'voucher' END"
        " AS payment_type",
        "cast(l_quantity AS bigint) - 3 AS payment_installments",
        "l_extendedprice * (1 - l_discount) AS payment_value",
    )


def reviews(spark, d) -> DataFrame:
    return read(spark, d, "events").selectExpr(
        "event_id AS review_id",
        "event_id div 3 AS order_id",
        "cast(get_json_object(props, '$.k') AS bigint) % 5 + 1 AS review_score",
        "event_type AS review_comment_title",
        "CASE WHEN event_type <> 'view' THEN concat(event_type, '-', cast(user_id AS string)) END"
        " AS review_comment_message",
        "cast(to_date(ts) AS timestamp_ntz) AS review_creation_date",
        "CASE WHEN value >= 5 THEN ts END AS review_answer_timestamp",
    )


def state_regions(spark, d) -> DataFrame:
    """State → region; one region is left out so that unknown states occur."""
    region = read(spark, d, "region").filter("r_name <> 'MIDDLE EAST'")
    return (
        read(spark, d, "nation")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_name").alias("state"), F.col("r_name").alias("region"))
    )


BINDERS = {
    "customers": customers,
    "sellers": sellers,
    "products": products,
    "translation": translation,
    "geolocation": geolocation,
    "orders": orders,
    "items": items,
    "payments": payments,
    "reviews": reviews,
}


class Bound(dict):
    """Marketplace tables by name, made when first asked for; session settings applied."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__()
        self.spark, self.folder = configure(spark), folder

    def __missing__(self, name: str) -> DataFrame:
        self[name] = BINDERS[name](self.spark, self.folder)
        return self[name]

    def regions(self) -> DataFrame:
        return state_regions(self.spark, self.folder)

    def all(self) -> "Bound":
        for name in BINDERS:
            self[name]
        return self

    def raw(self, name: str) -> DataFrame:
        return read(self.spark, self.folder, name)


# The same tables as SQL common table expressions: name -> (needs, text).
SQL_TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "m_customers": (
        (),
        """SELECT c_custkey AS customer_id, c_name AS customer_unique_id,
  lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '-' || substr(c_mktsegment, 1, 3) AS customer_zip_code_prefix,
  lower(c_mktsegment) AS customer_city,
  CASE WHEN c_acctbal >= -900 THEN n_name END AS customer_state
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "m_sellers": (
        (),
        """SELECT s_suppkey AS seller_id,
  lpad(CAST(s_nationkey AS VARCHAR), 2, '0') || '-' || CASE WHEN s_acctbal < 0 THEN 'NON'
    WHEN s_acctbal < 2500 THEN 'AUT' WHEN s_acctbal < 5000 THEN 'BUI'
    WHEN s_acctbal < 7500 THEN 'FUR' ELSE 'HOU' END AS seller_zip_code_prefix,
  lower(s_name) AS seller_city,
  CASE WHEN s_acctbal >= -700 THEN n_name END AS seller_state
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    ),
    "m_products": (
        (),
        """SELECT p_partkey AS product_id,
  CASE WHEN p_type <> 'PROMO' THEN lower(p_type) END AS product_category_name,
  CAST(length(p_name) AS BIGINT) AS product_name_lenght,
  CAST(length(p_brand) AS BIGINT) AS product_description_lenght,
  CAST(p_size % 5 AS BIGINT) AS product_photos_qty,
  CASE WHEN p_size < 50 THEN (p_size - 2) * CAST(50 AS DOUBLE) END AS product_weight_g,
  p_size + CAST(5 AS DOUBLE) AS product_length_cm,
  p_size - CAST(1 AS DOUBLE) AS product_height_cm,
  p_size / CAST(2 AS DOUBLE) + 1 AS product_width_cm
FROM part""",
    ),
    "m_translation": (
        (),
        """SELECT DISTINCT lower(p_type) AS product_category_name,
  upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS product_category_name_english
FROM part WHERE p_type NOT IN ('LARGE', 'PROMO')""",
    ),
    "m_geolocation": (
        (),
        """SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '-' || substr(c_mktsegment, 1, 3)
    AS geolocation_zip_code_prefix,
  c_acctbal / CAST(250 AS DOUBLE) - 33 AS geolocation_lat,
  -75 + (c_custkey % 4200) / CAST(100 AS DOUBLE) AS geolocation_lng,
  'city ' || right(c_name, 1) AS geolocation_city, n_name AS geolocation_state
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "m_orders": (
        (),
        """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  CASE WHEN o_orderstatus IN ('F', 'O') THEN 'delivered' ELSE 'shipped' END AS order_status,
  bought AS order_purchase_timestamp,
  CASE WHEN o_totalprice >= 5000 THEN bought + to_milliseconds(cents * 1000 % 172800000) END
    AS order_approved_at,
  bought + to_days(CAST(1 + trip // 3 AS INTEGER)) AS order_delivered_carrier_date,
  o_orderdate + to_days(CAST(trip AS INTEGER)) + to_seconds(cents * 7 % 86400)
    AS order_delivered_customer_date,
  o_orderdate + to_days(CAST(promise AS INTEGER)) AS order_estimated_delivery_date
FROM (
  SELECT *, o_orderdate + to_seconds(cents % 86400) AS bought, 2 + m * m // 60 AS trip,
    8 * CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 8 + o_custkey % 13 AS promise
  FROM (
    SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
      ((date_diff('day', CAST(o_orderdate AS DATE), CAST(shipped AS DATE)) % 45) + 45) % 45 AS m
    FROM orders LEFT JOIN (
      SELECT l_orderkey, max(l_shipdate) AS shipped FROM lineitem GROUP BY l_orderkey
    ) s ON l_orderkey = o_orderkey
  )
)""",
    ),
    "m_items": (
        (),
        """SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id,
  l_partkey AS product_id, l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
  l_extendedprice AS price, abs(l_extendedprice * l_tax) AS freight_value
FROM lineitem""",
    ),
    "m_payments": (
        (),
        """SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS payment_sequential,
  CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto' ELSE 'voucher' END AS payment_type,
  CAST(l_quantity AS BIGINT) - 3 AS payment_installments,
  l_extendedprice * (1 - l_discount) AS payment_value
FROM lineitem""",
    ),
    "m_reviews": (
        (),
        """SELECT event_id AS review_id, event_id // 3 AS order_id,
  CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 + 1 AS review_score,
  event_type AS review_comment_title,
  CASE WHEN event_type <> 'view' THEN event_type || '-' || CAST(user_id AS VARCHAR) END
    AS review_comment_message,
  CAST(CAST(ts AS DATE) AS TIMESTAMP) AS review_creation_date,
  CASE WHEN value >= 5 THEN ts END AS review_answer_timestamp
FROM events""",
    ),
    "m_regions": (
        (),
        """SELECT n_name AS state, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey
WHERE r_name <> 'MIDDLE EAST'""",
    ),
}
