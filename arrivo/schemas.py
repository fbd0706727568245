"""The nine marketplace tables: column types, required columns, keys and references."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TEXT, WHOLE, REAL, STAMP = T.StringType(), T.LongType(), T.DoubleType(), T.TimestampNTZType()


@dataclass(frozen=True)
class TableSpec:
    """One source table. `key` is empty where the source has no unique column set."""

    columns: tuple[tuple[str, T.DataType], ...]
    required: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    references: tuple[tuple[str, str], ...] = ()  # (column, parent table)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t, n not in self.required) for n, t in self.columns])


# Column names and types of the public marketplace dataset (source spelling kept).
TABLES: dict[str, TableSpec] = {
    "customers": TableSpec(
        (
            ("customer_id", TEXT),
            ("customer_unique_id", TEXT),
            ("customer_zip_code_prefix", TEXT),
            ("customer_city", TEXT),
            ("customer_state", TEXT),
        ),
        required=("customer_id", "customer_unique_id"),
        key=("customer_id",),
    ),
    "sellers": TableSpec(
        (
            ("seller_id", TEXT),
            ("seller_zip_code_prefix", TEXT),
            ("seller_city", TEXT),
            ("seller_state", TEXT),
        ),
        required=("seller_id",),
        key=("seller_id",),
    ),
    "products": TableSpec(
        (
            ("product_id", TEXT),
            ("product_category_name", TEXT),
            ("product_name_lenght", WHOLE),
            ("product_description_lenght", WHOLE),
            ("product_photos_qty", WHOLE),
            ("product_weight_g", REAL),
            ("product_length_cm", REAL),
            ("product_height_cm", REAL),
            ("product_width_cm", REAL),
        ),
        required=("product_id",),
        key=("product_id",),
    ),
    "translation": TableSpec(
        (("product_category_name", TEXT), ("product_category_name_english", TEXT)),
        required=("product_category_name",),
    ),
    "geolocation": TableSpec(
        (
            ("geolocation_zip_code_prefix", TEXT),
            ("geolocation_lat", REAL),
            ("geolocation_lng", REAL),
            ("geolocation_city", TEXT),
            ("geolocation_state", TEXT),
        ),
    ),
    "orders": TableSpec(
        (
            ("order_id", TEXT),
            ("customer_id", TEXT),
            ("order_status", TEXT),
            ("order_purchase_timestamp", STAMP),
            ("order_approved_at", STAMP),
            ("order_delivered_carrier_date", STAMP),
            ("order_delivered_customer_date", STAMP),
            ("order_estimated_delivery_date", STAMP),
        ),
        required=("order_id", "customer_id"),
        key=("order_id",),
        references=(("customer_id", "customers"),),
    ),
    "items": TableSpec(
        (
            ("order_id", TEXT),
            ("order_item_id", WHOLE),
            ("product_id", TEXT),
            ("seller_id", TEXT),
            ("shipping_limit_date", STAMP),
            ("price", REAL),
            ("freight_value", REAL),
        ),
        required=("order_id", "order_item_id", "product_id", "seller_id"),
        key=("order_id", "order_item_id"),
        references=(("order_id", "orders"), ("product_id", "products"), ("seller_id", "sellers")),
    ),
    "payments": TableSpec(
        (
            ("order_id", TEXT),
            ("payment_sequential", WHOLE),
            ("payment_type", TEXT),
            ("payment_installments", WHOLE),
            ("payment_value", REAL),
        ),
        required=("order_id", "payment_sequential"),
        references=(("order_id", "orders"),),
    ),
    "reviews": TableSpec(
        (
            ("review_id", TEXT),
            ("order_id", TEXT),
            ("review_score", WHOLE),
            ("review_comment_title", TEXT),
            ("review_comment_message", TEXT),
            ("review_creation_date", STAMP),
            ("review_answer_timestamp", STAMP),
        ),
        required=("review_id", "order_id"),
    ),
}

# Tables the feature engine needs; geolocation is asked for separately by the route features.
FEATURE_TABLES = ("orders", "items", "products", "sellers", "customers", "payments")

# Published row counts of version 2 of the dataset.
PUBLISHED_ROWS = {
    "orders": 99441,
    "items": 112650,
    "customers": 99441,
    "sellers": 3095,
    "products": 32951,
    "payments": 103886,
    "reviews": 99224,
    "geolocation": 1000163,
    "translation": 71,
}
PUBLISHED_LABELLED = 96470
PUBLISHED_MODEL_ROWS = 96189

# Label column, study period (half open), anchors.
TARGET = "pedido_retrasado"
PREDICTION_TIME = "prediction_time"
PURCHASE = "order_purchase_timestamp"
APPROVED = "order_approved_at"
CARRIER = "order_delivered_carrier_date"
DELIVERED = "order_delivered_customer_date"
ESTIMATED = "order_estimated_delivery_date"
STUDY_PERIOD = ("2017-01-01", "2018-09-01")
ANCHORS = {"aprobacion": APPROVED, "compra": PURCHASE}
DEFAULT_ANCHOR = "aprobacion"

# Bounding boxes (degrees) used by the model and by the star schema.
MODEL_BOX = ((-33.8, 5.3), (-74.0, -34.7))
STAR_BOX = ((-34.0, 6.0), (-74.0, -34.0))

# Macro-regions and their 27 states.
REGIONS = {
    "Norte": ("AC", "AM", "AP", "PA", "RO", "RR", "TO"),
    "Nordeste": ("AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"),
    "Centro-Oeste": ("DF", "GO", "MS", "MT"),
    "Sudeste": ("ES", "MG", "RJ", "SP"),
    "Sul": ("PR", "RS", "SC"),
}

# Categories missing from the published translation table.
EXTRA_TRANSLATIONS = (
    ("pc_gamer", "pc_gamer"),
    ("portateis_cozinha_e_preparadores_de_alimentos", "portable_kitchen_food_preparers"),
)
