"""Session and small marketplace tables shared by the tests."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Row  # noqa: E402

from arrivo.schemas import TABLES  # noqa: E402
from arrivo.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.log.level": "ERROR",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    yield session
    session.stop()


def values(df, *columns) -> list[tuple]:
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)


def by_key(df, key: str = "order_id") -> dict[str, Row]:
    rows = df.collect()
    assert len({r[key] for r in rows}) == len(rows), "more than one row per key"
    return {r[key]: r for r in rows}


def table(spark, rows, columns: str, spec: str | None = None):
    """Text rows to a typed table: names in `columns`, types from the schema of table `spec`."""
    names = columns.split()
    df = spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows], ", ".join(f"{n} string" for n in names))
    if spec is None:
        return df
    kinds = dict(TABLES[spec].columns)
    return df.select(*[df[n].cast(kinds[n]) for n in names])


ORDER_COLUMNS = (
    "order_id customer_id order_status order_purchase_timestamp order_approved_at"
    " order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date"
)


def order_rows():
    return [
        ("o1", "c1", "delivered", "2017-01-05 10:30:00", "2017-01-05 11:00:00", "2017-01-07 00:00:00", "2017-01-20 14:00:00", "2017-01-25 00:00:00"),
        ("o2", "c2", "delivered", "2017-06-10 22:00:00", "2017-06-11 01:00:00", "2017-06-13 00:00:00", "2017-07-15 10:00:00", "2017-07-01 00:00:00"),
        ("o3", "c3", "delivered", "2018-02-01 08:00:00", "2018-02-01 09:00:00", "2018-02-03 00:00:00", "2018-02-10 12:00:00", "2018-02-10 00:00:00"),
    ]


def market(spark, **changes):
    """Three orders, two sellers, two products; keyword arguments replace the rows of a table."""
    rows = {
        "orders": order_rows(),
        "items": [
            ("o1", 1, "p1", "s1", "2017-01-08 00:00:00", 100, 10),
            ("o1", 2, "p2", "s2", "2017-01-08 00:00:00", 50, 5),
            ("o2", 1, "p1", "s1", "2017-06-14 00:00:00", 100, 20),
            ("o3", 1, "p2", "s2", "2018-02-04 00:00:00", 50, 8),
        ],
        "products": [("p1", "moveis", 500, 10, 10, 10), ("p2", None, 1000, 20, 10, 10)],
        "sellers": [("s1", "01000", "SP"), ("s2", "20000", "RJ")],
        "customers": [("c1", "01000", "SP"), ("c2", "01000", "SP"), ("c3", "20000", "RJ")],
        "payments": [
            ("o1", "voucher", 1, 20),
            ("o1", "credit_card", 3, 145),
            ("o2", "boleto", 1, 120),
            ("o3", "credit_card", 6, 58),
        ],
        "geolocation": [("01000", -23.5, -46.6), ("01000", -23.7, -46.6), ("20000", -22.9, -43.2)],
    } | changes
    columns = {
        "orders": ORDER_COLUMNS,
        "items": "order_id order_item_id product_id seller_id shipping_limit_date price freight_value",
        "products": "product_id product_category_name product_weight_g product_length_cm product_height_cm product_width_cm",
        "sellers": "seller_id seller_zip_code_prefix seller_state",
        "customers": "customer_id customer_zip_code_prefix customer_state",
        "payments": "order_id payment_type payment_installments payment_value",
        "geolocation": "geolocation_zip_code_prefix geolocation_lat geolocation_lng",
    }
    return {name: table(spark, rows[name], columns[name], name) for name in columns}


@pytest.fixture
def tables(spark):
    return market(spark)
