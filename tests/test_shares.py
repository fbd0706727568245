"""Flat items made a share of the orders at a time against those of all orders at once."""

import os

import pytest
from pyspark.sql import functions as F
from test_tables import full_market

from arrivo import session
from arrivo.plans import star
from arrivo.queries.star import EXTRA_TRANSLATIONS


def odd_rows():
    """Repeated orders, customers, products and sellers; items without an order, a key or a seller; orders without items."""
    days = ("2017-01-02 10:00:00", "2017-01-02 11:00:00", "2017-01-03 09:00:00")
    late, soon = "2017-01-20 08:00:00", "2017-01-08 08:00:00"
    orders = [(f"o{i}", f"c{i % 4}", "delivered" if i % 3 else "shipped", *days, late if i % 2 else soon, "2017-01-15 00:00:00") for i in range(12)]
    orders += [("o3", "c9", "delivered", *days, soon, "2017-01-15 00:00:00"), (None, "c1", "delivered", *days, late, "2017-01-15 00:00:00")]
    items = [(f"o{i % 11 if i % 7 else 99}", i, f"p{i % 4}", f"s{i % 3}" if i % 5 else None, days[0], 10.0 + i, 1.5) for i in range(40)]
    items += [(None, 1, "p1", "s1", days[0], 5.0, 0.5), ("o3", 1, None, "s1", days[0], 6.0, None)]
    payments = [(f"o{i % 9}", "credit_card", 2, 11.0 + i) for i in range(20)]
    customers = [("c0", "01000", "SP"), ("c1", "20000", "RJ"), ("c1", "20000", "SP"), ("c2", "01000", None)]
    sellers = [("s0", "01000", "SP"), ("s1", "20000", "RJ"), ("s1", "01000", "SP")]
    return {"orders": orders, "items": items, "payments": payments, "customers": customers, "sellers": sellers}


@pytest.fixture(scope="module")
def tables(spark):
    return full_market(spark, **odd_rows())


def as_text(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("few", [True, False])
def test_shares_make_the_rows_of_the_whole(spark, tables, monkeypatch, few):
    monkeypatch.setattr(star, "fits_every_task", lambda df: few)
    sizes, written = [], star.materialize

    def noted(df, name, **kind):
        out = written(df, name, **kind)
        sizes.append((name, out.count()))
        return out

    monkeypatch.setattr(star, "materialize", noted)
    whole = star.build_star(tables, EXTRA_TRANSLATIONS)["items_flat"]
    got = star.flat_in_shares(tables, EXTRA_TRANSLATIONS, share_rows=9)
    assert got.dtypes == whole.dtypes
    assert as_text(got) == as_text(whole)
    shares = [n for name, n in sizes if name.startswith("flat-")]
    assert len(shares) == 5 and sum(n > 0 for n in shares) > 2 and sum(shares) == whole.count()


def test_few_items_are_not_written(spark, tables, monkeypatch):
    monkeypatch.setattr(star, "materialize", lambda *_, **__: pytest.fail("written"))
    whole = star.build_star(tables, EXTRA_TRANSLATIONS)["items_flat"]
    assert as_text(star.flat_in_shares(tables, EXTRA_TRANSLATIONS)) == as_text(whole)


def test_items_meet_their_totals_in_one_exchange(spark, tables):
    rolled = star.item_rollup(tables["items"])
    old = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        assert rolled.select("*")._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    want = tables["items"].groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_items"), F.count_distinct("seller_id").alias("n_vendedores"),
        F.coalesce(F.sum("price"), F.lit(0.0)).alias("total_price"), F.coalesce(F.sum("freight_value"), F.lit(0.0)).alias("total_freight"),
    )
    assert rolled.dtypes == want.dtypes and as_text(rolled) == as_text(want)


def test_tables_that_fit_every_task(spark, tmp_path):
    small = session.materialize(spark.range(10).toDF("seller_id"), "small", codec="zstd")
    assert session.fits_every_task(small) and small.count() == 10
    assert any(f.endswith(".zstd.parquet") for f in os.listdir(small.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
        assert not session.fits_every_task(small)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
