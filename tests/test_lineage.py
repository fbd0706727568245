"""Where columns come from, and leaks that hide behind another name."""

import pytest
from pyspark.sql import Window, functions as F

from arrivo.plans import builders
from arrivo.plans.lineage import Lineage, refuse_leaks


def test_sources_are_followed(tables):
    orders = tables["orders"]
    renamed = orders.withColumnRenamed("order_status", "a").withColumn("b", F.length("a") + 1)
    grouped = renamed.groupBy("customer_id").agg(F.max("b").alias("m")).withColumn("w", F.row_number().over(Window.orderBy("m")))
    stacked = orders.select(F.col("customer_id").alias("z")).unionByName(orders.select(F.col("order_status").alias("z")))
    cases = [
        (renamed, "b", {"order_status"}),
        (renamed, "order_id", {"order_id"}),
        (grouped, "w", {"order_status"}),
        (grouped, "customer_id", {"customer_id"}),
        (stacked, "z", {"customer_id", "order_status"}),
        (orders.select(F.explode(F.array("order_status")).alias("g")), "g", {"order_status"}),
        (orders.select(grouped.agg(F.max("m").alias("q")).scalar().alias("s")), "s", {"order_status"}),
        (orders.join(renamed.select("order_id", "b"), "order_id"), "b", {"order_status"}),
        (orders.select(F.lit(1).alias("one")), "one", set()),
        # rows chosen by a filter are not followed
        (orders.filter("order_status = 'x'").select("order_id"), "order_id", {"order_id"}),
    ]
    for df, column, sources in cases:
        assert Lineage(df).sources(column) == sources, column


def test_renamed_and_derived_leaks_are_refused(tables):
    def extra(rows, **options):
        return builders.Extra("x", builders.schema_of(x=builders.NUMBER), rows, **options)

    def build(one):
        return builders.build_model_dataset(tables, extras=[one])

    status = extra(lambda i: i.tables["orders"].select("order_id", F.length("order_status").cast("double").alias("x")))
    day = extra(lambda i: i.tables["orders"].withColumnRenamed("order_delivered_customer_date", "d").groupBy("order_id").agg(F.max(F.day("d")).cast("double").alias("x")))
    for leak, name in ((status, "order_status"), (day, "order_delivered_customer_date")):
        with pytest.raises(ValueError, match=name):
            build(leak)
    assert "x" in build(extra(status.rows, cut_at_prediction=True)).columns
    assert "x" in build(extra(lambda i: i.tables["items"].groupBy("order_id").agg(F.max("price").alias("x")))).columns


def test_what_is_known_depends_on_the_anchor(tables):
    hours = tables["orders"].select(F.hour("order_approved_at").alias("x"))
    refuse_leaks(hours, ["x"], "aprobacion")
    with pytest.raises(ValueError, match="order_approved_at"):
        refuse_leaks(hours, ["x"], "compra")
