"""Skewed keys, equal instants and missing keys against brute force."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from arrivo.operators.running import asof_history, running_totals


def moments(rng, n, spread):
    start = datetime(2024, 1, 1)
    return [start + timedelta(seconds=rng.randrange(spread)) for _ in range(n)]


@pytest.mark.parametrize("spread", [40, 5_000, 3_000_000])
def test_asof_history_matches_brute_force(spark, spread):
    rng = random.Random(spread)
    # one key holds more than a third of all rows
    key = lambda: rng.choice(["hot", "hot", "hot", "a", "b", "c", None])
    events = [(key(), t, rng.randint(0, 1)) for t in moments(rng, 400, spread)]
    asked = [(i, key(), t) for i, t in enumerate(moments(rng, 300, spread))]
    ev = spark.createDataFrame(events, "k string, t timestamp_ntz, late int").withColumn("one", F.lit(1))
    qs = spark.createDataFrame(asked, "id int, k string, q timestamp_ntz")
    got = {r.id: (r.n, r.late) for r in asof_history(qs, ev, "k", "q", "t", {"n": "one", "late": "late"}).collect()}
    want = {}
    for i, k, q in asked:
        before = [late for ek, t, late in events if k is not None and ek == k and t < q]
        want[i] = (len(before), sum(before))
    assert got == want


def test_missing_query_time_gets_zero(spark):
    ev = spark.createDataFrame([("a", datetime(2024, 1, 1), 1)], "k string, t timestamp_ntz, one int")
    qs = spark.createDataFrame([(1, "a", None), (2, "a", datetime(2024, 1, 2))], "id int, k string, q timestamp_ntz")
    rows = asof_history(qs, ev, "k", "q", "t", {"n": "one"}).collect()
    assert {r.id: r.n for r in rows} == {1: 0, 2: 1}


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_running_totals_do_not_depend_on_the_bucket(spark, width):
    rng = random.Random(3)
    points = sorted({(rng.choice("xy"), rng.randrange(500)) for _ in range(200)})
    rows = [(k, p, rng.randint(1, 5)) for k, p in points]
    df = spark.createDataFrame(rows, "k string, p long, v int")
    got = running_totals(df, ["k"], "p", F.floor(F.col("p") / width), ["v"], totals=True).collect()
    for r in got:
        assert r.before_v == sum(v for k, p, v in rows if k == r.k and p < r.p)
        assert r.total_v == sum(v for k, _, v in rows if k == r.k)
    assert len(got) == len(rows)


def test_hot_key_is_spread_over_tasks(spark):
    """A single key must not end up in a single partition of the ordered step."""
    df = spark.range(20_000).select(F.lit("hot").alias("k"), F.col("id").alias("p"), F.lit(1).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = running_totals(df, ["k"], "p", F.floor(F.col("p") / 100), ["v"])
        rows = out.groupBy(F.spark_partition_id().alias("part")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(rows) > 1 and max(r["count"] for r in rows) < 0.7 * 20_000
