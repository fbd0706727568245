"""As-of joins with payload against a plain search, hot keys, ties and gaps included."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from arrivo.operators.asof import asof_join

START = datetime(2024, 1, 1)


def made(seed, spread):
    rng = random.Random(seed)
    key = lambda: rng.choice(["hot", "hot", "hot", "a", "b", "c", None])
    time = lambda: None if rng.random() < 0.03 else rng.randrange(spread)
    left = [(i, key(), time()) for i in range(250)]
    right = [(key(), time(), rng.choice([None, 1, 2, 3]), f"p{i}") for i in range(200)]
    return left, right


def plain(left, right, backward, exact, tolerance):
    out = {}
    for i, k, t in left:
        sign = 1 if backward else -1
        fits = [
            r for r in right
            if k is not None and r[0] == k and None not in (t, r[1])
            and (sign * (t - r[1]) > 0 or exact and t == r[1]) and (tolerance is None or abs(t - r[1]) <= tolerance)
        ]
        # nearest; of equals the largest payload, null before others
        best = max(fits, key=lambda r: (sign * r[1], r[2] is not None, r[2] or 0, r[3]), default=None)
        out[i] = None if best is None else (best[2], best[3], best[1])
    return out


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("tolerance", [None, 7])
def test_all_modes(spark, direction, exact, tolerance):
    left, right = made(len(direction) + exact, 120)
    ls = spark.createDataFrame(left, "id int, k string, t long")
    rs = spark.createDataFrame(right, "k string, u long, x int, name string")
    got = asof_join(ls, rs, ["k"], "t", "u", ["x", "name"], direction, exact, tolerance, bucket=10, matched="at")
    assert got.columns == ["id", "k", "t", "x", "name", "at"]
    rows = {r.id: (r.x, r.name, r["at"]) if r.name is not None else None for r in got.collect()}
    assert rows == plain(left, right, direction == "backward", exact, tolerance)


@pytest.mark.parametrize("spread", [50, 100_000])
def test_timestamps(spark, spread):
    left, right = made(spread, spread)
    moment = lambda s: None if s is None else START + timedelta(seconds=s)
    ls = spark.createDataFrame([(i, k, moment(t)) for i, k, t in left], "id int, k string, t timestamp_ntz")
    rs = spark.createDataFrame([(k, moment(t), x, n) for k, t, x, n in right], "k string, t timestamp_ntz, x int, name string")
    got = asof_join(ls, rs, ["k"], "t", "t", ["x", "name"], tolerance=30_000_000)
    want = plain(left, right, True, True, 30)
    assert {r.id: (r.x, r.name) if r.name else None for r in got.collect()} == {i: w and w[:2] for i, w in want.items()}


def test_several_keys_and_repeated_left_rows(spark):
    ls = spark.createDataFrame([(1, 1, 5), (1, 1, 5), (1, 2, 5), (2, None, 5)], "a int, b int, t int")
    rs = spark.createDataFrame([(1, 1, 4, "x"), (1, 2, 6, "y"), (2, None, 1, "z")], "a int, b int, u int, v string")
    got = sorted((r.a, r.b or 0, r.v or "") for r in asof_join(ls, rs, ["a", "b"], "t", "u", ["v"]).collect())
    assert got == [(1, 1, "x"), (1, 1, "x"), (1, 2, ""), (2, 0, "")]


def test_empty_sides_and_wrong_calls(spark):
    ls = spark.createDataFrame([(1, 1)], "k int, t int")
    rs = spark.createDataFrame([], "k int, u int, v string")
    assert [r.v for r in asof_join(ls, rs, ["k"], "t", "u", ["v"]).collect()] == [None]
    assert asof_join(ls.limit(0), rs, ["k"], "t", "u", ["v"]).count() == 0
    with pytest.raises(ValueError):
        asof_join(ls, rs, ["k"], "t", "u", ["v"], "sideways")
    with pytest.raises(ValueError):
        asof_join(ls, rs.withColumn("t", F.lit(1)), ["k"], "t", "u", ["t"])


def test_no_window_over_a_whole_hot_key(spark):
    """Rows enter windows by key and bucket; the only window by key sees one row per bucket."""
    ls = spark.range(2000).select(F.lit(1).alias("k"), F.col("id").alias("t"))
    rs = spark.range(2000).select(F.lit(1).alias("k"), F.col("id").alias("u"), F.col("id").alias("v"))
    joined = asof_join(ls, rs, ["k"], "t", "u", ["v"], allow_exact=False, bucket=100)
    assert joined.where("v <=> t - 1").count() == 1999
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window " in line]
    assert len(windows) == 2 and sum("_bucket" in line.split("], [")[1] for line in windows) >= 1
