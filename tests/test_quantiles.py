import math
import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from arrivo.functions.scalars import value_bucket
from arrivo.operators.quantiles import (
    column_quantiles,
    equal_frequency_bins,
    quantiles,
    time_quantiles,
)

PROBS = [0.0, 0.05, 0.25, 0.5, 0.8, 0.95, 0.999, 1.0]
SHAPES = {
    "even": [float(i) for i in range(101)],
    "ties": [1.0] * 50 + [2.0] * 3 + [3.0],
    "single": [4.2],
    "constant": [7.0] * 9,
    "signs": [-5.0, -1e-9, 0.0, -0.0, 1e-9, 5.0, 123.0],
    "heavy tail": [10.0 ** (i / 4) for i in range(60)] + [1e18],
    "close together": [1 + i * 1e-12 for i in range(50)],
    "powers of two": [2.0**i for i in range(-20, 20)],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_same_as_numpy(spark, shape):
    data = SHAPES[shape]
    df = spark.createDataFrame([(v,) for v in data] + [(None,), (float("nan"),)], "v double")
    got = list(quantiles(df, "v", PROBS).first())
    assert got == pytest.approx(list(np.quantile(data, PROBS)), rel=1e-12, abs=1e-15)


def test_groups_with_one_hot_group(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot", "hot", "a", "b"]), rng.gauss(-23, 1)) for _ in range(800)] + [(None, 5.0)]
    got = {r.k: r.m for r in quantiles(spark.createDataFrame(rows, "k string, v double"), "v", [0.5], ["k"], ["m"]).collect()}
    want = pd.DataFrame(rows, columns=["k", "v"]).groupby("k").v.median().to_dict()
    assert got == pytest.approx(want)


def test_empty_input_gives_no_row(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert quantiles(df, "v", [0.5]).collect() == []


def test_many_columns_at_once(spark):
    df = spark.createDataFrame([(1, 10.0), (2, None), (3, 30.0), (4, 40.0)], "a int, b double")
    got = {r.columna: r.m for r in column_quantiles(df, ["a", "b"], [0.5], ["m"]).collect()}
    assert got == {"a": 2.5, "b": 30.0}


def test_timestamps(spark):
    rng = random.Random(2)
    start = datetime(2017, 1, 1)
    stamps = [start + timedelta(microseconds=rng.randrange(10**13)) for _ in range(301)]
    df = spark.createDataFrame([(s,) for s in stamps], "t timestamp_ntz")
    got = time_quantiles(df, "t", [0.5, 0.8], ["a", "b"]).first()
    want = pd.Series(stamps).quantile([0.5, 0.8]).tolist()
    assert all(abs(g - w.to_pydatetime()) <= timedelta(microseconds=1) for g, w in zip(got, want))


@pytest.mark.parametrize("data", [list(range(100)), [1] * 30 + list(range(10)), [5] * 10, [0.5, 0.1, 0.9]])
def test_bins_same_as_pandas(spark, data):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(data)], "i int, v double")
    got = [r.bin for r in equal_frequency_bins(df, "v", 5, "bin").orderBy("i").collect()]
    edges = np.unique(np.quantile(data, np.linspace(0, 1, 6)))
    if len(edges) == 1:
        assert got == [0] * len(data)
    else:
        want = pd.qcut(pd.Series(data, dtype=float), 5, labels=False, duplicates="drop")
        assert got == want.astype(int).tolist()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=2, max_size=60))
def test_buckets_keep_the_order(spark, data):
    df = spark.createDataFrame([(float(v),) for v in data], "v double")
    rows = df.select("v", value_bucket("v").alias("b")).orderBy("v").collect()
    assert all(x.b <= y.b for x, y in zip(rows, rows[1:]))
    assert all(r.b is not None and math.copysign(1, r.b) == math.copysign(1, r.v) for r in rows if r.v != 0)


def test_bucket_is_null_for_null(spark):
    assert spark.range(1).select(F.lit(None).cast("double").alias("v")).select(value_bucket("v")).first()[0] is None
