"""What the fits know of overlapping parts, measured together, against each part alone."""

import pytest
from pyspark.sql import functions as F

from arrivo.learning.preprocess import Statistics, counts_by_part


@pytest.fixture(scope="module")
def rows(spark):
    made = [
        (i, None if i % 7 == 0 else float(i % 11), float("nan") if i % 5 == 0 else -0.0 if i % 3 else i / 3, None if i % 4 == 0 else f"c{i % 6}", i % 2)
        for i in range(300)
    ]
    made += [(400 + i, float("inf"), None, "only here", 1) for i in range(3)]
    return spark.createDataFrame(made, "t int, a double, b double, c string, y int").repartition(3).persist()


@pytest.fixture(scope="module")
def parts(spark):
    return {"early": F.col("t") < 100, "most": F.col("t") < 350, "some": F.col("t") % 9 == 1, "end": F.col("t") >= 390}


def test_parts_together_are_as_alone(rows, parts):
    together = Statistics.of_parts(rows, parts, ["a", "b"], ["c"], "y")
    for part, where in parts.items():
        alone = Statistics.of(rows.where(where), ["a", "b"], ["c"], "y")
        got = together[part]
        assert (got.medians, got.counts, got.classes) == (alone.medians, alone.counts, alone.classes), part
        assert list(got.counts["c"]) == sorted(got.counts["c"])
        for c in ("a", "b"):
            assert got.moments[c] == pytest.approx(alone.moments[c], nan_ok=True)
    assert together["end"].medians == {"a": float("inf"), "b": 0.0} and together["end"].counts["c"] == {"only here": 3}


def test_rows_of_many_parts_are_handed_over_once(rows, parts):
    found = counts_by_part(rows, {"a": F.coalesce("a", F.lit(float("nan")))}, "double", parts)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Generate" not in plan and "Union" not in plan
    n = {r["part"]: r["n"] for r in found.groupBy("part").agg(F.sum("_n").alias("n")).collect()}
    assert n == {p: rows.where(w).where("a IS NOT NULL").count() for p, w in parts.items()}


def test_only_categories(rows):
    got = Statistics.of_parts(rows, {"all": F.lit(True)}, [], ["c"], "y")["all"]
    assert got.medians == {} and got.moments == {} and sum(got.counts["c"].values()) == sum(got.classes.values()) == 303
