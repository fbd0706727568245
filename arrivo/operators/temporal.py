"""Cohorts by time: train on the past, evaluate on the future."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from arrivo.functions.aggregates import rate
from arrivo.operators.quantiles import time_quantiles
from arrivo.schemas import PREDICTION_TIME, TARGET

TEST_FRACTION = 0.2
VALIDATION_FRACTION = 0.2
FOLDS = 4
COHORTS = ("train", "validation", "test")


def start_of_day(time: Column) -> Column:
    return F.to_date(time).cast("timestamp_ntz")


def cutoff_table(
    table: DataFrame, fraction: float = TEST_FRACTION, time: str = PREDICTION_TIME
) -> DataFrame:
    """One row: the day from which about the last `fraction` of the rows lie."""
    edge = time_quantiles(table, time, [1 - fraction], ["cutoff"])
    return edge.select(start_of_day(F.col("cutoff")).alias("cutoff"))


def temporal_cutoff(
    table: DataFrame, fraction: float = TEST_FRACTION, time: str = PREDICTION_TIME
) -> datetime:
    """The cutoff as a value: later plans then hold a literal, which reaches the scans."""
    return cutoff_table(table, fraction, time).first()["cutoff"]


def moment(value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def temporal_split(table: DataFrame, cutoff: datetime, time: str = PREDICTION_TIME) -> DataFrame:
    """Add `cohort`: test from the cutoff on, train before it (and where the time is missing)."""
    return table.withColumn("cohort", F.when(F.col(time) >= moment(cutoff), "test").otherwise("train"))


def two_way_split(
    table: DataFrame, fraction: float = TEST_FRACTION, time: str = PREDICTION_TIME
) -> DataFrame:
    return temporal_split(table, temporal_cutoff(table, fraction, time), time)


def three_way_cutoffs(
    table: DataFrame,
    test_fraction: float = TEST_FRACTION,
    validation_fraction: float = VALIDATION_FRACTION,
    time: str = PREDICTION_TIME,
) -> tuple[datetime, datetime]:
    """Starts of validation and test; the first is computed on what lies before the second."""
    test_start = temporal_cutoff(table, test_fraction, time)
    earlier = table.filter(F.col(time) < moment(test_start))
    return temporal_cutoff(earlier, validation_fraction, time), test_start


def three_way_table(
    table: DataFrame,
    test_fraction: float = TEST_FRACTION,
    validation_fraction: float = VALIDATION_FRACTION,
    time: str = PREDICTION_TIME,
) -> DataFrame:
    """The same cutoffs as one row; empty where there is nothing to cut."""
    last = cutoff_table(table, test_fraction, time)
    earlier = table.withColumn("_cut", last.scalar()).filter(F.col(time) < F.col("_cut")).drop("_cut")
    return cutoff_table(earlier, validation_fraction, time).select(
        F.col("cutoff").alias("validation_start"), last.scalar().alias("test_start")
    )


def three_way_split(
    table: DataFrame,
    test_fraction: float = TEST_FRACTION,
    validation_fraction: float = VALIDATION_FRACTION,
    time: str = PREDICTION_TIME,
) -> DataFrame:
    """Add `cohort` train / validation / test, in that order in time.

    Reads the time column twice to find the cutoffs: hand over a written table where the plan
    behind it is costly.
    """
    validation_start, test_start = three_way_cutoffs(table, test_fraction, validation_fraction, time)
    return table.withColumn(
        "cohort",
        F.when(F.col(time) >= moment(test_start), "test")
        .when(F.col(time) >= moment(validation_start), "validation")
        .otherwise("train"),
    )


def fold_edges(table: DataFrame, folds: int = FOLDS, time: str = PREDICTION_TIME) -> DataFrame:
    """One row: edge0 … edge<folds>, the second half of the period cut at equal shares of rows."""
    names = [f"edge{i}" for i in range(folds)]
    probs = [0.5 + 0.5 * i / folds for i in range(folds)]
    edges = time_quantiles(table, time, probs, names)
    end = table.agg((F.max(time) + F.expr("interval 1 day")).alias("end"))
    return edges.select(*names, end.scalar().alias(f"edge{folds}"))


def temporal_folds(table: DataFrame, folds: int = FOLDS, time: str = PREDICTION_TIME) -> DataFrame:
    """Add `fold`, 1…folds, the slice a row is evaluated in; 0 for the first half.

    Fold k is evaluated with a model fitted on the rows whose fold is below k.
    """
    packed = fold_edges(table, folds, time).select(
        F.array(*[f"edge{i}" for i in range(folds)]).alias("e")
    )
    fold = F.lit(0)
    for number in range(folds):
        fold = F.when(F.col(time) >= F.col("_e")[number], number + 1).otherwise(fold)
    return table.withColumn("_e", packed.scalar()).withColumn("fold", fold).drop("_e")


def cohort_periods(table: DataFrame, cohort: str = "cohort", time: str = PREDICTION_TIME) -> DataFrame:
    """First and last day, rows and late rate of each cohort."""
    return table.groupBy(cohort).agg(
        F.to_date(F.min(time)).alias("desde"),
        F.to_date(F.max(time)).alias("hasta"),
        F.count(F.lit(1)).alias("n"),
        rate(TARGET).alias("late_rate"),
    )


def union_cohorts(table: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows of several cohorts: a filter on the column replaces concatenating tables."""
    return table.filter(F.col("cohort").isin(list(names)))
