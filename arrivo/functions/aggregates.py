"""Aggregate expressions. All of them combine map-side, so a hot group never sits in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from arrivo.functions.scalars import as_column


def strict_sum(c: Column | str) -> Column:
    """Sum that is null when any member of the group is null."""
    c = as_column(c)
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def sum_or_zero(c: Column | str) -> Column:
    return F.coalesce(F.sum(as_column(c)), F.lit(0.0))


def rate(flag: Column | str) -> Column:
    return F.avg(as_column(flag).cast("double"))


def count_true(condition: Column) -> Column:
    return F.count_if(condition)


def at_largest(payload: Column, size: Column | str, ties: Sequence[Column | str] = ()) -> Column:
    """Payload of the row with the largest `size`, nulls last, ties by the smallest tie columns.

    One aggregate with a fixed-size buffer: no sort of the group and no window over it.
    """
    keys = [as_column(t).alias(f"tie{number}") for number, t in enumerate(ties)]
    return F.min(F.struct(_descending(size), *keys, payload.alias("payload")))["payload"]


def row_at_largest(size: Column | str, ties: Sequence[str]) -> Column:
    """The tie columns of the row `at_largest` finds: where they hold all that is asked for, nothing is kept and moved twice."""
    return F.min(F.struct(_descending(size), *ties))


def _descending(size: Column | str) -> Column:
    return F.coalesce(-as_column(size).cast("double"), F.lit(float("inf"))).alias("order")


def last_known(value: Column | str, time: Column | str, ties: Sequence[Column | str] = ()) -> Column:
    """Latest non-null value; a missing time counts as the newest."""
    value, time = as_column(value), as_column(time)
    order = F.struct(time.isNull(), time, *[as_column(t) for t in ties])
    return F.max_by(value, F.when(value.isNotNull(), order))
