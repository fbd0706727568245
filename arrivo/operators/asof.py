"""As-of joins that return the matched row, with no window over a whole key.

The rows of a key are cut into buckets of time. One row per bucket says which right row is its last; a window over these
carries it into later buckets, and a window inside each bucket does the rest. A key that owns a third of all rows is spread
over its buckets like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegralType

from arrivo.functions.scalars import micros
from arrivo.operators.running import BUCKET, MINUTE, never_null

BACKWARD, FORWARD = "backward", "forward"


def _place(df: DataFrame, time: str) -> Column:
    """Integers as they are, timestamps as microseconds."""
    return F.col(time).cast("long") if isinstance(df.schema[time].dataType, IntegralType) else micros(time)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    columns: Sequence[str],
    direction: str = BACKWARD,
    allow_exact: bool = True,
    tolerance: int | None = None,
    bucket: int = MINUTE,
    matched: str | None = None,
) -> DataFrame:
    """Every left row with `columns` of the nearest right row of its key at or before its time (or after it).

    `allow_exact` says whether equal times match; `tolerance` is the largest distance that does (in microseconds for
    timestamps, else in units of the time). Of right rows with one key and time the one with the largest values counts, null
    before others, column by column in the given order. Left rows without key, time or match get nulls. `matched` names an
    output column for the time of the matched row. `columns` must not be columns of `left`.
    """
    if direction not in (BACKWARD, FORWARD):
        raise ValueError(f"direction is {BACKWARD!r} or {FORWARD!r}, not {direction!r}")
    if clash := set(columns) & set(left.columns):
        raise ValueError(f"columns of both sides: {', '.join(sorted(clash))}")
    keys = [f"_k{i}" for i in range(len(by))]
    sign = 1 if direction == BACKWARD else -1  # forward is backward on the reversed axis
    named = [F.col(c).alias(k) for c, k in zip(by, keys)]
    asked = left.select(*named, (sign * _place(left, left_time)).alias("_t")).dropna()
    payload = F.struct(*columns)
    given = right.select(*named, (sign * _place(right, right_time)).alias("_t"), F.struct(payload.alias("row"), F.col(right_time).alias("at")).alias("_row"))
    empty = F.lit(None).cast(given.schema["_row"].dataType)
    # one row per key and moment: the right row there, and whether somebody asks
    marks = given.dropna(subset=[*keys, "_t"]).select("*", F.lit(False).alias("_asked"))
    marks = marks.unionByName(asked.select("*", empty.alias("_row"), F.lit(True).alias("_asked")))
    marks = marks.groupBy(*keys, "_t").agg(F.max("_row").alias("_row"), F.bool_or("_asked").alias("_asked"))
    marks = marks.select("*", F.when(F.col("_row").isNotNull(), F.struct("_t", F.col("_row").alias("row"))).alias("_hit"))
    slot = never_null(F.floor(F.col("_t") / bucket))
    whole = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    # the last right row of each bucket, and of all buckets before it
    lasts = marks.groupBy(*keys, slot.alias(BUCKET)).agg(F.max_by("_hit", F.when(F.col("_hit").isNotNull(), F.col("_t"))).alias("_in"))
    carried = lasts.select(*keys, BUCKET, F.last("_in", ignorenulls=True).over(whole).alias("_before"))
    inside = Window.partitionBy(*keys, BUCKET).orderBy("_t").rowsBetween(Window.unboundedPreceding, 0 if allow_exact else -1)
    near = F.coalesce(F.last("_hit", ignorenulls=True).over(inside), F.col("_before"))
    found = marks.withColumn(BUCKET, slot).join(carried, [*keys, BUCKET]).select(*keys, "_t", "_asked", near.alias("_near")).where("_asked")
    if tolerance is not None:
        close = F.col("_t") - F.col("_near._t") <= tolerance
        found = found.withColumn("_near", F.when(close, F.col("_near")))
    found = found.select(*keys, "_t", F.col("_near.row").alias("_row"))
    l = left.select("*", *named, (sign * _place(left, left_time)).alias("_t"))
    out = l.join(found, [*keys, "_t"], "left")
    extra = [F.col("_row.at").alias(matched)] if matched else []
    return out.select(*[F.col(c) for c in left.columns], *[F.col(f"_row.row.{c}").alias(c) for c in columns], *extra)
