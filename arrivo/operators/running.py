"""Running totals that stay parallel inside one hot key, and the as-of history built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from arrivo.functions.scalars import micros

BUCKET = "_bucket"
MINUTE = 60_000_000


def never_null(bucket: Column) -> Column:
    """Bucket numbers of known values are never null; saying so keeps the optimizer from adding a
    null filter to one use of the points only, which would stop the two uses sharing an exchange."""
    return F.coalesce(bucket.cast("long"), F.lit(0).cast("long"))


def bucket_offsets(
    points: DataFrame, keys: Sequence[str], bucket: Column, sums: Sequence[str], totals: bool = False
) -> DataFrame:
    """Per (keys, bucket): the sums of all earlier buckets, and of the whole key when asked.

    The points are summed map-side first; the window then sees one row per bucket.
    """
    per_bucket = points.groupBy(*keys, never_null(bucket).alias(BUCKET)).agg(
        *[F.sum(c).alias(f"_in_{c}") for c in sums]
    )
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    columns = [F.coalesce(F.sum(f"_in_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}") for c in sums]
    if totals:
        columns += [F.sum(f"_in_{c}").over(whole).alias(f"total_{c}") for c in sums]
    return per_bucket.select(*keys, BUCKET, *[f"_in_{c}" for c in sums], *columns)


def within_buckets(
    points: DataFrame,
    offsets: DataFrame,
    keys: Sequence[str],
    order: str,
    bucket: Column,
    sums: Sequence[str],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Add `before_<c>`: the sum of `c` over all rows of the key strictly before `order`."""
    inside = (
        Window.partitionBy(*keys, BUCKET).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    joined = points.withColumn(BUCKET, never_null(bucket)).join(offsets, [*keys, BUCKET])
    return joined.select(
        *points.columns,
        *keep,
        *[
            (F.col(f"_before_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(f"before_{c}")
            for c in sums
        ],
    )


def running_totals(
    points: DataFrame,
    keys: Sequence[str],
    order: str,
    bucket: Column,
    sums: Sequence[str],
    totals: bool = False,
) -> DataFrame:
    """Exclusive running sums per key, in order of `order`.

    `points` holds one row per (keys, order) and `bucket` never decreases with `order`. Work is
    split by (keys, bucket), so a key that owns a third of all rows is spread over its buckets; only
    one row per bucket meets the other buckets of its key.
    """
    offsets = bucket_offsets(points, keys, bucket, sums, totals)
    keep = [f"total_{c}" for c in sums] if totals else []
    return within_buckets(points, offsets, keys, order, bucket, sums, keep)


def asof_history(
    queries: DataFrame,
    events: DataFrame,
    by: str,
    query_time: str,
    event_time: str,
    sums: dict[str, str],
    bucket_micros: int = MINUTE,
) -> DataFrame:
    """Per query row: sums over the events of the same `by` strictly before the query time.

    `sums` maps an output column to the event column it adds up. Events at exactly the query time do
    not count. Events and asked moments are first reduced to one row per (by, instant), then summed
    by `running_totals` in calendar buckets; queries with no earlier event get 0.
    """
    moment = "_t"
    asked = queries.select(by, micros(query_time).alias(moment)).dropna()
    happened = events.select(
        by, micros(event_time).alias(moment), *[F.col(c).alias(out) for out, c in sums.items()]
    ).dropna(subset=[by, moment])
    # nothing but the sums: both uses of the marks below then share one exchange
    marks = (
        happened.unionByName(asked.withColumns({out: F.lit(0) for out in sums}))
        .groupBy(by, moment)
        .agg(*[F.sum(out).alias(out) for out in sums])
    )
    history = running_totals(
        marks, [by], moment, F.floor(F.col(moment) / bucket_micros), list(sums)
    ).select(by, moment, *[F.col(f"before_{out}").alias(out) for out in sums])
    return (
        queries.withColumn(moment, micros(query_time))
        .join(history, [by, moment], "left")
        .select(*queries.columns, *[F.coalesce(F.col(out), F.lit(0)).alias(out) for out in sums])
    )
