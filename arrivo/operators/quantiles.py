"""Exact, linearly interpolated quantiles and the equal-frequency bins made from them.

`percentile` keeps a value map of the whole group in one buffer. Here the values are counted
map-side, located by bucket totals, and only the few buckets that hold a wanted rank are ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from arrivo.functions.scalars import as_column, from_micros, micros, value_bucket
from arrivo.operators.running import MINUTE, bucket_offsets, within_buckets

VALUE, WEIGHT = "_value", "_n"


def value_counts(df: DataFrame, value: Column | str, keys: Sequence[str] = ()) -> DataFrame:
    return (
        df.select(*keys, as_column(value).cast("double").alias(VALUE))
        .filter(F.col(VALUE).isNotNull() & ~F.isnan(VALUE))
        .groupBy(*keys, VALUE)
        .agg(F.count(F.lit(1)).alias(WEIGHT))
    )


def quantiles_of_counts(
    counts: DataFrame,
    probs: Sequence[float],
    keys: Sequence[str],
    names: Sequence[str],
    bucket: Column | None = None,
) -> DataFrame:
    """Quantiles of a (keys, value, count) table with one row per (keys, value)."""
    bucket = value_bucket(VALUE) if bucket is None else bucket
    # position p·(n−1) of each probability, from the total count of the key
    levels = f"array({', '.join(f'{float(p)!r}D' for p in probs)})"

    def holds(start: str, size: str) -> str:
        """Does the run of equal values, or the bucket, hold one of the two ranks of a level?"""
        spot = f"((total_{WEIGHT} - 1) * p)"
        return f"exists({levels}, p -> floor({spot}) < {start} + {size} AND ceil({spot}) >= {start})"

    offsets = bucket_offsets(counts, keys, bucket, [WEIGHT], totals=True).filter(
        holds(f"_before_{WEIGHT}", f"_in_{WEIGHT}")
    )
    ordered = within_buckets(
        counts, offsets, keys, VALUE, bucket, [WEIGHT], keep=[f"total_{WEIGHT}"]
    ).filter(holds(f"before_{WEIGHT}", WEIGHT))
    # at most two rows per probability are left
    found = ordered.groupBy(*keys).agg(
        F.expr(f"collect_list(struct(before_{WEIGHT} AS first, {WEIGHT} AS n, {VALUE} AS v))").alias("r"),
        F.max(f"total_{WEIGHT}").alias("n"),
    )

    def interpolated(p: float) -> str:
        spot = f"((n - 1) * {float(p)!r}D)"
        low, high = (
            f"filter(r, x -> {edge}({spot}) >= x.first AND {edge}({spot}) < x.first + x.n)[0].v"
            for edge in ("floor", "ceil")
        )
        # a rank that is met needs no neighbour; between infinities the difference would be NaN
        met = f"{spot} = floor({spot}) OR {low} = {high}"
        return f"CASE WHEN {met} THEN {low} ELSE {low} + ({high} - {low}) * ({spot} - floor({spot})) END"

    return found.filter("n > 0").select(
        *keys, *[F.expr(interpolated(p)).alias(name) for p, name in zip(probs, names)]
    )


def quantiles(
    df: DataFrame,
    value: Column | str,
    probs: Sequence[float],
    keys: Sequence[str] = (),
    names: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key with a column per probability. Null keys and null values are left out."""
    names = names or [f"q{number}" for number in range(len(probs))]
    if keys:
        df = df.dropna(subset=list(keys))
    return quantiles_of_counts(value_counts(df, value, keys), probs, keys, names)


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], names: Sequence[str]
) -> DataFrame:
    """Quantiles of many columns in one pass: one row per column."""
    long = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("columna"), F.col(c).cast("double").alias(VALUE))
                    for c in columns
                ]
            )
        ).alias("_cell")
    ).select("_cell.*")
    return quantiles(long, VALUE, probs, ["columna"], names)


def time_quantiles(
    df: DataFrame, time: Column | str, probs: Sequence[float], names: Sequence[str]
) -> DataFrame:
    """Quantiles of a timestamp column, interpolated to the microsecond."""
    minute = F.expr(f"floor({VALUE} / {MINUTE})")
    raw = quantiles_of_counts(value_counts(df, micros(time)), probs, [], names, minute)
    return raw.select(*[from_micros(F.floor(F.col(n)).cast("long")).alias(n) for n in names])


def equal_frequency_bins(df: DataFrame, value: str, bins: int, out: str) -> DataFrame:
    """Right-closed bins 0…bins-1 at interpolated quantiles; repeated edges are merged."""
    probs = [i / bins for i in range(bins + 1)]
    names = [f"_e{i}" for i in range(bins + 1)]
    edges = f"array_sort(array_distinct(array({', '.join(names)})))"
    inner = quantiles(df, value, probs, names=names).selectExpr(
        f"slice({edges}, 2, greatest(size({edges}) - 2, 0)) AS inner_edges"
    )
    # bin number = inner edges strictly below the value. Written out rather than as a lambda over the
    # array: the value may be a long expression, which generated code then evaluates once per row.
    above = [f"coalesce(cast({value} > get(_edges, {i}) AS int), 0)" for i in range(bins - 1)]
    known = f"{value} IS NOT NULL AND NOT isnan(cast({value} AS double))"
    return (
        df.withColumn("_edges", inner.scalar())
        .withColumn(out, F.expr(f"CASE WHEN {known} THEN {' + '.join(above) or '0'} END"))
        .drop("_edges")
    )
