"""Audit of a table: nulls, infinities, duplicates, grain, invalid values, distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from arrivo.functions.aggregates import count_true
from arrivo.functions.scalars import any_true
from arrivo.operators.quantiles import column_quantiles, quantiles

MEASURES = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count and percentage per column, one scan."""
    columns = list(columns or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[count_true(F.col(c).isNull()).alias(c) for c in columns]
    )
    return (
        counts.unpivot(["_rows"], columns, "columna", "cantidad_nulos")
        .select(
            "columna",
            "cantidad_nulos",
            F.round(100 * F.col("cantidad_nulos") / F.col("_rows"), 3).alias("porcentaje_nulos"),
        )
        .orderBy(F.col("cantidad_nulos").desc(), "columna")
    )


def infinity_profile(df: DataFrame) -> DataFrame:
    """Infinite values per floating-point column."""
    reals = [f.name for f in df.schema if f.dataType.typeName() in ("double", "float")]
    counts = df.agg(*[count_true(F.abs(F.col(c)) == float("inf")).alias(c) for c in reals])
    return counts.unpivot([], reals, "columna", "cantidad_infinitos")


def duplicate_profile(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in every column."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(
        F.sum("_n").alias("filas"), F.sum(F.col("_n") - 1).alias("duplicadas")
    )


def grain(df: DataFrame, key: str) -> DataFrame:
    """Is there one row per key?"""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").alias("filas"), F.count(key).alias("unicos"), F.sum(F.col("n") - 1).alias("repetidos")
    ).withColumn("una_fila_por_clave", F.col("filas") == F.col("unicos"))


def missing_measure() -> Column:
    return any_true([F.col(c).isNull() for c in MEASURES])


def nonpositive_measure() -> Column:
    return any_true([F.col(c) <= 0 for c in MEASURES])


def nonpositive_installments() -> Column:
    return F.coalesce(F.col("payment_installments") <= 0, F.lit(False))


def invalid_value_counts(products: DataFrame, payments: DataFrame) -> DataFrame:
    bad_payments = payments.agg(count_true(nonpositive_installments()).alias("n"))
    return products.agg(
        count_true(missing_measure()).alias("productos_con_faltantes"),
        count_true(nonpositive_measure()).alias("productos_con_no_positivos"),
    ).select("*", bad_payments.scalar().alias("pagos_con_cuotas_no_positivas"))


def invalid_products(products: DataFrame) -> DataFrame:
    return products.filter(missing_measure() | nonpositive_measure()).select("product_id", *MEASURES)


def invalid_payments(payments: DataFrame) -> DataFrame:
    return payments.filter(nonpositive_installments())


def value_counts(df: DataFrame, column: str, keep_null: bool = False) -> DataFrame:
    """Rows per value with their share, most frequent first."""
    if not keep_null:
        df = df.filter(F.col(column).isNotNull())
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("cantidad"))
    total = counts.agg(F.sum("cantidad").alias("n"))
    return counts.withColumn("proporcion", F.col("cantidad") / total.scalar()).orderBy(
        F.col("cantidad").desc(), column
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample deviation, min, exact quartiles and max per column."""
    kinds = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    cells = [
        F.struct(F.lit(c).alias("columna"), *[f(F.col(c).cast("double")).alias(k) for k, f in kinds.items()])
        for c in columns
    ]
    moments = df.agg(F.array(*cells).alias("cells")).select(F.explode("cells").alias("cell")).select("cell.*")
    quartiles = column_quantiles(df, columns, [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
    return moments.join(quartiles, "columna", "left").select(
        "columna", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def group_stats(df: DataFrame, key: str, value: str) -> DataFrame:
    """count, mean, median, min and max of a column per group."""
    stats = df.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    return stats.join(quantiles(df, value, [0.5], [key], ["median"]), key, "left")


def top_rows(df: DataFrame, by: str, k: int, ties: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The k rows with the largest value (a distributed top-k, not a full sort)."""
    return df.filter(F.col(by).isNotNull()).orderBy(F.col(by).desc(), *ties).limit(k).select(*columns)


def seeded_sample(df: DataFrame, key: str, k: int, seed: int = 42) -> DataFrame:
    """k rows in an order fixed by key and seed, whatever the partitioning; other engines can repeat it."""
    place = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"/{seed}")).cast("binary"))
    return df.orderBy(place, key).limit(k)
