"""Data checks. Each returns a small table with an `ok` column where it can fail."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from arrivo.functions.aggregates import count_true, rate
from arrivo.operators.joins import orphans
from arrivo.operators.label import in_period, late_flag, observable
from arrivo.schemas import DELIVERED, ESTIMATED, PURCHASE, STUDY_PERIOD, TABLES, TARGET

Tables = Mapping[str, DataFrame]


def stack(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def pct(flag) -> F.Column:
    return F.round(100 * rate(flag), 2)


def row_counts(tables: Tables) -> DataFrame:
    """Rows per table."""
    return stack(
        [
            df.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias("tabla"), "filas")
            for name, df in tables.items()
        ]
    )


def check_row_counts(tables: Tables, expected: Mapping[str, int]) -> DataFrame:
    counted = row_counts({name: tables[name] for name in expected})
    wanted = F.create_map(*[x for name, n in expected.items() for x in (F.lit(name), F.lit(n).cast("long"))])
    return counted.select(
        "tabla",
        wanted[F.col("tabla")].alias("esperado"),
        F.col("filas").alias("obtenido"),
        (F.col("filas") == wanted[F.col("tabla")]).alias("ok"),
    )


def check_unique(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows against distinct complete keys: a null key part counts as a failure."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("filas"), count_true(complete).alias("claves")
    ).select(
        F.lit(name).alias("prueba"), "filas", "claves", (F.col("filas") == F.col("claves")).alias("ok")
    )


def check_keys(tables: Tables) -> DataFrame:
    return stack(
        [
            check_unique(tables[name], spec.key, f"{name}({', '.join(spec.key)})")
            for name, spec in TABLES.items()
            if spec.key and name in tables
        ]
    )


def check_references(tables: Tables) -> DataFrame:
    """Orphan rows of every declared reference."""
    return stack(
        [
            orphans(tables[name].select(column), column, tables[parent])
            .agg(F.count(F.lit(1)).alias("huerfanos"))
            .select(
                F.lit(f"{name}.{column}").alias("prueba"),
                "huerfanos",
                (F.col("huerfanos") == 0).alias("ok"),
            )
            for name, spec in TABLES.items()
            if name in tables
            for column, parent in spec.references
        ]
    )


def check_required(tables: Tables) -> DataFrame:
    """Nulls in columns declared NOT NULL (file sources do not enforce it). One scan per table."""
    parts = []
    for name, spec in TABLES.items():
        if name in tables and spec.required:
            nulls = tables[name].agg(*[count_true(F.col(c).isNull()).alias(c) for c in spec.required])
            parts.append(
                nulls.unpivot([], list(spec.required), "columna", "nulos").select(
                    F.lit(name).alias("tabla"), "columna", "nulos", (F.col("nulos") == 0).alias("ok")
                )
            )
    return stack(parts)


def label_audit(orders: DataFrame, expected_rows: int) -> DataFrame:
    """Late percentage under both rules, over all observable orders."""
    delivered, estimated = F.col(DELIVERED), F.col(ESTIMATED)
    return orders.filter(observable(orders)).agg(
        F.count(F.lit(1)).alias("entregados"),
        pct(late_flag(delivered, estimated).cast("int")).alias("pct_tarde_dia_calendario"),
        pct(late_flag(delivered, estimated, False).cast("int")).alias("pct_tarde_timestamp"),
        (F.count(F.lit(1)) == expected_rows).alias("ok_conteo"),
    )


def label_audit_period(orders: DataFrame, period: tuple[str, str] = STUDY_PERIOD) -> DataFrame:
    day = F.to_date(PURCHASE)
    return orders.filter(observable(orders) & in_period(F.col(PURCHASE), period)).agg(
        F.count(F.lit(1)).alias("entregados_periodo"),
        pct(late_flag(F.col(DELIVERED), F.col(ESTIMATED)).cast("int")).alias("pct_tarde_periodo"),
        F.min(day).alias("primera_compra"),
        F.max(day).alias("ultima_compra"),
    )


def view_audit(view: DataFrame) -> DataFrame:
    return view.agg(
        F.count(F.lit(1)).alias("filas"),
        pct(TARGET).alias("pct_tarde"),
        count_true(F.col("n_items").isNull()).alias("pedidos_sin_items"),
        count_true(F.col("main_payment_type").isNull()).alias("pedidos_sin_pago"),
    )


def close_enough(a, b, rtol: float = 1e-5, atol: float = 1e-8) -> F.Column:
    return F.abs(a - b) <= atol + rtol * F.abs(b)


def check_sums(pairs: Mapping[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Totals that must survive the joins: (joined table, column, source table, column) per check."""
    parts = []
    for name, (joined, column, source, source_column) in pairs.items():
        expected = source.agg(F.sum(source_column).alias("s"))
        parts.append(
            joined.agg(F.sum(column).alias("obtenido")).select(
                F.lit(name).alias("prueba"), "obtenido", expected.scalar().alias("esperado")
            )
        )
    return stack(parts).withColumn("ok", close_enough(F.col("obtenido"), F.col("esperado")))


def check_fan_out(joined: DataFrame, source: DataFrame, name: str) -> DataFrame:
    """Joins to dimensions must keep the row count of the fact."""
    rows = source.agg(F.count(F.lit(1)).alias("n"))
    return joined.agg(F.count(F.lit(1)).alias("obtenido")).select(
        F.lit(name).alias("prueba"), "obtenido", rows.scalar().alias("esperado")
    ).withColumn("ok", F.col("obtenido") == F.col("esperado"))


def verdict(checks: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check: all columns named ok… hold. Checks without such a column always pass."""
    parts = []
    for name, df in checks.items():
        flags = [c for c in df.columns if c.startswith("ok")]
        every = reduce(lambda a, b: a & b, [F.col(c) for c in flags]) if flags else F.lit(True)
        parts.append(
            df.agg(F.coalesce(F.bool_and(every), F.lit(True)).alias("ok")).select(
                F.lit(name).alias("prueba"), "ok"
            )
        )
    return stack(parts)


def require_ok(checks: DataFrame) -> None:
    """Raise with the failing rows (check tables are a handful of rows)."""
    failed = [row.asDict() for row in checks.filter(~F.coalesce(F.col("ok"), F.lit(False))).collect()]
    if failed:
        raise ValueError(f"failed checks: {failed}")
