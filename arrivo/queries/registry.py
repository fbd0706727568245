"""Registry of queries and the normalisation that makes both engines comparable."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from arrivo.queries.binding import Bound
from arrivo.queries.sql import query

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
DIGITS = 6
EXACT = 8  # enough for seconds as a fraction of a day, so that no value lies on a rounding edge


def comparable(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Reals rounded (sums differ in their last bits with the order of addition), integers widened."""
    columns = []
    for f in df.schema:
        kind = f.dataType.typeName()
        if kind in ("double", "float"):
            columns.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        elif kind in ("integer", "short", "byte"):
            columns.append(F.col(f.name).cast("long").alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


def register(
    name: str,
    build: Callable[[Bound], DataFrame],
    sql: str | None = None,
    real: Sequence[str] = (),
    whole: Sequence[str] = (),
    digits: int = DIGITS,
    **views: str,
) -> None:
    """Add a query; `real` and `whole` name the SQL columns to round and to widen."""
    QUERIES[name] = lambda spark, folder: comparable(build(Bound(spark, folder)), digits)
    if sql is None:
        return
    fixes = [f"round({c}, {digits}) AS {c}" for c in real]
    fixes += [f"CAST({c} AS BIGINT) AS {c}" for c in whole]
    text = f"SELECT * REPLACE ({', '.join(fixes)}) FROM ({sql})" if fixes else sql
    SQL[name] = query(text, **views)
