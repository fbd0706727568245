"""Joins whose cardinality is checked."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def one_to_one_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join that refuses repeated keys on either side before it is planned."""
    for side, df in (("left", left), ("right", right)):
        if not repeated_keys(df, keys).isEmpty():
            raise ValueError(f"keys {list(keys)} are not unique on the {side} side")
    return left.join(right, list(keys), how)


def require_unique(tables: Mapping[str, tuple[DataFrame, str]]) -> None:
    """Refuse tables, given with their key, in which a key occurs more than once; one job for all of them."""
    parts = [
        repeated_keys(df.select(key), [key]).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("t"), "n")
        for name, (df, key) in tables.items()
    ]
    found = reduce(DataFrame.unionByName, parts).where("n > 0").collect()  # a row per table at most
    if found:
        raise ValueError("keys are not unique in " + ", ".join(sorted(f"{r.t} ({r.n} repeated)" for r in found)))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str | None = None) -> DataFrame:
    """Child rows whose reference is missing from the parent (null references included)."""
    keys = parent.select(F.col(parent_column or column).alias("_parent_key"))
    return child.join(keys, child[column] == F.col("_parent_key"), "left_anti")
