"""Writers."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

# lossless, and read back by the CSV reader
STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def write_table(df: DataFrame, path: str, fmt: str = "csv") -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        # quotes doubled, so that text with quotes and line breaks reads back unchanged
        writer.options(header=True, escape='"', timestampNTZFormat=STAMP_FORMAT).csv(path)
    else:
        writer.format(fmt).save(path)


def write_tables(tables: Mapping[str, DataFrame], folder: str, fmt: str = "csv") -> DataFrame:
    """Write every table to its own folder; returns name, rows and columns of what was written.

    Rows are counted while they are written, so that nothing is read again.
    """
    shapes = []
    for name, df in tables.items():
        counted = Observation(f"written {name}")
        write_table(df.observe(counted, F.count(F.lit(1)).alias("filas")), f"{folder.rstrip('/')}/{name}", fmt)
        shapes.append((name, counted.get.get("filas", 0), len(df.columns)))
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(shapes, "tabla string, filas long, columnas int")


def write_report(spark: SparkSession, report: Mapping, path: str) -> None:
    """A small nested report as one JSON file, on any Hadoop store."""
    text = json.dumps(report, ensure_ascii=False, indent=2, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_report(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])
