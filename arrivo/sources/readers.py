"""CSV and Parquet readers with fixed schemas: nothing is inferred, nothing is scanned twice."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from arrivo.operators.checks import row_counts
from arrivo.schemas import FEATURE_TABLES, TABLES
from arrivo.sources.releases import numbers, publish, read_release

STAMP_FORMAT = "yyyy-MM-dd[ HH:mm[:ss[.SSSSSS]]]"
# free text with line breaks inside quotes: such a file cannot be split
MULTILINE = ("reviews",)


def table_path(folder: str, name: str, files: Mapping[str, str] | None, suffix: str) -> str:
    """`files` maps table names to file names; by default <table><suffix>."""
    return f"{folder.rstrip('/')}/{(files or {}).get(name, name + suffix)}"


def require_paths(spark: SparkSession, paths: Mapping[str, str]) -> None:
    """One error that names everything missing, before any job starts. Works on any Hadoop store."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    missing = []
    for name, path in paths.items():
        target = jvm.org.apache.hadoop.fs.Path(path)
        if not target.getFileSystem(conf).exists(target):
            missing.append(f"{name} ({path})")
    if missing:
        raise FileNotFoundError(f"missing input: {', '.join(missing)}")


def without_nan(df: DataFrame) -> DataFrame:
    """NaN means missing, like an empty cell."""
    reals = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in reals else F.col(c) for c in df.columns])


def read_csv_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return without_nan(
        spark.read.schema(TABLES[name].schema)
        .option("header", True)
        .option("enforceSchema", False)  # a header that does not match the schema is an error
        .option("escape", '"')
        .option("nullValue", "")
        .option("timestampNTZFormat", STAMP_FORMAT)
        .option("multiLine", name in MULTILINE)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def load_tables(
    spark: SparkSession,
    folder: str,
    names: Iterable[str] = FEATURE_TABLES,
    files: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """The named CSV tables, typed."""
    paths = {name: table_path(folder, name, files, ".csv") for name in names}
    require_paths(spark, paths)
    return {name: read_csv_table(spark, path, name) for name, path in paths.items()}


def load_geolocation(
    spark: SparkSession, folder: str, files: Mapping[str, str] | None = None
) -> DataFrame:
    return load_tables(spark, folder, ["geolocation"], files)["geolocation"]


def load_all_tables(
    spark: SparkSession, folder: str, files: Mapping[str, str] | None = None
) -> dict[str, DataFrame]:
    """All nine CSV tables."""
    return load_tables(spark, folder, TABLES, files)


def load_parquet_tables(
    spark: SparkSession, folder: str, names: Iterable[str] = tuple(TABLES)
) -> dict[str, DataFrame]:
    """Tables of the newest release in the folder (written by `ingest`), else of plain folders by their names."""
    if numbers(spark, folder):
        found = read_release(spark, folder)
        if missing := [n for n in names if n not in found]:
            raise FileNotFoundError(f"missing in the release: {', '.join(missing)}")
        return {n: without_nan(found[n]) for n in names}
    paths = {name: f"{folder.rstrip('/')}/{name}" for name in names}
    require_paths(spark, paths)
    return {n: without_nan(spark.read.schema(TABLES[n].schema).parquet(p)) for n, p in paths.items()}


def ingest(
    spark: SparkSession,
    csv_folder: str,
    folder: str,
    names: Iterable[str] = tuple(TABLES),
    files: Mapping[str, str] | None = None,
) -> DataFrame:
    """CSV to Parquet as one release; safe to repeat. Returns the loaded row counts.

    A load that fails half-way leaves readers the release before.
    """
    names = list(names)
    publish(load_tables(spark, csv_folder, names, files), folder)
    return row_counts(load_parquet_tables(spark, folder, names))
