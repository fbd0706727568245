"""Releases: sets of tables that readers see whole or not at all.

All tables of a release are written to folders that no reader knows; then its manifest appears under the next number, by one
rename that refuses to replace. Readers take the newest manifest. A writer that is lost leaves folders without a manifest,
which nobody reads. Of two writers that want one number the later one takes the next, where the store renames in one step (a distributed file
system does; a local disk or an object store may let the later one win). A release holds the tables of the one before that it
does not replace itself.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from arrivo.sources.sinks import STAMP_FORMAT, write_tables

# how the writer writes CSV, per format; Parquet needs nothing
READ_OPTIONS = {"csv": {"header": "true", "escape": '"', "multiLine": "true", "timestampNTZFormat": STAMP_FORMAT}}


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, folder: str):
    return _path(spark, folder).getFileSystem(spark._jsc.hadoopConfiguration())


def _manifest(folder: str, number: int) -> str:
    return f"{folder}/manifests/{number:08d}.json"


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete releases, ascending."""
    folder = folder.rstrip("/")
    files, place = _files(spark, folder), _path(spark, f"{folder}/manifests")
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))


def manifest(spark: SparkSession, folder: str, number: int | None = None) -> dict:
    """Per table of a release (the newest by default): its path below the folder, its format and its schema."""
    folder, found = folder.rstrip("/"), numbers(spark, folder)
    if not found or number is not None and number not in found:
        raise FileNotFoundError(f"no release {'' if number is None else number} in {folder}")
    path = _manifest(folder, found[-1] if number is None else number)
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def _claim(spark: SparkSession, folder: str, number: int, tables: dict) -> bool:
    """Make the manifest visible under this number; false if another writer has it."""
    files = _files(spark, folder)
    pending, target = _path(spark, f"{folder}/pending/{uuid.uuid4().hex}"), _path(spark, _manifest(folder, number))
    out = files.create(pending, False)
    out.write(bytearray(json.dumps(tables), "utf-8"))
    out.close()
    files.mkdirs(target.getParent())
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    keep_existing = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        context.rename(files.makeQualified(pending), files.makeQualified(target), keep_existing)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        files.delete(pending, False)
        return False
    return True


def publish(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> DataFrame:
    """Write the tables as one release; returns their names, rows and columns.

    If any table fails, readers keep the release before.
    """
    folder = folder.rstrip("/")
    spark = next(iter(tables.values())).sparkSession
    data = f"data/{uuid.uuid4().hex}"
    shapes = write_tables(tables, f"{folder}/{data}", fmt)
    own = {name: {"path": f"{data}/{name}", "format": fmt, "schema": df.schema.jsonValue()} for name, df in tables.items()}
    while True:
        last = (numbers(spark, folder) or [0])[-1]
        before = manifest(spark, folder, last) if last else {}
        if _claim(spark, folder, last + 1, before | own):
            return shapes


def read_release(spark: SparkSession, folder: str, number: int | None = None) -> dict[str, DataFrame]:
    """The tables of a release, the newest by default; a later release does not change what was read."""
    out = {}
    for name, entry in manifest(spark, folder, number).items():
        reader = spark.read.schema(StructType.fromJson(entry["schema"])).options(**READ_OPTIONS.get(entry["format"], {}))
        out[name] = reader.format(entry["format"]).load(f"{folder.rstrip('/')}/{entry['path']}")
    return out


def expire(spark: SparkSession, folder: str, keep: int = 2) -> None:
    """Delete all releases but the last ones, with the tables that only they hold."""
    folder, found = folder.rstrip("/"), numbers(spark, folder)
    if keep < 1:
        raise ValueError("at least one release stays")
    files = _files(spark, folder)
    old = {number: manifest(spark, folder, number) for number in found[:-keep]}
    used = {entry["path"] for number in found[-keep:] for entry in manifest(spark, folder, number).values()}
    for number, tables in old.items():
        files.delete(_path(spark, _manifest(folder, number)), False)
        for path in {entry["path"] for entry in tables.values()} - used:
            files.delete(_path(spark, f"{folder}/{path}"), True)


def register_tables(spark: SparkSession, folder: str, database: str, number: int | None = None) -> None:
    """Put the tables of a release into a database of the catalog; they stay where they are."""
    files = _files(spark, folder)
    for name, entry in manifest(spark, folder, number).items():
        place = files.makeQualified(_path(spark, f"{folder.rstrip('/')}/{entry['path']}")).toString()
        options = READ_OPTIONS.get(entry["format"], {})
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
        spark.catalog.createTable(f"`{database}`.`{name}`", place, entry["format"], StructType.fromJson(entry["schema"]), **options)
