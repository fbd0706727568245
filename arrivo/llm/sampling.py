"""Bounded samples of rows for fitting, drawn by hash so that they do not depend on file order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def crc_fold(id_col: str, folds: int):
    """crc32 of the id as text, modulo `folds`; a null id falls in fold 0, which no fit learns from or which is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds, F.lit(0))


PLACES = 1 << 62


def place(*columns: str) -> Column:
    """Place of a row in a shuffle by hash: 0 to `PLACES` - 1."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 2)


def first_places(rows: DataFrame, wanted: int, among: int, *columns: str) -> DataFrame:
    """The `wanted` rows with the smallest places, of `among` rows in all.

    Rows that lie beyond four times the expected place go before the sort, so that what meets in its one last task
    follows the sample and not the number of partitions.
    """
    share = min(1.0, 4.0 * wanted / among) if among else 1.0
    near = rows.where(place(*columns) < int(share * PLACES)) if share < 1 else rows
    return near.orderBy(place(*columns), *columns).limit(wanted)


def labelled_rows(docs: DataFrame, labels: DataFrame, target: str, per_class: int, where=None) -> DataFrame:
    """At most `per_class` documents of each class 0 and 1, as (doc_id, text, y): the smallest hashes of the id.

    Ids that repeat in `labels` count once, with the larger label. The keys are at most 2 * `per_class` rows, hence
    small enough to broadcast, and so is the result: rows of one id beyond that bound are cut by the order of their hash.
    """
    known = labels.where(F.col(target).isin(0, 1) & F.col("doc_id").isNotNull())
    if where is not None:
        known = known.where(where)
    known = known.groupBy("doc_id").agg(F.max(F.col(target).cast("int")).alias("y"))
    sizes = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}  # two rows
    picked = [first_places(known.where(F.col("y") == y), per_class, sizes.get(y, 0), "doc_id") for y in (0, 1)]
    keys = picked[0].unionByName(picked[1])
    rows = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(keys), "doc_id")
    return rows.orderBy(F.xxhash64("doc_id"), F.xxhash64("text")).limit(2 * per_class)
