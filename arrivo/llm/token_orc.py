"""Token ids as ORC files: integer run-length encoding, row indexes, Bloom filters on document ids.

Documents are dealt out by ranges of doc_id, sorted within each range, encoded and written; every range is a shard.
A shard's rows carry their start within the shard, so that reading any stripe needs only the (small) table of shard
sizes, read from the files' own columns, to give global positions.

Defined results: a null text has the end id only; null ids come first; rows of one id are ordered by the
hash of their text; an empty table gives an empty, readable table; further columns are not written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from arrivo.llm.tokens import PIECE_BYTES, crc_of_lists, encoder, id_lists, tokenizer_path
from arrivo.llm.words import pieces, texts_of

STRIPE_BYTES = 16 << 20
INDEX_STRIDE = 1000
BLOOM_RATE = 0.01


def write_ids(docs: DataFrame, path: str, tokenizer: str | None = None) -> None:
    """Encode and write all documents; columns shard, doc_id, shard_start, n_tokens, ids."""
    place = tokenizer or tokenizer_path()
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, before = TaskContext.get().partitionId(), 0
        for part in pieces(batches, limit=PIECE_BYTES):
            ids, starts = encoder(place)(texts_of(part))
            n = part.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, shard, np.int32)), part.column("doc_id"), pa.array(starts[:-1] + before), pa.array(np.diff(starts)), id_lists(ids, starts)],
                names=["shard", "doc_id", "shard_start", "n_tokens", "ids"],
            )
            before += len(ids)

    # ties get further keys, so that one id with very many rows is dealt out as well
    keys = [F.asc_nulls_first("doc_id"), F.asc("_hash"), F.asc("_row")]
    rows = docs.select("doc_id", "text").withColumns({"_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    (
        ordered.select("doc_id", "text").mapInArrow(encode, f"shard int, doc_id {id_type}, shard_start long, n_tokens long, ids array<int>")
        .write.mode("overwrite")
        .option("orc.compress", "ZSTD")
        .option("orc.stripe.size", str(STRIPE_BYTES))
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", str(INDEX_STRIDE))
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", str(BLOOM_RATE))
        .orc(path)
    )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the files; a filter on doc_id prunes stripes and row groups by their indexes and Bloom filters."""
    return spark.read.orc(path)


def global_starts(stored: DataFrame) -> DataFrame:
    """Add `start`: ids of all documents before, in ascending order of doc_id.

    The window orders one row per shard, that is per written partition.
    """
    shards = stored.groupBy("shard").agg(F.sum("n_tokens").alias("_size"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shards.select(F.col("shard").alias("_shard"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    # one row per written partition: small enough for every executor
    return stored.join(F.broadcast(offsets), F.col("shard") == F.col("_shard")).withColumn("start", F.col("shard_start") + F.col("_before")).drop("_shard", "_before")


def digest(stored: DataFrame) -> DataFrame:
    """Per stored document: doc_id, start, n_tokens and ids_crc32 of the ids read back."""
    id_type = stored.schema["doc_id"].dataType.simpleString()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = pa.concat_arrays([part.column("ids")])  # offsets from 0
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("start"), pa.array(np.diff(lists.offsets.to_numpy()).astype(np.int64)), pa.array(crc_of_lists(lists))],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return global_starts(stored).select("doc_id", "start", "ids").mapInArrow(check, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")
