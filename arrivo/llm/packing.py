"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are the powers of two that add up to n, none longer than
`MAX_LENGTH`, longest first. Pieces of one length form a bucket, and every piece is a sequence of its own: no sequence
crosses documents, none needs padding, and training draws batches from one bucket at a time.

Defined results: a null or empty text is its end id, one piece of length 1; repeated rows are packed each; an empty
table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from arrivo.llm.tokens import PIECE_BYTES, crc_of_lists, encoder, id_lists, tokenizer_path
from arrivo.llm.words import pieces, texts_of
from arrivo.session import materialize

MAX_LENGTH = 2048


def decompose(sizes: np.ndarray, longest: int = MAX_LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of all pieces of all documents in a row, and the number of pieces per document."""
    whole, rest = sizes // longest, sizes % longest
    bits = 1 << np.arange(longest.bit_length() - 2, -1, -1)
    used = (rest[:, None] & bits) > 0
    number = whole + used.sum(1)
    lengths = np.full(int(number.sum()), longest, np.int64)
    first = np.concatenate([[0], np.cumsum(number)])[:-1] + whole
    row, bit = np.nonzero(used)
    lengths[first[row] + (np.cumsum(used, 1) - 1)[row, bit]] = bits[bit]
    return lengths, number


def pack(docs: DataFrame, tokenizer: str | None = None, longest: int = MAX_LENGTH) -> DataFrame:
    """Per piece: doc_id, start, length, doc_tokens, ids, sequence_id, offset.

    The pieces are written once, numbered within (bucket, task). Sequence numbers run through the buckets from the
    longest to the shortest; the offsets of (bucket, task) come from a table with one row for each of them.
    """
    if longest < 2 or longest & (longest - 1):
        raise ValueError("the longest piece must be a power of two")
    place = tokenizer or tokenizer_path()
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(longest.bit_length(), np.int64)
        for part in pieces(batches, limit=PIECE_BYTES):
            ids, starts = encoder(place)(texts_of(part))
            sizes = np.diff(starts)
            lengths, number = decompose(sizes, longest)
            ends = np.cumsum(lengths)
            begin = ends - lengths
            order = np.argsort(-lengths, kind="stable")
            rank, power = np.empty(len(lengths), np.int64), np.log2(lengths).astype(np.int64)
            for p in np.unique(power):
                mine = order[power[order] == p]
                rank[mine] = seen[p] + np.arange(len(mine))
                seen[p] += len(mine)
            owner = np.repeat(np.arange(part.num_rows), number)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(owner)), pa.array(begin - starts[:-1][owner]), pa.array(lengths), pa.array(sizes[owner]),
                    id_lists(ids, np.append(begin, ends[-1:])), pa.array(np.full(len(owner), task, np.int32)), pa.array(rank),
                ],
                names=["doc_id", "start", "length", "doc_tokens", "ids", "task", "rank"],
            )

    spec = f"doc_id {id_type}, start long, length long, doc_tokens long, ids array<int>, task int, rank long"
    written = materialize(docs.select("doc_id", "text").mapInArrow(cut, spec), "pieces")
    sizes = written.groupBy("length", "task").agg(F.count("*").alias("_size"))
    before = Window.orderBy(F.desc("length"), "task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("length").alias("_length"), F.col("task").alias("_task"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    # one row per length and task of the first pass: small enough for every executor
    joined = written.join(F.broadcast(offsets), (F.col("length") == F.col("_length")) & (F.col("task") == F.col("_task")))
    return joined.select("doc_id", "start", "length", "doc_tokens", "ids", (F.col("_before") + F.col("rank")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def digest(packed: DataFrame) -> DataFrame:
    """The pieces with ids_crc32 of their ids in place of the ids."""
    id_type = packed.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = pa.array(crc_of_lists(pa.concat_arrays([batch.column("ids")])))
            yield pa.RecordBatch.from_arrays([crc if n == "ids_crc32" else batch.column(n) for n in names], names=names)

    return packed.mapInArrow(check, f"doc_id {id_type}, " + ", ".join(f"{n} long" for n in names[1:]))
