"""Lines that many documents share are dropped from all of them but one, found with two Bloom filters.

The key of a line is the line without white space (space, U+0009..U+000D) at its ends, A-Z in lower case. Keys of at least
`KEY_CHARS` code points found in at least `DOCS` documents lose all their lines except in the largest doc_id holding one.

1. Every task sends the 64-bit hashes of its keys, each once, to the segment of the hash range that owns them. There they
   run through two Bloom filters: what the once-seen filter knows already enters the twice-seen filter. Neither forgets a
   key, so a repeated key is always in the second. A segment has about `SEGMENT_KEYS` lines, whatever the corpus.
2. The twice-seen filters, which hold repeated keys only, are folded as long as few bits are set, and to
   `FILTER_BYTES` together at the most: that bounds what is broadcast. Texts run past them; only lines that the filter
   suspects are shuffled, with their text. A filter that had to be folded too far lets more lines through, no result
   depends on it.
3. Suspects are counted exactly, by their text, over distinct documents; the largest doc_id of each key is found with it.
   The (doc_id, line hash) pairs to drop then meet their documents.

Defined results: null or empty text is one empty line; a row without doc_id is no document: it counts for no key and
keeps all its lines; rows with one doc_id are one document when counted, and each gives its own result; an empty table
gives an empty result; further columns are kept by `dedup` and not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from arrivo.llm.words import mix, pieces, signed, texts_of
from arrivo.session import materialize

KEY_CHARS = 20
DOCS = 3
SEGMENT_KEYS = 1 << 20  # lines per segment
SEGMENT_BITS = 1 << 23  # bits of each filter of a segment
PROBES = 4  # bits a key sets
FILTER_BYTES = 32 << 20  # what all twice-seen filters have together, at most
FULL = 0.25  # share of set bits up to which a filter is folded
LEAST_BITS = 1 << 10
FLUSH_KEYS = 1 << 20  # hashes that a task holds before it sends them


def line_key(line: bytes, chars: int = KEY_CHARS) -> bytes | None:
    """Key of a line; None if it has fewer than `chars` code points."""
    key = line.strip().lower()  # of bytes: ASCII white space and A-Z only
    if len(key) >= 4 * chars or len(key) >= chars and len(key.decode()) >= chars:
        return key
    return None


def keys_of(text: bytes, chars: int = KEY_CHARS) -> set[bytes]:
    return {key for key in (line_key(line, chars) for line in text.split(b"\n")) if key is not None}


def byte_texts(batch: pa.RecordBatch) -> list[bytes]:
    return texts_of(batch).cast(pa.binary()).to_pylist()


# --- filters ---


def probes(hashes: np.ndarray) -> np.ndarray:
    """The numbers that choose the bits of each hash, a row per probe; the low bits count in a folded filter too."""
    step = mix(hashes) | np.uint64(1)
    with np.errstate(over="ignore"):
        return np.stack([hashes + np.uint64(j) * step for j in range(PROBES)])


class SeenTwice:
    """Once-seen and twice-seen filter of one segment."""

    def __init__(self, bits: int = SEGMENT_BITS):
        self.once, self.twice = np.zeros(bits, bool), np.zeros(bits, bool)

    def add(self, hashes: np.ndarray, repeated: np.ndarray) -> None:
        """Distinct hashes, and whether each was met several times already."""
        at = (probes(hashes) & np.uint64(len(self.once) - 1)).astype(np.int64)
        known = self.once[at].all(0) | repeated
        self.once[at] = True
        self.twice[at[:, known]] = True

    def folded(self, most_bits: int) -> bytes:
        """The twice-seen filter, halved while few bits are set and until it has at most `most_bits`."""
        bits = self.twice
        while len(bits) > LEAST_BITS:
            half = bits[: len(bits) // 2] | bits[len(bits) // 2 :]
            if len(bits) <= most_bits and half.mean() > FULL:
                break
            bits = half
        return np.packbits(bits, bitorder="little").tobytes()


class Suspicion:
    """The folded filters of all segments."""

    def __init__(self, segments: int, filters: dict[int, bytes]):
        sizes = np.array([len(filters.get(s, b"")) for s in range(segments)], np.int64)
        self.shift, self.starts = np.uint64(64 - segments.bit_length() + 1), np.concatenate([[0], np.cumsum(sizes)])[:-1]
        self.masks = (np.maximum(sizes * 8, 1) - 1).astype(np.uint64)
        self.known = sizes > 0
        self.bits = np.frombuffer(b"".join(filters.get(s, b"") for s in range(segments)) or b"\0", np.uint8)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each hash may belong to a repeated key."""
        segment = segment_of(hashes, self.shift)
        at = (probes(hashes) & self.masks[segment]).astype(np.int64)
        byte = np.minimum(self.starts[segment] + (at >> 3), len(self.bits) - 1)
        return ((self.bits[byte] >> (at & 7).astype(np.uint8)) & 1).astype(bool).all(0) & self.known[segment]


def segment_of(hashes: np.ndarray, shift: np.uint64) -> np.ndarray:
    return (hashes >> shift).astype(np.int64) if shift < 64 else np.zeros(len(hashes), np.int64)


def _hashes(keys) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64)


def suspicion(docs: DataFrame, chars: int = KEY_CHARS) -> Suspicion:
    """Twice-seen filters of the keys of `docs` (doc_id, text)."""
    lines = docs.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    segments = 1 << max(0, int(lines // SEGMENT_KEYS).bit_length())
    shift, most = np.uint64(64 - segments.bit_length() + 1), max(LEAST_BITS, 8 * FILTER_BYTES // segments)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for part in pieces(batches):
            held += [_hashes(keys_of(text, chars)) for text in byte_texts(part)]
            if sum(map(len, held)) > FLUSH_KEYS:
                yield from block(held)
                held = []
        yield from block(held)

    def block(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        found, times = np.unique(np.concatenate(held or [np.zeros(0, np.uint64)]), return_counts=True)
        owner = segment_of(found, shift)
        for s in np.unique(owner).tolist():
            mine = slice(*np.searchsorted(owner, [s, s + 1]))
            row = [[s], [found[mine].tobytes()], [(times[mine] > 1).tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(row[0], pa.int32()), pa.array(row[1], pa.binary()), pa.array(row[2], pa.binary())], names=["segment", "hashes", "repeated"])

    def build(rows: pa.Table) -> pa.Table:
        seen = SeenTwice()
        for hashes, repeated in zip(rows.column("hashes").to_pylist(), rows.column("repeated").to_pylist()):
            seen.add(np.frombuffer(hashes, np.uint64), np.frombuffer(repeated, bool))
        return pa.table({"segment": rows.column("segment")[:1], "bits": pa.array([seen.folded(most)], pa.binary())})

    blocks = docs.select("text").where("doc_id is not null").mapInArrow(send, "segment int, hashes binary, repeated binary")
    built = blocks.groupBy("segment").applyInArrow(build, "segment int, bits binary")
    return Suspicion(segments, {row.segment: bytes(row.bits) for row in built.collect()})  # FILTER_BYTES at most


# --- lines to drop ---


def repeated_lines(docs: DataFrame, chars: int = KEY_CHARS, least_docs: int = DOCS) -> DataFrame:
    """(doc_id, hash): the lines, by the hash of their key, that a document loses."""
    if least_docs < 2 or chars < 1:
        raise ValueError("a repeated line has a code point at least and is in two documents at least")
    docs = docs.select("doc_id", "text").where("doc_id is not null")
    suspected = suspicion(docs, chars)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            keys = [list(keys_of(text, chars)) for text in byte_texts(part)]
            flat = [key for found in keys for key in found]
            hashes = _hashes(flat)
            at = np.flatnonzero(suspected(hashes))
            owner = np.repeat(np.arange(len(keys)), [len(found) for found in keys])[at]
            texts = pa.array([flat[i] for i in at.tolist()], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(owner)), pa.array(signed(hashes[at])), texts], names=["doc_id", "hash", "key"])

    found = materialize(docs.mapInArrow(suspects, f"doc_id {id_type}, hash long, key string"), "suspects")
    counted = found.groupBy("key").agg(F.count_distinct("doc_id").alias("docs"), F.max("doc_id").alias("kept"))
    # a table of its own, so that the join can split the suspects of a very common line
    kept = materialize(counted.where(F.col("docs") >= least_docs).select("key", "kept"), "repeated")
    return found.join(kept, "key").where("doc_id <> kept").select("doc_id", "hash").distinct()


def _without(text: bytes, gone: set[int], chars: int) -> tuple[bytes, int]:
    """The text without the lines whose keys have these hashes, and their number."""
    lines = text.split(b"\n")
    kept = []
    for line in lines:
        key = line_key(line, chars)
        if key is None or xxhash.xxh3_64_intdigest(key) not in gone:
            kept.append(line)
    return b"\n".join(kept), len(lines) - len(kept)


def _marked(docs: DataFrame, chars: int, least_docs: int, column: str) -> DataFrame:
    """`docs` with the hashes of the lines each row loses."""
    gone = repeated_lines(docs, chars, least_docs).groupBy(F.col("doc_id").alias("_of")).agg(F.collect_list("hash").alias(column))
    return docs.join(gone, docs["doc_id"] == gone["_of"], "left").drop(gone["_of"])


def _shortened(part: pa.RecordBatch, column: str, chars: int) -> tuple[list[bytes], list[int]]:
    texts, dropped = byte_texts(part), [0] * part.num_rows
    lists = part.column(column)
    for i in np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False)).tolist():
        gone = {h % (1 << 64) for h in lists[i].as_py()}
        texts[i], dropped[i] = _without(texts[i], gone, chars)
    return texts, dropped


def dedup(docs: DataFrame, chars: int = KEY_CHARS, least_docs: int = DOCS) -> DataFrame:
    """The rows with all their columns, `text` without the dropped lines; a null text stays null."""
    column = "_gone"
    while column in docs.columns:
        column += "_"
    schema = docs.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            texts, _ = _shortened(part, column, chars)
            text = pc.if_else(part.column("text").is_valid(), pa.array(texts, pa.binary()).cast(pa.string()), pa.scalar(None, pa.string()))
            yield pa.RecordBatch.from_arrays([text if n == "text" else part.column(n) for n in schema.names], names=schema.names)

    return _marked(docs, chars, least_docs, column).mapInArrow(cut, schema)


def digest(docs: DataFrame, chars: int = KEY_CHARS, least_docs: int = DOCS) -> DataFrame:
    """Per row: doc_id, n_lines before dropping, n_dropped, and the SHA-256 of the lines that stay, joined by line feeds."""
    docs = docs.select("doc_id", "text")
    out = StructType([docs.schema["doc_id"], StructField("n_lines", LongType()), StructField("n_dropped", LongType()), StructField("kept_sha256", StringType())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            lines = pc.add(pc.count_substring(texts_of(part), "\n"), 1).cast(pa.int64())
            texts, dropped = _shortened(part, "_gone", chars)
            marks = pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lines, pa.array(dropped, pa.int64()), marks], names=out.names)

    return _marked(docs, chars, least_docs, "_gone").mapInArrow(measure, out)
