"""Words of many texts at once, on Arrow arrays inside tasks.

A word is a run of characters other than space and U+0009..U+000D. Nothing here holds more than one piece of
a batch (`PIECE_BYTES` of text, or one text if that is longer).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

PIECE_BYTES = 4 << 20
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of about `limit` bytes of text; rows stay whole and in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        upto = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = upto[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(upto, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The texts; null counts as empty."""
    return batch.column(column).fill_null("")


class Words:
    """Word numbers of all texts in a row; text i owns `codes[starts[i]:starts[i + 1]]`."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        if lower:
            texts = pc.ascii_lower(texts)
        lists = pc.ascii_split_whitespace(texts)
        flat = lists.flatten().dictionary_encode()
        codes = flat.indices.to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)])
        self.vocabulary: pa.Array = flat.dictionary
        lengths = pc.binary_length(self.vocabulary).to_numpy(zero_copy_only=False)
        empty = np.flatnonzero(lengths == 0)
        if len(empty):  # white space at the ends of a text leaves an empty string
            keep = codes != empty[0]
            ends = np.concatenate([[0], np.cumsum(keep, dtype=np.int64)])[ends]
            codes = codes[keep]
        self.codes, self.starts = codes.astype(np.int64), ends

    def __len__(self) -> int:
        return len(self.codes)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.starts)

    def owner(self) -> np.ndarray:
        """Text number of each word."""
        return np.repeat(np.arange(len(self.starts) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word of the vocabulary, the same in every process."""
        values = self.vocabulary.cast(pa.binary()).to_pylist()
        return np.fromiter((xxhash.xxh3_64_intdigest(v) for v in values), np.uint64, len(values))


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of `values[starts[i]:starts[i + 1]]` for each i; empty ranges give 0."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[starts[1:]] - total[starts[:-1]]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * MIX[1]
        h = (h ^ (h >> np.uint64(27))) * MIX[2]
    return h ^ (h >> np.uint64(31))


def chain(hashes: list[np.ndarray], seed: int = 0) -> np.ndarray:
    """Hash of the sequence of given hashes, position by position."""
    with np.errstate(over="ignore"):
        out = np.full(len(hashes[0]), (seed * int(MIX[0]) + 1) % (1 << 64), np.uint64)
        for h in hashes:
            out = mix(out * MIX[0] + h)
    return out


def signed(h: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return h.view(np.int64)


def table(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


# Patterns of the word traits.
TRAITS = {
    "upper": r"\p{Lu}",
    "symbols": r"[#*$%&|<>]",
    "bangs": r"[!?]",
    "digits": r"[0-9]",
    "stops": r"[.,;:]",
}


def word_traits(vocabulary: pa.Array) -> dict[str, np.ndarray]:
    """Per word of the vocabulary: code points, bytes beyond them, and counts of the kinds in `TRAITS`."""
    chars = pc.utf8_length(vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
    size = pc.binary_length(vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
    out = {"chars": chars, "beyond_ascii": size - chars}
    for name, pattern in TRAITS.items():
        out[name] = pc.count_substring_regex(vocabulary, pattern).to_numpy(zero_copy_only=False).astype(np.int64)
    return out
