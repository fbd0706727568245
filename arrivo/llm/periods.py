"""Periodic runs of words, found by internal pattern matching.

A run is a stretch of consecutive words with smallest period q, words q apart being identical, that no neighbouring word
extends, of at least `LEAST_WORDS` words and `EXPONENT` periods.

Per document: a suffix array by prefix doubling gives every block of 2^l words the range of suffixes that begin with it. A
wavelet tree over the suffix array answers the range successor: where does this block occur next? Blocks start at every
half block length m/2. A run of period q, m/2 < q <= m, holds a block whose next occurrence is q words on, as it has 4q
words, 6 at least (the smallest blocks, of four words, see periods 1 to 4); and if the next occurrence of a block lies d <= m
words on, then d is the smallest period of that stretch. So one query a block suffices. Blocks of one level whose next
occurrences are equally far form a progression: one stretch, which ends within half a block beyond its outer blocks.

All documents of a piece of a batch share one suffix array and one tree, in which they never meet. Suffixes that are told
apart from all others of their document leave the doubling early, and only suffixes that share four words enter the tree.

Defined results: null texts and texts without words have no run; each row is a document of its own, so repeated rows or
ids give repeated results; an empty table gives an empty result; further columns are kept by `collapse` and not looked at.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from arrivo.llm.words import Words, pieces, texts_of

LEAST_WORDS = 6
EXPONENT = 4
SMALLEST_BLOCK = 4
PIECE_BYTES = 2 << 20


# --- suffix array ---


@dataclass
class Blocks:
    """Repeated blocks of one length: where they start, and the range of the suffix array that begins with them."""

    length: int
    at: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _grouped(keys: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ascending keys in the given slots: the slot at which each key's group starts, and the group's size."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(first, len(keys)))
    return np.repeat(slots[first], sizes), np.repeat(sizes, sizes)


def _levels(longest: int) -> int:
    """Largest block length that a document of so many words needs: a period beyond half of it fits `EXPONENT` times."""
    m = SMALLEST_BLOCK
    while EXPONENT * (m + 1) <= longest:
        m *= 2
    return m


def repeated_blocks(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[Blocks]]:
    """Suffix array of all documents and their repeated blocks.

    Document i owns `codes[starts[i]:starts[i + 1]]`. Returns the suffixes that share `SMALLEST_BLOCK` words with another
    of their document, in the order of the suffix array (to the depth of the longest block), their slots in it, and the
    blocks per length. Ranges of blocks are slots.
    """
    n, counts = len(codes), np.diff(starts)
    owner = np.repeat(np.arange(len(counts)), counts)
    end = np.repeat(starts[1:], counts)
    local = np.arange(n) - starts[owner]
    alphabet = int(codes.max()) + 2 if n else 2
    follow = np.zeros(n, np.int64)
    inside = np.flatnonzero(np.arange(1, n + 1) < end)
    follow[inside] = codes[inside + 1] + 1
    if len(counts) * alphabet * alphabet >= 1 << 63:
        raise OverflowError("too many distinct words in one piece")
    keys = (owner * alphabet + codes) * alphabet + follow
    suffixes = np.argsort(keys, kind="stable")
    name, size = _grouped(keys[suffixes], np.arange(n))
    rank = np.empty(n, np.int64)
    rank[suffixes] = name
    long = counts[owner] >= LEAST_WORDS
    slots = np.flatnonzero((size > 1) & long[suffixes])
    blocks, m, shared = [], 2, None
    deepest = _levels(int(counts.max())) if n else 0
    while len(slots) and m < deepest:
        at = suffixes[slots]
        beyond = at + m
        second = np.where(beyond < end[at], rank[np.minimum(beyond, n - 1)] + 1, 0)
        keys = rank[at] * (n + 1) + second
        order = np.argsort(keys, kind="stable")
        at, keys = at[order], keys[order]
        suffixes[slots] = at
        name, size = _grouped(keys, slots)
        rank[at] = name
        m *= 2
        again = size > 1
        if shared is None:
            shared = slots[again]
        inner = again & (local[at] % (m // 2) == 0)
        if inner.any():
            blocks.append(Blocks(m, at[inner], name[inner], (name + size)[inner]))
        # blocks of twice the length serve documents that hold a longer period four times
        slots = slots[again & (counts[owner[at]] >= EXPONENT * (m + 1))]
    if shared is None:
        shared = np.zeros(0, np.int64)
    return suffixes[shared], shared, blocks


# --- wavelet tree ---


class WaveletTree:
    """Sequence of numbers, level by level: bit after bit, zeros before ones, with the count of zeros before each place."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max()).bit_length()) if len(values) else 1
        self.zeros: list[np.ndarray] = []
        for b in reversed(range(self.bits)):
            one = (values >> b & 1).astype(bool)
            self.zeros.append(np.concatenate([[0], np.cumsum(~one)]))
            values = np.concatenate([values[~one], values[one]])

    def _smaller(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many numbers of the range are smaller than x."""
        count = np.zeros(len(x), np.int64)
        for level, zeros in enumerate(self.zeros):
            one = (x >> (self.bits - 1 - level) & 1).astype(bool)
            a, b = zeros[low], zeros[high]
            count += np.where(one, b - a, 0)
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return count

    def _ranked(self, low: np.ndarray, high: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The number at the given place (from 0) of the range in ascending order."""
        found = np.zeros(len(place), np.int64)
        for level, zeros in enumerate(self.zeros):
            a, b = zeros[low], zeros[high]
            one = place >= b - a
            found |= one.astype(np.int64) << (self.bits - 1 - level)
            place = np.where(one, place - (b - a), place)
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return found

    def successor(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Smallest number of each range `[low, high)` that is x or more; -1 if there is none."""
        reachable = x < 1 << self.bits
        place = np.where(reachable, self._smaller(low, high, np.where(reachable, x, 0)), high - low)
        found = np.full(len(x), -1, np.int64)
        has = np.flatnonzero(place < high - low)
        found[has] = self._ranked(low[has], high[has], place[has])
        return found


# --- runs ---


@dataclass
class Runs:
    """Runs of all documents in a row, by first word and period; `start` counts over all documents."""

    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def _matching(codes: np.ndarray, at: np.ndarray, distance: np.ndarray, limit: np.ndarray, reach: int, step: int) -> np.ndarray:
    """How many words on from `at`, in steps of `step`, equal the word `distance` away, up to `limit` and `reach`."""
    offset = np.arange(reach)
    inside = offset < limit[:, None]
    where = np.where(inside, at[:, None] + step * offset, 0)
    same = inside & (codes[where] == codes[np.where(inside, where + distance[:, None], 0)])
    return np.where(same.all(1), reach, same.argmin(1))


def find(codes: np.ndarray, starts: np.ndarray, least: int = LEAST_WORDS, exponent: int = EXPONENT) -> Runs:
    """All runs of at least `least` words and `exponent` periods."""
    if least < LEAST_WORDS or exponent < EXPONENT:
        raise ValueError(f"blocks are laid out for runs of {LEAST_WORDS} words and {EXPONENT} periods at least")
    suffixes, slots, blocks = repeated_blocks(codes, starts)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if blocks:
        owner = np.searchsorted(starts, np.arange(len(codes)), side="right") - 1
        tree = WaveletTree(suffixes - starts[owner[suffixes]])
    for level in blocks:
        m, half = level.length, level.length // 2
        order = np.argsort(level.at)
        at = level.at[order]
        document = owner[at]
        low, high = np.searchsorted(slots, level.low[order]), np.searchsorted(slots, level.high[order])
        place = at - starts[document]
        distance = tree.successor(low, high, place + 1) - place
        near = (distance > (0 if m == SMALLEST_BLOCK else half)) & (distance <= m)
        at, distance, document = at[near], distance[near], document[near]
        if not len(at):
            continue
        # progressions: neighbouring blocks whose next occurrences are equally far
        goes_on = (at[1:] == at[:-1] + half) & (distance[1:] == distance[:-1]) & (document[1:] == document[:-1])
        first, last = np.flatnonzero(np.concatenate([[True], ~goes_on])), np.flatnonzero(np.concatenate([~goes_on, [True]]))
        left, right, d, document = at[first], at[last] + m + distance[last], distance[first], document[first]
        left = left - _matching(codes, left - 1, d, left - starts[document], half, -1)
        right = right + _matching(codes, right, -d, starts[document + 1] - right, half, 1)
        enough = right - left >= np.maximum(least, exponent * d)
        found.append((left[enough], (right - left)[enough], d[enough]))
    start, length, period = (np.concatenate([f[i] for f in found] or [np.zeros(0, np.int64)]) for i in range(3))
    order = np.lexsort((period, start))
    return Runs(start[order], length[order], period[order])


def superfluous(runs: Runs, n: int) -> np.ndarray:
    """Words that lie in a run after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs.start + runs.period, 1)
    np.add.at(change, runs.start + runs.length, -1)
    return np.cumsum(change)[:n] > 0


# --- documents ---


def planted(codes: np.ndarray, starts: np.ndarray, ids: list) -> np.ndarray:
    """The words with a repetition planted in one of ten documents, chosen and shaped by the CRC-32 of the id."""
    source = np.arange(len(codes))
    for i, doc in enumerate(ids):
        n = int(starts[i + 1] - starts[i])
        h = zlib.crc32(str(doc).encode()) if doc is not None else 1  # no id: left as it is
        if h % 10 or not n:
            continue
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        source[starts[i] + a : starts[i + 1]] = starts[i] + a + np.arange(n - a) % p
    return codes[source]


class Document:
    """Words, runs and kept words of the texts of a piece."""

    def __init__(self, part: pa.RecordBatch, plant: bool = False, least: int = LEAST_WORDS, exponent: int = EXPONENT):
        words = Words(texts_of(part))
        self.vocabulary, self.starts = words.vocabulary, words.starts
        self.codes = planted(words.codes, words.starts, part.column("doc_id").to_pylist()) if plant else words.codes
        self.runs = find(self.codes, self.starts, least, exponent)
        # runs of document i are [bounds[i], bounds[i + 1])
        self.bounds = np.searchsorted(self.runs.start, self.starts)

    def collapsed(self) -> pa.Array:
        """Texts of the words that stay, joined by one space."""
        keep = ~superfluous(self.runs, len(self.codes))
        ends = np.concatenate([[0], np.cumsum(keep)])[self.starts]
        words = self.vocabulary.take(pa.array(self.codes[keep]))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words), " ")

    def lists(self) -> list[str]:
        """Per document: its runs as lines `start,length,period`, by start and period."""
        owner = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.bounds))
        lines = [f"{s},{n},{q}\n" for s, n, q in zip((self.runs.start - self.starts[owner]).tolist(), self.runs.length.tolist(), self.runs.period.tolist())]
        return ["".join(lines[a:b]) for a, b in zip(self.bounds[:-1], self.bounds[1:])]

    def longest(self) -> list[int | None]:
        """Number of the longest run of each document; the smallest start, then period, among equals."""
        lengths = self.runs.length
        return [a + int(lengths[a:b].argmax()) if b > a else None for a, b in zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist())]


def find_runs(docs: DataFrame, least: int = LEAST_WORDS, exponent: int = EXPONENT) -> DataFrame:
    """(doc_id, start, length, period) of every run; words are numbered from 0."""
    docs = docs.select("doc_id", "text")
    out = StructType([docs.schema["doc_id"], *(StructField(c, LongType()) for c in ("start", "length", "period"))])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, limit=PIECE_BYTES):
            whole = Document(part, least=least, exponent=exponent)
            owner = np.repeat(np.arange(part.num_rows), np.diff(whole.bounds))
            start = whole.runs.start - whole.starts[owner]
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(owner)), *map(pa.array, (start, whole.runs.length, whole.runs.period))], names=out.names)

    return docs.mapInArrow(runs, out)


def collapse(docs: DataFrame, least: int = LEAST_WORDS, exponent: int = EXPONENT) -> DataFrame:
    """The rows with all their columns; a text with a run keeps its first period only, words joined by one space.

    Texts without a run stay as they are.
    """
    schema = docs.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, limit=PIECE_BYTES):
            whole = Document(part, least=least, exponent=exponent)
            text = pc.if_else(pa.array(np.diff(whole.bounds) > 0), whole.collapsed(), part.column("text"))
            yield pa.RecordBatch.from_arrays([text if n == "text" else part.column(n) for n in schema.names], names=schema.names)

    return docs.mapInArrow(cut, schema)


def digest(docs: DataFrame, plant: bool = False) -> DataFrame:
    """Per row: doc_id, n_runs, the longest run, and SHA-256 of all its runs and of the words that stay.

    `plant` first repeats words in one of ten documents (`planted`).
    """
    docs = docs.select("doc_id", "text")
    numbers = ("n_runs", "start", "length", "period", "exponent_milli")
    out = StructType([docs.schema["doc_id"], *(StructField(c, LongType()) for c in numbers), *(StructField(c, StringType()) for c in ("runs_sha256", "collapsed_sha256"))])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, limit=PIECE_BYTES):
            whole = Document(part, plant)
            runs, best = whole.runs, pa.array(whole.longest(), pa.int64())
            owner = np.repeat(np.arange(part.num_rows), np.diff(whole.bounds))
            columns = [runs.start - whole.starts[owner], runs.length, runs.period, 1000 * runs.length // np.maximum(runs.period, 1)]
            marks = [hashlib.sha256(s.encode()).hexdigest() for s in whole.lists()]
            texts = [hashlib.sha256(t).hexdigest() for t in whole.collapsed().cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(whole.bounds)), *(pa.array(c).take(best) for c in columns), pa.array(marks, pa.string()), pa.array(texts, pa.string())],
                names=out.names,
            )

    return docs.mapInArrow(measure, out)
