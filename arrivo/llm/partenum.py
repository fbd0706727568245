"""N-gram Jaccard join by PartEnum signatures, with the components of its links.

A document is the set of its distinct word shingles, as 64-bit hashes. Sets of equal content are one class. Sizes are
cut into bands so that similar sets lie in one band or in neighbours; a set carries the tags of its band and the next.
Under a tag two similar sets differ in at most k elements. The feature domain (the range of hashes) is cut into n1 parts
of n2 pieces; of n1 > k / (k2 + 1) parts one has at most k2 differences, so the two sets agree on n2 - k2 of its pieces.
Each choice of pieces is a signature: the hash of the elements in them. (`plan` picks the numbers by size.)

Pieces without any element would make all sets of a tag alike. They need no signature as long as a set has at most m
empty choices and the tag has m parts more than it needs: then one of the agreeing choices is not empty. Sets with more
empty choices than that carry them as well.

Candidates. First each set is compared with the smallest set of each of its buckets, then with the one next to it in a
random order of each bucket. After that only pairs in one bucket that lie in different components remain. Of all these,
only pairs whose sizes and parity sketches leave room for a link count; differing bits are a lower bound of the
difference, so nothing similar is lost. Candidates are verified on their whole sets. A group of near copies is joined
before its pairs are asked for, so no step lists the pairs within a group. The last step deals buckets into parts of at
most about `PART_ROWS` sets, past which the other sets of the bucket stream; pairs are judged in the task, and only those
that sizes and sketches allow leave it. The sketches that travel grow with the set, so that large unlike sets do not pass
for similar and the pairs that leave grow with the links and not with the square of a bucket. Sets are made again from the
texts of likely pairs rather than written for all.

Defined results: a text with fewer words than a shingle is one shingle of all its words; a null text or one without
words has an empty set, linked with nothing; repeated rows are one class; the component of null ids alone is null; an
empty table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from arrivo.llm.components import components
from arrivo.llm.words import Words, chain, mix, pieces, signed, texts_of
from arrivo.session import discard, materialize

BRIEF_LONGS = 16  # 64-bit words of the shortest sketch, by which pairs are judged first: sharp for sets of some hundred shingles
CELL_LOAD = 1.5  # elements per cell at most of the sketch that travels with the buckets; from about 2 on unlike sets pass
FINE_BELOW = 256  # sets up to this size get signatures over more elements, since chance agreement is likelier
PART_ROWS = 2048  # sets of a bucket that a task holds at once
KNOWN_SETS = 200_000  # sets that a task remembers having signed


# --- sets ---


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, and where each text starts."""
    words = Words(texts, lower=True)
    hashes, n = words.hashes()[words.codes] if len(words) else np.zeros(0, np.uint64), words.counts
    owner = words.owner()
    first = np.flatnonzero(owner[: len(words) - width + 1] == owner[width - 1 :]) if len(words) >= width else np.zeros(0, np.int64)
    full = chain([hashes[first + i] for i in range(width)]) if len(first) else np.zeros(0, np.uint64)
    found, owners = [full], [owner[first]]
    for short in range(1, width):
        rows = np.flatnonzero(n == short)
        if len(rows):
            found.append(chain([hashes[words.starts[rows] + i] for i in range(short)], seed=short))
            owners.append(rows)
    flat, owner = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(flat, kind="stable")
    order = order[np.argsort(owner[order], kind="stable")]
    flat, owner = flat[order], owner[order]
    fresh = np.concatenate([[True], (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])]) if len(flat) else np.zeros(0, bool)
    flat, owner = flat[fresh], owner[fresh]
    return flat, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))]).astype(np.int64)


def _range_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums modulo 2**64 of the ranges between neighbouring ends."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[ends[1:]] - total[ends[:-1]]


def fingerprints(flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits per set."""
    with np.errstate(over="ignore"):
        return tuple(_range_sums(mix(flat ^ np.uint64(salt)), starts) for salt in (0x243F6A8885A308D3, 0x13198A2E03707344))


def sketches(flat: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Per set: the parity of the number of its elements in each cell, as words of 64 bits.

    The number of cells is a power of two, twice the size of the set or more, so that it tells differences of the order
    of the size; a longer sketch folds into a shorter one.
    """
    sizes = np.diff(starts)
    cells = 1 << np.maximum(np.ceil(np.log2(np.maximum(2 * sizes, 1))), np.log2(64 * BRIEF_LONGS)).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(cells)])
    cell = (mix(flat) & np.repeat((cells - 1).astype(np.uint64), sizes)).astype(np.int64) + np.repeat(ends[:-1], sizes)
    parity = (np.bincount(cell, minlength=ends[-1]) & 1).astype(np.uint8)
    words = np.packbits(parity, bitorder="little").view(np.uint64)
    return [words[a // 64 : b // 64] for a, b in zip(ends[:-1], ends[1:])]


def folded(sketch: np.ndarray, longs: int) -> np.ndarray:
    """The sketch of the same set with fewer cells."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, longs), axis=0)


def travelling(sketch: np.ndarray, size: int) -> np.ndarray:
    """The shortest fold of a set's sketch that still tells it from unlike sets."""
    longs = BRIEF_LONGS
    while 64 * longs * CELL_LOAD < size:
        longs *= 2
    return folded(sketch, longs)


def least_difference(x: np.ndarray, y: np.ndarray) -> int:
    """Elements in which two sets with these sketches differ at least."""
    longs = min(len(x), len(y))
    return int(np.bitwise_count(folded(x, longs) ^ folded(y, longs)).sum())


# --- signatures ---


def bands(threshold: int, largest: int) -> np.ndarray:
    """Largest size of each band; similar sets lie in the same or in neighbouring bands."""
    out, low = [], 1
    while not out or out[-1] < largest:
        out.append(low * 100 // threshold)
        low = out[-1] + 1
    return np.array(out, np.int64)


def most_different(threshold: int, sizes) -> np.ndarray:
    """Elements in which two similar sets whose sizes add up to `sizes` can differ."""
    return (100 - threshold) * sizes // (100 + threshold)


def plan(threshold: int, top: int) -> tuple[int, int, int, int]:
    """n1, n2, k2 and the spare parts m of the tag whose sets have at most `top` elements."""
    k = int(most_different(threshold, 2 * top))
    n2, k2 = (3, 1) if top <= FINE_BELOW else (1, 0)
    need = k // (k2 + 1) + 1
    if k == 0:
        return 1, 1, 0, 0
    empty = need * np.exp(-threshold / 100 * top / need * (n2 - k2) / n2) * (n2 if k2 else 1)
    spare = int(np.ceil(empty + 3 * np.sqrt(empty) + 0.5))
    return need + spare, n2, k2, spare


def signatures(flat: np.ndarray, starts: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of all sets, and the number of the set each belongs to."""
    sizes = np.diff(starts)
    found, owners = [], []
    if not len(flat):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    tops = bands(threshold, int(sizes.max()))
    tops = np.append(tops, (tops[-1] + 1) * 100 // threshold)
    band = np.searchsorted(tops, sizes)
    with np.errstate(over="ignore"):
        content = mix(flat ^ np.uint64(0xA4093822299F31D0))
    for tag in np.unique(np.concatenate([band[sizes > 0], band[sizes > 0] + 1])):
        rows = np.flatnonzero((sizes > 0) & ((band == tag) | (band == tag - 1)))
        n1, n2, k2, spare = plan(threshold, int(tops[tag]))
        size = sizes[rows]
        ends = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(ends[-1]) + np.repeat(starts[rows] - ends[:-1], size)
        # hashes ascend within a set, so the elements of a piece are neighbours
        piece = ((flat[at] >> np.uint64(32)) * np.uint64(n1 * n2)) >> np.uint64(32)
        slot = np.repeat(np.arange(len(rows)) * (n1 * n2), size) + piece.astype(np.int64)
        number = np.bincount(slot, minlength=len(rows) * n1 * n2)
        sums = _range_sums(content[at], np.concatenate([[0], np.cumsum(number)])).reshape(len(rows), n1, n2)
        number = number.reshape(len(rows), n1, n2)
        choices = list(combinations(range(n2), n2 - k2))
        with np.errstate(over="ignore"):
            chosen = np.stack([sums[:, :, list(c)].sum(2, dtype=np.uint64) for c in choices], 2)
            label = chain([np.full(n1 * len(choices), tag, np.uint64), np.arange(n1 * len(choices), dtype=np.uint64)]).reshape(n1, len(choices))
            signature = mix(chosen ^ label)
        filled = np.stack([number[:, :, list(c)].sum(2) > 0 for c in choices], 2)
        # a part counts as empty if any of its choices is: the agreeing choice might be that one
        hollow = (~filled).any(2).sum(1) > spare
        keep = filled | hollow[:, None, None]
        found.append(signature[keep])
        owners.append(np.repeat(rows, keep.reshape(len(rows), -1).sum(1)))
    return np.concatenate(found), np.concatenate(owners)


# --- pairs within buckets ---


@dataclass
class Sets:
    """Rows of buckets, those of one part next to each other and its own before the guests."""

    group: np.ndarray
    own: np.ndarray
    known: np.ndarray  # rows that have been compared with each other already
    set: np.ndarray
    n: np.ndarray
    brief: np.ndarray
    longer: np.ndarray  # the sketch that came, where it is longer than the brief one; else none
    root: np.ndarray

    def take(self, rows: np.ndarray) -> "Sets":
        return Sets(*(getattr(self, f.name)[rows] for f in fields(self)))

    def followed_by(self, other: "Sets") -> "Sets":
        return Sets(*(np.concatenate([getattr(x, f.name) for x in (self, other)]) for f in fields(self)))

    def _near(self, x: np.ndarray, y: np.ndarray, threshold: int) -> np.ndarray:
        """Which of the pairs of rows the longer sketches leave room for, on the length that both have."""
        near = np.ones(len(x), bool)
        longs = np.array([BRIEF_LONGS if s is None else len(s) for s in self.longer[np.concatenate([x, y])]], np.int64).reshape(2, -1).min(0)
        for length in np.unique(longs[longs > BRIEF_LONGS]).tolist():
            at = np.flatnonzero(longs == length)
            rows, place = np.unique(np.concatenate([x[at], y[at]]), return_inverse=True)
            marks = np.stack([folded(s, length) for s in self.longer[rows]])
            odd = np.bitwise_count(marks[place[: len(at)]] ^ marks[place[len(at) :]]).sum(1, dtype=np.int64)
            near[at] = (100 + threshold) * odd <= (100 - threshold) * (self.n[x[at]] + self.n[y[at]])
        return near

    def pairs(self, threshold: int, reach: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows (i, j) of one part, in different components, whose sizes and sketches leave room for a link.

        With `reach`, only rows that lie no more than that many places apart.
        """
        found = [(np.zeros(0, np.int64),) * 2]
        i, away = np.flatnonzero(self.own), 0
        while len(i) and away != reach:  # all rows that lie `away` places apart, until no part is that long
            away += 1
            i = i[i + away < len(self.group)]
            i = i[self.group[i] == self.group[i + away]]
            j = i + away
            a, b = self.n[i], self.n[j]
            open_ = (self.root[i] != self.root[j]) & ~(self.known[i] & self.known[j])
            open_ &= 100 * np.minimum(a, b) >= threshold * np.maximum(a, b)
            x, y = i[open_], j[open_]
            odd = np.bitwise_count(self.brief[x] ^ self.brief[y]).sum(1, dtype=np.int64)
            near = (100 + threshold) * odd <= (100 - threshold) * (self.n[x] + self.n[y])
            x, y = x[near], y[near]
            near = self._near(x, y, threshold)
            found.append((x[near], y[near]))
        return tuple(np.concatenate(side) for side in zip(*found))


def received(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The brief sketch of each row, and the longer one it was folded from where one came."""
    values, lengths = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64), column.value_lengths().to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    brief, longer = np.empty((len(lengths), BRIEF_LONGS), np.uint64), np.full(len(lengths), None, object)
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        marks = values[ends[rows][:, None] + np.arange(length)]
        brief[rows] = np.bitwise_xor.reduce(marks.reshape(len(rows), -1, BRIEF_LONGS), axis=1)
        if length > BRIEF_LONGS:
            for row, mark in zip(rows.tolist(), marks):
                longer[row] = mark
    return brief, longer


def compared(batches: Iterator[pa.RecordBatch], threshold: int, reach: int | None = None) -> Iterator[pa.RecordBatch]:
    """Candidate pairs (a, b, ra, rb) from rows sorted by signature, part and owner; a part may reach over batches.

    With `reach`, which supposes that all rows are their part's own, rows further apart in the order are not compared.
    """
    held, last, number = None, None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        column = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
        signature, part = column("signature"), column("part")
        fresh = np.concatenate([[(signature[0], part[0]) != last], (signature[1:] != signature[:-1]) | (part[1:] != part[:-1])])
        last = signature[-1], part[-1]
        group = number + np.cumsum(fresh)
        number = int(group[-1])
        rows = Sets(group, column("own").astype(bool), np.zeros(len(group), bool), column("class"), column("n"), *received(batch.column("brief")), column("root"))
        if held is not None:
            rows = held.followed_by(rows)
        i, j = rows.pairs(threshold, reach)
        swap = rows.set[i] > rows.set[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        if len(i):
            found = np.unique(np.stack([rows.set[i], rows.set[j], rows.root[i], rows.root[j]], 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.ascontiguousarray(found.T)], names=["a", "b", "ra", "rb"])
        held = rows.take(np.flatnonzero(rows.own & (rows.group == number))[-(reach or len(rows.group)) :])
        held.known[:] = True


# --- the join ---


def first_row():
    """Aggregate: doc_id and text_hash of one row, the smallest; a null id comes after all others."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash"))


@dataclass(frozen=True)
class WantedSets:
    """Sets of texts, of which only those are wanted that have the fingerprints asked for."""

    width: int

    def __call__(self, part: pa.RecordBatch, known: set[tuple]) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Sets of the texts, and the rows whose set is wanted and not `known` yet."""
        flat, starts = shingle_sets(texts_of(part), self.width)
        keys = zip(*[signed(f).tolist() for f in fingerprints(flat, starts)])
        rows = []
        for i, (key, want) in enumerate(zip(keys, zip(part.column("f1").to_pylist(), part.column("f2").to_pylist()))):
            if key == want and key not in known:
                rows.append(i)
                known.add(key)
        if len(known) > KNOWN_SETS:
            known.clear()
        return flat, starts, rows


class Join:
    """Sets, classes, links and components of the documents (doc_id, text)."""

    def __init__(self, docs: DataFrame, width: int = 4, threshold: int = 85):
        if not 1 <= threshold <= 100 or width < 1:
            raise ValueError("the threshold is a percentage and a shingle has a word at least")
        self.docs, self.width, self.threshold = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), width, threshold
        self.id_type = docs.schema["doc_id"].dataType.simpleString()
        self.sets = materialize(self._sets(), "sets")
        grouped = self.sets.where("n > 0").groupBy("n", "f1", "f2").agg(first_row().alias("_first")).select("n", "f1", "f2", "_first.doc_id", "_first.text_hash")
        self.classes = materialize(grouped.withColumn("class", F.monotonically_increasing_id()), "classes")

    def _sets(self) -> DataFrame:
        width = self.width

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in pieces(batches):
                flat, starts = shingle_sets(texts_of(part), width)
                f1, f2 = fingerprints(flat, starts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array(np.diff(starts)), pa.array(signed(f1)), pa.array(signed(f2))],
                    names=["doc_id", "text_hash", "n", "f1", "f2"],
                )

        return self.docs.mapInArrow(measure, f"doc_id {self.id_type}, text_hash long, n long, f1 long, f2 long")

    def _buckets(self) -> DataFrame:
        """Rows (signature, set, smallest set) of the signatures that more than one set carries.

        A task signs each set once, so that copies weigh no more than the number of tasks.
        """
        width, threshold = self.width, self.threshold

        def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known: set[int] = set()
            for part in pieces(batches, limit=2 << 20):
                flat, starts = shingle_sets(texts_of(part), width)
                f1, _ = fingerprints(flat, starts)
                found, owner = signatures(flat, starts, threshold)
                fresh = np.zeros(len(f1), bool)
                for i, f in enumerate(f1.tolist()):
                    fresh[i] = f not in known
                    known.add(f)
                if len(known) > KNOWN_SETS:
                    known = set()
                mine = fresh[owner]
                found, owner = found[mine], owner[mine]
                for at in range(0, len(found), 200_000):
                    cut = slice(at, at + 200_000)
                    yield pa.RecordBatch.from_arrays([pa.array(signed(found[cut])), pa.array(signed(f1[owner[cut]]))], names=["signature", "f1"])

        same = Window.partitionBy("signature")
        rows = self.docs.select("text").mapInArrow(sign, "signature long, f1 long")
        rows = rows.select("*", F.min("f1").over(same).alias("least"), F.max("f1").over(same).alias("_most"))
        return rows.where("least < _most").drop("_most").distinct()

    def _texts(self, classes: DataFrame) -> DataFrame:
        """Text of one document of each of these classes, with the columns by which its set is known."""
        d, w = self.docs.alias("d"), classes.select("doc_id", "text_hash", "class", "f1", "f2").alias("w")
        same = (F.col("d.text_hash") == F.col("w.text_hash")) & F.col("d.doc_id").eqNullSafe(F.col("w.doc_id"))
        return d.join(w, same).select("d.text", "w.class", "w.f1", "w.f2")

    def _candidate_sets(self, buckets: DataFrame) -> DataFrame:
        """Sizes and sketches of the classes that share a signature, each once."""
        whole = WantedSets(self.width)

        def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known: set[tuple] = set()
            for part in pieces(batches, limit=2 << 20):
                flat, starts, rows = whole(part, known)
                marks, sizes = sketches(flat, starts), np.diff(starts)
                longs = [pa.array([f(i).view(np.int64) for i in rows], pa.list_(pa.int64())) for f in (lambda i: folded(marks[i], BRIEF_LONGS), lambda i: travelling(marks[i], sizes[i]))]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(c).take(pa.array(rows, pa.int64())) for c in ("class", "f1")], pa.array(sizes[rows]),
                        *longs, pa.array([marks[i].tobytes() for i in rows], pa.binary()),
                    ],
                    names=["class", "f1", "n", "brief", "travel", "sketch"],
                )

        wanted = self.classes.join(buckets.select("f1").distinct(), "f1", "left_semi")
        found = self._texts(wanted).mapInArrow(collect, "class long, f1 long, n long, brief array<long>, travel array<long>, sketch binary")
        return found.dropDuplicates(["class"])

    def _elements(self, classes: DataFrame) -> DataFrame:
        """(class, elements) of these classes, each once."""
        whole = WantedSets(self.width)

        def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known: set[tuple] = set()
            for part in pieces(batches, limit=2 << 20):
                flat, starts, rows = whole(part, known)
                sets = [flat[starts[i] : starts[i + 1]].tobytes() for i in rows]
                yield pa.RecordBatch.from_arrays([part.column("class").take(pa.array(rows, pa.int64())), pa.array(sets, pa.binary())], names=["class", "elements"])

        return self._texts(classes).mapInArrow(collect, "class long, elements binary").dropDuplicates(["class"])

    def _fits(self, left: str, right: str):
        """Whether the sizes leave room for a link."""
        a, b = F.col(f"{left}.n"), F.col(f"{right}.n")
        return 100 * F.least(a, b) >= self.threshold * F.greatest(a, b)

    def _possible(self, left: str, right: str):
        """Whether sizes and brief sketches leave room for a link."""
        odd = sum(F.bit_count(F.col(f"{left}.brief")[i].bitwiseXOR(F.col(f"{right}.brief")[i])) for i in range(BRIEF_LONGS))
        return self._fits(left, right) & ((100 + self.threshold) * odd <= (100 - self.threshold) * (F.col(f"{left}.n") + F.col(f"{right}.n")))

    def _likely(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs that the whole sketches do not rule out."""
        threshold = self.threshold

        def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = []
                for i, size in enumerate(batch.column("size").to_pylist()):
                    x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in ("x", "y"))
                    keep.append((100 + threshold) * least_difference(x, y) <= (100 - threshold) * size)
                yield batch.select(["a", "b", "ra", "rb"]).filter(pa.array(keep, pa.bool_()))

        marks = sets.select("class", "n", "brief", "sketch")
        p, l, r = pairs.alias("p"), marks.alias("l"), marks.alias("r")
        both = p.join(l, F.col("p.a") == F.col("l.class")).join(r, F.col("p.b") == F.col("r.class")).where(self._possible("l", "r"))
        rows = both.select("p.a", "p.b", "p.ra", "p.rb", F.col("l.sketch").alias("x"), F.col("r.sketch").alias("y"), (F.col("l.n") + F.col("r.n")).alias("size"))
        return rows.mapInArrow(weigh, "a long, b long, ra long, rb long")

    def _verified(self, pairs: DataFrame, elements: DataFrame) -> DataFrame:
        """Links among candidate pairs of classes (a, b, with their roots), on whole sets."""
        threshold = self.threshold

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = []
                for i in range(batch.num_rows):
                    x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in ("x", "y"))
                    place = np.minimum(np.searchsorted(y, x), len(y) - 1)
                    common = int((y[place] == x).sum())
                    keep.append(100 * common >= threshold * (len(x) + len(y) - common))
                yield batch.select(["a", "b", "ra", "rb"]).filter(pa.array(keep, pa.bool_()))

        first = elements.select(F.col("class").alias("a"), F.col("elements").alias("x"))
        second = elements.select(F.col("class").alias("b"), F.col("elements").alias("y"))
        rows = pairs.join(first, "a").join(second, "b").select("a", "b", "ra", "rb", "x", "y")
        return rows.mapInArrow(compare, "a long, b long, ra long, rb long")

    def _open(self, buckets: DataFrame, known: DataFrame) -> DataFrame:
        """Rows (signature, class, root) of the buckets in which sets of different components meet.

        The smallest set of a bucket has been compared with all others and is left out, so a bucket of two is done.
        """
        same = Window.partitionBy("signature")
        rows = buckets.where("f1 <> least").select("signature", "f1").join(known, "f1").drop("f1")
        rows = rows.select("*", F.min("root").over(same).alias("_low"), F.max("root").over(same).alias("_high"))
        return materialize(rows.where("_low < _high").drop("_low", "_high"), "open")

    def _judged(self, rows: DataFrame, sets: DataFrame, keys: list[str], order: list, reach: int | None = None) -> DataFrame:
        """Candidates among the rows of equal keys, judged in the task by the sketches that travel only there."""
        threshold = self.threshold
        marked = rows.join(sets.select("class", "n", F.col("travel").alias("brief")), "class")
        ordered = marked.select("signature", "part", "own", "class", "n", "brief", "root").repartition(*keys).sortWithinPartitions(*keys, *order)
        return ordered.mapInArrow(lambda batches: compared(batches, threshold, reach), "a long, b long, ra long, rb long").distinct()

    def _neighbours(self, rows: DataFrame, sets: DataFrame) -> DataFrame:
        """Candidates among the sets next to each other in a random order of every open bucket.

        Their number is that of the rows, however large a bucket is; a set lies in many buckets and so meets many others
        of its group, which joins a group of near copies without its pairs.
        """
        whole = rows.withColumn("part", F.lit(0)).withColumn("own", F.lit(True))
        return self._judged(whole, sets, ["signature"], [F.xxhash64("class", "signature"), "class"], reach=1)

    def _within(self, rows: DataFrame, sets: DataFrame) -> DataFrame:
        """Candidates among all that is left of the open buckets: each part meets itself and the later parts."""
        sizes = rows.groupBy("signature").agg(F.ceil(F.count("*") / PART_ROWS).cast("int").alias("parts"))
        dealt = rows.join(sizes, "signature").withColumn("home", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
        dealt = dealt.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("home")))).withColumn("own", F.col("part") == F.col("home"))
        return self._judged(dealt, sets, ["signature", "part"], [F.desc("own")])

    def _ordered(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) of classes with their roots, each once, from rows with `l` and `r`."""
        ends = F.array_sort(F.array(*[F.struct(F.col(f"{x}.class").alias("c"), F.col(f"{x}.root").alias("r")) for x in "lr"]))
        both = pairs.select(ends.alias("e"))
        return both.select(F.col("e")[0]["c"].alias("a"), F.col("e")[1]["c"].alias("b"), F.col("e")[0]["r"].alias("ra"), F.col("e")[1]["r"].alias("rb")).distinct()

    def _joined(self, pairs: DataFrame, sets: DataFrame, known: DataFrame) -> DataFrame:
        """`known` with the roots that the links among the candidate pairs bring together.

        Each sieve writes what it lets through, so that the shuffles of the one before are gone when whole sets move.
        """
        pairs = materialize(pairs, "pairs")
        likely = materialize(self._likely(pairs, sets), "likely")
        discard(pairs)
        ends = likely.select(F.col("a").alias("class")).unionByName(likely.select(F.col("b").alias("class"))).distinct()
        elements = materialize(self._elements(self.classes.join(ends, "class", "left_semi")), "elements")
        links = self._verified(likely, elements).select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        found = components(links).withColumnRenamed("root", "_joint")
        discard(likely, elements)
        moved = known.join(found, F.col("root") == F.col("node"), "left")
        written = materialize(moved.withColumn("root", F.coalesce("_joint", "root")).drop("node", "_joint"), "roots")
        discard(found)
        return written

    def components(self) -> DataFrame:
        """(class, root) for the classes that share a signature with another; the root is one of them."""
        buckets = materialize(self._buckets(), "buckets")
        sets = materialize(self._candidate_sets(buckets), "candidates")
        known = sets.select("class", "f1", F.col("class").alias("root"))
        firsts = buckets.where("f1 <> least").select("f1", "least").distinct().alias("p")
        ends = sets.select("f1", "n", "class", F.col("class").alias("root"))
        paired = firsts.join(ends.alias("l"), F.col("p.f1") == F.col("l.f1")).join(ends.alias("r"), F.col("p.least") == F.col("r.f1"))
        known = self._joined(self._ordered(paired.where(self._fits("l", "r"))), sets, known)
        # a round's tables go when the next roots are written
        for candidates in (self._neighbours, self._within):
            rows, before = self._open(buckets, known), known
            known = self._joined(candidates(rows, sets), sets, before)
            discard(rows, before)
        discard(buckets, sets)
        return known.select("class", "root")

    def documents(self) -> DataFrame:
        """Per document row: doc_id, n_shingles, component_id, group (equal for linked documents), text_hash."""
        named = self.classes.join(self.components().distinct(), "class", "left").withColumn("group", F.coalesce("root", "class"))
        smallest = named.groupBy("group").agg(F.min("doc_id").alias("component_id"))
        member = named.select("n", "f1", "f2", "group").join(smallest, "group")
        s, m = self.sets.alias("s"), member.alias("m")
        joined = s.join(m, (F.col("s.f1") == F.col("m.f1")) & (F.col("s.f2") == F.col("m.f2")) & (F.col("s.n") == F.col("m.n")), "left")
        own = F.when(F.col("s.n") > 0, F.col("m.component_id")).otherwise(F.col("s.doc_id"))
        return joined.select("s.doc_id", F.col("s.n").alias("n_shingles"), own.alias("component_id"), "m.group", "s.text_hash")


def one_of_each(docs: DataFrame, width: int, threshold: int) -> DataFrame:
    """The rows, with all columns, of one document per component: the smallest id, and of its texts the smallest hash.

    A row without id is kept only where no document of the component has one. Documents with an empty set stay, each once.
    """
    found = Join(docs, width, threshold).documents()
    best = found.where(F.col("group").isNotNull()).groupBy("group").agg(first_row().alias("_first"))
    empty = found.where(F.col("group").isNull()).select("doc_id", "text_hash")
    kept = best.select("_first.doc_id", "_first.text_hash").unionByName(empty).distinct()
    kept = materialize(kept.select(F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_hash")), "kept")
    discard(found)
    key = F.xxhash64("text")
    same = docs["doc_id"].eqNullSafe(kept["_kept_id"]) & (key == kept["_kept_hash"])
    return docs.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"])
