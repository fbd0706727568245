"""Spelling variants: frequent words one edit apart, found with blocked Gram matrices of letter counts.

Words are runs of A-Z, a-z and U+00C0..U+00FF, A-Z in lower case, of at least `LEAST_CHARS` code points and `LEAST_COUNT`
occurrences. Two are near if they differ by exactly one inserted, deleted or replaced code point. One replacement changes
two letter counts by one each, one insertion a single count: squared distances of two within a length, of one between
neighbouring lengths. Squared distances of whole blocks come from a product of count matrices (|x|^2 + |y|^2 - 2 x.y), and only
pairs at these distances are verified letter by letter.

Blocks. Letters fall into K classes by code point; a block holds the words with the same number of letters in each class,
hence of one length. Near words lie in one block, in two of one length that trade one letter between classes, or in two of
neighbouring lengths that differ by one letter in one class. So a word meets its own block and K(K + 1) / 2 others instead of
its whole length; K grows with the logarithm of the vocabulary, which keeps blocks small. Blocks of more than `BLOCK_WORDS`
words are dealt into parts, and a task holds one part and streams the others past it.

Defined results: null texts have no words; each row counts by itself, so repeated rows count repeatedly; an empty table, or one
without such words, gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from arrivo.llm.words import Words, pieces, texts_of
from arrivo.session import materialize

LEAST_CHARS = 6
LEAST_COUNT = 5
STRONGER = 5  # a form occurs so many times as often as its variant
BLOCK_WORDS = 2048
TASK_WORDS = 4096  # words of the vocabulary for each task that multiplies blocks
SHORT_BYTES = 64  # words up to this size get their CRC-32 from tables
OTHER = "[^a-z\\x{C0}-\\x{FF}]+"
LETTERS = 26 + 64


# --- words ---


def _zero_byte_table() -> np.ndarray:
    """CRC-32 of each byte, without the inversions: what a zero byte makes of the low byte of a state."""
    state = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        state = np.where(state & 1, (state >> 1) ^ np.uint32(0xEDB88320), state >> 1)
    return state.astype(np.uint32)


def paired_crc(prefixes: list[bytes], words: list[bytes], owner: np.ndarray, code: np.ndarray) -> np.ndarray:
    """CRC-32 of `prefixes[owner] + words[code]` for each pair.

    The CRC of a concatenation is that of the second part, combined with that of the first moved on by as many zero bytes.
    """
    table = _zero_byte_table()
    moved = np.empty((SHORT_BYTES + 1, len(prefixes)), np.uint32)
    moved[0] = [zlib.crc32(p) for p in prefixes]
    for i in range(SHORT_BYTES):
        moved[i + 1] = (moved[i] >> 8) ^ table[moved[i] & 255]
    own = np.array([zlib.crc32(w) for w in words], np.uint32)
    size = np.array([len(w) for w in words], np.int64)
    out = moved[np.minimum(size[code], SHORT_BYTES), owner] ^ own[code]
    for i in np.flatnonzero(size[code] > SHORT_BYTES).tolist():
        out[i] = zlib.crc32(words[code[i]], zlib.crc32(prefixes[owner[i]]))
    return out


def count_piece(texts: pa.Array, ids: list, misspelt: int = 0, chars: int = LEAST_CHARS) -> tuple[pa.Array, pa.Array]:
    """Words of at least `chars` code points in some texts, and how often each occurs.

    `misspelt`: where it divides the CRC-32 of `id:word`, that word loses one letter in that document, the one at the
    CRC modulo its length. Texts without an id keep their words.
    """
    words = Words(pc.replace_substring_regex(pc.ascii_lower(texts), OTHER, " "))
    vocabulary = words.vocabulary
    lengths = pc.utf8_length(vocabulary).to_numpy(zero_copy_only=False)
    picked = np.flatnonzero(lengths >= chars)
    renumbered = np.full(len(vocabulary), -1, np.int64)
    renumbered[picked] = np.arange(len(picked))
    vocabulary = vocabulary.take(pa.array(picked))
    code, owner = renumbered[words.codes], words.owner()
    code, owner = code[code >= 0], owner[code >= 0]
    counts = np.bincount(code, minlength=len(vocabulary))
    changed: dict[str, int] = {}
    if misspelt and len(code):
        crc = paired_crc([f"{i}:".encode() for i in ids], vocabulary.cast(pa.binary()).to_pylist(), owner, code)
        named = np.array([i is not None for i in ids], bool)
        for c, h in zip(*(a[(crc % misspelt == 0) & named[owner]].tolist() for a in (code, crc))):
            word = vocabulary[c].as_py()
            cut = h % len(word)
            counts[c] -= 1
            if len(word) > chars:
                rest = word[:cut] + word[cut + 1 :]
                changed[rest] = changed.get(rest, 0) + 1
    left = np.flatnonzero(counts)
    return (
        pa.concat_arrays([vocabulary.take(pa.array(left)), pa.array(list(changed), pa.string())]),
        pa.array(np.concatenate([counts[left], np.array(list(changed.values()), np.int64)])),
    )


def count_words(docs: DataFrame, misspelt: int = 0, chars: int = LEAST_CHARS, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words with at least `chars` code points and `least` occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            found, counts = count_piece(texts_of(part), part.column("doc_id").to_pylist(), misspelt, chars)
            yield pa.RecordBatch.from_arrays([found, counts], names=["word", "n"])

    return docs.select("doc_id", "text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# --- blocks ---


def letters(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length)


def letter_numbers(points: np.ndarray) -> np.ndarray:
    return np.where(points < 128, points - 97, points - 0xC0 + 26).astype(np.int64)


def letter_counts(points: np.ndarray) -> np.ndarray:
    """How often each word has each letter; exact in float32 up to squared lengths of 2^24, in float64 beyond."""
    n, length = points.shape
    cells = letter_numbers(points) + np.arange(n)[:, None] * LETTERS
    kind = np.float32 if length < 2048 else np.float64
    return np.bincount(cells.ravel(), minlength=n * LETTERS).reshape(n, LETTERS).astype(kind)


def profiles(words: list[str], classes: int) -> np.ndarray:
    """Letters of each class in each word."""
    lengths = np.array([len(w) for w in words], np.int64)
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    cells = letter_numbers(points) % classes + np.repeat(np.arange(len(words)) * classes, lengths)
    return np.bincount(cells, minlength=len(words) * classes).reshape(len(words), classes)


def visited(profile: np.ndarray) -> Iterator[np.ndarray]:
    """Profiles of the other blocks in which the words of these profiles are compared: each pair of blocks once."""
    classes = profile.shape[1]
    for a in range(classes):
        longer = profile.copy()
        longer[:, a] += 1
        yield longer
        for b in range(a + 1, classes):  # one letter from class b to class a: the larger of the two in this order
            traded = longer.copy()
            traded[:, b] -= 1
            yield traded


def _block_rows(words: DataFrame, classes: int) -> DataFrame:
    """(block, own, word, n): each word in its own block and in those it visits."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            home = profiles(batch.column("word").to_pylist(), classes)
            for own, target in [(True, home), *((False, t) for t in visited(home))]:
                valid = np.flatnonzero((target >= 0).all(1))
                keys = np.ascontiguousarray(target[valid].astype("<u4")).view(f"V{4 * classes}").ravel()
                rows = batch.take(pa.array(valid))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k.tobytes() for k in keys], pa.binary()), pa.array(np.full(len(valid), own)), rows.column("word"), rows.column("n")],
                    names=["block", "own", "word", "n"],
                )

    return words.select("word", "n").mapInArrow(place, "block binary, own boolean, word string, n long")


# --- near pairs ---


def one_replaced(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether rows of equal length differ in exactly one place."""
    return (x != y).sum(1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether the longer row is the shorter one with one code point more: its equal beginning and end cover the shorter."""
    length = short.shape[1]
    begin, end = short == long[:, :length], (short == long[:, 1:])[:, ::-1]
    lead, tail = (np.where(same.all(1), length, same.argmin(1)) for same in (begin, end))
    return lead + tail >= length


def near_pairs(held: np.ndarray, other: np.ndarray, same: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of a held word and another one, as long or one letter shorter, that are one edit apart.

    `same`: both are the same words, and each pair counts once.
    """
    x, y = letter_counts(held), letter_counts(other)
    shorter = held.shape[1] - other.shape[1]
    distance = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    i, j = np.nonzero(distance == (1 if shorter else 2))
    if same:
        i, j = i[i < j], j[i < j]
    found = np.zeros(len(i), bool)
    step = max(1, (8 << 20) // max(1, held.shape[1]))
    for a in range(0, len(i), step):
        cut = slice(a, a + step)
        found[cut] = one_inserted(other[j[cut]], held[i[cut]]) if shorter else one_replaced(held[i[cut]], other[j[cut]])
    return i[found], j[found]


class Part:
    """One part of a block: the words that live there, and pairs with those that pass."""

    def __init__(self):
        self.home: list[str] = []
        self.home_n: list[int] = []
        self.guests: list[str] = []
        self.guests_n: list[int] = []
        self.points: np.ndarray | None = None

    def add(self, own: list[bool], words: list[str], counts: list[int]) -> Iterator[tuple[list, list, list]]:
        """Rows of this part, its own words before all others."""
        owned = sum(own)
        self.home += words[:owned]
        self.home_n += counts[:owned]
        self.guests += words[owned:]
        self.guests_n += counts[owned:]
        if len(self.guests) >= BLOCK_WORDS:
            yield from self.meet()

    def meet(self) -> Iterator[tuple[list, list, list]]:
        """Links (word, near, count of near) in both directions; guests are let go."""
        guests, counts = self.guests, self.guests_n
        self.guests, self.guests_n = [], []
        if not self.home:
            return
        home, home_n = np.array(self.home, object), np.array(self.home_n)
        if self.points is None:
            self.points = letters(self.home, len(self.home[0]))
            if len(home) > 1:
                yield from links(home, home_n, home, home_n, near_pairs(self.points, self.points, same=True))
        for length in {len(g) for g in guests}:
            rows = [k for k, g in enumerate(guests) if len(g) == length]
            for a in range(0, len(rows), BLOCK_WORDS):
                some = rows[a : a + BLOCK_WORDS]
                words = [guests[k] for k in some]
                pairs = near_pairs(self.points, letters(words, length))
                yield from links(home, home_n, np.array(words, object), np.array([counts[k] for k in some]), pairs)


def links(x, x_n, y, y_n, pairs) -> Iterator[tuple[list, list, list]]:
    i, j = pairs
    if len(i):
        yield [*x[i], *y[j]], [*y[j], *x[i]], [*y_n[j].tolist(), *x_n[i].tolist()]


def classes_for(words: int) -> int:
    """Letter classes for a vocabulary of this size."""
    return min(14, max(3, words.bit_length() - 12))


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): every pair of near words of (word, n), in both directions."""
    size = words.count()
    rows = _block_rows(words, classes_for(size))
    homes = rows.where("own").groupBy("block").agg(F.ceil(F.count("*") / BLOCK_WORDS).cast("int").alias("parts"))
    # blocks that no word lives in go with the join
    rows = rows.join(homes, "block").withColumn("home", F.when(F.col("own"), F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")))
    # a word passes all parts of the blocks that it visits, and the later parts of its own
    first = F.coalesce(F.col("home"), F.lit(0))
    dealt = rows.withColumn("part", F.explode(F.sequence(first, F.col("parts") - 1))).withColumn("own", F.col("own") & (F.col("part") == F.col("home")))
    tasks = max(8, size // TASK_WORDS)
    ordered = dealt.select("block", "part", "own", "word", "n").repartition(tasks, "block", "part").sortWithinPartitions("block", "part", F.desc("own"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, part = None, Part()
        for batch in batches:
            if not batch.num_rows:
                continue
            blocks, parts = batch.column("block").to_pylist(), batch.column("part").to_pylist()
            own, word, n = (batch.column(c).to_pylist() for c in ("own", "word", "n"))
            bounds = [0, *(k for k in range(1, len(blocks)) if blocks[k] != blocks[k - 1] or parts[k] != parts[k - 1]), len(blocks)]
            for a, b in zip(bounds, bounds[1:]):
                if (blocks[a], parts[a]) != current:
                    yield from out(part.meet())
                    current, part = (blocks[a], parts[a]), Part()
                yield from out(part.add(own[a:b], word[a:b], n[a:b]))
        yield from out(part.meet())

    def out(found: Iterator[tuple[list, list, list]]) -> Iterator[pa.RecordBatch]:
        for word, near, n in found:
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.string()), pa.array(n, pa.int64())], names=["word", "near", "near_n"])

    return ordered.mapInArrow(compare, "word string, near string, near_n long")


# --- forms ---


def rooted(forms: DataFrame, most: int) -> DataFrame:
    """(word, root): the last word that forms (word, form) lead to.

    Counts grow by `STRONGER` at each step, so `most`, the largest count, bounds the length of a chain; each round doubles
    the steps that a word has gone.
    """
    chain = 1
    while STRONGER**chain <= most:
        chain += 1
    found = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(chain)) if chain > 1 else 0):
        found = materialize(found, "roots")
        ahead = found.select(F.col("word").alias("_at"), F.col("root").alias("_on"))
        found = found.join(ahead, F.col("root") == F.col("_at"), "left").select("word", F.coalesce("_on", "root").alias("root"))
    return found


def variants(docs: DataFrame, misspelt: int = 0, chars: int = LEAST_CHARS, least: int = LEAST_COUNT) -> DataFrame:
    """Per frequent word: word, n, n_near, form (its commonest near word, if common enough), form_n, root.

    The form is the near word with the largest count, the first in code-point order among equals, if it occurs at least
    `STRONGER` times as often as the word; the root is the last word that forms lead to.
    """
    words = materialize(count_words(docs, misspelt, chars, least), "words")
    best = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    strong = -F.col("best.less") >= STRONGER * F.col("n")
    known = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n"),
    )
    known = materialize(known, "forms")
    most = words.agg(F.max("n")).first()[0] or 0
    roots = rooted(known.where("form is not null").select("word", "form"), most)
    return known.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
