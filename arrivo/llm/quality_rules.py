"""Quality rules: gradient-boosted trees over document statistics.

Statistics are computed over whole texts in Arrow batches. The trees are fitted in numpy on a bounded sample of
labelled documents (`SAMPLE_PER_CLASS` of each class), with monotonic constraints on chosen statistics, and flattened
into node arrays that score a batch with `depth` gathers per tree.

Defined results: a null text has no words; a text without words fails the base rules; repeated rows are scored each;
an empty table gives an empty result; further columns of the input are not looked at. Without labelled rows of both
classes the trees give their prior, and only the base rules decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from arrivo.llm.sampling import labelled_rows
from arrivo.llm.words import Words, chain, pieces, sums, table, texts_of, word_traits

SAMPLE_PER_CLASS = 1500
KEEP_FROM = 0.3
MIN_WORDS = 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATISTICS = (
    "log_words", "mean_chars", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "bang_share",
    "digit_share", "stop_share", "distinct_share", "words_per_line", "beyond_ascii_share",
)
# more of these never raises the score
FALLING = ("symbol_share", "dup_line_share", "repeat_share", "bang_share")


def repeated_windows(words: Words, width: int = 3) -> np.ndarray:
    """Per word: lies in a window of `width` words found at least twice in its text."""
    n = len(words)
    covered = np.zeros(n, bool)
    if n < width:
        return covered
    owner = words.owner()
    inside = np.flatnonzero(owner[: n - width + 1] == owner[width - 1 :])
    if not len(inside):
        return covered
    parts = [owner[inside]] + [words.codes[inside + i] for i in range(width)]
    key = chain([p.astype(np.uint64) for p in parts])
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    a, b = order[:-1][same], order[1:][same]
    if not all(np.array_equal(p[a], p[b]) for p in parts):  # two windows share a hash: compare the windows themselves
        _, number, times = np.unique(np.stack(parts, 1), axis=0, return_inverse=True, return_counts=True)
        hits = inside[times[number.ravel()] > 1]
    else:
        hits = inside[np.concatenate([a, b])]
    for i in range(width):
        covered[hits + i] = True
    return covered


def duplicate_lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per text: lines with a word, and those among them equal to an earlier line."""
    lines = pc.split_pattern(texts, "\n")
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lines).to_numpy(zero_copy_only=False))
    flat = lines.flatten()
    filled = pc.binary_length(pc.ascii_trim_whitespace(flat)).to_numpy(zero_copy_only=False) > 0
    coded = flat.dictionary_encode()
    codes, owner = coded.indices.to_numpy(zero_copy_only=False)[filled].astype(np.int64), owner[filled]
    total = np.bincount(owner, minlength=len(texts))
    distinct = np.unique(owner * (len(coded.dictionary) + 1) + codes) // (len(coded.dictionary) + 1)
    return total, total - np.bincount(distinct, minlength=len(texts))


def statistics(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The exact counts of `COUNTS` and the matrix of `STATISTICS`, one row per text."""
    words = Words(texts)
    traits = {k: sums(v[words.codes], words.starts) for k, v in word_traits(words.vocabulary).items()}
    n = words.counts
    repeat = sums(repeated_windows(words).astype(np.int64), words.starts)
    lines, dup = duplicate_lines(texts)
    distinct = np.bincount(np.unique(words.owner() * (len(words.vocabulary) + 1) + words.codes) // (len(words.vocabulary) + 1), minlength=len(n))
    counts = np.stack([n, traits["chars"], traits["symbols"], dup, repeat], 1).astype(np.int64)
    some, chars, rows = np.maximum(n, 1), np.maximum(traits["chars"], 1), np.maximum(lines, 1)
    matrix = np.stack(
        [
            np.log1p(n), traits["chars"] / some, traits["symbols"] / chars, dup / rows, repeat / some,
            traits["upper"] / chars, traits["bangs"] / chars, traits["digits"] / chars, traits["stops"] / some,
            distinct / np.sqrt(some), n / rows, traits["beyond_ascii"] / chars,
        ],
        1,
    )
    return counts, matrix


@dataclass
class Trees:
    """Flattened trees: a leaf points to itself, so that every row takes `depth` steps."""

    base: float
    depth: int
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x))
        for start in range(0, len(x), 4096):
            part = x[start : start + 4096]
            rows = np.arange(len(part))[:, None]
            node = np.tile(self.roots, (len(part), 1))
            for _ in range(self.depth):
                down = part[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(down, self.left[node], self.right[node])
            out[start : start + 4096] = self.base + self.value[node].sum(1)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


@dataclass
class _Nodes:
    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self) -> int:
        at = len(self.feature)
        for column, value in ((self.feature, 0), (self.threshold, np.inf), (self.left, at), (self.right, at), (self.value, 0.0)):
            column.append(value)
        return at


def fit_trees(
    x: np.ndarray, y: np.ndarray, signs: np.ndarray, rounds: int = 60, depth: int = 4, bins: int = 48,
    rate: float = 0.15, l2: float = 2.0, least: float = 5.0,
) -> Trees:
    """Newton boosting of the logistic loss on quantile bins.

    `signs` has -1, 0 or 1 per column: the score never rises, is free, or never falls with it. A split against the
    sign of its column is refused, and the middle of an accepted one bounds all leaves below it.
    """
    n, width = x.shape
    mean = float(np.clip(y.mean() if n else 0.5, 0.01, 0.99))
    base, nodes, roots = float(np.log(mean / (1 - mean))), _Nodes(), []
    if n == 0 or y.min() == y.max():
        rounds = 0
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins)[1:-1])) for f in range(width)] if rounds else []
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1) if rounds else None
    margin = np.full(n, base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        roots.append(nodes.add())
        level = [(roots[-1], np.arange(n), -np.inf, np.inf)]
        for step in range(depth + 1):
            following = []
            for at, rows, low, high in level:
                leaf = float(np.clip(g[rows].sum() / (h[rows].sum() + l2), low, high))
                nodes.value[at] = rate * leaf
                margin[rows] += rate * leaf
                best = _best_split(binned[rows], g[rows], h[rows], signs, bins, l2, least, low, high) if step < depth else None
                if best is None:
                    continue
                f, cut, a, b = best
                margin[rows] -= rate * leaf
                down = binned[rows, f] <= cut
                nodes.feature[at], nodes.threshold[at] = f, float(edges[f][cut])
                nodes.left[at], nodes.right[at] = nodes.add(), nodes.add()
                middle = (a + b) / 2
                bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[int(signs[f])]
                following.append((nodes.left[at], rows[down], *bounds[0]))
                following.append((nodes.right[at], rows[~down], *bounds[1]))
            level = following
    as_ints = [np.asarray(c, np.int64) for c in (roots, nodes.feature, nodes.left, nodes.right)]
    return Trees(base, depth, as_ints[0], as_ints[1], np.asarray(nodes.threshold, float), as_ints[2], as_ints[3], np.asarray(nodes.value, float))


def _best_split(binned, g, h, signs, bins, l2, least, low, high):
    """(column, last bin of the left side, left value, right value) of the largest gain, or None."""
    width = binned.shape[1]
    slot = (binned + np.arange(width) * bins).ravel()
    left_g = np.bincount(slot, np.repeat(g, width), width * bins).reshape(width, bins).cumsum(1)
    left_h = np.bincount(slot, np.repeat(h, width), width * bins).reshape(width, bins).cumsum(1)
    right_g, right_h = left_g[:, -1:] - left_g, left_h[:, -1:] - left_h
    a, b = np.clip(left_g / (left_h + l2), low, high), np.clip(right_g / (right_h + l2), low, high)
    gain = left_g * a - (left_h + l2) * a * a / 2 + right_g * b - (right_h + l2) * b * b / 2
    leaf = np.clip(g.sum() / (h.sum() + l2), low, high)
    gain = gain - (g.sum() * leaf - (h.sum() + l2) * leaf * leaf / 2)
    allowed = (left_h >= least / 4) & (right_h >= least / 4) & (signs[:, None] * (b - a) >= 0)
    gain = np.where(allowed, gain, -1)
    f, cut = divmod(int(gain.argmax()), bins)
    return (f, cut, float(a[f, cut]), float(b[f, cut])) if gain[f, cut] > 1e-6 else None


def collect_sample(docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of the bounded sample; only these numbers reach the driver."""
    width = len(STATISTICS)
    schema = pa.schema([("y", pa.int32()), ("x", pa.list_(pa.float64()))])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            _, matrix = statistics(texts_of(part))
            yield table(schema, part.column("y").cast(pa.int32()), pa.array(list(matrix), pa.list_(pa.float64())))

    rows = labelled_rows(docs, labels, "quality", per_class).repartition(8).mapInArrow(measure, "y int, x array<double>").collect()
    rows.sort()
    return np.array([r.x for r in rows]).reshape(-1, width), np.array([r.y for r in rows], float)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Trees:
    signs = np.array([-1 if name in FALLING else 0 for name in STATISTICS])
    return fit_trees(*collect_sample(docs, labels, per_class), signs)


def apply_rules(docs: DataFrame, trees: Trees, keep_from: float = KEEP_FROM) -> DataFrame:
    """Per document: doc_id, the counts of `COUNTS`, base_failed, kept, score."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    spec = f"doc_id {id_type}, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, score double"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            counts, matrix = statistics(texts_of(part))
            n, repeat = counts[:, 0], counts[:, 4]
            failed = (n < MIN_WORDS) | (100 * repeat > 50 * n)
            score = trees.score(matrix)
            columns = [part.column("doc_id"), *[pa.array(c) for c in counts.T], pa.array(failed), pa.array(~failed & (score >= keep_from)), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *COUNTS, "base_failed", "kept", "score"])

    return docs.select("doc_id", "text").mapInArrow(judge, spec)
