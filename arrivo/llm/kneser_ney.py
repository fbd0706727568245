"""Language-model scoring: interpolated modified Kneser-Ney over words, in memory-mapped sorted hash arrays.

Counting. Every task reduces its texts to distinct n-grams with counts and sends them, as blocks of columns, to the
shard of their context. A shard adds the blocks up, writes sorted arrays of n-gram hashes with counts and of context
hashes with the sums that the weights need, and sends the next shorter n-grams, with the number of distinct words
before them, on to their shards. So every order is one shuffle of pre-aggregated blocks; the number of shards follows
the size of the corpus (`SHARD_BYTES`), and a hot word is a context like any other, one row per distinct follower.

Scoring. Workers map the arrays from the shared folder and look up the distinct n-grams of a piece of texts, shard by
shard in sorted order. Where the shared folder is not a mounted file system, a worker fetches the shards it meets.

Words and n-grams are told apart by 64-bit hashes.

Defined results: a null text is empty, one end token; a null id counts as held out; repeated rows count and are scored
each; without training texts all probabilities are 1 over one unknown token, so all scores are 0; an empty table gives
an empty result; further columns are not looked at.
"""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from arrivo.llm.sampling import crc_fold
from arrivo.llm.words import Words, chain, pieces, sums, texts_of
from arrivo.session import scratch_path

ORDER = 2
FOLDS = 10
SHARD_BYTES = 24 << 20
FLUSH_ROWS = 3_000_000
MERGE_ROWS = 250_000  # about as many are sorted at a time
BLOCK_ROWS = 8_192  # of one block at most: longer ones would be huge objects of the JVM, which it never moves
BEGIN, END = np.uint64(0x1F123BB5159A55E5), np.uint64(0x2545F4914F6CDD1D)
BIG = 255  # counts from here on are kept apart
BLOCK = "shard int, level int, rows long, data binary, stats array<long>"


# --- arrays in the shared folder ---


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + os.path.abspath(uri))


def save(uri: str, values: np.ndarray) -> None:
    """Write one array; a repeated attempt replaces the file by an equal one."""
    system, path = _open(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        np.lib.format.write_array(out, np.ascontiguousarray(values), allow_pickle=False)
    system.move(part, path)


@functools.lru_cache(maxsize=4096)
def load(uri: str) -> np.ndarray:
    """Map one array; empty where the shard got no rows."""
    system, path = _open(uri)
    if system.get_file_info(path).type == fs.FileType.NotFound:
        return np.zeros(0, np.uint64)
    if not isinstance(system, fs.LocalFileSystem):
        local = os.path.join(tempfile.gettempdir(), "arrays-" + uuid.uuid5(uuid.NAMESPACE_URL, uri).hex)
        if not os.path.exists(local):
            with system.open_input_stream(path) as source, open(f"{local}.{os.getpid()}", "wb") as out:
                while chunk := source.read(1 << 20):
                    out.write(chunk)
            os.replace(f"{local}.{os.getpid()}", local)
        path = local
    return np.load(path, mmap_mode="r")


# --- counting ---


def sequences(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, each text with its end, and where each text starts."""
    starts = words.starts + np.arange(len(words.starts))
    out = np.full(int(starts[-1]), END, np.uint64)
    out[np.arange(len(words)) + words.owner()] = words.hashes()[words.codes]
    return out, starts


def grams(tokens: np.ndarray, starts: np.ndarray, order: int) -> list[np.ndarray]:
    """Columns of the n-grams that end at each token; `BEGIN` stands before a text."""
    place = np.arange(len(tokens)) - np.repeat(starts[:-1], np.diff(starts))
    columns = [tokens]
    for back in range(1, order):
        before = np.full(len(tokens), BEGIN, np.uint64)
        inside = place >= back
        before[inside] = tokens[np.flatnonzero(inside) - back]
        columns.insert(0, before)
    return columns


def release() -> None:
    """Give freed Arrow memory back to the system; workers live on after their tasks, beside those of other tasks."""
    pa.default_memory_pool().release_unused()


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts the keys, and where in it each distinct key starts."""
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    return order, np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(key) else np.zeros(0, np.int64)


def _add_up(columns: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Distinct rows with the sums of their counts, sorted by hash."""
    order, first = _runs(chain(columns))
    if not len(first):
        return columns, counts
    return [c[order[first]] for c in columns], [np.add.reduceat(c[order], first, dtype=np.int64) for c in counts]


def _joined(parts: list[tuple[list[np.ndarray], list[np.ndarray]]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Columns and counts of all parts, one after the other."""
    return [np.concatenate(c) for c in zip(*[p[0] for p in parts])], [np.concatenate(c) for c in zip(*[p[1] for p in parts])]


def _merged(blocks: list[tuple[list[np.ndarray], list[np.ndarray]]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Distinct rows of a shard with the sums of their counts, sorted by hash.

    Blocks are sorted by their first column, so a range of it is a slice of each: only one range is gathered and sorted at a time.
    The list is emptied.
    """
    ranges = 1 + sum(len(columns[0]) for columns, _ in blocks) // MERGE_ROWS
    edges = np.array([(i << 64) // ranges for i in range(1, ranges)], np.uint64)
    cuts = [[0, *np.searchsorted(columns[0], edges), len(columns[0])] for columns, _ in blocks]
    found = []
    for i in range(ranges):
        part = [([c[at[i] : at[i + 1]] for c in columns], [c[at[i] : at[i + 1]] for c in counts]) for (columns, counts), at in zip(blocks, cuts)]
        found.append(_add_up(*_joined(part)))
    blocks.clear()
    del part
    columns, counts = _joined(found)
    del found
    release()
    order = np.argsort(chain(columns), kind="stable")
    return [c[order] for c in columns], [c[order] for c in counts]


def shard_of(context: np.ndarray, shards: int) -> np.ndarray:
    return ((context >> np.uint64(20)) % np.uint64(shards)).astype(np.int64)


def _context(columns: list[np.ndarray]) -> np.ndarray:
    """What n-grams are dealt out by: all words but the last; single words by themselves."""
    return chain(columns[:-1]) if len(columns) > 1 else columns[0]


def _blocks(columns: list[np.ndarray], counts: list[np.ndarray], shards: int) -> Iterator[pa.RecordBatch]:
    """Cut rows by shard; within a block columns lie one after the other, sorted and compressed, so that the JVM holds little of them."""
    level = len(columns)
    shard = shard_of(_context(columns), shards)
    order = np.lexsort((columns[0], shard))
    ends = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(ends)):
        for at in range(ends[s], ends[s + 1], BLOCK_ROWS):
            mine = order[at : min(at + BLOCK_ROWS, ends[s + 1])]
            data = b"".join(c[mine].tobytes() for c in columns) + b"".join(c[mine].astype(np.uint32).tobytes() for c in counts)
            data = pa.compress(data, codec="zstd", asbytes=True)
            yield pa.RecordBatch.from_pylist([{"shard": int(s), "level": level, "rows": len(mine), "data": data, "stats": None}], schema=_schema())


def _schema() -> pa.Schema:
    return pa.schema([("shard", pa.int32()), ("level", pa.int32()), ("rows", pa.int64()), ("data", pa.binary()), ("stats", pa.list_(pa.int64()))])


def _unblock(level: int, rows: int, data: pa.Buffer) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """A block's columns and counts, views of one buffer."""
    data = pa.decompress(data, decompressed_size=(8 * level + 8) * rows, codec="zstd")
    columns = [np.frombuffer(data, np.uint64, rows, 8 * rows * i) for i in range(level)]
    return columns, [np.frombuffer(data, np.uint32, rows, 8 * rows * level + 4 * rows * i) for i in range(2)]


def count_blocks(docs: DataFrame, order: int, shards: int) -> DataFrame:
    """Blocks of the longest n-grams; each row has its count twice, as the count to discount and as the plain one.

    What a task holds of its pieces lies in parts, by ranges of shards, which are merged and sent one after the other.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = min(shards, 1 + FLUSH_ROWS // MERGE_ROWS)
        held, rows = [[] for _ in range(ranges)], 0
        for part in pieces(batches):
            found = grams(*sequences(Words(texts_of(part), lower=True)), order)
            found, number = _add_up(found, [np.ones(len(found[0]), np.uint32)])
            of = (shard_of(_context(found), shards) * ranges // shards).astype(np.uint16)
            at = np.argsort(of, kind="stable")
            ends = np.searchsorted(of[at], np.arange(ranges + 1))
            for i in np.flatnonzero(np.diff(ends)):
                mine = at[ends[i] : ends[i + 1]]
                held[i].append(([c[mine] for c in found], [number[0][mine].astype(np.uint32)]))
            rows += len(at)
            if rows >= FLUSH_ROWS:
                yield from flush(held)
                rows = 0
        yield from flush(held)

    def flush(held):
        for parts in held:
            if parts:
                merged, number = _add_up(*_joined(parts))
                parts.clear()
                yield from _blocks(merged, [number[0], number[0]], shards)
        release()

    return docs.select("text").mapInArrow(count, BLOCK)


def reduce_level(blocks: DataFrame, level: int, shards: int, model: str) -> DataFrame:
    """Write the arrays of one order; gives the blocks of the next shorter one and rows of statistics.

    Statistics: rows, n-grams with adjusted count 1, 2, 3, 4, their sum, those above 2, plain tokens. They travel with
    shard -level and pass later levels untouched.
    """

    def reduce(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = key[0].as_py()
        if shard < 0:
            yield from batches
            return
        columns, (adjusted, plain) = _merged(
            [_unblock(level, r, d.as_buffer()) for batch in batches for r, d in zip(batch.column("rows").to_pylist(), batch.column("data"))]
        )
        to = f"{model}/{level}/{shard}"
        # `_merged` leaves the rows in the order of this hash; a single word is its own key
        key = chain(columns)
        save(f"{to}-keys.npy", key)
        save(f"{to}-counts.npy", np.minimum(adjusted, BIG).astype(np.uint8))
        big = adjusted >= BIG
        save(f"{to}-big.npy", np.stack([key[big], adjusted[big].astype(np.uint64)]))
        stats = [len(key), *[int((adjusted == i).sum()) for i in (1, 2, 3, 4)], int(adjusted.sum()), int((adjusted > 2).sum()), int(plain.sum())]
        yield pa.RecordBatch.from_pylist([{"shard": -level, "level": level, "rows": 0, "data": None, "stats": stats}], schema=_schema())
        if level == 1:
            save(f"{to}-plain.npy", plain.astype(np.uint32 if not len(plain) or plain.max() < 1 << 32 else np.uint64))
        else:
            context = _context(columns)
            order, first = _runs(context)
            add = lambda v: np.add.reduceat(v[order], first)
            save(f"{to}-contexts.npy", context[order[first]])
            sums_ = [add(adjusted), *[add((adjusted == i).astype(np.int64)) for i in (1, 2)], add((adjusted > 2).astype(np.int64))]
            save(f"{to}-weights.npy", np.stack(sums_).astype(np.uint32 if sums_[0].max() < 1 << 32 else np.uint64))
            shorter, numbers = _add_up(columns[1:], [np.ones(len(key), np.uint32), plain])
            del columns, adjusted, plain, key, context, order, first, sums_
            yield from _blocks(shorter, numbers, shards)
        release()

    return blocks.groupBy("shard").applyInArrow(reduce, BLOCK)


# --- model ---


def discounts(stats: list[int]) -> tuple[float, float, float]:
    """The three discounts of one order from its counts of counts; halves where these are too few to tell."""
    t = stats[1:5]
    if min(t) <= 0:
        return 0.5, 1.0, 1.5
    y = t[0] / (t[0] + 2 * t[1])
    return tuple(float(np.clip(i - (i + 1) * y * t[i] / t[i - 1], 0.01, i)) for i in (1, 2, 3))


@dataclass
class Model:
    """Where the arrays lie, and the few numbers that hold for the whole corpus."""

    folder: str
    order: int
    shards: int
    stats: dict[int, list[int]]  # by length of the n-gram

    @property
    def tokens(self) -> int:
        return self.stats[1][7] if 1 in self.stats else 0

    @property
    def words(self) -> int:
        return self.stats[1][0] if 1 in self.stats else 0

    def _by_shard(self, context: np.ndarray, level: int, name: str, find) -> None:
        shard = shard_of(context, self.shards)
        order = np.argsort(shard, kind="stable")
        ends = np.searchsorted(shard[order], np.arange(self.shards + 1))
        for s in np.flatnonzero(np.diff(ends)):
            rows = order[ends[s] : ends[s + 1]]
            keys = load(f"{self.folder}/{level}/{s}-{name}.npy")
            if len(keys):
                find(rows, keys, f"{self.folder}/{level}/{s}")

    def counts(self, context: np.ndarray, key: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Adjusted counts of n-grams, and of single words the plain ones; 0 if unseen."""
        adjusted, plain = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)

        def find(rows, keys, at):
            place = np.minimum(np.searchsorted(keys, key[rows]), len(keys) - 1)
            seen = keys[place] == key[rows]
            rows, place = rows[seen], place[seen]
            small = load(f"{at}-counts.npy")[place].astype(np.int64)
            large = np.flatnonzero(small == BIG)
            if len(large):
                big = load(f"{at}-big.npy")
                small[large] = big[1, np.searchsorted(big[0], key[rows[large]])].astype(np.int64)
            adjusted[rows] = small
            if level == 1:
                plain[rows] = load(f"{at}-plain.npy")[place]

        self._by_shard(context, level, "keys", find)
        return adjusted, plain

    def weights(self, context: np.ndarray, level: int) -> np.ndarray:
        """Sum of adjusted counts and numbers of followers with count 1, 2 and more, per context."""
        out = np.zeros((4, len(context)), np.int64)

        def find(rows, keys, at):
            place = np.minimum(np.searchsorted(keys, context[rows]), len(keys) - 1)
            seen = keys[place] == context[rows]
            out[:, rows[seen]] = load(f"{at}-weights.npy")[:, place[seen]]

        self._by_shard(context, level, "contexts", find)
        return out

    def probability(self, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Of the last word of each n-gram after the others, and the plain count of that word.

        Each order is looked up for its distinct n-grams only.
        """
        level = len(columns)
        key, first, back = np.unique(chain(columns), return_index=True, return_inverse=True)
        some = [c[first] for c in columns]
        if level == 1:
            adjusted, plain = self.counts(some[0], key, 1)
            s = self.stats.get(1, [0] * 8)
            weights = np.array([s[5], s[1], s[2], s[6]], np.int64)[:, None]
            shorter = np.full(len(key), 1 / (self.words + 1))
        else:
            context, at, again = np.unique(_context(some), return_index=True, return_inverse=True)
            adjusted, _ = self.counts(context[again], key, level)
            weights = self.weights(context, level)[:, again]
            shorter, plain = self.probability(some[1:])
        d = discounts(self.stats.get(level, [0] * 8))
        total = np.maximum(weights[0], 1)
        taken = np.array([0.0, *d])[np.minimum(adjusted, 3)]
        gamma = np.where(weights[0] > 0, (d[0] * weights[1] + d[1] * weights[2] + d[2] * weights[3]) / total, 1.0)
        p = (adjusted - taken) / total + gamma * shorter
        return p[back.ravel()], plain[back.ravel()]


def fit(docs: DataFrame, order: int = ORDER, shard_bytes: int = SHARD_BYTES) -> Model:
    """Count all given documents; arrays go to a fresh folder of the shared one."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(2, -(-size // shard_bytes))
    folder = scratch_path(docs.sparkSession, "ngrams")
    blocks = count_blocks(docs, order, shards)
    for level in range(order, 0, -1):
        blocks = reduce_level(blocks, level, shards, folder)
    added = [F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(8)]
    stats = {r.level: [int(r[f"s{i}"]) for i in range(8)] for r in blocks.groupBy("level").agg(*added).collect()}
    return Model(folder, order, shards, stats)


def score_documents(docs: DataFrame, model: Model, folds: int = FOLDS) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    floor = model.tokens + 0.1 * (model.words + 1)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            tokens, starts = sequences(Words(texts_of(part), lower=True))
            release()
            p, plain = model.probability(grams(tokens, starts, model.order))
            n = np.diff(starts)
            score = sums(np.log10(p), starts)
            base = sums(np.log10((plain + 0.1) / floor), starts)
            known = sums((plain > 0).astype(np.int64), starts)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(n), pa.array(known), pa.array(np.full(len(n), model.tokens)), pa.array(base), pa.array(score), pa.array(10 ** (-score / n))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"],
            )

    rows = docs.select("doc_id", (crc_fold("doc_id", folds) == 0).alias("held_out"), "text")
    spec = f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    return rows.mapInArrow(judge, spec)


def training_rows(docs: DataFrame, folds: int = FOLDS) -> DataFrame:
    return docs.where(crc_fold("doc_id", folds) != 0).select("text")
