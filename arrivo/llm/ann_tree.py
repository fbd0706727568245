"""Approximate nearest neighbours: a hierarchical k-means tree searched best bin first.

The tree is fitted on a bounded sample (`SAMPLE_FLOATS` numbers) by spherical k-means, level by level; every valid row
is put in the leaf its vector descends to. Equal vectors are one class, of which only the `neighbours` + 1 smallest ids
can ever be among the nearest, so a vector with any number of copies is one candidate. A query walks the tree through a
priority queue of nodes by cosine to their centres and visits the leaves in that order. How many it visits is found by
widening: the visits double until the recall of `CALIBRATION` sample queries, against their exact neighbours over all
rows, reaches `RECALL`. Leaves with many rows or many queries are dealt out in blocks by hash; each task sees one block
of rows and one of queries.

Defined results: vectors that are null, zero, hold null or non-finite numbers, or have another length than most take no
part; rows that repeat an id with the same vector count once; a query never finds a row of its own id; fewer neighbours
than asked for come out when there are no more candidates; empty tables give an empty result; further columns are not
looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from arrivo.llm.sampling import first_places
from arrivo.session import materialize

NEIGHBOURS = 5
SAMPLE_FLOATS = 1_500_000
BRANCHES = 8
LEAF_ROWS = 400  # wanted rows of a leaf, as far as the sample carries
LEAST_SAMPLE = 16  # sample rows that a leaf rests on
CALIBRATION = 128
RECALL = 0.97
BLOCK_ROWS = 4096
BLOCK_QUERIES = 1024
MARGIN = 1e-9


@dataclass
class Tree:
    """Nodes in a row: `children[i]` are the numbers of its children, `leaf[i]` the leaf number or -1."""

    centres: np.ndarray
    children: list[np.ndarray]
    leaf: np.ndarray
    leaves: int

    def leaf_of(self, unit: np.ndarray) -> np.ndarray:
        out = np.zeros(len(unit), np.int64)
        todo = [(0, np.arange(len(unit)))]
        while todo:
            at, rows = todo.pop()
            if not len(self.children[at]):
                out[rows] = self.leaf[at]
                continue
            best = (unit[rows] @ self.centres[self.children[at]].T).argmax(1)
            todo += [(child, rows[best == i]) for i, child in enumerate(self.children[at]) if (best == i).any()]
        return out

    def best_first(self, unit: np.ndarray) -> Iterator[int]:
        """Leaves in the order of the priority queue."""
        queue = [(-1.0, 0)]
        while queue:
            _, at = heapq.heappop(queue)
            if not len(self.children[at]):
                yield int(self.leaf[at])
                continue
            near = self.centres[self.children[at]] @ unit
            for child, cosine in zip(self.children[at], near):
                heapq.heappush(queue, (-float(cosine), int(child)))


def grow(sample: np.ndarray, rows: int, branches: int = BRANCHES, leaf_rows: int = LEAF_ROWS) -> Tree:
    """Split nodes of unit vectors by spherical k-means until a leaf stands for about `leaf_rows` of all rows."""
    rng = np.random.default_rng(3)
    centres, children, leaf, leaves = [np.zeros(sample.shape[1])], [np.zeros(0, int)], [-1], 0
    todo = [(0, np.arange(len(sample)))]
    least = max(LEAST_SAMPLE, leaf_rows * len(sample) / max(rows, 1))
    while todo:
        at, mine = todo.pop()
        k = int(min(branches, len(mine) // max(least / 2, 1)))
        groups = _split(sample[mine], k, rng) if len(mine) > least and k > 1 else []
        if len(groups) < 2:
            leaf[at], leaves = leaves, leaves + 1
            continue
        children[at] = np.arange(len(centres), len(centres) + len(groups))
        for centre, picked in groups:
            todo.append((len(centres), mine[picked]))
            centres.append(centre)
            children.append(np.zeros(0, int))
            leaf.append(-1)
    return Tree(np.array(centres), children, np.array(leaf), leaves)


def _split(unit: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> list[tuple[np.ndarray, np.ndarray]]:
    centres = unit[rng.choice(len(unit), k, replace=False)]
    for _ in range(rounds):
        own = (unit @ centres.T).argmax(1)
        total = np.zeros_like(centres)
        np.add.at(total, own, unit)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        centres = np.where(norm > 0, total / np.maximum(norm, 1e-300), centres)
    own = (unit @ centres.T).argmax(1)
    return [(centres[i], np.flatnonzero(own == i)) for i in range(k) if (own == i).any()]


def valid_vectors(table: DataFrame) -> DataFrame:
    """Rows that take part: id, v, each (id, v) once; the length is that of most vectors."""
    v = F.col("v")
    rows = table.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v")).where(F.col("id").isNotNull() & v.isNotNull())
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(finite & F.exists(v, lambda x: x != 0)).withColumn("_length", F.size("v"))
    common = rows.groupBy("_length").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "_length").first()
    return rows.where(F.col("_length") == (common[0] if common else -1)).select("id", "v").dropDuplicates()


def classes_of(rows: DataFrame, keep: int) -> DataFrame:
    """One row per distinct vector: v, ids (the `keep` smallest, ascending)."""
    rank = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= keep).groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def _matrix(lists: pa.Array) -> np.ndarray:
    return np.array(lists.to_pylist(), np.float64).reshape(len(lists), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def nearest_classes(queries: np.ndarray, vectors: np.ndarray, keep: int) -> list[np.ndarray]:
    """Per query: the classes that can be among its `keep` nearest, rounding of the product aside."""
    cosine = _unit(queries) @ _unit(vectors).T
    if vectors.shape[0] > keep:
        least = np.partition(cosine, vectors.shape[0] - keep, axis=1)[:, vectors.shape[0] - keep]
    else:
        least = np.full(len(queries), -np.inf)
    return [np.flatnonzero(row >= bound - MARGIN) for row, bound in zip(cosine, least)]


def exact_cosine(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The same sums for equal vectors, whatever the block they are in."""
    dot = (query * vectors).sum(1)
    return dot / (np.sqrt((query * query).sum()) * np.sqrt((vectors * vectors).sum(1)))


def _candidates(query_ids, queries, vectors, ids, keep) -> pd.DataFrame:
    """The `keep` nearest of one block for each query, by (cosine, smaller id)."""
    out = []
    for query_id, query, found in zip(query_ids, queries, nearest_classes(queries, vectors, keep + 1)):
        score = exact_cosine(query, vectors[found])
        pairs = sorted((-s, int(i)) for s, c in zip(score, found) for i in ids[c] if i != query_id)[:keep]
        out += [(int(query_id), i, -s) for s, i in pairs]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


RESULT = "query_id long, vec_id long, score double"


def best_of(found: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def brute_force(classes: DataFrame, query_ids: list[int], queries: np.ndarray, keep: int) -> DataFrame:
    """Exact neighbours of a stated, bounded set of queries over all rows, a batch of rows at a time."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                found = _candidates(query_ids, queries, _matrix(part.column("v")), part.column("ids").to_pylist(), keep)
                yield pa.RecordBatch.from_pandas(found, pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]), preserve_index=False)

    return best_of(classes.select("v", "ids").mapInArrow(scan, RESULT), keep)


def build(classes: DataFrame) -> tuple[Tree | None, DataFrame, dict[int, int]]:
    """Tree, the written table of classes with their leaf, and the number of classes per leaf."""
    count = classes.count()
    first = classes.select("v").first()
    if first is None:
        return None, classes.withColumn("leaf", F.lit(0)), {}
    sample = first_places(classes.select("v"), max(LEAST_SAMPLE, SAMPLE_FLOATS // len(first.v)), count, "v").collect()
    tree = grow(_unit(np.array([r.v for r in sample], np.float64)), count)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                leaf = tree.leaf_of(_unit(_matrix(part.column("v"))))
                yield pa.RecordBatch.from_arrays([part.column("v"), part.column("ids"), pa.array(leaf.astype(np.int32))], names=["v", "ids", "leaf"])

    kind = classes.schema["v"].dataType.simpleString()
    index = materialize(classes.select("v", "ids").mapInArrow(assign, f"v {kind}, ids array<long>, leaf int"), "leaves")
    sizes = {r.leaf: r.n for r in index.groupBy("leaf").agg(F.count("*").alias("n")).collect()}  # bounded by the sample
    return tree, index, sizes


def calibrate(tree: Tree, index: DataFrame, sizes: dict[int, int], keep: int, recall: float = RECALL) -> tuple[int, float]:
    """Leaf visits that reach the recall on sample queries, and the recall they reach."""
    rows = first_places(index.withColumn("_own", F.lit(1)), CALIBRATION, sum(sizes.values()), "_own", "v").collect()
    if not rows or tree.leaves == 1:
        return 1, 1.0
    ids, queries = [int(r.ids[0]) for r in rows], np.array([r.v for r in rows], np.float64)
    truth = brute_force(index, ids, queries, keep).collect()
    leaf_of = {}
    wanted = sorted({r.vec_id for r in truth})
    for r in index.where(F.exists("ids", lambda i: i.isin(wanted))).select("leaf", "ids").collect():
        leaf_of.update({i: r.leaf for i in r.ids})
    order = {q: list(tree.best_first(v)) for q, v in zip(ids, _unit(queries))}
    visits = 1
    while True:
        hits = [leaf_of[r.vec_id] in order[r.query_id][:visits] for r in truth]
        reached = float(np.mean(hits)) if hits else 1.0
        if reached >= recall or visits >= tree.leaves:
            return min(visits, tree.leaves), reached
        visits += max(1, visits // 4)


def search(index: DataFrame, tree: Tree, sizes: dict[int, int], queries: DataFrame, visits: int, keep: int = NEIGHBOURS) -> DataFrame:
    """The nearest of the visited leaves for each query (id, v): query_id, rank, vec_id, score."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves, picked = [], []
            for row, unit in enumerate(_unit(_matrix(batch.column("v"))) if batch.num_rows else []):
                seen = 0
                for n, leaf in enumerate(tree.best_first(unit)):
                    if n >= visits and seen > keep:  # a sparse neighbourhood goes on until there are enough candidates
                        break
                    seen += sizes.get(leaf, 0)
                    if leaf in sizes:
                        leaves.append(leaf)
                        picked.append(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaves, pa.int32()), batch.column("id").take(pa.array(picked, pa.int64())), batch.column("v").take(pa.array(picked, pa.int64()))],
                names=["leaf", "id", "v"],
            )

    kind = index.schema["v"].dataType.simpleString()
    visited = materialize(queries.select("id", "v").mapInArrow(walk, f"leaf int, id long, v {kind}"), "visits")
    asked = {r.leaf: r.n for r in visited.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    if not asked:
        return queries.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    spark = queries.sparkSession
    blocks = [(leaf, -(-sizes[leaf] // BLOCK_ROWS), -(-n // BLOCK_QUERIES)) for leaf, n in sorted(asked.items())]
    grid = spark.createDataFrame(blocks, "leaf int, row_blocks int, query_blocks int")  # one row per leaf
    part = lambda key, n: F.pmod(F.xxhash64(*key), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = index.join(grid, "leaf").withColumn("rb", part(["v"], "row_blocks")).withColumn("qb", all_of("query_blocks")).select("leaf", "rb", "qb", "v", "ids")
    asks = visited.join(grid, "leaf").withColumn("qb", part(["id"], "query_blocks")).withColumn("rb", all_of("row_blocks")).select("leaf", "rb", "qb", "id", "v")

    def compare(ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if not len(ours) or not len(theirs):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        stack = lambda c: np.stack([np.asarray(x, np.float64) for x in c])
        return _candidates(theirs["id"].to_list(), stack(theirs["v"]), stack(ours["v"]), ours["ids"].to_list(), keep)

    key = ["leaf", "rb", "qb"]
    return best_of(rows.groupBy(*key).cogroup(asks.groupBy(*key)).applyInPandas(compare, RESULT), keep)


def neighbours(table: DataFrame, is_query, keep: int = NEIGHBOURS, recall: float = RECALL) -> DataFrame:
    """Search all rows (vec_id, embedding) for the rows that `is_query` picks."""
    rows = materialize(valid_vectors(table), "vectors")
    tree, index, sizes = build(classes_of(rows, keep + 1))
    if tree is None:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    visits, _ = calibrate(tree, index, sizes, keep, recall)
    return search(index, tree, sizes, rows.where(is_query), visits, keep)
