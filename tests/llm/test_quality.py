import re
from collections import Counter

import numpy as np
import pyarrow as pa
from llm.conftest import awkward_rows, made_rows

from arrivo.llm import quality_mil, quality_rules
from arrivo.llm.words import Words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    """The five counts, word by word."""
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


TEXTS = [r[1] for r in awkward_rows()] + ["a b c a b c a", "x\nx\n\n \nx", "a a a a", "#*$%&|<> é ü", "w " * 40 + "v " * 40]


def test_counts_are_exact():
    counts, matrix = quality_rules.statistics(pa.array([t or "" for t in TEXTS]))
    assert [tuple(r) for r in counts.tolist()] == [plain_counts(t) for t in TEXTS]
    assert np.isfinite(matrix).all()


def test_trees_obey_their_signs():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 3))
    signal = x[:, 0] + np.sin(3 * x[:, 1])
    y = (signal + rng.normal(size=3000) > 0).astype(float)
    signs = np.array([1, 0, -1])
    trees = quality_rules.fit_trees(x, y, signs)
    # no rule does better on average than the sign of the signal itself
    assert ((trees.score(x) > 0.5) == y).mean() > ((signal > 0) == y).mean() - 0.01
    grid = np.linspace(-3, 3, 50)
    for f in (0, 2):
        for row in x[:40]:
            line = np.tile(row, (50, 1))
            line[:, f] = grid
            assert (signs[f] * np.diff(trees.margin(line)) >= -1e-12).all()


def test_flattened_trees_equal_recursion():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 4))
    trees = quality_rules.fit_trees(x, (x[:, 0] * x[:, 1] > 0).astype(float), np.zeros(4, int), rounds=10)

    def walk(node, row):
        while trees.left[node] != node:
            node = trees.left[node] if row[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
        return trees.value[node]

    assert np.allclose(trees.margin(x[:50]), [trees.base + sum(walk(r, row) for r in trees.roots) for row in x[:50]])


def test_rules_on_awkward_rows(awkward, nothing, labels, no_labels):
    for known in (labels, no_labels):
        rows = quality_rules.apply_rules(awkward, quality_rules.fit(awkward, known)).collect()
        got = sorted((r[0] if r[0] is not None else -1, *r[1:8]) for r in rows)
        want = []
        for doc_id, text, *_ in awkward_rows():
            n = plain_counts(text)
            want.append((-1 if doc_id is None else doc_id, *n, n[0] < 50 or 100 * n[4] > 50 * n[0]))
        assert [g[:7] for g in got] == sorted(want)
        assert not any(r.kept and r.base_failed for r in rows)
    empty = quality_rules.apply_rules(nothing, quality_rules.fit(nothing, no_labels))
    assert empty.count() == 0 and "kept" in empty.columns


def test_classifier_learns_and_never_sees_held_out(spark):
    import zlib

    rows = made_rows(400, 4)
    bad = lambda t: " ".join(w.upper() + "!!" for w in t.split())
    docs = spark.createDataFrame([(i, bad(t) if i % 4 == 0 else t) for i, t, *_ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], int(r[0] % 4 > 0)) for r in rows], "doc_id long, quality int")
    model = quality_mil.fit(docs, labels)
    got = quality_mil.score_documents(docs, model).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0}
    assert np.mean([r.predicted == int(r.doc_id % 4 > 0) for r in held]) > 0.95
    # turned labels of held-out rows change nothing
    held_ids = [r.doc_id for r in held]
    turned = spark.createDataFrame([(r[0], int(r[0] % 4 > 0) ^ int(r[0] in held_ids)) for r in rows], "doc_id long, quality int")
    again = {r.doc_id: r.score for r in quality_mil.score_documents(docs, quality_mil.fit(docs, turned)).collect()}
    assert again == {r.doc_id: r.score for r in got}


def test_attention_gradient():
    """Training lowers the loss on bags whose label hangs on one passage."""
    rng = np.random.default_rng(2)
    bags, y = [], []
    for i in range(200):
        bag = rng.normal(0, 0.3, (rng.integers(1, 8), 5))
        if i % 2:
            bag[rng.integers(len(bag)), 0] += 3
        bags.append(bag)
        y.append(i % 2)
    model = quality_mil.train(bags, np.array(y, float), 0.5)
    score = model.score(np.concatenate(bags), np.array([len(b) for b in bags]))
    assert ((score > 0.5) == np.array(y)).mean() > 0.95


def test_classifier_on_awkward_rows(awkward, nothing, labels, no_labels):
    for known in (labels, no_labels):
        rows = quality_mil.score_documents(awkward, quality_mil.fit(awkward, known)).collect()
        assert len(rows) == len(awkward_rows())
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
        assert {r.score for r in rows if r.doc_id in (100, 101, 102)} == {0.0}
        assert all(r.held_out for r in rows if r.doc_id is None)
    assert quality_mil.score_documents(nothing, quality_mil.fit(nothing, no_labels)).count() == 0


def test_passages_cover_all_words():
    words = Words(pa.array(["", "a " * 48, "b " * 49, "c"]))
    starts, number = quality_mil.passages(words)
    assert list(number) == [0, 1, 2, 1] and list(np.diff(np.append(starts, len(words)))) == [48, 48, 1, 1]
