"""Spelling variants against all pairs of a small vocabulary."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from arrivo.llm import spelling
from llm.conftest import awkward_rows

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(rows, misspelt):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(UPPER)
            h = zlib.crc32(f"{doc}:{word}".encode())
            if misspelt and doc is not None and h % misspelt == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= 6:
                counts[word] += 1
    return {w: n for w, n in counts.items() if n >= 5}


def one_edit(x, y):
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    if len(x) > len(y):
        x, y = y, x
    return len(y) == len(x) + 1 and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def plain_variants(rows, misspelt=0):
    n = plain_counts(rows, misspelt)
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, n[w], len(near[w]), form[w], n.get(form[w]), root(w)) for w in n)


def variants(docs, misspelt=0):
    rows = spelling.variants(docs, misspelt).select("word", "n", "n_near", "form", "form_n", "root").collect()
    return sorted(map(tuple, rows))


def spelled_rows(seed=1, docs=60):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcdeéß×") for _ in range(rng.randint(6, 9))) for _ in range(12)]
    rows = []
    for i in range(docs):
        words = []
        for _ in range(120):
            word = stems[min(int(rng.expovariate(0.6)), 11)]
            for _ in range(rng.choice((0, 0, 0, 0, 1, 1, 2))):
                k = rng.randrange(len(word))
                word = rng.choice((word[:k] + word[k + 1 :], word[:k] + rng.choice("abcé") + word[k:], word[:k] + rng.choice("abcé") + word[k + 1 :]))
            words.append(word.upper() if rng.random() < 0.1 else word)
        rows.append((i, rng.choice((" ", "-", "1", "Ā")).join(words)))
    return rows


@pytest.mark.parametrize("misspelt", [0, 7])
def test_variants(make, misspelt):
    rows = spelled_rows()
    want = plain_variants(rows, misspelt)
    assert len(want) > 100 and sum(r[3] is not None for r in want) > 20
    assert variants(make(rows).repartition(3), misspelt) == want


def test_parts_of_blocks(make, monkeypatch):
    """Blocks larger than a part: every pair still meets once."""
    monkeypatch.setattr(spelling, "BLOCK_WORDS", 3)
    monkeypatch.setattr(spelling, "classes_for", lambda words: 1)
    rows = spelled_rows(2, 30)
    assert variants(make(rows).repartition(3)) == plain_variants(rows)


def test_awkward_rows(awkward):
    rows = [(r[0], r[1]) for r in awkward_rows() if r[0] != 105]
    docs = awkward.where("doc_id is null or doc_id <> 105")
    assert variants(docs, 13) == plain_variants(rows, 13)


def test_very_long_words(make):
    long = "ab" * 3000
    rows = [(i, f"{long} {long}x {'c' * 70}é {'c' * 70}") for i in range(5)]
    assert variants(make(rows), 3) == plain_variants(rows, 3)


def test_chains_and_ties(make):
    """A chain of forms, near words of one count, a word without near words."""
    rows = [(1, " ".join(["abcdef"] * 5 + ["abcdex"] * 25 + ["abcdxx"] * 125 + ["abcdefg"] * 25 + ["unalike"] * 9))]
    got = {r[0]: r for r in variants(make(rows))}
    assert got["abcdef"][2:] == (2, "abcdefg", 25, "abcdefg")  # of two with 25, the first in order
    assert got["abcdex"][2:] == (2, "abcdxx", 125, "abcdxx")
    assert got["unalike"][2:] == (0, None, None, "unalike")
    assert sorted(got.values()) == plain_variants(rows)


def test_paired_crc():
    rng = random.Random(3)
    prefixes = [f"{rng.randrange(10**6)}:".encode() for _ in range(20)]
    words = ["é".encode() * k + b"w" * j for k in (0, 1, 40) for j in (1, 7, 30, 64, 65)]
    owner, code = np.repeat(np.arange(20), len(words)), np.tile(np.arange(len(words)), 20)
    want = [zlib.crc32(prefixes[i] + words[j]) for i, j in zip(owner, code)]
    assert spelling.paired_crc(prefixes, words, owner, code).tolist() == want


def test_gram_distances_rule_nothing_out():
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("abzÀÿ") for _ in range(6)) for _ in range(300)})
    points = spelling.letters(words, 6)
    i, j = spelling.near_pairs(points, points, same=True)
    assert {(words[a], words[b]) for a, b in zip(i, j)} == {(x, y) for x in words for y in words if x < y and one_edit(x, y)}


def test_each_pair_of_blocks_once():
    """Two near words meet in exactly one block, whatever their letters."""
    rng = random.Random(9)
    for _ in range(300):
        x = "".join(rng.choice("abcdefg") for _ in range(6))
        k = rng.randrange(6)
        y = rng.choice((x[:k] + rng.choice("abcdefg") + x[k + 1 :], x[:k] + rng.choice("abcdefg") + x[k:]))
        if x == y:
            continue
        home = [tuple(spelling.profiles([w], 3)[0]) for w in (x, y)]
        away = [[tuple(t[0]) for t in spelling.visited(spelling.profiles([w], 3))] for w in (x, y)]
        assert (home[0] == home[1]) + away[0].count(home[1]) + away[1].count(home[0]) == 1


def test_empty(nothing, make):
    assert variants(nothing) == []
    assert variants(make([(1, "short words only here"), (2, None)])) == []
    found, counts = spelling.count_piece(pa.array(["", "12 ab"]), [1, 2], 3)
    assert len(found) == 0 and len(counts) == 0
