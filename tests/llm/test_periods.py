"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from arrivo.llm import periods
from llm.conftest import awkward_rows


def plain_runs(w, least=6, exponent=4):
    n, out = len(w), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            s, size = i, j + q - i
            if size >= max(least, exponent * q) and not any(all(w[x] == w[x + p] for x in range(s, s + size - p)) for p in range(1, q)):
                out.append((s, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_words(doc_id, text, plant):
    w = [] if text is None else [v.decode() for v in text.encode().split()]
    n = len(w)
    if plant and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    return w


def plain_digest(doc_id, text, plant=True):
    w = plain_words(doc_id, text, plant)
    runs = plain_runs(w)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    longest = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    listed = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    kept = " ".join(v for i, v in enumerate(w) if i not in gone)
    return (doc_id, len(runs), *longest, *(hashlib.sha256(t.encode()).hexdigest() for t in (listed, kept)))


def repeating(rng, n):
    """Words of few kinds, from some place on repeated with a period, sometimes with one word changed."""
    w = [rng.choice("abcde"[: rng.choice((1, 2, 5))]) for _ in range(n)]
    if n > 8 and rng.random() < 0.7:
        a, p = rng.randrange(n), 1 + rng.randrange(max(1, n // 4))
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if rng.random() < 0.4:
            w[rng.randrange(n)] = "x"
    return w


def found(docs):
    """Runs per document of lists of words, all in one piece."""
    names = {v: i for i, v in enumerate(sorted({v for d in docs for v in d}))}
    codes = np.array([names[v] for d in docs for v in d], np.int64)
    starts = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
    runs = periods.find(codes, starts)
    bounds = np.searchsorted(runs.start, starts)
    return [
        [(int(runs.start[k] - starts[i]), int(runs.length[k]), int(runs.period[k])) for k in range(bounds[i], bounds[i + 1])]
        for i in range(len(docs))
    ]


def test_runs_equal_plain_search():
    rng = random.Random(5)
    for _ in range(300):
        docs = [repeating(rng, rng.choice((0, 1, 5, 6, 7, 13, 40, 90))) for _ in range(rng.randint(1, 6))]
        assert found(docs) == [plain_runs(d) for d in docs]


def test_every_period_and_offset():
    """A run of exactly the least length is found wherever it starts."""
    for q in (1, 2, 3, 4, 5, 7, 8, 9, 16, 17):
        for lead in range(0, 2 * q + 3):
            size = max(6, 4 * q)
            w = [f"l{i}" for i in range(lead)] + [f"w{i % q}" for i in range(size)] + ["end"]
            assert found([w]) == [[(lead, size, q)]]


def test_long_constant_text():
    assert found([["a"] * 20_000]) == [[(0, 20_000, 1)]]


def test_wavelet_successor():
    rng = np.random.default_rng(2)
    values = rng.permutation(300)
    tree = periods.WaveletTree(values)
    low = rng.integers(0, 300, 500)
    high = np.minimum(low + rng.integers(0, 60, 500), 300)
    x = rng.integers(0, 700, 500)
    want = [min((v for v in values[a:b] if v >= y), default=-1) for a, b, y in zip(low, high, x)]
    assert tree.successor(low, high, x).tolist() == want


def test_suffix_array_ranges():
    """The range of a block holds exactly the places at which it occurs."""
    rng = random.Random(8)
    w = [rng.randrange(2) for _ in range(200)]
    codes, starts = np.array(w), np.array([0, 120, 200])
    suffixes, slots, blocks = periods.repeated_blocks(codes, starts)
    place = dict(zip(slots.tolist(), suffixes.tolist()))
    for level in blocks:
        for at, low, high in zip(level.at.tolist(), level.low.tolist(), level.high.tolist()):
            first, last = (0, 120) if at < 120 else (120, 200)
            same = [i for i in range(first, last - level.length + 1) if w[i : i + level.length] == w[at : at + level.length]]
            assert sorted(place[k] for k in range(low, high)) == same


def test_weaker_runs_are_refused():
    with pytest.raises(ValueError):
        periods.find(np.zeros(3, np.int64), np.array([0, 3]), exponent=3)


def test_stronger_runs():
    w = ["a", "b"] * 4 + ["c"] + ["d"] * 9
    codes = np.unique(w, return_inverse=True)[1]
    runs = periods.find(codes, np.array([0, len(w)]), least=9, exponent=5)
    assert (runs.start.tolist(), runs.length.tolist(), runs.period.tolist()) == ([9], [9], [1])


@pytest.mark.parametrize("plant", [False, True])
def test_digest(awkward, plant):
    got = [tuple(r) for r in periods.digest(awkward, plant).collect()]
    assert len(got) == len(awkward_rows())
    # the plain search over the very long text takes too long; `test_long_constant_text` has one
    want = [plain_digest(r[0], r[1], plant) for r in awkward_rows() if r[0] != 105]
    assert sorted((r for r in got if r[0] != 105), key=str) == sorted(want, key=str)


def test_planted_documents(spark, make):
    """Enough ids that the planted repetition is met, over texts that repeat by themselves too."""
    rng = random.Random(4)
    rows = [(i, " ".join(repeating(rng, rng.choice((1, 4, 30, 80))))) for i in range(150)]
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows) > 5
    got = sorted(map(tuple, periods.digest(make(rows).repartition(3), plant=True).collect()), key=str)
    assert got == sorted((plain_digest(*r) for r in rows), key=str)


def test_runs_and_collapsed_texts(make, awkward):
    docs = make([(1, "x a b a b a b\na b y"), (2, "no run  here"), (3, None)])
    assert [tuple(r) for r in periods.find_runs(docs).collect()] == [(1, 1, 8, 2)]
    assert {r.doc_id: r.text for r in periods.collapse(docs).collect()} == {1: "x a b y", 2: "no run  here", 3: None}
    assert periods.collapse(awkward).schema == awkward.schema


def test_empty_table(nothing):
    assert periods.digest(nothing).count() == 0
    assert periods.find_runs(nothing).count() == 0
