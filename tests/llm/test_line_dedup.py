"""Repeated lines against a plain count, and the filters by their promises."""

import hashlib
import random

import numpy as np
import pytest

from arrivo.llm import line_dedup
from llm.conftest import awkward_rows

SPACE = " \t\n\x0b\x0c\r"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_key(line):
    return line.strip(SPACE).translate(UPPER)


def plain_kept(rows, chars=20, least=3):
    """Per row: number of lines, number dropped, kept text."""
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(plain_key(line)) >= chars and doc is not None:
                holders.setdefault(plain_key(line), set()).add(doc)
    repeated = {key: max(docs) for key, docs in holders.items() if len(docs) >= least}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [v for v in lines if doc is None or repeated.get(plain_key(v), doc) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def plain_digest(rows):
    return sorted(((*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in plain_kept(rows)), key=str)


def line_rows(seed=3, docs=120):
    rng = random.Random(seed)
    pool = [f"shared line number {i} of the pool {'é' * (i % 5)}" for i in range(40)] + ["x" * 19, "Y" * 20, "é" * 19, "É" * 20, "short"]
    rows = []
    for i in range(docs):
        lines = [rng.choice(pool) if rng.random() < 0.5 else f"line {rng.random()} of document {i}" for _ in range(rng.randint(1, 12))]
        lines = [rng.choice(("", " ", "\t\x0b")) + (v.upper() if rng.random() < 0.3 else v) + rng.choice(("", "\r", " ")) for v in lines]
        rows.append((i, "\n".join(lines)))
    return rows


def digested(docs):
    return sorted(map(tuple, line_dedup.digest(docs).collect()), key=str)


def test_lines(make):
    rows = line_rows()
    assert sum(r[2] for r in plain_kept(rows)) > 100
    assert digested(make(rows).repartition(5)) == plain_digest(rows)


def test_awkward_rows(awkward):
    assert digested(awkward) == plain_digest([(r[0], r[1]) for r in awkward_rows()])


def test_repeated_rows_and_ids(make):
    """Rows of one id are one document; rows without id count for nothing and lose nothing."""
    line = "a line of more than twenty letters"
    rows = [(1, line), (1, line), (1, f"{line}\n{line}"), (2, f"{line}\nother"), (None, line), (None, line)]
    assert digested(make(rows)) == plain_digest(rows)
    assert all(r[2] == 0 for r in digested(make(rows)))
    rows += [(3, f"{line.upper()}\t\n{line}"), (4, None), (5, "")]
    got = digested(make(rows))
    assert got == plain_digest(rows)
    assert sum(r[2] for r in got) == 5


def test_same_key_in_the_largest_document_stays_whole(make):
    line = "the line that everybody has in common"
    got = {r.doc_id: r.text for r in line_dedup.dedup(make([(i, f"{line}\nown {i}\n{line}") for i in range(4)])).collect()}
    assert got == {0: "own 0", 1: "own 1", 2: "own 2", 3: f"{line}\nown 3\n{line}"}


def test_columns_stay(awkward, nothing):
    kept = line_dedup.dedup(awkward)
    assert kept.schema == awkward.schema
    want = sorted(((r[0], r[3] if r[1] is not None else None) for r in zip([r[0] for r in awkward_rows()], [r[1] for r in awkward_rows()], range(99), [k[3] for k in plain_kept([(r[0], r[1]) for r in awkward_rows()])])), key=str)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == want
    assert line_dedup.digest(nothing).count() == 0 and line_dedup.dedup(nothing).count() == 0


def test_other_limits(make):
    rows = [(1, "abc\nde"), (2, "abc"), (3, "de\nxyz")]
    got = {r.doc_id: r.text for r in line_dedup.dedup(make(rows), chars=3, least_docs=2).collect()}
    assert got == {r[0]: r[3] for r in plain_kept(rows, 3, 2)}
    with pytest.raises(ValueError):
        line_dedup.repeated_lines(make(rows), least_docs=1)


@pytest.mark.parametrize("most", [1 << 23, 1 << 14, 1 << 10])
def test_filters_never_forget(most):
    """Whatever the folding, every hash met twice is suspected; with room, few others are."""
    rng = np.random.default_rng(1)
    hashes = np.unique(rng.integers(0, 1 << 64, 60_000, np.uint64))
    rng.shuffle(hashes)
    repeated, single = hashes[:3000], hashes[3000:]
    seen = line_dedup.SeenTwice(1 << 19)
    seen.add(np.sort(hashes[:30_000]), np.zeros(30_000, bool))
    seen.add(np.concatenate([repeated[:2000], hashes[30_000:]]), np.zeros(2000 + len(hashes) - 30_000, bool))
    seen.add(repeated[2000:], np.ones(1000, bool))
    suspected = line_dedup.Suspicion(1, {0: seen.folded(most)})
    assert suspected(repeated).all()
    if most == 1 << 23:
        assert suspected(single).mean() < 0.05


def test_segments():
    rng = np.random.default_rng(4)
    hashes = rng.integers(0, 1 << 64, 4000, np.uint64)
    owner = line_dedup.segment_of(hashes, np.uint64(64 - 2))
    filters = {}
    for s in (0, 1, 3):  # segment 2 has no lines
        seen = line_dedup.SeenTwice(1 << 16)
        mine = hashes[owner == s]
        seen.add(mine, np.arange(len(mine)) % 2 == 0)
        filters[s] = seen.folded(1 << 16)
    suspected = line_dedup.Suspicion(4, filters)(hashes)
    for s in range(4):
        mine = suspected[owner == s]
        assert (mine[::2].all() and mine[1::2].mean() < 0.1) if s in filters else not mine.any()


def test_many_segments(make, monkeypatch):
    monkeypatch.setattr(line_dedup, "SEGMENT_KEYS", 50)
    monkeypatch.setattr(line_dedup, "SEGMENT_BITS", 1 << 11)
    monkeypatch.setattr(line_dedup, "FLUSH_KEYS", 30)
    rows = line_rows(7)
    assert digested(make(rows).repartition(4)) == plain_digest(rows)
