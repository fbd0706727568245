import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm.conftest import awkward_rows

from arrivo.llm import kneser_ney


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered) + ["</s>"]


class Plain:
    """The model by definition, on dictionaries of words."""

    def __init__(self, texts, order):
        self.order, self.plain = order, Counter()
        level = {order: Counter()}
        for t in texts:
            s = ["<s>"] * (order - 1) + words_of(t)
            for i in range(order - 1, len(s)):
                level[order][tuple(s[i - order + 1 : i + 1])] += 1
                self.plain[s[i]] += 1
        for k in range(order - 1, 0, -1):
            level[k] = Counter(g[1:] for g in level[k + 1])
        self.level = level
        self.cut = {k: (0, *kneser_ney.discounts([0] + [sum(v == j for v in level[k].values()) for j in (1, 2, 3, 4)])) for k in level}
        self.context = {k: defaultdict(lambda: [0, 0, 0, 0]) for k in level}
        for k in level:
            for g, c in level[k].items():
                self.context[k][g[:-1]][0] += c
                self.context[k][g[:-1]][min(c, 3)] += 1

    def p(self, gram):
        if not gram:
            return 1 / (len(self.plain) + 1)
        k = len(gram)
        x = self.context[k].get(gram[:-1])
        if x is None:
            return self.p(gram[1:])
        c, d = self.level[k].get(gram, 0), self.cut[k]
        return (c - d[min(c, 3)]) / x[0] + sum(d[j] * x[j] for j in (1, 2, 3)) / x[0] * self.p(gram[1:])

    def score(self, text):
        s = ["<s>"] * (self.order - 1) + words_of(text)
        return sum(math.log10(self.p(tuple(s[i - self.order + 1 : i + 1]))) for i in range(self.order - 1, len(s)))

    def base(self, text):
        total = sum(self.plain.values())
        return sum(math.log10((self.plain[w] + 0.1) / (total + 0.1 * (len(self.plain) + 1))) for w in words_of(text))


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_the_definition(awkward, order, monkeypatch):
    monkeypatch.setattr(kneser_ney, "FLUSH_ROWS", 500)
    docs = awkward_rows()
    train = [t for i, t, *_ in docs if i is not None and zlib.crc32(str(i).encode()) % 10]
    plain = Plain(train, order)
    model = kneser_ney.fit(kneser_ney.training_rows(awkward), order, shard_bytes=20_000)
    assert model.shards > 5 and model.tokens == sum(plain.plain.values()) and model.words == len(plain.plain)
    got = kneser_ney.score_documents(awkward, model).collect()
    assert len(got) == len(docs)
    key = lambda r: (-1 if r[0] is None else r[0], round(r[1], 5), round(r[2], 5), *r[3:])
    want = [(i, plain.score(t), plain.base(t), len(words_of(t)), sum(w in plain.plain for w in words_of(t)), i is None or zlib.crc32(str(i).encode()) % 10 == 0) for i, t, *_ in docs]
    for g, w in zip(sorted(key((r.doc_id, r.score, r.base_score, r.n_tokens, r.n_known, r.held_out)) for r in got), sorted(map(key, want))):
        assert g[0] == w[0] and g[3:] == w[3:] and g[1:3] == pytest.approx(w[1:3], rel=1e-6, abs=2e-5)


def test_probabilities_add_up_to_one(make):
    docs = make([(i, t) for i, t in enumerate(["a b c a b", "b a", "c c c a", ""])])
    model = kneser_ney.fit(docs, 2)
    from arrivo.llm.words import Words
    import pyarrow as pa

    vocabulary = np.append(Words(pa.array(["a b c neverseen"])).hashes(), kneser_ney.END)
    for before in [*vocabulary, kneser_ney.BEGIN]:
        p, _ = model.probability([np.full(len(vocabulary), before, np.uint64), vocabulary])
        assert p.sum() == pytest.approx(1)


def test_large_counts_are_kept(make):
    docs = make([(1, "a b " * 5000)])
    model = kneser_ney.fit(docs, 2)
    plain = Plain(["a b " * 5000], 2)
    got = {r.doc_id: r.score for r in kneser_ney.score_documents(make([(7, "a b b a")]), model).collect()}
    assert got[7] == pytest.approx(plain.score("a b b a"))


def test_no_training_rows(make, nothing):
    model = kneser_ney.fit(nothing)
    rows = kneser_ney.score_documents(make([(1, "a b"), (2, None)]), model).collect()
    assert [(r.train_tokens, r.n_known, r.score, r.base_score) for r in rows] == [(0, 0, 0.0, 0.0)] * 2
    assert kneser_ney.score_documents(nothing, model).count() == 0


def test_arrays_are_mapped(make):
    model = kneser_ney.fit(make([(1, "a b c")]))
    files = [kneser_ney.load(f"{model.folder}/2/{s}-keys.npy") for s in range(model.shards)]
    some = [f for f in files if len(f)]
    assert some and all(isinstance(f, np.memmap) for f in some)
    assert all((np.diff(f.astype(object)) > 0).all() for f in some)


def test_blocks_stay_small(make):
    """A task sends its n-grams in blocks of a bounded number of rows, compressed, however many a shard gets of them."""
    words = [f"w{i}" for i in range(40_000)]
    blocks = kneser_ney.count_blocks(make([(1, " ".join(words))]).select("text"), 2, 2).collect()
    assert sum(b.rows for b in blocks) == len(words) + 1 and {b.shard for b in blocks} == {0, 1}
    assert max(b.rows for b in blocks) <= 8_192
    assert all(len(b.data) < 24 * b.rows for b in blocks if b.rows > 1000)


def test_shard_is_merged_in_ranges(monkeypatch):
    """The blocks of a shard are added up like dictionaries would, and never sorted all at once."""
    monkeypatch.setattr(kneser_ney, "MERGE_ROWS", 500)
    sorted_at_once, runs = [], kneser_ney._runs
    monkeypatch.setattr(kneser_ney, "_runs", lambda key: sorted_at_once.append(len(key)) or runs(key))
    draw, want, blocks = np.random.default_rng(5), Counter(), []
    for _ in range(40):
        first, second = (draw.integers(0, 60, 200).astype(np.uint64) * np.uint64(2**58 - 9) for _ in range(2))
        order = np.argsort(first, kind="stable")
        counts = draw.integers(1, 2**32, 200).astype(np.uint32)
        blocks.append(([first[order], second[order]], [counts, np.ones(200, np.uint32)]))
        for row in zip(first[order].tolist(), second[order].tolist(), counts.tolist()):
            want[row[:2]] += row[2]
    columns, (adjusted, plain) = kneser_ney._merged(blocks)
    assert dict(zip(zip(columns[0].tolist(), columns[1].tolist()), adjusted.tolist())) == want and plain.sum() == 8000
    key = kneser_ney.chain(columns)
    assert (key[1:] > key[:-1]).all() and len(sorted_at_once) > 10 and max(sorted_at_once) < 1500
    assert [len(c) for c in kneser_ney._merged([([np.zeros(0, np.uint64)] * 2, [np.zeros(0, np.uint32)] * 2)])[0]] == [0, 0]
