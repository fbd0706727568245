import random
import re

import numpy as np
import pyarrow as pa
import pytest

from arrivo.llm.words import Words, chain, pieces, sums

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("lower", [False, True])
def test_words_are_runs_of_other_characters(lower):
    rng = random.Random(3)
    texts = ["", " ", "a", " a  b c\x1cD E ", "\x0bÄ\x0cb\r\n"] + ["".join(rng.choice("aB é\t\n\x0b\x85 ") for _ in range(30)) for _ in range(200)]
    words = Words(pa.array(texts), lower)
    vocabulary = words.vocabulary.to_pylist()
    got = [[vocabulary[c] for c in words.codes[a:b]] for a, b in zip(words.starts[:-1], words.starts[1:])]
    fold = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t) if lower else t
    assert got == [SPLIT.findall(fold(t)) for t in texts]


def test_no_texts():
    words = Words(pa.array([], pa.string()))
    assert len(words) == 0 and list(words.starts) == [0]


def test_pieces_keep_rows_whole_and_in_order():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (5, 0, 100, 3, 3)] + [None]})
    parts = list(pieces(iter([batch, batch.slice(0, 0)]), limit=8))
    assert [t for p in parts for t in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert max(p.num_rows for p in parts) < batch.num_rows


def test_sums_of_empty_ranges():
    assert list(sums(np.array([1, 2, 3]), np.array([0, 0, 2, 2, 3]))) == [0, 3, 0, 3]


def test_chain_depends_on_order():
    a, b = np.array([1], np.uint64), np.array([2], np.uint64)
    assert chain([a, b]) != chain([b, a]) and chain([a]) != chain([a], seed=1)
