import hashlib
import random
import re

import pyarrow as pa
from llm.conftest import awkward_rows

from arrivo.llm import pii_crf


def plain_spans(text):
    """The patterns as written, by the regular-expression engine."""
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
        if 16 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0:
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return sorted(out)


PARTS = ["1", "25", "256", "0", "007", ".", ".", "@", "@", "a", "b", "-", "+", " ", "  ", "(", ")", "%", "é", "\n", "4111111111111111", "+1 (743) 555-3824", "1.2.3.4", "x@y.z"]


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    for _ in range(5000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25)))
        assert sorted(pii_crf.base_spans(text)) == plain_spans(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "@" * 50_000, "a@" * 50_000, "+1" + " " * 100_000, "1 " * 100_000):
        pii_crf.base_spans(text)
        pii_crf.nodes_of(text)


def sample_texts():
    rng = random.Random(2)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    texts = []
    for _ in range(150):
        texts.append(f"the word +1 ({number(3)}) 555-{number(4)} and {rng.randint(1, 255)}.{rng.randint(1, 255)}.3.4 in ing{number(2)}@mail{number(1)}.example.com or 4111111111111111 x{number(5)} {number(4)}")
    return texts


def model():
    graph = pii_crf.Graph()
    for i, text in enumerate(sample_texts()):
        graph.add(i, text, sorted(pii_crf.base_spans(text)))
    return pii_crf.train(graph)


def test_field_spreads_what_the_document_says_elsewhere():
    field = model()
    text = "Call +1 (743) 555-3824 today. Later dial (743) 555-3824 again."
    base, more = pii_crf.find(pa.array([text]), field)[0]
    assert [text[a:b] for _, a, b in base] == ["+1 (743) 555-3824"]
    assert [text[a:b] for _, a, b in more] == ["(743) 555-3824"]
    assert pii_crf.masked(text, base + more) == "Call [phone] today. Later dial [phone] again."


def test_no_spans_without_base():
    """Numbers alone, however they look, are left alone."""
    clean = ["in 1999 and 2001 or 12 34 56", "(743) 555-3824", "version 1.2.3 of 2020-01-02", "order 12345678 a1b2"]
    assert all(found == ([], []) for found in pii_crf.find(pa.array(clean), model()))


def test_message_passing_is_exact_on_a_chain():
    """Without skip edges the graph is a chain, where messages give the exact marginals."""
    import itertools

    import numpy as np

    rng = np.random.default_rng(0)
    field = pii_crf.Field(rng.normal(size=(pii_crf.SLOTS, pii_crf.LABELS)), rng.normal(size=(3, pii_crf.LABELS, pii_crf.LABELS)))
    graph = pii_crf.Graph(owner=[0] * 4, slots=[[1, 2], [3, 4], [5, 6], [7, 8]], base=[0] * 4, chain=[(0, 1), (1, 2), (2, 3)])
    own = field.unary[np.array(graph.slots)].sum(1)
    weight = np.zeros((4, pii_crf.LABELS))
    for y in itertools.product(range(pii_crf.LABELS), repeat=4):
        w = np.exp(sum(own[i, y[i]] for i in range(4)) + sum(field.pair[0][y[i], y[i + 1]] for i in range(3)))
        for i in range(4):
            weight[i, y[i]] += w
    assert np.allclose(field.beliefs(graph, rounds=80), weight / weight.sum(1, keepdims=True), atol=1e-6)


def test_grouping_of_documents_does_not_matter(monkeypatch):
    field, texts = model(), pa.array(sample_texts()[:40] + ["Call +1 (743) 555-3824 today. Later dial (743) 555-3824 again."])
    whole = pii_crf.find(texts, field)
    monkeypatch.setattr(pii_crf, "NODES_AT_ONCE", 1)
    monkeypatch.setattr(pii_crf, "EDGES_AT_ONCE", 7)
    assert pii_crf.find(texts, field) == whole


def test_awkward_rows(awkward, nothing, spark):
    field = pii_crf.fit(awkward)
    rows = pii_crf.find_spans(awkward, field).collect()
    assert len(rows) == len(awkward_rows())
    none = hashlib.sha256(b"").hexdigest()
    assert all(r.base_sha256 == none and r.spans == "" for r in rows if r.doc_id in (100, 101, 102))
    assert pii_crf.mask(awkward, field).columns == awkward.columns
    assert sorted(map(str, pii_crf.mask(awkward, field).collect())) == sorted(map(str, awkward.collect()))
    assert pii_crf.find_spans(nothing, pii_crf.fit(nothing)).count() == 0
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(sample_texts())], "doc_id long, text string")
    for r in pii_crf.find_spans(docs, pii_crf.fit(docs)).collect():
        base = plain_spans(sample_texts()[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in base) for k in range(4))
        assert set(pii_crf._listed(base).split(",")) <= set(r.spans.split(","))


def test_every_further_mention_is_found():
    """The third and later mentions are linked only to each other, not to the base span."""
    field = model()
    for mentions in (3, 4, 30):
        text = "Call +1 (743) 555-3824 today. " + "Later dial (743) 555-3824 again. " * mentions
        base, more = pii_crf.find(pa.array([text]), field)[0]
        assert [text[a:b] for _, a, b in base] == ["+1 (743) 555-3824"]
        assert [text[a:b] for _, a, b in more] == ["(743) 555-3824"] * mentions
        assert "3824" not in pii_crf.masked(text, base + more)


def test_backing_passes_through_sure_words_only():
    """Same characters, then same shape: through a word of that kind, not through one that is of none."""
    import numpy as np

    graph = pii_crf.Graph()
    graph.add(0, "x555-3824 y5553824 z x5553824 w 1234 v a555-3824b", [])
    graph.groups = [(0, 0), (0, 1), (2, 1), (3, 3), (0, 4)]
    base = np.array([4, 0, 0, 0, 0])
    assert pii_crf.backed_nodes(graph, np.array([4, 4, 4, 4, 4]), base).tolist() == [True, True, True, False, True]
    assert pii_crf.backed_nodes(graph, np.array([4, 0, 4, 4, 4]), base).tolist() == [True, False, False, False, True]
    assert pii_crf.backed_nodes(graph, np.array([4, 3, 4, 4, 3]), base).tolist() == [True, False, False, False, False]


def run_together():
    """Texts in which two pieces of data stand side by side, so that the patterns fail, among many in which they do not."""
    rng = random.Random(6)
    texts, want = sample_texts(), []
    cards = [c for c in (str(rng.randrange(10**15, 10**16)) for _ in range(900)) if pii_crf.luhn(c)]
    for i, (a, b) in enumerate(zip(cards[:20], cards[20:40])):
        texts.append(f"the word {a} and then")
        if i < 4:
            for words, kinds in ((f"+1 (826) 555-40{i}1 190.137.223.{i}", [(3, f"+1 (826) 555-40{i}1")]), (f"{a} {b}", [(2, a), (2, b)]), (f"{a} {a}", [(2, a), (2, a)])):
                want.append((f"the word {words} and then", kinds))
    return texts, want


def test_data_that_stands_side_by_side():
    texts, want = run_together()
    graph = pii_crf.Graph()
    for i, text in enumerate(texts + [w[0] for w in want]):
        graph.add(i, text, sorted(pii_crf.base_spans(text)))
    field = pii_crf.train(graph)
    for text, kinds in want:
        base, more = pii_crf.find(pa.array([text]), field)[0]
        assert [(k, text[a:b]) for k, a, b in sorted(more, key=lambda s: s[1])] == kinds, text
    clean = ["in 1999 and 2001 or 12 34 56", "(743) 555-3824", "order 1234567812345678 a1b2", "12.2020 and 1.2.3"]
    assert all(found == ([], []) for found in pii_crf.find(pa.array(clean), field))


def test_skip_edges_change_the_result():
    """Repeated data teaches the skip potentials; without them the beliefs are others."""
    import numpy as np

    rng = random.Random(8)
    cards = [c for c in (str(rng.randrange(10**15, 10**16)) for _ in range(1200)) if pii_crf.luhn(c)][:80]
    graph = pii_crf.Graph()
    for i, card in enumerate(cards):
        text = f"the word {card} and {rng.randrange(10**15)} then {card} of {rng.randrange(10**6)}, {card}."
        graph.add(i, text, sorted(pii_crf.base_spans(text)))
    field = pii_crf.train(graph)
    alone = pii_crf.Field(field.unary, field.pair * np.array([1.0, 0.0, 0.0])[:, None, None])
    texts = [f"x{a}x {a} {b} y {a} and {a}, {b}" for a, b in zip(cards[:40], cards[40:])]
    tested = pii_crf.Graph()
    for i, text in enumerate(texts):
        tested.add(i, text, sorted(pii_crf.base_spans(text)))
    assert np.abs(field.beliefs(tested) - alone.beliefs(tested)).max() > 0.05
    assert pii_crf.added_spans(tested, dict(enumerate(texts)), field.beliefs(tested)) != {}


def test_words_that_pass_by_themselves_are_not_taught_as_none():
    graph = pii_crf.Graph()
    text = "4111111111111111 4111111111111111 1.2.3.4 999.1.1.1 12"
    graph.add(0, text, sorted(pii_crf.base_spans(text)))
    assert graph.unknown == [True, True, False, False, False] and graph.base[2] == 2


def test_many_open_spans_and_long_words():
    text = "x" * 70 + "1 " + "x" * 70 + "2 +1 " + ". ".join(str(i % 10) for i in range(12)) + " 1.2.3.4"
    graph = pii_crf.Graph()
    spans = [(3, 0, len(text))] + [(1, i, i + 1) for i in range(0, 40, 2)]
    graph.add(0, text, spans)
    assert all(label != 0 for label in graph.base)
    assert pii_crf.shape("a" * 64 + "1") != pii_crf.shape("a" * 64 + "-")
