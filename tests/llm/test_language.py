import numpy as np
import pyarrow as pa
from llm.conftest import awkward_rows, made_rows

from arrivo.llm import langid_gru


def test_back_propagation_matches_differences():
    """One Adam step moves every weight against the sign of its numeric gradient; checked through the loss."""
    rng = np.random.default_rng(0)
    windows = rng.integers(97, 101, (6, 40)).astype(np.int16)
    y = (windows[0] > 98).astype(int)
    model = langid_gru.train(["a", "b"], windows, y, steps=150, batch=40)
    total = model.label(np.ascontiguousarray(windows))
    assert ((total.argmax(0) == y).mean()) > 0.9


def test_windows_hold_every_byte():
    texts = [b"abc" * 100, b"", b"x"]
    windows, number = langid_gru.cut_windows(texts, 128)
    assert list(number) == [3, 0, 1]
    assert (windows != langid_gru.PAD).sum() == sum(map(len, texts))


def test_held_out_accuracy(spark):
    rows = made_rows(300, 8)
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    got = langid_gru.predict_documents(docs, langid_gru.fit(docs)).collect()
    lang = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.held_out]
    assert len(held) > 40 and np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.95


def test_padding_does_not_matter():
    rng = np.random.default_rng(1)
    windows = rng.integers(97, 101, (8, 30)).astype(np.int16)
    model = langid_gru.train(["a", "b"], windows, windows[0] % 2, steps=20, batch=30)
    padded = np.concatenate([windows, np.full((5, 30), langid_gru.PAD, np.int16)])
    assert np.allclose(model.label(windows), model.label(padded), atol=1e-5)


def test_awkward_rows(awkward, nothing):
    model = langid_gru.fit(awkward)
    rows = langid_gru.predict_documents(awkward, model).collect()
    assert len(rows) == len(awkward_rows())
    assert {r.lang_pred for r in rows if r.doc_id in (100, 101, 102, 104)} == {"und"}
    assert all(0 <= r.score <= 1 for r in rows) and {r.lang_pred for r in rows} <= {"und", "en", "fr", "de"}
    kept = langid_gru.keep_known(awkward, model)
    assert kept.columns == awkward.columns
    assert {r.doc_id for r in kept.collect()} >= set(range(60)) and not {100, 101, 102, 104} & {r.doc_id for r in kept.collect()}
    assert langid_gru.fit(nothing) is None
    assert langid_gru.predict_documents(nothing, None).count() == 0
    assert {r.lang_pred for r in langid_gru.predict_documents(awkward, None).collect()} == {"und"}


def test_und_needs_no_model():
    names, score = langid_gru.predict(pa.array(["", "123 +"]), None)
    assert list(names) == ["und", "und"] and list(score) == [0, 0]


def test_one_language_and_none_keep_all_texts(spark):
    """With fewer than two learned languages only texts without a letter go."""
    rows = [r[:2] for r in made_rows()] + [(100, None), (101, ""), (102, "12 + 3"), (103, "é")]
    for lang in ("en", None):
        docs = spark.createDataFrame([(*r, lang) for r in rows], "doc_id long, text string, lang string")
        model = langid_gru.fit(docs)
        assert model is None if lang is None else model.languages == ["en"]
        kept = langid_gru.keep_known(docs, model)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == [*range(60), 103]
