"""Every stage on its own input against a plain version, on awkward rows and on the whole small table."""

import re

import corpus_pipeline
import pytest
from llm.conftest import awkward_rows
from llm.test_jaccard_join import brute
from llm.test_pii import plain_spans
from llm.test_tokens import check_packed

from arrivo.llm import packing
from arrivo.session import materialize


@pytest.fixture(scope="module")
def stages(spark, awkward):
    """Output of each stage, written and read again, by name."""
    out, docs = {"documents": awkward}, awkward
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = materialize(stage(spark, docs, ""), name)
    return out


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_all_but_the_last_keep_the_columns(stages, awkward):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name].columns == awkward.columns and stages[name].dtypes == awkward.dtypes
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "personal_data", "mixture", "sequences"]


def test_language_drops_what_has_none(stages):
    lettered = [(r[0], r[1]) for r in awkward_rows() if r[1] and re.search(r"[^\W\d_]", r[1])]
    assert rows_of(stages["language"]) == sorted(lettered, key=str)


def test_near_duplicates_keep_the_smallest(stages):
    before = [(r.doc_id, r.text) for r in stages["language"].collect()]
    want = {(c if c is not None else None) for _, _, c in brute(before, 5, 80)}
    assert {r.doc_id for r in stages["near_duplicates"].collect()} == want
    assert stages["near_duplicates"].count() == len(want)


def test_personal_data_is_masked(stages):
    before, after = rows_of(stages["near_duplicates"]), rows_of(stages["personal_data"])
    assert len(before) == len(after)
    assert not any(plain_spans(t) for _, t in after)
    clean = [r for r in before if not re.search("[0-9@]", r[1])]
    assert set(clean) <= set(after)


def test_mixture_takes_and_repeats_whole_rows(stages):
    before, after = set(rows_of(stages["personal_data"])), rows_of(stages["mixture"])
    assert set(after) <= before and max(after.count(r) for r in after) <= 3


def test_sequences(stages, spark):
    docs = [(r.doc_id, r.text) for r in stages["mixture"].collect()]
    check_packed(packing.pack(stages["mixture"]).collect(), docs)
    assert stages["sequences"].columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_empty_table(spark, nothing):
    docs = nothing
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, ""), name)
        assert docs.count() == 0
