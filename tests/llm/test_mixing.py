import duckdb
import pandas as pd
import pytest
from llm.conftest import awkward_rows
from pyspark.sql import functions as F

from arrivo.llm import mixing
from arrivo.llm.queries import SQL


def against_sql(docs):
    documents, pieces = mixing.mix(docs, block_words=64)
    got = mixing.taken_words(documents, pieces).drop("row")
    connection = duckdb.connect()
    rows = [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]
    connection.register("documents_", pd.DataFrame({"doc_id": pd.array([r[0] for r in rows], "Int64"), "text": [r[1] for r in rows], "source": [r[2] for r in rows]}, dtype=object))
    connection.execute("CREATE VIEW documents AS SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(text AS VARCHAR) AS text, CAST(source AS VARCHAR) AS source FROM documents_")
    cursor = connection.execute(SQL["op4_source_mix"])
    assert [d[0] for d in cursor.description] == got.columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, cursor.fetchall()))
    return documents, pieces


def plain_targets(sizes, weights):
    """Resharing by rounds, as the rule is written."""
    total, capped = sum(sizes), {}
    while True:
        rest = [i for i in range(len(sizes)) if i not in capped]
        level = (total - sum(capped.values())) / sum(weights[i] for i in rest) if rest else 0
        over = [i for i in rest if weights[i] * level > 3 * sizes[i] + 1e-9]
        if not over:
            return [capped.get(i, weights[i] * level) for i in range(len(sizes))]
        capped.update({i: 3 * sizes[i] for i in over})


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 1000, 5], [1, 1, 1000, 0, 3, 50], [0, 0], [7], [2, 3, 500, 400, 1, 90, 800]])
def test_targets_reshare_the_excess(make, sizes):
    docs = make([(i, "w " * n, f"s{i}") for i, n in enumerate(sizes)])
    sized = docs.select("source", mixing.word_count(F.col("text")).alias("size"))
    got = [r.target for r in mixing.source_targets(sized).orderBy("number").collect()]
    want = plain_targets(sizes, [mixing.WEIGHTS[i % 3] for i in range(len(sizes))])
    assert got == pytest.approx(want)


def test_awkward_rows_equal_sql(awkward):
    documents, pieces = against_sql(awkward)
    # pieces stay within their documents, and no slot holds more than its block
    sizes = {r.row: r.size for r in documents.collect()}
    rows = pieces.collect()
    assert all(0 <= p.first and p.length > 0 and p.first + p.length <= sizes[p.row] for p in rows)


def test_skewed_sources_equal_sql(make):
    docs = make([(i, "w " * (i % 7 + 1), "big" if i % 3 else f"s{i % 5}") for i in range(400)])
    documents, pieces = against_sql(docs)
    taken = pieces.groupBy("number").agg(F.sum("length").alias("n")).collect()
    targets = {r.number: r.words for r in documents.select("number", "words").distinct().collect()}
    assert {r.number: r.n for r in taken} == {k: v for k, v in targets.items() if v}


def test_schedule_is_even(spark):
    """Any stretch of the schedule is close to the target mix."""
    targets = spark.createDataFrame([(0, 0.0, 0.6, 60), (1, 0.6, 0.9, 30), (2, 0.9, 1.0, 10)], "number int, low double, high double, words long")
    rows = sorted((r.slot, r.number, r.rank) for r in mixing.schedule(targets, 1000).collect())
    assert [r[0] for r in rows] == list(range(1000))
    for start in range(0, 900, 100):
        part = [r[1] for r in rows[start : start + 100]]
        assert all(abs(part.count(k) - n) <= 4 for k, n in ((0, 60), (1, 30), (2, 10)))
    for k in range(3):
        assert [r[2] for r in rows if r[1] == k] == list(range(sum(r[1] == k for r in rows)))


def test_no_words_and_no_rows(make, nothing):
    documents, pieces = mixing.mix(make([(1, None, "a"), (2, "", None)]))
    assert pieces.count() == 0
    assert sorted(map(tuple, mixing.taken_words(documents, pieces).drop("row").collect())) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    documents, pieces = mixing.mix(nothing)
    assert mixing.taken_words(documents, pieces).count() == 0


def test_plan_is_native(make):
    documents, pieces = mixing.mix(make([(1, "a b", "x")]))
    plan = mixing.taken_words(documents, pieces)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))


def test_mixed_documents_keep_columns_and_meet_targets(awkward, make):
    mixed = mixing.mixed_documents(awkward)
    assert mixed.columns == awkward.columns
    assert mixed.count() > 0
    docs = make([(i, "w " * 10, f"s{i % 3}") for i in range(240)])
    n = {r.source: r["count"] for r in mixing.mixed_documents(docs).groupBy("source").count().collect()}
    assert n == {"s0": 150, "s1": 60, "s2": 30}
    assert len(awkward_rows()) == awkward.count()
