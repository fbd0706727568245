"""Temporal cohorts, metrics, calibration levels."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest

from arrivo.operators import metrics, risk, temporal
from arrivo.schemas import PREDICTION_TIME, TARGET


def timeline(spark, n, step_days):
    rows = [(i, datetime(2017, 1, 1) + timedelta(days=step_days * i), i % 2) for i in range(n)]
    return spark.createDataFrame(rows, f"id int, {PREDICTION_TIME} timestamp_ntz, {TARGET} int")


def scored(spark, rows):
    return spark.createDataFrame(rows, f"{TARGET} int, score double")


FOUR = [(0, 0.1), (0, 0.6), (1, 0.4), (1, 0.9)]


def test_two_way_split(spark):
    rows = temporal.two_way_split(timeline(spark, 10, 30), 0.3).collect()
    assert sum(r.cohort == "test" for r in rows) == 3
    assert max(r.id for r in rows if r.cohort == "train") < min(r.id for r in rows if r.cohort == "test")


def test_missing_time_falls_in_train(spark):
    df = spark.createDataFrame([(datetime(2020, 1, 1),), (None,)], f"{PREDICTION_TIME} timestamp_ntz")
    rows = temporal.temporal_split(df, datetime(2019, 1, 1)).collect()
    assert {r[0]: r.cohort for r in rows} == {datetime(2020, 1, 1): "test", None: "train"}


def test_three_way_split_is_complete_and_ordered(spark):
    rows = temporal.three_way_split(timeline(spark, 100, 5)).collect()
    ids = {c: [r.id for r in rows if r.cohort == c] for c in temporal.COHORTS}
    assert sum(map(len, ids.values())) == 100
    assert max(ids["train"]) < min(ids["validation"]) and max(ids["validation"]) < min(ids["test"])
    assert (len(ids["test"]), len(ids["validation"])) == (20, 16)


def test_folds_train_on_the_past_and_evaluate_once(spark):
    rows = temporal.temporal_folds(timeline(spark, 200, 3)).collect()
    by_fold = {k: [r.id for r in rows if r.fold == k] for k in range(5)}
    assert [len(by_fold[k]) for k in range(5)] == [100, 25, 25, 25, 25]
    for k in range(1, 5):
        assert max(i for j in range(k) for i in by_fold[j]) < min(by_fold[k])


def test_metrics_on_four_rows(spark):
    row = metrics.classification_metrics(scored(spark, FOUR)).first()
    assert (row.tn, row.fp, row.fn, row.tp) == (1, 1, 1, 1)
    assert row.precision == row.recall == row.f1 == 0.5
    assert row.roc_auc == 0.75 and row.pr_auc == pytest.approx(5 / 6)
    assert row.n == 4 and row.positive_rate == 0.5 and row.threshold == 0.5


def test_nothing_flagged_counts_as_zero(spark):
    row = metrics.classification_metrics(scored(spark, FOUR), 2.0).first()
    assert row.precision == row.recall == row.f1 == 0.0


def brute_force(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    ap, recall = 0.0, 0.0
    for t in sorted({s for _, s in rows}, reverse=True):
        flagged = [y for y, s in rows if s >= t]
        ap += (sum(flagged) / len(pos) - recall) * sum(flagged) / len(flagged)
        recall = sum(flagged) / len(pos)
    return auc, ap


@pytest.mark.parametrize("decimals", [1, 2, 9])
def test_ranking_with_ties_matches_brute_force(spark, decimals):
    rng = random.Random(decimals)
    rows = [(int(rng.random() < 0.2), round(rng.betavariate(2, 5), decimals)) for _ in range(300)]
    row = metrics.ranking_metrics(scored(spark, rows)).first()
    assert (row.roc_auc, row.pr_auc) == pytest.approx(brute_force(rows))


def test_one_hot_score_holds_half_of_the_rows(spark):
    rows = [(i % 3 == 0, 0.5) for i in range(200)] + [(i % 2, i / 200) for i in range(200)]
    rows = [(int(y), float(s)) for y, s in rows]
    row = metrics.ranking_metrics(scored(spark, rows)).first()
    assert (row.roc_auc, row.pr_auc) == pytest.approx(brute_force(rows))


def test_single_class_has_no_ranking(spark):
    row = metrics.ranking_metrics(scored(spark, [(0, 0.1), (0, 0.2)])).first()
    assert row.roc_auc is None and row.pr_auc is None


def test_class_weights(spark):
    rows = metrics.class_weights(scored(spark, [(0, 0.0)] * 9 + [(1, 0.0)])).collect()
    assert {r[TARGET]: r.peso for r in rows} == {0: pytest.approx(10 / 18), 1: 5.0}


def even_scores(spark):
    return scored(spark, [(0, i / 999) for i in range(1000)])


def test_alert_volume(spark):
    df = even_scores(spark)
    threshold = metrics.alert_threshold(df).first()[0]
    assert df.filter(df.score >= threshold).count() / 1000 == pytest.approx(0.05, abs=0.002)


def test_levels_by_volume(spark):
    df = even_scores(spark)
    rows = risk.assign_risk_level(df, risk.risk_cuts(df, "score"), "score").groupBy("nivel").count().collect()
    shares = {r.nivel: r["count"] / 1000 for r in rows}
    assert shares == pytest.approx({"alto": 0.05, "medio": 0.15, "bajo": 0.80}, abs=0.01)


def test_lift(spark):
    rows = [(1, "alto"), (1, "alto"), (0, "medio"), (0, "medio")] + [(0, "bajo")] * 6
    df = spark.createDataFrame(rows, f"{TARGET} int, nivel string")
    got = {r.nivel: r for r in risk.risk_report(df).collect()}
    assert got["alto"].tasa_retraso == 1 and got["alto"].lift == pytest.approx(5) and got["alto"].pct_retrasos == 1
    assert got["bajo"].pct_pedidos == 0.6 and got["bajo"].lift == 0


def test_empty_levels_and_no_late_orders(spark):
    df = spark.createDataFrame([(0, "bajo"), (0, "bajo")], f"{TARGET} int, nivel string")
    got = {r.nivel: tuple(r)[1:] for r in risk.risk_report(df).collect()}
    assert got == {"alto": (0, 0, 0, 0), "medio": (0, 0, 0, 0), "bajo": (1, 0, 0, 0)}


def test_cost_threshold(spark):
    assert risk.cost_threshold(1) == 0.5 and risk.cost_threshold(10) == pytest.approx(1 / 11)
    df = spark.createDataFrame([(1, 0.5), (0, 0.2), (0, 0.01), (1, 0.06)], f"{TARGET} int, prob double")
    got = {r.fn_cuesta_x_fp: r for r in risk.cost_report(df).collect()}
    assert (got[5].pct_alertas, got[5].recall, got[5].precision) == (0.5, 0.5, 0.5)
    assert (got[20].pct_alertas, got[20].recall) == (0.75, 1.0)


def test_deciles(spark):
    df = spark.createDataFrame([(i % 2, i / 100) for i in range(100)], f"{TARGET} int, prob double")
    rows = risk.calibration_deciles(df).collect()
    assert [r.decil for r in rows] == list(range(10))
    assert rows[0].predicho == pytest.approx(0.045) and all(r.observado == 0.5 for r in rows)


@pytest.mark.parametrize("tolerance,chosen", [(0.01, "logistica_seleccion"), (0.001, "arboles_seleccion")])
def test_simplest_wins_a_tie(spark, tolerance, chosen):
    rows = list(zip(range(3), risk.MAIN_CANDIDATES, (0.205, 0.212, 0.200)))
    table = spark.createDataFrame(rows, "rank int, modelo string, pr_auc double")
    assert risk.select_model(table, tolerance).first().modelo == chosen
