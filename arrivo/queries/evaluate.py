"""Temporal cohorts, metrics, risk reports and fitted statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from arrivo.learning import preprocess
from arrivo.operators import metrics, risk, temporal
from arrivo.queries.explore import COHORT, CUTS, bins_sql
from arrivo.queries.features import base, moments, scored
from arrivo.queries.registry import register
from arrivo.schemas import TARGET

THRESHOLD = 0.4
LEVEL_CUTS = {"alto": 0.6, "medio": 0.35}
M_COHORT = {"m_cohort": COHORT, "m_cuts": CUTS}
SCORED_COHORT = """SELECT s.*, CASE WHEN prediction_time >= test_start THEN 'test'
  WHEN prediction_time >= validation_start THEN 'validation' ELSE 'train' END AS cohort
FROM m_scored s, m_cuts"""
M_SCORED = {"m_scored_cohort": SCORED_COHORT, "m_cuts": CUTS}

register(
    "temporal_cutoff",
    lambda b: temporal.cutoff_table(moments(b)),
    "SELECT date_trunc('day', quantile_cont(prediction_time, 0.8))::TIMESTAMP AS cutoff FROM m_moments",
)
register(
    "three_way_cutoffs",
    lambda b: temporal.three_way_table(moments(b)),
    "SELECT validation_start, test_start FROM m_cuts",
    m_cuts=CUTS,
)
register(
    "two_way_split",
    lambda b: temporal.two_way_split(moments(b)).select("order_id", "cohort"),
    "SELECT order_id, CASE WHEN prediction_time >= cutoff THEN 'test' ELSE 'train' END AS cohort FROM m_moments,"
    " (SELECT date_trunc('day', quantile_cont(prediction_time, 0.8)) AS cutoff FROM m_moments)",
)
register(
    "three_way_split",
    lambda b: temporal.three_way_split(moments(b)).select("order_id", "cohort"),
    "SELECT order_id, cohort FROM m_cohort",
    **M_COHORT,
)
register(
    "cohort_periods",
    lambda b: temporal.cohort_periods(temporal.three_way_split(moments(b))),
    """SELECT cohort, CAST(min(prediction_time) AS DATE) AS desde, CAST(max(prediction_time) AS DATE) AS hasta,
  count(*) AS n, avg(pedido_retrasado) AS late_rate FROM m_cohort GROUP BY 1""",
    real=["late_rate"],
    **M_COHORT,
)
register(
    "train_validation_union",
    lambda b: temporal.union_cohorts(
        temporal.three_way_split(moments(b)), ["train", "validation"]
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(TARGET).alias("retrasados")),
    "SELECT count(*) AS n, sum(pedido_retrasado) AS retrasados FROM m_cohort WHERE cohort <> 'test'",
    whole=["retrasados"],
    **M_COHORT,
)
FOLD_EDGES = "(SELECT quantile_cont(prediction_time, [0.5, 0.625, 0.75, 0.875]) AS e FROM m_moments)"
register(
    "fold_edges",
    lambda b: temporal.fold_edges(moments(b)),
    f"SELECT {', '.join(f'e[{i + 1}] AS edge{i}' for i in range(4))},"
    f" (SELECT max(prediction_time) + INTERVAL 1 DAY FROM m_moments) AS edge4 FROM {FOLD_EDGES}",
)
register(
    "temporal_folds",
    lambda b: temporal.temporal_folds(moments(b)).select("order_id", "fold"),
    f"SELECT order_id, len(list_filter(e, lambda x: x <= prediction_time)) AS fold FROM m_moments, {FOLD_EDGES}",
    whole=["fold"],
)
register(
    "class_weights",
    lambda b: metrics.class_weights(moments(b)),
    "SELECT pedido_retrasado, count(*) AS n, sum(count(*)) OVER () / (2.0 * count(*)) AS peso FROM m_moments GROUP BY 1",
    real=["peso"],
    whole=["pedido_retrasado"],
)
CONFUSION = f"""SELECT count(*) FILTER (WHERE score < {THRESHOLD} AND pedido_retrasado = 0) AS tn,
  count(*) FILTER (WHERE score >= {THRESHOLD} AND pedido_retrasado = 0) AS fp,
  count(*) FILTER (WHERE score < {THRESHOLD} AND pedido_retrasado = 1) AS fn,
  count(*) FILTER (WHERE score >= {THRESHOLD} AND pedido_retrasado = 1) AS tp FROM m_scored"""
register("confusion", lambda b: metrics.confusion(scored(b), THRESHOLD), CONFUSION)


def ranking_sql(view: str, label: str, score: str, key: str = "") -> str:
    """ROC-AUC by mid-ranks and average precision by peers-inclusive windows, over all rows."""
    by, part = (f"{key}, ", f"PARTITION BY {key} ") if key else ("", "")
    return f"""SELECT {by}(sum(CASE WHEN y = 1 THEN r END) - max(p) * (max(p) + 1) / 2.0)
    / max(p) / max(n - p) AS roc_auc, sum(y * tp / CAST(flagged AS DOUBLE)) / max(p) AS pr_auc
FROM (SELECT {by}{label} AS y, count(*) OVER ({part}) AS n, sum({label}) OVER ({part}) AS p,
    rank() OVER ({part}ORDER BY {score}) + (count(*) OVER ({part + ', ' if part else 'PARTITION BY '}{score}) - 1) / 2.0
      AS r,
    sum({label}) OVER ({part}ORDER BY {score} DESC) AS tp, count(*) OVER ({part}ORDER BY {score} DESC) AS flagged
  FROM {view}) {f'GROUP BY {key}' if key else ''}"""


register(
    "ranking_metrics",
    lambda b: metrics.ranking_metrics(scored(b)),
    ranking_sql("m_scored", "pedido_retrasado", "score"),
    real=["roc_auc", "pr_auc"],
)


def toxic_scores(b):
    """Document labels against document length: few rows, many equal scores."""
    texts = b.raw("documents").select("doc_id", (F.col("n_chars") / 40000.0).alias("score"))
    return b.raw("labels").select("doc_id", "toxic").join(texts, "doc_id")


register(
    "ranking_metrics_documents",
    lambda b: metrics.ranking_metrics(toxic_scores(b), "toxic"),
    ranking_sql("m_toxic", "toxic", "score"),
    real=["roc_auc", "pr_auc"],
    m_toxic="SELECT toxic, n_chars / 40000.0 AS score FROM labels JOIN documents USING (doc_id)",
)
register(
    "ranking_metrics_by_cohort",
    lambda b: metrics.ranking_metrics(temporal.three_way_split(scored(b)), keys=["cohort"]),
    ranking_sql("m_scored_cohort", "pedido_retrasado", "score", "cohort"),
    real=["roc_auc", "pr_auc"],
    **M_SCORED,
)
register(
    "classification_metrics",
    lambda b: metrics.classification_metrics(scored(b), THRESHOLD),
    f"""SELECT tn, fp, fn, tp, tn + fp + fn + tp AS n, (tp + fn) / CAST(tn + fp + fn + tp AS DOUBLE) AS positive_rate,
  CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE 0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / CAST(tp + fn AS DOUBLE) ELSE 0 END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) ELSE 0 END AS f1,
  CAST({THRESHOLD} AS DOUBLE) AS threshold, roc_auc, pr_auc FROM m_confusion, m_ranking""",
    real=["positive_rate", "precision", "recall", "f1", "roc_auc", "pr_auc"],
    m_confusion=CONFUSION,
    m_ranking=ranking_sql("m_scored", "pedido_retrasado", "score"),
)
register(
    "alert_threshold",
    lambda b: metrics.alert_threshold(scored(b)),
    "SELECT quantile_cont(score, 0.95) AS threshold FROM m_scored",
    real=["threshold"],
)
VALIDATION = "SELECT * FROM m_scored_cohort WHERE cohort = 'validation'"
register(
    "risk_cuts",
    lambda b: risk.risk_cuts(
        temporal.three_way_split(scored(b)).filter("cohort = 'validation'"), prob="score"
    ),
    f"SELECT quantile_cont(score, 0.95) AS alto, quantile_cont(score, 0.8) AS medio FROM ({VALIDATION})",
    real=["alto", "medio"],
    **M_SCORED,
)
LEVELED = """SELECT *, CASE WHEN score >= 0.6 THEN 'alto' WHEN score >= 0.35 THEN 'medio' ELSE 'bajo' END AS nivel
FROM m_scored"""


def leveled(b):
    return risk.assign_risk_level(scored(b), LEVEL_CUTS, "score")


register(
    "risk_levels",
    lambda b: leveled(b).select("order_id", "nivel"),
    "SELECT order_id, nivel FROM m_leveled",
    m_leveled=LEVELED,
)


def levels_by_quantile(b):
    """Levels from the cuts of the whole population instead of fixed numbers."""
    rows = scored(b)
    return risk.assign_risk_level(rows, risk.risk_cuts(rows, "score"), "score").select("order_id", "nivel")


register(
    "risk_levels_by_volume",
    levels_by_quantile,
    """SELECT order_id, CASE WHEN score >= alto THEN 'alto' WHEN score >= medio THEN 'medio' ELSE 'bajo' END AS nivel
FROM m_scored, (SELECT quantile_cont(score, 0.95) AS alto, quantile_cont(score, 0.8) AS medio FROM m_scored)""",
)
REPORT = """SELECT l.nivel, coalesce(n, 0) / total AS pct_pedidos, coalesce(late / CAST(n AS DOUBLE), 0) AS tasa_retraso,
  coalesce(late / total_late, 0) AS pct_retrasos,
  coalesce(late / CAST(n AS DOUBLE) / (total_late / total), 0) AS lift
FROM (VALUES ('alto'), ('medio'), ('bajo')) l(nivel)
  LEFT JOIN (SELECT nivel, count(*) AS n, sum(pedido_retrasado) AS late FROM {view} GROUP BY 1) g
    ON g.nivel = l.nivel,
  (SELECT CAST(count(*) AS DOUBLE) AS total, CAST(sum(pedido_retrasado) AS DOUBLE) AS total_late FROM {view})"""
register(
    "risk_report",
    lambda b: risk.risk_report(leveled(b)),
    REPORT.format(view="m_leveled"),
    real=["pct_pedidos", "tasa_retraso", "pct_retrasos", "lift"],
    m_leveled=LEVELED,
)
register(
    "risk_report_empty_level",
    lambda b: risk.risk_report(
        risk.assign_risk_level(scored(b), {"alto": 2.0, "medio": 0.35}, "score")
    ),
    REPORT.format(view="m_two_levels"),
    real=["pct_pedidos", "tasa_retraso", "pct_retrasos", "lift"],
    m_two_levels="SELECT *, CASE WHEN score >= 0.35 THEN 'medio' ELSE 'bajo' END AS nivel FROM m_scored",
)
register(
    "cost_thresholds",
    lambda b: risk.cost_report(scored(b), prob="score"),
    """SELECT CAST(r AS BIGINT) AS fn_cuesta_x_fp, 1.0 / (1.0 + r) AS umbral, avg(CAST(alert AS INTEGER)) AS pct_alertas,
  coalesce(sum(pedido_retrasado) FILTER (WHERE alert) / CAST(sum(pedido_retrasado) AS DOUBLE), 0) AS recall,
  coalesce(avg(pedido_retrasado) FILTER (WHERE alert), 0) AS precision
FROM (SELECT s.*, r, score >= 1 / (1 + CAST(r AS DOUBLE)) AS alert
  FROM m_scored s, (VALUES (5), (10), (20)) t(r)) GROUP BY r""",
    real=["umbral", "pct_alertas", "recall", "precision"],
)
register(
    "calibration_deciles",
    lambda b: risk.calibration_deciles(scored(b), prob="score"),
    "SELECT decil, avg(score) AS predicho, avg(pedido_retrasado) AS observado FROM m_deciles"
    " WHERE decil IS NOT NULL GROUP BY 1",
    real=["predicho", "observado"],
    whole=["decil"],
    m_deciles=bins_sql("m_scored", "score", 10, "decil"),
)
register(
    "cohort_summary",
    lambda b: risk.cohort_summary(
        temporal.three_way_split(scored(b)).withColumn("prob", F.col("score") / 2)
    ),
    """SELECT * FROM (SELECT cohort, avg(pedido_retrasado) AS prevalencia, avg(score) AS riesgo_medio_sin_calibrar,
  avg(score / 2) AS riesgo_medio_calibrado FROM m_scored_cohort GROUP BY 1) JOIN m_ranked USING (cohort)""",
    real=["prevalencia", "riesgo_medio_sin_calibrar", "riesgo_medio_calibrado", "roc_auc", "pr_auc"],
    m_ranked=ranking_sql("m_scored_cohort", "pedido_retrasado", "score", "cohort"),
    **M_SCORED,
)


def ranked_candidates(b):
    """Three scores made from features stand for three candidate models."""
    rows = moments(b).select(
        TARGET,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(rank).alias("rank"), F.lit(name).alias("modelo"), value.alias("score"))
                    for rank, (name, value) in enumerate(
                        zip(
                            risk.MAIN_CANDIDATES,
                            (
                                -F.floor(F.col("promised_days") / 4).cast("double"),
                                -F.col("promised_days").cast("double"),
                                F.col("approval_hours"),
                            ),
                        )
                    )
                ]
            )
        ).alias("c"),
    ).select(TARGET, "c.*")
    return risk.select_model(metrics.ranking_metrics(rows, keys=["rank", "modelo"]))


register(
    "model_choice",
    ranked_candidates,
    """SELECT * FROM m_measured WHERE pr_auc >= (SELECT max(pr_auc) FROM m_measured) - 0.01
ORDER BY rank LIMIT 1""",
    real=["roc_auc", "pr_auc"],
    whole=["rank"],
    m_measured="""SELECT rank, modelo, roc_auc, pr_auc FROM (
  SELECT 0 AS rank, 'logistica_seleccion' AS modelo, * FROM m_rank_a
  UNION ALL SELECT 1, 'arboles_seleccion', * FROM m_rank_b
  UNION ALL SELECT 2, 'arboles_completa', * FROM m_rank_c)""",
    m_rank_a=ranking_sql("m_moments", "pedido_retrasado", "-floor(promised_days / 4.0)"),
    m_rank_b=ranking_sql("m_moments", "pedido_retrasado", "-promised_days"),
    m_rank_c=ranking_sql("m_moments", "pedido_retrasado", "approval_hours"),
)

NUMERIC = ("promised_days", "approval_hours", "total_price", "freight_ratio", "total_weight_g", "max_installments")
CATEGORICAL = ("customer_state", "main_payment_type", "seller_other_state")


def union_all(parts) -> str:
    return "\nUNION ALL ".join(parts)


register(
    "imputation_medians",
    lambda b: preprocess.median_table(base(b), NUMERIC),
    union_all(
        f"SELECT '{c}' AS columna, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS mediana FROM m_features"
        for c in NUMERIC
    ),
)
FILL = {c: float(i) for i, c in enumerate(NUMERIC)}
register(
    "scaling_moments",
    lambda b: preprocess.moment_table(base(b), NUMERIC, FILL),
    union_all(
        f"SELECT '{c}' AS columna, round(avg(coalesce({c}, {FILL[c]})), 4) AS media,"
        f" round(stddev_pop(coalesce({c}, {FILL[c]})), 4) AS desvio FROM m_features"
        for c in NUMERIC
    ),
    digits=4,
)
register(
    "pooled_categories",
    lambda b: preprocess.pooled_categories(base(b), CATEGORICAL, 290),
    """SELECT columna, CASE WHEN n >= 290 THEN valor ELSE '_infrequent_' END AS valor, CAST(sum(n) AS BIGINT) AS n
FROM (""" + union_all(
        f"SELECT '{c}' AS columna, coalesce({c}, 'unknown') AS valor, count(*) AS n FROM m_features GROUP BY 2"
        for c in CATEGORICAL
    ) + ") GROUP BY 1, 2",
)
