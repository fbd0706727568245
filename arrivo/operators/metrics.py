"""Classification metrics over a scored table (a 0/1 label column and a score column).

The ranking metrics need a global order of the scores. Scores are counted first (one row per distinct
score), then ranked by the bucketed running totals: no window ever sees all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from arrivo.functions.aggregates import count_true, rate
from arrivo.functions.scalars import share, value_bucket
from arrivo.operators.quantiles import quantiles
from arrivo.operators.running import running_totals
from arrivo.schemas import TARGET

THRESHOLD = 0.5
ALERT_VOLUME = 0.05


def class_weights(table: DataFrame, label: str = TARGET) -> DataFrame:
    """Balanced weight n / (2·n_k) per class."""
    counts = table.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(F.sum("n").alias("n"))
    return counts.withColumn("peso", whole.scalar() / (2 * F.col("n")))


def confusion(
    scored: DataFrame,
    threshold: float | Column = THRESHOLD,
    label: str = TARGET,
    score: str = "score",
    keys: Sequence[str] = (),
) -> DataFrame:
    """tn, fp, fn, tp at `score >= threshold`."""
    alert, late = F.col(score) >= threshold, F.col(label) == 1
    return scored.groupBy(*keys).agg(
        count_true(~alert & ~late).alias("tn"),
        count_true(alert & ~late).alias("fp"),
        count_true(~alert & late).alias("fn"),
        count_true(alert & late).alias("tp"),
    )


def threshold_rates(counts: DataFrame) -> DataFrame:
    """Add n, positive rate, precision, recall and F1 to a confusion table; x/0 counts as 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    return counts.withColumns(
        {
            "n": n,
            "positive_rate": share(tp + fn, n),
            "precision": share(tp, tp + fp),
            "recall": share(tp, tp + fn),
            "f1": share(2 * tp, 2 * tp + fp + fn),
        }
    )


def score_counts(scored: DataFrame, label: str, score: str, keys: Sequence[str]) -> DataFrame:
    """Rows per distinct score; a NaN score has no rank and stops the job."""
    refused = F.raise_error(F.lit(f"{score} holds NaN, which cannot be ranked")).cast("double")
    ranked = F.when(F.isnan(F.col(score).cast("double")), refused).otherwise(F.col(score).cast("double"))
    return (
        scored.filter(F.col(score).isNotNull())
        .groupBy(*keys, ranked.alias("s"))
        .agg(F.sum(F.col(label).cast("long")).alias("pos"), F.count(F.lit(1)).alias("n"))
    )


def ranking_metrics(
    scored: DataFrame, label: str = TARGET, score: str = "score", keys: Sequence[str] = ()
) -> DataFrame:
    """ROC-AUC (ties count half) and average precision (step sum), per key."""
    ranked = running_totals(
        score_counts(scored, label, score, keys), keys, "s", value_bucket("s"), ["pos", "n"], True
    )
    pos, n = F.col("pos").cast("double"), F.col("n").cast("double")
    below_neg = F.col("before_n") - F.col("before_pos")
    wins = pos * (below_neg + (n - pos) / 2)
    # at threshold s everything from s up is flagged
    precision_at = (F.col("total_pos") - F.col("before_pos")) / (F.col("total_n") - F.col("before_n"))
    positives = F.max("total_pos")
    negatives = F.max(F.col("total_n") - F.col("total_pos"))
    return ranked.groupBy(*keys).agg(
        F.when(positives * negatives > 0, F.sum(wins) / positives / negatives).alias("roc_auc"),
        F.when(positives > 0, F.sum(pos * precision_at) / positives).alias("pr_auc"),
    )


def classification_metrics(
    scored: DataFrame, threshold: float = THRESHOLD, label: str = TARGET, score: str = "score"
) -> DataFrame:
    """One row: threshold metrics and ranking metrics."""
    ranked = ranking_metrics(scored, label, score).select(F.struct("roc_auc", "pr_auc").alias("r"))
    return (
        threshold_rates(confusion(scored, threshold, label, score))
        .withColumn("threshold", F.lit(float(threshold)))
        .withColumn("_r", ranked.scalar())
        .select("*", "_r.roc_auc", "_r.pr_auc")
        .drop("_r")
    )


def alert_threshold(scored: DataFrame, volume: float = ALERT_VOLUME, score: str = "score") -> DataFrame:
    """Score from which about `volume` of the rows lie."""
    return quantiles(scored, score, [1 - volume], names=["threshold"])


def label_rates(pairs: DataFrame) -> DataFrame:
    """Late rate under both label rules, same population."""
    return pairs.agg(
        F.count(F.lit(1)).alias("n"),
        rate("regla_por_dia").alias("tasa_dia"),
        rate("regla_por_fecha_y_hora").alias("tasa_fecha_y_hora"),
    )
