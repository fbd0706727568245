"""Risk levels, calibration and cost thresholds over calibrated probabilities."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from arrivo.functions.aggregates import count_true, rate
from arrivo.functions.scalars import share
from arrivo.operators.metrics import ranking_metrics
from arrivo.operators.quantiles import equal_frequency_bins, quantiles
from arrivo.schemas import TARGET

# Volume of each level, level names, cost ratios, tie tolerance, model order.
HIGH_SHARE = 0.05
MEDIUM_SHARE = 0.15
LEVELS = ("alto", "medio", "bajo")
COST_RATIOS = (5, 10, 20)
SELECTION_TOLERANCE = 0.01
MAIN_CANDIDATES = ("logistica_seleccion", "arboles_seleccion", "arboles_completa")


def risk_cuts(
    scored: DataFrame,
    prob: str = "prob",
    high_share: float = HIGH_SHARE,
    medium_share: float = MEDIUM_SHARE,
) -> DataFrame:
    """One row: probabilities from which an order is `alto` and `medio`."""
    return quantiles(
        scored, prob, [1 - high_share, 1 - high_share - medium_share], names=["alto", "medio"]
    )


def risk_level(prob: Column, high: Column, medium: Column) -> Column:
    return F.when(prob >= high, LEVELS[0]).when(prob >= medium, LEVELS[1]).otherwise(LEVELS[2])


def assign_risk_level(
    scored: DataFrame, cuts: DataFrame | Mapping[str, float], prob: str = "prob", out: str = "nivel"
) -> DataFrame:
    """Add the level of each row; `cuts` is a one-row table or a mapping."""
    if isinstance(cuts, DataFrame):
        packed = cuts.select(F.struct("alto", "medio").alias("c")).scalar()
        level = risk_level(F.col(prob), F.col("_cuts.alto"), F.col("_cuts.medio"))
        return scored.withColumn("_cuts", packed).withColumn(out, level).drop("_cuts")
    return scored.withColumn(
        out, risk_level(F.col(prob), F.lit(float(cuts["alto"])), F.lit(float(cuts["medio"])))
    )


def risk_report(
    leveled: DataFrame, label: str = TARGET, level: str = "nivel", keys: Sequence[str] = ()
) -> DataFrame:
    """Per level: share of orders, late rate, share of late orders captured, lift; 0 when empty.

    One aggregation counts all levels side by side, so empty levels show up by themselves.
    """
    late = F.col(label) == 1
    counts = leveled.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        count_true(late).alias("_late"),
        *[count_true(F.col(level) == name).alias(f"_n_{name}") for name in LEVELS],
        *[count_true((F.col(level) == name) & late).alias(f"_late_{name}") for name in LEVELS],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("nivel"),
                F.col(f"_n_{name}").alias("n"),
                F.col(f"_late_{name}").alias("late"),
            )
            for name in LEVELS
        ]
    )
    level_rate, base = share(F.col("r.late"), F.col("r.n")), share(F.col("_late"), F.col("_n"))
    return counts.withColumn("r", F.explode(rows)).select(
        *keys,
        "r.nivel",
        share(F.col("r.n"), F.col("_n")).alias("pct_pedidos"),
        level_rate.alias("tasa_retraso"),
        share(F.col("r.late"), F.col("_late")).alias("pct_retrasos"),
        share(level_rate, base).alias("lift"),
    )


def cost_threshold(ratio: float) -> float:
    """Best threshold on calibrated probabilities when a miss costs `ratio` false alarms."""
    return 1.0 / (1.0 + ratio)


def cost_report(
    scored: DataFrame,
    ratios: Sequence[float] = COST_RATIOS,
    label: str = TARGET,
    prob: str = "prob",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Alerts, recall and precision at each cost threshold, all ratios in one aggregation."""
    late = F.col(label) == 1
    counts = scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        count_true(late).alias("_late"),
        *[
            part
            for i, ratio in enumerate(ratios)
            for part in (
                count_true(F.col(prob) >= cost_threshold(ratio)).alias(f"_a{i}"),
                count_true((F.col(prob) >= cost_threshold(ratio)) & late).alias(f"_h{i}"),
            )
        ],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(ratio).alias("fn_cuesta_x_fp"),
                F.lit(cost_threshold(ratio)).alias("umbral"),
                F.col(f"_a{i}").alias("alerts"),
                F.col(f"_h{i}").alias("hits"),
            )
            for i, ratio in enumerate(ratios)
        ]
    )
    return counts.withColumn("r", F.explode(rows)).select(
        *keys,
        "r.fn_cuesta_x_fp",
        "r.umbral",
        share(F.col("r.alerts"), F.col("_n")).alias("pct_alertas"),
        share(F.col("r.hits"), F.col("_late")).alias("recall"),
        share(F.col("r.hits"), F.col("r.alerts")).alias("precision"),
    )


def calibration_deciles(
    scored: DataFrame, label: str = TARGET, prob: str = "prob", bins: int = 10
) -> DataFrame:
    """Mean predicted risk against the observed rate, per tenth of the probabilities."""
    known = scored.select(label, prob).filter(F.col(prob).isNotNull() & ~F.isnan(prob))
    return (
        equal_frequency_bins(known, prob, bins, "decil")
        .groupBy("decil")
        .agg(F.avg(prob).alias("predicho"), rate(label).alias("observado"))
        .orderBy("decil")
    )


def cohort_summary(
    scored: DataFrame,
    label: str = TARGET,
    raw: str = "score",
    prob: str = "prob",
    keys: Sequence[str] = ("cohort",),
) -> DataFrame:
    """Prevalence, ranking metrics and mean risk before and after calibration, per cohort."""
    means = scored.groupBy(*keys).agg(
        rate(label).alias("prevalencia"),
        F.avg(raw).alias("riesgo_medio_sin_calibrar"),
        F.avg(prob).alias("riesgo_medio_calibrado"),
    )
    return means.join(ranking_metrics(scored, label, raw, keys), list(keys))


def select_model(
    results: DataFrame, tolerance: float = SELECTION_TOLERANCE, metric: str = "pr_auc"
) -> DataFrame:
    """The simplest candidate within `tolerance` of the best; `rank` orders them by complexity.

    `results` has one row per candidate, so the window over all of them is a handful of rows.
    """
    best = F.max(metric).over(Window.partitionBy())
    return (
        results.withColumn("_best", best)
        .filter(F.col(metric) >= F.col("_best") - tolerance)
        .orderBy("rank")
        .limit(1)
        .drop("_best")
    )
