"""Baseline run, temporal cross-validation and model comparison, reported as long tables.

All candidates are fitted on the same five parts of the past (what lies before each fold, and the train cohort), all of them
in the same passes over one table. Scores of all candidates and cohorts are one written table, and every metric of the
comparison comes out of one job over it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from arrivo.learning.models import Candidate, FittedModel, baseline_candidate, candidate_models, fit_together
from arrivo.operators.label import build_target, compare_label_rules
from arrivo.operators.metrics import (
    ALERT_VOLUME,
    THRESHOLD,
    classification_metrics,
    confusion,
    label_rates,
    ranking_metrics,
    threshold_rates,
)
from arrivo.operators.quantiles import quantiles
from arrivo.operators.risk import MAIN_CANDIDATES, SELECTION_TOLERANCE, select_model
from arrivo.operators.temporal import (
    FOLDS,
    TEST_FRACTION,
    cohort_periods,
    temporal_cutoff,
    temporal_folds,
    temporal_split,
    three_way_split,
    union_cohorts,
)
from arrivo.plans.features import Sides, build_features_from, written_sides
from arrivo.schemas import DEFAULT_ANCHOR, STUDY_PERIOD, TARGET
from arrivo.session import materialize

SELECTION_METRIC = "pr_auc"
MEASURED = ("n", "positive_rate", "precision", "recall", "f1", "threshold", "roc_auc", "pr_auc")


def one_row(df: DataFrame) -> dict:
    return df.first().asDict(recursive=True)


def build_baseline_table(
    tables: Mapping[str, DataFrame],
    anchor: str = DEFAULT_ANCHOR,
    period: tuple[str, str] = STUDY_PERIOD,
    sides: Sides | None = None,
) -> DataFrame:
    return build_features_from(tables, build_target(tables["orders"], period=period), anchor, sides)


def in_rows(measured: DataFrame, keys: Iterable[str], columns: Iterable[str]) -> DataFrame:
    """One row (keys, metrica, valor) per measured column."""
    cells = [F.struct(F.lit(c).alias("metrica"), F.col(c).cast("double").alias("valor")) for c in columns]
    return measured.select(*keys, F.explode(F.array(*cells)).alias("m")).select(*keys, "m.*")


@dataclass(frozen=True)
class BaselineRun:
    """The fitted baseline, the cohorts it was split into, and its measures."""

    anchor: str
    model: FittedModel
    periods: DataFrame  # one row per cohort
    scored: DataFrame  # label and score of the test cohort
    rules: DataFrame  # late rate under both label rules, one row

    def metrics(self) -> DataFrame:
        """(cohort, metrica, valor): sizes, rates and periods' ends of both cohorts, quality on the test cohort."""
        quality = classification_metrics(self.scored, THRESHOLD).withColumn("cohort", F.lit("test"))
        sizes = in_rows(self.periods.withColumnRenamed("n", "rows"), ["cohort"], ["rows", "late_rate"])
        rules = self.rules.withColumn("cohort", F.lit("all"))
        return sizes.unionByName(in_rows(quality, ["cohort"], MEASURED)).unionByName(
            in_rows(rules, ["cohort"], ["tasa_dia", "tasa_fecha_y_hora"])
        )


def run_baseline(
    tables: Mapping[str, DataFrame],
    test_fraction: float = TEST_FRACTION,
    anchor: str = DEFAULT_ANCHOR,
    period: tuple[str, str] = STUDY_PERIOD,
    sides: Sides | None = None,
) -> BaselineRun:
    """Fit the baseline on the past, measure it on the last `test_fraction`."""
    table = materialize(build_baseline_table(tables, anchor, period, sides), "baseline", balanced=True)
    split = temporal_split(table, temporal_cutoff(table, test_fraction))
    model = baseline_candidate(anchor).fit(union_cohorts(split, ["train"]))
    scored = model.score(union_cohorts(split, ["test"])).select(TARGET, "score")
    rules = label_rates(compare_label_rules(tables["orders"], True, period=period))
    return BaselineRun(anchor, model, cohort_periods(split), materialize(scored, "baseline-scores"), rules)


def run_baselines(tables: Mapping[str, DataFrame], anchors: Iterable[str], **options) -> list[BaselineRun]:
    """The baseline under several anchors; orders, carts and payments, which no anchor changes, are made and written once."""
    shared = {"customers": tables["customers"], "orders": materialize(tables["orders"], "orders")}
    sides = written_sides(tables)
    return [run_baseline(shared, anchor=anchor, sides=sides, **options) for anchor in anchors]


def scored_by(models: Mapping[str, FittedModel], part: DataFrame, cohort: str) -> DataFrame:
    """(modelo, cohorte, label, score) of one cohort under all models, which read its rows once."""
    wide = part
    for number, model in enumerate(models.values()):
        wide = model.score(wide, f"_score{number}")
    cells = [F.struct(F.lit(name).alias("modelo"), F.col(f"_score{number}").alias("score")) for number, name in enumerate(models)]
    long = wide.select(TARGET, F.explode(F.array(*cells)).alias("_by"))
    return long.select("_by.modelo", F.lit(cohort).alias("cohorte"), TARGET, "_by.score")


@dataclass(frozen=True)
class Comparison:
    """Models fitted on the train cohort, scores of every cohort, and what was chosen from the past alone."""

    fitted: dict[str, FittedModel]
    scored: DataFrame
    cohorts: DataFrame
    tolerance: float

    def rankings(self) -> DataFrame:
        """(modelo, cohorte, roc_auc, pr_auc); the cohorts of the cross-validation are fold1, fold2 and so on."""
        return ranking_metrics(self.scored, keys=["modelo", "cohorte"])

    def cross_validation(self) -> DataFrame:
        """(modelo, roc_auc, pr_auc) averaged over the folds."""
        folds = self.rankings().where("cohorte LIKE 'fold%'")
        return folds.groupBy("modelo").agg(*[F.avg(m).alias(m) for m in ("roc_auc", "pr_auc")])

    def thresholds(self) -> DataFrame:
        """(modelo, threshold): the alert volume on the validation cohort."""
        return quantiles(self.scored.where("cohorte = 'validation'"), "score", [1 - ALERT_VOLUME], ["modelo"], ["threshold"])

    def choice(self) -> DataFrame:
        """(modelo, threshold) of the simplest candidate within the tolerance of the best."""
        order = F.array_position(F.array(*[F.lit(n) for n in MAIN_CANDIDATES]), F.col("modelo"))
        ranked = self.cross_validation().withColumn("rank", order).where("rank > 0")
        return select_model(ranked, self.tolerance, SELECTION_METRIC).select("modelo").join(self.thresholds(), "modelo")

    def metrics(self) -> DataFrame:
        """(modelo, cohorte, metrica, valor) of all candidates; later cohorts change nothing about the choice."""
        later = self.scored.where("cohorte NOT LIKE 'fold%'").join(self.thresholds(), "modelo")
        rates = threshold_rates(confusion(later, F.col("threshold"), keys=["modelo", "cohorte", "threshold"]))
        keys = ["modelo", "cohorte"]
        return in_rows(self.rankings(), keys, ["roc_auc", "pr_auc"]).unionByName(in_rows(rates, keys, MEASURED[:-2]))


def compare_models(
    dataset: DataFrame,
    anchor: str = DEFAULT_ANCHOR,
    candidates: Mapping[str, Candidate] | None = None,
    tolerance: float = SELECTION_TOLERANCE,
    folds: int = FOLDS,
) -> Comparison:
    """Choose on the past, then measure the test cohort, which decides nothing.

    Cross-validation on train + validation picks the model; a fit on train is scored on validation, where its alert
    threshold comes from, and on test.
    """
    candidates = candidates or candidate_models(anchor)
    needed = sorted({c for candidate in candidates.values() for c in candidate.columns})
    split = three_way_split(materialize(dataset.select("order_id", "prediction_time", TARGET, *needed), "dataset", balanced=True))
    folded = materialize(temporal_folds(union_cohorts(split, ["train", "validation"])), "folds", balanced=True)
    parts = {f"fold{k}": F.col("fold") < k for k in range(1, folds + 1)}
    fitted = fit_together(candidates, folded, parts | {"train": F.col("cohort") == "train"})
    measured = [scored_by(fitted[f"fold{k}"], folded.where(F.col("fold") == k), f"fold{k}") for k in range(1, folds + 1)]
    measured += [scored_by(fitted["train"], union_cohorts(split, [c]), c) for c in ("validation", "test")]
    scored = materialize(reduce(DataFrame.unionByName, measured), "scores")
    return Comparison(fitted["train"], scored, cohort_periods(split), tolerance)
