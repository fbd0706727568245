"""Exploration tables: rates, shares, pivots, buckets and distributions of the late label.

All of them aggregate map-side to a handful of groups. Medians of whole-day columns run on counted
values, so no group is ever gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from arrivo.functions.aggregates import count_true, rate
from arrivo.functions.scalars import calendar_days, month_start, pick_label, right_closed_bin
from arrivo.operators.label import observable
from arrivo.operators.quantiles import equal_frequency_bins, quantiles
from arrivo.schemas import DELIVERED, ESTIMATED, PREDICTION_TIME, PURCHASE, TARGET

# Bucket edges and labels of the published tables.
PROMISE_EDGES = (0, 10, 15, 20, 25, 30, 40, 200)
PROMISE_LABELS = ("≤10", "11–15", "16–20", "21–25", "26–30", "31–40", ">40")
APPROVAL_EDGES = (-0.01, 1, 6, 24, 48)
APPROVAL_LABELS = ("≤1 h", "1–6 h", "6–24 h", "24–48 h", ">48 h")
FREIGHT_LABELS = ("Q1 (flete bajo)", "Q2", "Q3", "Q4", "Q5 (flete alto)")
FOCUS_STATE = "SP"
REST = "Resto de Brasil"
MIN_GROUP = 300
LONGEST_DELAY = 60


def rates(df: DataFrame, *keys: str | Column, extra: Sequence[Column] = ()) -> DataFrame:
    """Rows and late rate per group; null groups are left out."""
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), rate(TARGET).alias("tasa"), *extra)
    names = grouped.columns[: len(keys)]
    return grouped.dropna(subset=names)


def focus_region(state: str = FOCUS_STATE) -> Column:
    """The focus state against the rest; a missing state belongs to the rest."""
    is_focus = F.coalesce(F.col("customer_state") == state, F.lit(False))
    return F.when(is_focus, state).otherwise(REST)


def with_region(df: DataFrame, state: str = FOCUS_STATE) -> DataFrame:
    return df.withColumn("region", focus_region(state))


def context_numbers(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("pedidos"), F.sum(TARGET).alias("retrasados"), rate(TARGET).alias("tasa")
    )


def late_days(labelled: DataFrame) -> DataFrame:
    """Whole days past the promise of the late orders."""
    return labelled.filter(F.col(TARGET) == 1).select(
        calendar_days(ESTIMATED, DELIVERED).alias("dias_tarde")
    )


def delay_quantiles(labelled: DataFrame) -> DataFrame:
    return quantiles(late_days(labelled), "dias_tarde", [0.5, 0.9], names=["mediana", "p90"])


def delay_histogram(labelled: DataFrame, longest: int = LONGEST_DELAY) -> DataFrame:
    """Late orders per day of delay, the tail gathered in the last day."""
    day = F.least(F.col("dias_tarde"), F.lit(longest)).alias("dias")
    return late_days(labelled).groupBy(day).agg(F.count(F.lit(1)).alias("n")).orderBy("dias")


def monthly_rates(df: DataFrame) -> DataFrame:
    """Volume, late rate and median promise per purchase month."""
    month = df.withColumn("anio_mes", month_start(PURCHASE))
    medians = quantiles(month, "promised_days", [0.5], ["anio_mes"], ["plazo_mediano"])
    return rates(month, "anio_mes").join(medians, "anio_mes", "left").orderBy("anio_mes")


def monthly_volume_change(df: DataFrame) -> DataFrame:
    """Orders per month and their change on the month before (one row per month in the window)."""
    months = df.groupBy(month_start(PURCHASE).alias("anio_mes")).agg(F.count(F.lit(1)).alias("n"))
    before = F.lag("n").over(Window.orderBy("anio_mes"))
    return months.withColumn("cambio", F.col("n") / before - 1)


def monthly_rates_by_region(df: DataFrame, state: str = FOCUS_STATE) -> DataFrame:
    return rates(df, month_start(PURCHASE).alias("anio_mes"), focus_region(state).alias("region"))


def rates_by_state(df: DataFrame, min_n: int = MIN_GROUP) -> DataFrame:
    """States with enough orders for a stable rate, from the lowest rate up."""
    return rates(df, "customer_state").filter(F.col("n") >= min_n).orderBy("tasa", "customer_state")


def small_states(df: DataFrame, min_n: int = MIN_GROUP) -> DataFrame:
    return rates(df, "customer_state").filter(F.col("n") < min_n)


def state_shares(df: DataFrame, k: int = 5) -> DataFrame:
    """Share of orders and of late orders per state, the k with most late orders."""
    counts = (
        df.filter(F.col("customer_state").isNotNull())
        .groupBy("customer_state")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(TARGET).alias("late"))
    )
    whole = counts.agg(F.struct(F.sum("n").alias("n"), F.sum("late").alias("late")).alias("t"))
    return (
        counts.withColumn("t", whole.scalar())
        .select(
            "customer_state",
            F.round(100 * F.col("n") / F.col("t.n"), 1).alias("pct_pedidos"),
            F.round(100 * F.col("late") / F.col("t.late"), 1).alias("pct_retrasos"),
            "late",
        )
        .orderBy(F.col("late").desc(), "customer_state")
        .limit(k)
        .drop("late")
    )


def rates_by_seller_place(df: DataFrame) -> DataFrame:
    return rates(df, "seller_other_state")


def rates_by_region_and_seller_place(df: DataFrame, state: str = FOCUS_STATE) -> DataFrame:
    return rates(df, focus_region(state).alias("region"), "seller_other_state")


def promise_bucket(days: str = "promised_days") -> Column:
    return right_closed_bin(days, PROMISE_EDGES)


def _with_promise_bucket(df: DataFrame, state: str) -> DataFrame:
    return with_region(df, state).withColumn("tramo", promise_bucket())


def rates_by_promise(df: DataFrame, state: str = FOCUS_STATE) -> DataFrame:
    """Per promise bucket: rows, rate, and share of orders from the focus state."""
    in_focus = rate(F.col("region") == state).alias("proporcion_foco")
    table = rates(_with_promise_bucket(df, state), "tramo", extra=[in_focus])
    return table.withColumn("tramo_plazo", pick_label("tramo", PROMISE_LABELS)).orderBy("tramo")


def rates_by_promise_and_region(df: DataFrame, state: str = FOCUS_STATE) -> DataFrame:
    """Promise bucket × region, regions side by side."""
    wide = _with_promise_bucket(df, state).dropna(subset=["tramo"]).groupBy("tramo").agg(
        *[
            expression
            for name, here in (("foco", F.col("region") == state), ("resto", F.col("region") != state))
            for expression in (
                count_true(here).alias(f"n_{name}"),
                F.avg(F.when(here, F.col(TARGET))).alias(f"tasa_{name}"),
            )
        ]
    )
    return wide.withColumn("tramo_plazo", pick_label("tramo", PROMISE_LABELS)).orderBy("tramo")


def promise_by_outcome(df: DataFrame, state: str = FOCUS_STATE) -> DataFrame:
    """Mean promise of punctual and late orders per region, and the difference."""
    return (
        with_region(df, state)
        .groupBy("region")
        .pivot(TARGET, [0, 1])
        .agg(F.avg("promised_days"))
        .withColumnsRenamed({"0": "puntual", "1": "retrasado"})
        .withColumn("diferencia", F.col("puntual") - F.col("retrasado"))
    )


def label_crosstab(pairs: DataFrame) -> DataFrame:
    """Contingency table of the two label rules; empty cells are 0."""
    return (
        pairs.groupBy("regla_por_dia")
        .pivot("regla_por_fecha_y_hora", [0, 1])
        .count()
        .withColumnsRenamed({"0": "a_tiempo", "1": "tarde"})
        .fillna(0, ["a_tiempo", "tarde"])
    )


def label_distribution(labelled: DataFrame) -> DataFrame:
    counts = labelled.groupBy(TARGET).agg(F.count(F.lit(1)).alias("cantidad"))
    whole = counts.agg(F.sum("cantidad").alias("n"))
    return counts.withColumn(
        "porcentaje", F.round(100 * F.col("cantidad") / whole.scalar(), 2)
    ).orderBy(TARGET)


def rates_by_approval(df: DataFrame) -> DataFrame:
    """Rate per bucket of hours to approval; the last bucket is open."""
    edges = (*APPROVAL_EDGES, float("inf"))
    table = rates(df.withColumn("tramo", right_closed_bin("approval_hours", edges)), "tramo")
    return table.withColumn("tramo_aprobacion", pick_label("tramo", APPROVAL_LABELS)).orderBy("tramo")


def rates_by_freight_quintile(df: DataFrame) -> DataFrame:
    """Rate per fifth of the freight/price ratio."""
    known = df.select("freight_ratio", TARGET).filter(F.col("freight_ratio").isNotNull())
    return (
        rates(equal_frequency_bins(known, "freight_ratio", 5, "quintil"), "quintil")
        .withColumn("quintil_flete", pick_label("quintil", FREIGHT_LABELS))
        .orderBy("quintil")
    )


def seller_count_table(df: DataFrame, state: str = FOCUS_STATE) -> DataFrame:
    """One seller against several: rows, rate, median promise, share from the focus state."""
    labelled = with_region(df, state).withColumn(
        "n_vendedores", F.when(F.col("n_sellers") >= 2, "2 o más").otherwise("1")
    )
    in_focus = rate(F.col("region") == state).alias("proporcion_foco")
    medians = quantiles(labelled, "promised_days", [0.5], ["n_vendedores"], ["plazo_mediano"])
    return rates(labelled, "n_vendedores", extra=[in_focus]).join(medians, "n_vendedores", "left")


def delivery_days_p99(orders: DataFrame, prob: float = 0.99) -> DataFrame:
    """Calendar days from purchase to delivery that `prob` of the deliveries do not exceed."""
    days = orders.filter(observable(orders)).select(calendar_days(PURCHASE, DELIVERED).alias("d"))
    return quantiles(days, "d", [prob], names=["dias_entrega"])


def delivered_share_by_month(orders: DataFrame) -> DataFrame:
    """Censoring check: share of each month's purchases whose delivery is known."""
    return orders.groupBy(month_start(PURCHASE).alias("anio_mes")).agg(
        F.count(F.lit(1)).alias("pedidos"),
        rate(F.coalesce(observable(orders), F.lit(False))).alias("proporcion_entregada"),
    )


def median_approval(df: DataFrame) -> DataFrame:
    return quantiles(df, "approval_hours", [0.5], names=["horas_mediana"])


def median_by_cohort(df: DataFrame, value: str, cohort: str = "cohort") -> DataFrame:
    """Drift of a feature across the temporal cohorts."""
    return quantiles(df, value, [0.5], [cohort], ["mediana"])


def compare_versions(
    old: DataFrame, new: DataFrame, cohorts: DataFrame, value: str, moved: float = 1.0, far: float = 3500.0
) -> DataFrame:
    """Per cohort: how many orders change between two versions of a feature, and how.

    `moved`: differ by more than that, known in both. `far`: old values above it. Newly null last.
    """
    before = old.select("order_id", F.col(value).alias("_old"))
    after = new.select("order_id", F.col(value).alias("_new"))
    joined = cohorts.select("order_id", "cohort").join(before, "order_id", "left").join(
        after, "order_id", "left"
    )
    return joined.groupBy("cohort").agg(
        F.count(F.lit(1)).alias("pedidos"),
        count_true(F.abs(F.col("_new") - F.col("_old")) > moved).alias("cambian"),
        count_true(F.col("_old") > far).alias("lejanos"),
        count_true(F.col("_old").isNotNull() & F.col("_new").isNull()).alias("quedan_sin_valor"),
    )


def early_deliveries(df: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders delivered before their own prediction time: they would see their own outcome."""
    known = orders.select("order_id", DELIVERED)
    return df.select("order_id", PREDICTION_TIME).join(known, "order_id").agg(
        count_true(F.col(DELIVERED) < F.col(PREDICTION_TIME)).alias("entregados_antes")
    )
