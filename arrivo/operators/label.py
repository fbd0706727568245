"""Late-delivery label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from arrivo.schemas import DELIVERED, ESTIMATED, PURCHASE, STUDY_PERIOD, TARGET


def lenient_timestamp(df: DataFrame, name: str) -> Column:
    """The column as a timestamp; text that does not parse becomes null instead of failing."""
    if df.schema[name].dataType.typeName() == "string":
        return F.col(name).try_cast("timestamp_ntz")
    return F.col(name)


def observable(df: DataFrame, delivered_status: str = "delivered") -> Column:
    """Delivered, with both dates known: only then can lateness be seen."""
    return (
        (F.col("order_status") == delivered_status)
        & lenient_timestamp(df, DELIVERED).isNotNull()
        & lenient_timestamp(df, ESTIMATED).isNotNull()
    )


def late_flag(delivered: Column, estimated: Column, by_calendar_day: bool = True) -> Column:
    """True when delivered after the promise. By day: the promise holds no time of day."""
    if by_calendar_day:
        return F.to_date(delivered) > F.to_date(estimated)
    return delivered > estimated


def in_period(time: Column, period: tuple[str, str]) -> Column:
    start, stop = (F.lit(p).cast("timestamp_ntz") for p in period)
    return (time >= start) & (time < stop)


def build_target(
    orders: DataFrame,
    by_calendar_day: bool = True,
    only_study_period: bool = True,
    period: tuple[str, str] = STUDY_PERIOD,
) -> DataFrame:
    """Orders whose lateness is observable, with the 0/1 label added. One scan, no shuffle."""
    keep = observable(orders)
    if only_study_period:
        keep = keep & in_period(lenient_timestamp(orders, PURCHASE), period)
    delivered, estimated = lenient_timestamp(orders, DELIVERED), lenient_timestamp(orders, ESTIMATED)
    return orders.filter(keep).withColumns(
        {
            DELIVERED: delivered,
            ESTIMATED: estimated,
            TARGET: late_flag(delivered, estimated, by_calendar_day).cast("int"),
        }
    )


def compare_label_rules(orders: DataFrame, only_study_period: bool = False, **options) -> DataFrame:
    """Both rules side by side per order, over the same population (one pass instead of a 1:1 join)."""
    by_day = build_target(orders, True, only_study_period, **options)
    return by_day.select(
        "order_id",
        F.col(TARGET).alias("regla_por_dia"),
        late_flag(F.col(DELIVERED), F.col(ESTIMATED), False).cast("int").alias("regla_por_fecha_y_hora"),
    )
