"""As-of joins of the event log: each click with the user's nearest purchase, in all four ways.

Every third user is one and the same key, which so owns a third of all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from arrivo.operators.asof import BACKWARD, FORWARD, asof_join
from arrivo.queries.registry import register

HOUR = 3_600_000_000


def nearest_purchase(b, direction: str, allow_exact: bool, tolerance: int | None) -> DataFrame:
    log = b.raw("events").withColumn("quien", F.when(F.col("user_id") % 3 == 0, 0).otherwise(F.col("user_id")))
    # whole minutes, so that equal times occur
    log = log.withColumn("cuando", F.date_trunc("minute", "ts").cast("timestamp_ntz"))
    clicks = log.where("event_type = 'click'").select("event_id", "quien", "cuando")
    bought = log.where("event_type = 'purchase'").select(
        F.col("event_id").alias("compra"), F.col("value").alias("valor"), "quien", F.col("cuando").alias("comprado")
    )
    return asof_join(
        clicks, bought, ["quien"], "cuando", "comprado", ["compra", "valor"], direction, allow_exact, tolerance, matched="comprado"
    )


def sql(comparison: str, hours: int | None) -> str:
    near = "true" if hours is None else f"abs(epoch_us(c.cuando) - epoch_us(p.comprado)) <= {hours} * {HOUR}"
    cells = ", ".join(f"CASE WHEN {near} THEN p.{x} END AS {x}" for x in ("compra", "valor", "comprado"))
    return f"""WITH bitacora AS (
  SELECT *, CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS quien, CAST(date_trunc('minute', ts) AS TIMESTAMP) AS cuando FROM events),
compras AS (
  SELECT quien, cuando AS comprado, max(event_id) AS compra, arg_max(value, event_id) AS valor
  FROM bitacora WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT c.event_id, c.quien, c.cuando, {cells}
FROM (SELECT * FROM bitacora WHERE event_type = 'click') c
ASOF LEFT JOIN compras p ON c.quien = p.quien AND c.cuando {comparison} p.comprado"""


MODES = {
    "asof_last_purchase": (BACKWARD, True, None, ">="),
    "asof_earlier_purchase": (BACKWARD, False, 6, ">"),
    "asof_next_purchase": (FORWARD, True, 6, "<="),
    "asof_later_purchase": (FORWARD, False, None, "<"),
}

for name, (direction, exact, hours, comparison) in MODES.items():
    limit = None if hours is None else hours * HOUR
    register(name, lambda b, d=direction, e=exact, t=limit: nearest_purchase(b, d, e, t), sql(comparison, hours), real=["valor"])
