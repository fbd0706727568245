"""Row-level expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

EARTH_RADIUS_KM = 6371.0
LOGIT_MARGIN = 1e-6
MICROS_PER_HOUR = 3_600_000_000.0
MICROS_PER_DAY = 86_400_000_000.0


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def positive_or_null(c: Column | str) -> Column:
    """Measures and instalments at or below zero are invalid, hence unknown."""
    c = as_column(c)
    return F.when(c > 0, c)


def micros(ts: Column | str) -> Column:
    """Microseconds since 1970 of a timestamp without zone (session zone pinned to UTC)."""
    return F.unix_micros(as_column(ts).cast("timestamp"))


def from_micros(c: Column | str) -> Column:
    return F.timestamp_micros(as_column(c)).cast("timestamp_ntz")


def hours_between(start: Column | str, end: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", as_column(start), as_column(end)) / MICROS_PER_HOUR


def days_between(start: Column | str, end: Column | str) -> Column:
    """Fractional days; negative when `end` comes first."""
    return F.timestamp_diff("MICROSECOND", as_column(start), as_column(end)) / MICROS_PER_DAY


def calendar_days(start: Column | str, end: Column | str) -> Column:
    return F.datediff(F.to_date(as_column(end)), F.to_date(as_column(start)))


def month_start(ts: Column | str) -> Column:
    return F.trunc(F.to_date(as_column(ts)), "month")


def ratio_if_positive(part: Column | str, whole: Column | str) -> Column:
    part, whole = as_column(part), as_column(whole)
    return F.when(whole > 0, part / whole)


def share(part: Column, whole: Column) -> Column:
    """part/whole as a double, 0 where the whole is 0 or missing."""
    return F.coalesce(F.when(whole != 0, part.cast("double") / whole), F.lit(0.0))


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    half_lat = F.radians(lat2 - lat1) / 2
    half_lng = F.radians(lng2 - lng1) / 2
    chord = (
        F.sin(half_lat) * F.sin(half_lat)
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(half_lng) * F.sin(half_lng)
    )
    # least() skips nulls, so the null of a missing point has to be put back
    arc = F.when(chord.isNotNull(), F.asin(F.sqrt(F.least(F.lit(1.0), chord))))
    return 2 * EARTH_RADIUS_KM * arc


def logit(p: Column | str) -> Column:
    p = as_column(p)
    inside = F.greatest(F.lit(LOGIT_MARGIN), F.least(F.lit(1 - LOGIT_MARGIN), p))
    return F.when(p.isNotNull(), F.log(inside / (1 - inside)))


def right_closed_bin(c: Column | str, edges: Sequence[float]) -> Column:
    """Number (0, 1, …) of the interval (edges[i], edges[i+1]] that holds the value, else null."""
    c = as_column(c)
    cases = [(c > lo) & (c <= hi) for lo, hi in zip(edges, edges[1:])]
    out = F.when(cases[0], F.lit(0))
    for number, case in enumerate(cases[1:], start=1):
        out = out.when(case, F.lit(number))
    return out


def pick_label(number: Column | str, labels: Sequence[str]) -> Column:
    number = as_column(number)
    return F.when(
        number.isNotNull(), F.element_at(F.array(*[F.lit(x) for x in labels]), number.cast("int") + 1)
    )


def any_true(conditions: Sequence[Column]) -> Column:
    """Any-of over predicates, a null predicate counting as false."""
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions])


def differs(a: Column, b: Column) -> Column:
    """Null-safe inequality."""
    return ~a.eqNullSafe(b)


def value_bucket(value: str, steps: int = 1 << 14) -> Column:
    """Order-preserving bucket number of a double: `steps` equal slices per power of two.

    Needs no minimum or maximum, is not spoilt by outliers, and keeps each bucket to 1/steps of an
    octave, whatever the scale of the data. Both infinities have a bucket of their own at the ends.
    """
    size, octave = f"abs({value})", f"floor(log2(abs({value})))"
    slot = f"(({octave} + 1100) * {steps} + floor(({size} / pow(2, {octave}) - 1) * {steps}))"
    end = (1 << 12) * steps  # beyond the bucket of every finite number
    return F.expr(
        f"CASE WHEN {value} = 0 THEN 0L WHEN {size} = double('inf') THEN if({value} > 0, {end}L, -{end}L)"
        f" WHEN {value} > 0 THEN {slot} ELSE -{slot} END"
    )
