"""Cleaning: runway override, external-estimate join, de-duplication, durations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pushback.functions.codes import clean_runway
from pushback.functions.timecols import seconds_between, whole_seconds_between

FLIGHT_KEY = ("airport_icao", "gufi")

RUNWAY_ON = ("gufi", "isarrival", "isdeparture")
ESTIMATE_ON = ("acid", "isarrival", "isdeparture", "departure_stand_initial_time",
               "departure_aerodrome_icao_name", "arrival_aerodrome_icao_name")


def _key(df: DataFrame, cols) -> list[str]:
    return [c for c in cols if c in df.columns]


def _observed(flights: DataFrame, runways: DataFrame, check_empty: bool) -> DataFrame:
    """``flights`` with ``__observed``: whether the flight's airport has any runway row."""
    if not check_empty:
        return flights.withColumn("__observed", F.lit(True))
    if "airport_icao" not in flights.columns or "airport_icao" not in runways.columns:
        return flights.crossJoin(F.broadcast(runways.agg((F.count(F.lit(1)) > 0).alias("__observed"))))
    # one row per airport of the job
    seen = runways.select(F.col("airport_icao").alias("__airport")).distinct()
    joined = flights.join(F.broadcast(seen), F.col("airport_icao") == F.col("__airport"), "left")
    return joined.withColumn("__observed", F.col("__airport").isNotNull()).drop("__airport")


def replace_runway_actuals(flights: DataFrame, runways: DataFrame,
                           check_empty: bool = True, mark: str | None = None) -> DataFrame:
    """Override runway codes/times with observed runway use.

    Runway rows get direction flags from which runway column is filled, are
    left-joined on ``(airport_icao, gufi, isarrival, isdeparture)`` and every
    non-key value wins where it is present.  Then the AMA and full durations
    are recomputed in whole seconds and runway codes are cleaned (``17.0`` ->
    ``17``, ``018`` -> ``18``).  With ``check_empty`` the flights of an airport
    without any runway row stay untouched, whatever other airports have.  With
    ``mark`` a column of that name tells which flights had a runway row.

    The join is never a broadcast: it deals the flights by key, so a later sort
    holds a shuffle's partition of them and not all that one file split has.
    """
    rw = (runways
          .withColumn("isdeparture", F.col("departure_runway_actual").isNotNull())
          .withColumn("isarrival", F.col("arrival_runway_actual").isNotNull()))
    on = [c for c in [*_key(flights, ("airport_icao",)), *RUNWAY_ON] if c in rw.columns]
    updates = [c for c in rw.columns if c not in on]
    rw = rw.select(*on, *[F.col(c).alias(f"{c}__new") for c in updates], F.lit(True).alias("__found"))
    merged = _observed(flights, runways, check_empty).join(rw.hint("merge"), on=on, how="left")
    known = [c for c in updates if c in flights.columns]
    merged = merged.withColumns({c: F.coalesce(F.col(f"{c}__new"), F.col(c)) for c in known})
    def seconds(start: str, end: str) -> Column | None:
        return whole_seconds_between(start, end) if {start, end} <= set(flights.columns) else None

    derived = {
        "actual_departure_ama_taxi_time": seconds("departure_movement_area_actual_time", "departure_runway_actual_time"),
        "actual_departure_full_taxi_time": seconds("departure_stand_actual_time", "departure_runway_actual_time"),
        "arrival_runway_actual": clean_runway("arrival_runway_actual"),
        "departure_runway_actual": clean_runway("departure_runway_actual"),
    }
    merged = merged.withColumns({c: F.when(F.col("__observed"), e).otherwise(F.col(c)) for c, e in derived.items()
                                 if c in flights.columns and e is not None})
    return merged.select(*flights.columns, *([F.col("__found").isNotNull().alias(mark)] if mark else []))


def merge_estimates(flights: DataFrame, estimates: DataFrame, suffix: str = "_ffs", mark: str | None = None) -> DataFrame:
    """Left join of external estimates on six keys; missing keys match each other.

    Non-key estimate columns that clash with flight columns get ``suffix``
    (so the estimate's own ``gufi`` becomes ``gufi_ffs``).  An empty estimate
    table simply yields all-NULL estimate columns, which keeps the schema
    stable for later steps.  With ``mark`` a column of that name tells which
    flights found an estimate.
    """
    on = [c for c in ESTIMATE_ON if c in estimates.columns]
    rest = [c for c in estimates.columns if c not in on]
    est = estimates.select(*[F.col(c).alias(f"{c}__k") for c in on],
                           *[F.col(c).alias(c + suffix if c in flights.columns else c) for c in rest],
                           *([F.lit(True).alias("__found")] if mark else []))
    cond = reduce(lambda a, b: a & b, [flights[c].eqNullSafe(est[f"{c}__k"]) for c in on])
    joined = flights.join(est, cond, "left").drop(*[f"{c}__k" for c in on])
    return joined.withColumn(mark, F.col("__found").isNotNull()).drop("__found") if mark else joined


def first_estimates(estimates: DataFrame, count: str | None = None) -> DataFrame:
    """One row per six-key tuple of the estimates: the one that ``keep_first_per_flight`` would keep.

    Missing keys match each other in ``merge_estimates``, so an equal tuple on
    both sides (say, flights and estimates without an initial time) joins into
    all pairs, of which one per flight is kept.  For any flight the smallest of
    its estimates is that of the tuple (every other column in order, NULLs
    last), so it is found before the join, which then keeps its flights' number.
    With ``count`` a column of that name has the tuple's rows.
    """
    on = [c for c in ESTIMATE_ON if c in estimates.columns]
    rest = [c for c in estimates.columns if c not in on]
    place = F.struct(*[part for c in rest for part in (F.col(c).isNull().alias(f"__no_{c}"), F.col(c))]) if rest else F.lit(True)
    found = estimates.groupBy(*on).agg(F.min(place).alias("__first"), F.count(F.lit(1)).alias("__rows"))
    return found.select(*on, *[F.col("__first")[c].alias(c) for c in rest], *([F.col("__rows").alias(count)] if count else []))


def estimate_match_rate(merged: DataFrame, marker: str = "gufi_ffs") -> DataFrame:
    """Share of flights (in %) that found an estimate: one-row table."""
    return merged.agg((F.avg(F.col(marker).isNotNull().cast("double")) * 100).alias("pct_matched"))


def keep_first_per_flight(df: DataFrame, order_by: tuple[str, ...] = (
        "departure_stand_initial_time", "departure_stand_actual_time", "departure_runway_actual_time",
        "arrival_runway_actual_time", "acid")) -> DataFrame:
    """One row per ``(airport_icao, gufi)``: the first under a declared order.

    The reference keeps the first row in input order, which is undefined for a
    distributed read.  Here "first" is the smallest ``order_by`` tuple (NULLs
    last) and then every other column, so the choice never depends on layout.
    ``row_number() … = 1`` is planned with a per-partition group limit before
    the shuffle.
    """
    key = _key(df, FLIGHT_KEY)
    first = [F.col(c).asc_nulls_last() for c in order_by if c in df.columns]
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in order_by and c not in key]
    w = Window.partitionBy(*key).orderBy(*first, *rest)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def add_total_taxi_time(df: DataFrame) -> DataFrame:
    """``actual_departure_total_taxi_time``: stand to runway, fractional seconds."""
    return df.withColumn("actual_departure_total_taxi_time",
                         seconds_between("departure_stand_actual_time", "departure_runway_actual_time"))
