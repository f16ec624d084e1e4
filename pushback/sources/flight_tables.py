"""Source queries: flight summary, runway actuals, speed fraction, estimates.

Each function takes the raw table as a DataFrame (Parquet, JDBC or any other
reader) plus a ``FlightWindow`` and returns a lazy DataFrame.  Time and
airport predicates are plain column comparisons with literals, so Catalyst
pushes them into the Parquet/JDBC scan.

Several airports can be served by one job: every output row carries
``airport_icao`` and every later key is ``(airport_icao, gufi)``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pushback.functions.codes import iata_from_icao
from pushback.functions.timecols import seconds_between


@dataclass(frozen=True)
class FlightWindow:
    airports: tuple[str, ...] = ("KDFW",)
    start: str = "2019-06-01 12:00:00"
    end: str = "2019-06-10 12:00:00"
    surface_surveillance: bool = True

    def start_lit(self) -> Column:
        return F.lit(self.start).cast("timestamp_ntz")

    def end_lit(self) -> Column:
        return F.lit(self.end).cast("timestamp_ntz")

    def between(self, c: str) -> Column:
        """Inclusive on both ends, like SQL ``BETWEEN``."""
        return F.col(c).between(self.start_lit(), self.end_lit())


FLIGHT_OUTPUT_COLUMNS = [
    "actual_arrival_ramp_taxi_time", "actual_arrival_ama_taxi_time",
    "actual_departure_ramp_taxi_time", "actual_departure_ama_taxi_time",
    "actual_departure_full_taxi_time",
    "gufi", "carrier", "acid", "departure_stand_initial_time", "aircraft_type",
    "arrival_aerodrome_icao_name", "departure_aerodrome_icao_name",
    "isarrival", "isdeparture",
    "arrival_stand_actual", "arrival_stand_actual_time", "arrival_stand_airline_time",
    "arrival_spot_actual", "arrival_movement_area_actual_time",
    "arrival_runway_actual", "arrival_runway_actual_time",
    "departure_stand_actual", "departure_stand_actual_time", "departure_stand_airline_time",
    "departure_spot_actual", "departure_movement_area_actual_time",
    "departure_runway_actual", "departure_runway_actual_time",
    "airport_icao",
]

# Priority order of the coalesced columns.
STAND_PRIORITY = ("actual", "user", "airline")
RUNWAY_PRIORITY = ("actual", "user", "assigned", "airline")


def _first_known(prefix: str, order: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.col(f"{prefix}_{s}") for s in order])


def _airport_rows(qualifiers: list[tuple[Column, Column]]) -> Column:
    """Distinct airports a row qualifies for: ``[(condition, airport), …]``."""
    picks = F.array(*[F.when(F.coalesce(cond, F.lit(False)), ap) for cond, ap in qualifiers])
    return F.explode(F.array_distinct(F.array_compact(picks)))


def flight_summary(raw: DataFrame, w: FlightWindow) -> DataFrame:
    """Flights of the window's airports with coalesced actuals and durations.

    A departure qualifies by its runway time, an arrival by its stand, runway
    or movement-area time, all inclusive.  Flags say whether the airport is
    the departure / arrival aerodrome (NULL aerodrome gives False).
    """
    airports = list(w.airports)
    dep_q = F.col("departure_aerodrome_icao_name").isin(airports) & w.between("departure_runway_actual_time")
    arr_q = F.col("arrival_aerodrome_icao_name").isin(airports) & (
        w.between("arrival_stand_actual_time")
        | w.between("arrival_runway_actual_time")
        | w.between("arrival_movement_area_actual_time"))
    picked = raw.where(dep_q | arr_q).withColumn(
        "airport_icao",
        _airport_rows([(dep_q, F.col("departure_aerodrome_icao_name")),
                       (arr_q, F.col("arrival_aerodrome_icao_name"))]))
    ap = F.col("airport_icao")
    out = picked.select(
        seconds_between("arrival_movement_area_actual_time", "arrival_stand_actual_time")
        .alias("actual_arrival_ramp_taxi_time"),
        seconds_between("arrival_runway_actual_time", "arrival_movement_area_actual_time")
        .alias("actual_arrival_ama_taxi_time"),
        seconds_between("departure_stand_actual_time", "departure_movement_area_actual_time")
        .alias("actual_departure_ramp_taxi_time"),
        seconds_between("departure_movement_area_actual_time", "departure_runway_actual_time")
        .alias("actual_departure_ama_taxi_time"),
        seconds_between("departure_stand_actual_time", "departure_runway_actual_time")
        .alias("actual_departure_full_taxi_time"),
        "gufi", "carrier", "acid", "departure_stand_initial_time", "aircraft_type",
        "arrival_aerodrome_icao_name", "departure_aerodrome_icao_name",
        F.coalesce(F.col("arrival_aerodrome_icao_name") == ap, F.lit(False)).alias("isarrival"),
        F.coalesce(F.col("departure_aerodrome_icao_name") == ap, F.lit(False)).alias("isdeparture"),
        _first_known("arrival_stand", STAND_PRIORITY).alias("arrival_stand_actual"),
        "arrival_stand_actual_time", "arrival_stand_airline_time",
        _first_known("arrival_spot", STAND_PRIORITY).alias("arrival_spot_actual"),
        "arrival_movement_area_actual_time",
        _first_known("arrival_runway", RUNWAY_PRIORITY).alias("arrival_runway_actual"),
        "arrival_runway_actual_time",
        _first_known("departure_stand", STAND_PRIORITY).alias("departure_stand_actual"),
        "departure_stand_actual_time", "departure_stand_airline_time",
        _first_known("departure_spot", STAND_PRIORITY).alias("departure_spot_actual"),
        "departure_movement_area_actual_time",
        _first_known("departure_runway", RUNWAY_PRIORITY).alias("departure_runway_actual"),
        "departure_runway_actual_time",
        "airport_icao",
    )
    return out


def runway_actuals(raw: DataFrame, w: FlightWindow, strict: bool = False) -> DataFrame:
    """Observed runway use for the window's airports.

    The published query reads ``dep OR arr AND points``: the
    ``points_on_runway`` test binds to the arrival branch only.  That is the
    default; ``strict=True`` applies it to both branches.
    """
    flag = F.lit(bool(w.surface_surveillance))
    iata_to_icao = F.create_map(*[x for a in w.airports for x in (F.lit(a[1:4]), F.lit(a))])
    iatas = [a[1:4] for a in w.airports]
    points = F.coalesce(F.col("points_on_runway") == flag, F.lit(False))
    dep_q = F.col("departure_aerodrome_iata_name").isin(iatas) & w.between("departure_runway_actual_time")
    arr_q = (F.col("arrival_aerodrome_iata_name").isin(iatas) & w.between("arrival_runway_actual_time")
             & points)
    if strict:
        dep_q = dep_q & points
    picked = raw.where(dep_q | arr_q).withColumn(
        "airport_icao",
        _airport_rows([(dep_q, iata_to_icao[F.col("departure_aerodrome_iata_name")]),
                       (arr_q, iata_to_icao[F.col("arrival_aerodrome_iata_name")])]))
    return picked.select("gufi", "departure_runway_actual_time", "departure_runway_actual",
                         "arrival_runway_actual_time", "arrival_runway_actual", "airport_icao")


def speed_fraction(positions: DataFrame, raw_flights: DataFrame, w: FlightWindow,
                   threshold_knots: float = 4.0, system_id: str = "ASDEX") -> DataFrame:
    """Share of surveillance points at or above ``threshold_knots`` per flight.

    Points of the surface system, strictly inside the window widened by one
    hour, before take-off and (when the airport has surface surveillance)
    after the movement-area entry.  NULL speeds are ignored by ``avg``.

    The one-hour literal bounds are redundant with the per-flight bounds but
    are what lets the scan of the (very large) position table skip files.
    """
    fl = (raw_flights
          .where(F.col("departure_aerodrome_icao_name").isin(list(w.airports))
                 & w.between("departure_runway_actual_time"))
          .select("gufi",
                  F.col("departure_runway_actual_time").alias("_rwy"),
                  F.col("departure_movement_area_actual_time").alias("_ama")))
    lo = F.timestamp_add("HOUR", F.lit(-1), w.start_lit())
    hi = F.timestamp_add("HOUR", F.lit(1), w.end_lit())
    pos = (positions
           .where((F.col("system_id") == system_id) & (F.col("timestamp") > lo) & (F.col("timestamp") < hi))
           .select("gufi", "timestamp", "position_speed"))
    cond = F.col("timestamp") < F.col("_rwy")
    if w.surface_surveillance:
        cond = cond & (F.col("timestamp") > F.col("_ama"))
    joined = pos.join(fl, "gufi").where(cond)
    return joined.groupBy("gufi").agg(
        F.avg((F.col("position_speed") >= F.lit(threshold_knots)).cast("int").cast("double"))
        .alias("fraction_speed_gte_threshold"))


def external_estimates(raw: DataFrame, w: FlightWindow) -> DataFrame:
    """External undelayed-transit estimates for one airport's table."""
    keep = (F.coalesce(F.col("isdeparture"), F.lit(False)) & w.between("departure_runway_actual_time")) | (
        F.coalesce(F.col("isarrival"), F.lit(False)) & w.between("arrival_stand_actual_time"))
    return raw.where(keep).select(
        "gufi", "isarrival", "isdeparture", "acid", "departure_stand_initial_time",
        "departure_aerodrome_icao_name", "arrival_aerodrome_icao_name",
        "undelayed_departure_ramp_transit_time", "undelayed_departure_ama_transit_time",
        "undelayed_departure_total_transit_time")


__all__ = ["FlightWindow", "flight_summary", "runway_actuals", "speed_fraction",
           "external_estimates", "FLIGHT_OUTPUT_COLUMNS", "iata_from_icao"]
