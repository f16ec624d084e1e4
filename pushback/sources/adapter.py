"""Flight-shaped source tables built from the driver's TPC-H-like tables.

The reference reads four production tables that are not public (flight
summaries, observed runway use, surface surveillance points and external
taxi estimates).  This module only *stands in* for them: it maps rows of
``orders`` (one flight each) and ``lineitem`` (one surveillance point each)
to those schemas with integer arithmetic, so that every job in the library
runs on input that grows with the driver tables.  The jobs themselves take
nothing from how these rows are made.

The formulas are written once as SQL text and rendered for two dialects:
Spark SQL (used here through ``selectExpr``) and DuckDB (used by the
independent oracle queries), so both engines see identical input rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

BASE_TIME = "2019-06-01 00:00:00"
HOME_AIRPORT = "KDFW"


@dataclass(frozen=True)
class Dialect:
    name: str

    def idiv(self, a: str, b: int) -> str:
        return f"(({a}) div {b})" if self.name == "spark" else f"(({a}) // {b})"

    def at_ms(self, ms: str) -> str:
        """Timestamp ``BASE_TIME + ms`` milliseconds (timestamp without zone)."""
        if self.name == "spark":
            return f"timestampadd(MILLISECOND, {ms}, TIMESTAMP_NTZ'{BASE_TIME}')"
        return f"(TIMESTAMP '{BASE_TIME}' + to_milliseconds({ms}))"


SPARK = Dialect("spark")
DUCK = Dialect("duckdb")


def _runway(n: str) -> str:
    return (f"CASE {n} WHEN 0 THEN '18L' WHEN 1 THEN '36R' WHEN 2 THEN '17C' "
            f"WHEN 3 THEN '17.0' ELSE '018' END")


def _other_airport(d: Dialect, k: str) -> str:
    return (f"CASE {d.idiv(k, 3)} % 4 WHEN 0 THEN 'KCLT' WHEN 1 THEN 'KJFK' "
            f"WHEN 2 THEN 'KLGA' ELSE 'KEWR' END")


def _stand(letter_off: str, num: str) -> str:
    return f"chr(CAST(65 + {letter_off} % 5 AS INT)) || CAST(1 + {num} % 13 AS STRING)"


def _base_columns(d: Dialect) -> list[str]:
    """Integer building blocks per order ``k`` (all stay inside 64 bits)."""
    k = "o_orderkey"
    c = "o_custkey"
    h = f"({k} * 7919 + {c} * 104729)"
    return [
        f"{k} AS k", f"{c} AS c", f"{h} AS h",
        f"({k} * 2654435761) % 864000 AS t0s",
        f"CASE WHEN {k} % 97 = 0 THEN 9000 ELSE 120 + {h} % 600 END AS dep_ramp_s",
        f"CASE WHEN {k} % 89 = 0 THEN 12000 ELSE 240 + {d.idiv(h, 7)} % 900 END AS dep_ama_s",
        f"3600 + {d.idiv(h, 3)} % 7200 AS air_s",
        f"60 + {d.idiv(h, 5)} % 400 AS arr_ama_s",
        f"60 + {d.idiv(h, 11)} % 300 AS arr_ramp_s",
        f"{h} % 1000 AS jitter_ms",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'FDX' WHEN '2-HIGH' THEN 'AAL' "
        "WHEN '3-MEDIUM' THEN 'UAL' WHEN '4-NOT SPECIFIED' THEN 'DAL' ELSE 'SKW' END AS carrier",
        f"CASE WHEN {k} % 11 = 0 THEN 'KJFK' WHEN {k} % 3 = 0 THEN {_other_airport(d, k)} "
        f"ELSE '{HOME_AIRPORT}' END AS dep_ap",
        f"CASE WHEN {k} % 11 = 0 THEN 'KLGA' WHEN {k} % 3 = 0 THEN '{HOME_AIRPORT}' "
        f"ELSE {_other_airport(d, k)} END AS arr_ap",
    ]


def _flight_columns(d: Dialect, dup: bool) -> list[str]:
    """Columns of the flight summary source (one row per flight record)."""
    shift = "120000" if dup else "0"
    dep_stand_ms = f"(t0s * 1000 + {shift})"
    dep_ama_ms = f"({dep_stand_ms} + dep_ramp_s * 1000)"
    dep_rwy_ms = f"({dep_ama_ms} + dep_ama_s * 1000 + jitter_ms)"
    arr_rwy_ms = f"({dep_rwy_ms} + air_s * 1000)"
    arr_ama_ms = f"({arr_rwy_ms} + arr_ama_s * 1000)"
    arr_stand_ms = f"({arr_ama_ms} + arr_ramp_s * 1000)"
    init_shift = "60000" if dup else "0"
    return [
        "'FL' || CAST(k AS STRING) AS gufi",
        "carrier",
        "carrier || CAST(100 + k % 9000 AS STRING) AS acid",
        f"CASE {d.idiv('h', 19)} % 5 WHEN 0 THEN 'A320' WHEN 1 THEN 'B738' WHEN 2 THEN 'CRJ9' "
        "WHEN 3 THEN 'MD90' ELSE 'B737' END AS aircraft_type",
        "arr_ap AS arrival_aerodrome_icao_name",
        "dep_ap AS departure_aerodrome_icao_name",
        # arrival side
        f"CASE WHEN k % 9 = 2 OR k % 37 = 0 THEN NULL ELSE {_stand('(c + 2)', '(k + 3)')} END AS arrival_stand_actual",
        f"CASE WHEN k % 8 = 3 OR k % 37 = 0 THEN NULL ELSE {_stand('(c + 3)', '(k + 4)')} END AS arrival_stand_user",
        f"CASE WHEN k % 37 = 0 THEN NULL ELSE {_stand('(c + 4)', '(k + 5)')} END AS arrival_stand_airline",
        "CASE WHEN k % 6 = 2 THEN NULL ELSE 'S' || CAST(1 + (h + 3) % 9 AS STRING) END AS arrival_spot_actual",
        "CASE WHEN k % 4 = 2 THEN NULL ELSE 'S' || CAST(1 + (h + 4) % 9 AS STRING) END AS arrival_spot_user",
        "'S' || CAST(1 + (h + 5) % 9 AS STRING) AS arrival_spot_airline",
        f"CASE WHEN k % 6 = 4 OR k % 31 = 0 THEN NULL ELSE {_runway(d.idiv('h', 29) + ' % 5')} END AS arrival_runway_actual",
        f"CASE WHEN k % 4 = 1 OR k % 31 = 0 THEN NULL ELSE {_runway(d.idiv('h', 37) + ' % 5')} END AS arrival_runway_user",
        f"CASE WHEN k % 31 = 0 THEN NULL ELSE {_runway(d.idiv('h', 41) + ' % 5')} END AS arrival_runway_assigned",
        f"CASE WHEN k % 31 = 0 OR k % 2 = 1 THEN NULL ELSE {_runway(d.idiv('h', 43) + ' % 5')} END AS arrival_runway_airline",
        # departure side
        f"CASE WHEN k % 7 = 1 OR k % 41 = 0 THEN NULL ELSE {_stand('c', 'k')} END AS departure_stand_actual",
        f"CASE WHEN k % 5 = 1 OR k % 41 = 0 THEN NULL ELSE {_stand('c', '(k + 1)')} END AS departure_stand_user",
        f"CASE WHEN k % 41 = 0 THEN NULL ELSE {_stand('(c + 1)', '(k + 2)')} END AS departure_stand_airline",
        "CASE WHEN k % 6 = 1 THEN NULL ELSE 'S' || CAST(1 + h % 9 AS STRING) END AS departure_spot_actual",
        "CASE WHEN k % 4 = 1 THEN NULL ELSE 'S' || CAST(1 + (h + 1) % 9 AS STRING) END AS departure_spot_user",
        "'S' || CAST(1 + (h + 2) % 9 AS STRING) AS departure_spot_airline",
        f"CASE WHEN k % 6 = 5 OR k % 43 = 0 THEN NULL ELSE {_runway(d.idiv('h', 11) + ' % 5')} END AS departure_runway_actual",
        f"CASE WHEN k % 4 = 3 OR k % 43 = 0 THEN NULL ELSE {_runway(d.idiv('h', 13) + ' % 5')} END AS departure_runway_user",
        f"CASE WHEN k % 43 = 0 THEN NULL ELSE {_runway(d.idiv('h', 17) + ' % 5')} END AS departure_runway_assigned",
        f"CASE WHEN k % 43 = 0 OR k % 2 = 0 THEN NULL ELSE {_runway(d.idiv('h', 23) + ' % 5')} END AS departure_runway_airline",
        # times
        f"CASE WHEN k % 45 = 0 THEN NULL ELSE {d.at_ms(f'(t0s - 600 - h % 1800) * 1000 + {init_shift}')} END "
        "AS departure_stand_initial_time",
        f"CASE WHEN k % 47 = 0 THEN NULL ELSE {d.at_ms(arr_stand_ms)} END AS arrival_stand_actual_time",
        f"{d.at_ms(arr_stand_ms + ' + (' + d.idiv('h', 31) + ' % 600) * 1000')} AS arrival_stand_airline_time",
        f"CASE WHEN k % 23 = 0 THEN NULL ELSE {d.at_ms(arr_ama_ms)} END AS arrival_movement_area_actual_time",
        f"CASE WHEN k % 53 = 1 THEN NULL ELSE {d.at_ms(arr_rwy_ms)} END AS arrival_runway_actual_time",
        f"CASE WHEN k % 59 = 0 THEN NULL ELSE {d.at_ms(dep_stand_ms)} END AS departure_stand_actual_time",
        f"{d.at_ms(dep_stand_ms + ' - (' + d.idiv('h', 23) + ' % 900) * 1000')} AS departure_stand_airline_time",
        f"CASE WHEN k % 29 = 0 THEN NULL ELSE {d.at_ms(dep_ama_ms)} END AS departure_movement_area_actual_time",
        f"CASE WHEN k % 37 = 0 THEN NULL ELSE {d.at_ms(dep_rwy_ms)} END AS departure_runway_actual_time",
    ]


def _runway_columns(d: Dialect) -> list[str]:
    dep_rwy_ms = "(t0s * 1000 + dep_ramp_s * 1000 + dep_ama_s * 1000 + jitter_ms)"
    arr_rwy_ms = f"({dep_rwy_ms} + air_s * 1000)"
    return [
        "'FL' || CAST(k AS STRING) AS gufi",
        "substring(dep_ap, 2, 3) AS departure_aerodrome_iata_name",
        "substring(arr_ap, 2, 3) AS arrival_aerodrome_iata_name",
        f"CASE WHEN k % 3 = 0 THEN NULL ELSE {_runway(d.idiv('h', 13) + ' % 5')} END AS departure_runway_actual",
        f"CASE WHEN k % 3 = 0 OR k % 28 = 0 THEN NULL ELSE {d.at_ms(dep_rwy_ms + ' + 30000')} END "
        "AS departure_runway_actual_time",
        f"CASE WHEN k % 3 = 0 THEN {_runway(d.idiv('h', 47) + ' % 5')} ELSE NULL END AS arrival_runway_actual",
        f"CASE WHEN k % 3 = 0 AND k % 28 <> 0 THEN {d.at_ms(arr_rwy_ms + ' + 15000')} ELSE NULL END "
        "AS arrival_runway_actual_time",
        "k % 2 = 0 AS points_on_runway",
    ]


def _estimate_columns(d: Dialect, airport: str) -> list[str]:
    dep_rwy_ms = "(t0s * 1000 + dep_ramp_s * 1000 + dep_ama_s * 1000 + jitter_ms)"
    arr_stand_ms = f"({dep_rwy_ms} + air_s * 1000 + arr_ama_s * 1000 + arr_ramp_s * 1000)"
    return [
        "'EST' || CAST(k AS STRING) AS gufi",
        f"arr_ap = '{airport}' AS isarrival",
        f"dep_ap = '{airport}' AS isdeparture",
        "carrier || CAST(100 + k % 9000 AS STRING) AS acid",
        f"CASE WHEN k % 45 = 0 THEN NULL ELSE {d.at_ms('(t0s - 600 - h % 1800) * 1000')} END "
        "AS departure_stand_initial_time",
        "dep_ap AS departure_aerodrome_icao_name",
        "arr_ap AS arrival_aerodrome_icao_name",
        f"CASE WHEN k % 37 = 0 THEN NULL ELSE {d.at_ms(dep_rwy_ms)} END AS departure_runway_actual_time",
        f"CASE WHEN k % 47 = 0 THEN NULL ELSE {d.at_ms(arr_stand_ms)} END AS arrival_stand_actual_time",
        "CAST(dep_ramp_s AS DOUBLE) * CAST(0.9 AS DOUBLE) AS undelayed_departure_ramp_transit_time",
        "CAST(dep_ama_s AS DOUBLE) * CAST(0.9 AS DOUBLE) AS undelayed_departure_ama_transit_time",
        "CAST(dep_ramp_s + dep_ama_s AS DOUBLE) * CAST(0.9 AS DOUBLE) AS undelayed_departure_total_transit_time",
    ]


def _position_columns(d: Dialect) -> list[str]:
    t0s = "((l_orderkey * 2654435761) % 864000)"
    ms = f"({t0s} * 1000 + 60000 * l_linenumber + (l_partkey % 600) * 1000)"
    return [
        "'FL' || CAST(l_orderkey AS STRING) AS gufi",
        "CASE WHEN l_returnflag = 'R' THEN 'TRACON' ELSE 'ASDEX' END AS system_id",
        f"{d.at_ms(ms)} AS timestamp",
        "CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_quantity / CAST(5.0 AS DOUBLE) END AS position_speed",
    ]


# ---------------------------------------------------------------- SQL text

def flights_sql(d: Dialect, orders: str = "orders") -> str:
    base = ", ".join(_base_columns(d))
    cols = ", ".join(_flight_columns(d, dup=False))
    dcols = ", ".join(_flight_columns(d, dup=True))
    return (f"SELECT {cols} FROM (SELECT {base} FROM {orders}) b "
            f"UNION ALL SELECT {dcols} FROM (SELECT {base} FROM {orders}) b WHERE k % 53 = 0")


def runways_sql(d: Dialect, orders: str = "orders") -> str:
    base = ", ".join(_base_columns(d))
    return f"SELECT {', '.join(_runway_columns(d))} FROM (SELECT {base} FROM {orders}) b WHERE k % 7 = 0"


def estimates_sql(d: Dialect, airport: str = HOME_AIRPORT, orders: str = "orders") -> str:
    base = ", ".join(_base_columns(d))
    return (f"SELECT {', '.join(_estimate_columns(d, airport))} FROM (SELECT {base} FROM {orders}) b "
            f"WHERE k % 5 = 0 AND (dep_ap = '{airport}' OR arr_ap = '{airport}')")


def positions_sql(d: Dialect, lineitem: str = "lineitem") -> str:
    return f"SELECT {', '.join(_position_columns(d))} FROM {lineitem}"


def duck_views() -> str:
    """DuckDB CTE list defining the four source tables over the driver views."""
    return (f"flights_src AS ({flights_sql(DUCK)}), "
            f"runways_src AS ({runways_sql(DUCK)}), "
            f"estimates_src AS ({estimates_sql(DUCK)}), "
            f"positions_src AS ({positions_sql(DUCK)})")


# ---------------------------------------------------------------- Spark side

def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderpriority")
    return o


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _orders(spark, sf_dir).selectExpr(*_base_columns(SPARK))
    first = b.selectExpr(*_flight_columns(SPARK, dup=False))
    again = b.where("k % 53 = 0").selectExpr(*_flight_columns(SPARK, dup=True))
    return first.unionByName(again)


def runways(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _orders(spark, sf_dir).selectExpr(*_base_columns(SPARK))
    return b.where("k % 7 = 0").selectExpr(*_runway_columns(SPARK))


def estimates(spark: SparkSession, sf_dir: str, airport: str = HOME_AIRPORT) -> DataFrame:
    b = _orders(spark, sf_dir).selectExpr(*_base_columns(SPARK))
    return (b.where(f"k % 5 = 0 AND (dep_ap = '{airport}' OR arr_ap = '{airport}')")
            .selectExpr(*_estimate_columns(SPARK, airport)))


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag")
    return li.selectExpr(*_position_columns(SPARK))
