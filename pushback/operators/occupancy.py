"""Surface occupancy at pushback (how many aircraft are in each area).

For every departure with a pushback time, count the aircraft present in four
areas at that instant:

=====================  ========================================  =========
column                 interval of one flight                    direction
=====================  ========================================  =========
arr_runway_AMA_count   [runway landing, movement-area exit)      arrival
AMA_gate_count         [movement-area exit, stand arrival)       arrival
dep_stand_AMA_count    [pushback, movement-area entry)           departure
dep_AMA_runway_count   [movement-area entry, take-off)           departure
=====================  ========================================  =========

plus totals per direction and overall.  Intervals are closed at the start and
open at the end, so a departure counts itself at its own pushback and an
aircraft leaving at instant t is already gone when reading at t.

Missing times (our documented rule; the reference delegates this to a
package that is not public): an interval's end is the next known milestone of
the same flight, else ``start + timeout``; an interval without a start is
skipped.  So per flight the two areas tile the whole surface stay and the
totals equal the sum of their parts.  A count is NULL when the reading time
precedes the first interval of that series at that airport (as an as-of
lookup before the first event would be).

Plan shape (no as-of join, no inequality join, no global window):

1. every interval becomes a +1 and a -1 event in one of four delta columns;
   every pushback becomes a zero-delta probe row;
2. events are grouped per ``(airport, bucket)`` (bucket = hour by default):
   a small table whose running sum per airport is the *carry* into each
   bucket;
3. inside each ``(airport, bucket)`` a running sum ordered by
   ``(ts, probe-after-events)`` plus the carry gives the count in force at
   each probe.

The only windows are partitioned by ``(airport, bucket)`` (bounded by how
many movements one airport handles in an hour) and by airport over the tiny
per-bucket table.  The carry join is left to the planner: AQE broadcasts it
when the measured size is under the broadcast threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pushback.functions.timecols import add_seconds

SERIES = ("arr_runway_AMA_count", "AMA_gate_count", "dep_stand_AMA_count", "dep_AMA_runway_count")
TOTALS = ("total_arrivals_on_surface", "total_departures_on_surface", "total_flights_on_surface")
COUNT_COLUMNS = SERIES + TOTALS

CALC_TIME = "departure_stand_actual_time"

# series -> (flag column, start, middle, end) milestones of the two-area stay
_STAYS = {
    "arrival": ("isarrival", "arrival_runway_actual_time", "arrival_movement_area_actual_time",
                "arrival_stand_actual_time", "arr_runway_AMA_count", "AMA_gate_count"),
    "departure": ("isdeparture", "departure_stand_actual_time", "departure_movement_area_actual_time",
                  "departure_runway_actual_time", "dep_stand_AMA_count", "dep_AMA_runway_count"),
}


def surface_intervals(flights: DataFrame, timeout_seconds: int = 3600, infer_times: bool = True,
                      timeout_flights: bool = True) -> DataFrame:
    """One row per (flight, area) interval: ``airport_icao, gufi, series, t_in, t_out``.

    ``infer_times``: a missing exit takes the flight's next known milestone.
    ``timeout_flights``: an exit still missing becomes entry + timeout;
    otherwise such intervals are left out.  Intervals of zero or negative
    length are dropped (they hold nobody).
    """
    timeout = (lambda c: add_seconds(c, F.lit(timeout_seconds))) if timeout_flights else (lambda c: F.lit(None))
    parts = []
    for flag, m0, m1, m2, first_area, second_area in _STAYS.values():
        f = F.coalesce(F.col(flag), F.lit(False))
        a_in = F.col(m0)
        a_out = (F.coalesce(F.col(m1), F.col(m2), timeout(m0)) if infer_times
                 else F.coalesce(F.col(m1), timeout(m0)))
        b_in = F.col(m1)
        b_out = F.coalesce(F.col(m2), timeout(m1))
        parts.append(F.when(f & a_in.isNotNull(), F.struct(F.lit(first_area).alias("series"),
                                                            a_in.alias("t_in"), a_out.alias("t_out"))))
        parts.append(F.when(f & b_in.isNotNull(), F.struct(F.lit(second_area).alias("series"),
                                                           b_in.alias("t_in"), b_out.alias("t_out"))))
    iv = (flights.select("airport_icao", "gufi", F.explode(F.array_compact(F.array(*parts))).alias("i"))
          .select("airport_icao", "gufi", "i.series", "i.t_in", "i.t_out"))
    return iv.where(F.col("t_out") > F.col("t_in"))


def open_interval_counts(intervals: DataFrame, probes: DataFrame, series: tuple[str, ...],
                         by: tuple[str, ...] = ("airport_icao",), bucket: str = "hour",
                         probe_key: str = "gufi") -> DataFrame:
    """For every probe, the number of open intervals ``[t_in, t_out)`` per series.

    ``intervals``: ``*by, series, t_in, t_out``; ``probes``: ``*by, probe_key, ts``.
    Returns ``*by, probe_key, ts`` and one count column per series; a count
    is NULL when the probe precedes the first interval of that series within
    ``by``, or when the probe's group or time is NULL.  Counts include
    intervals starting at the probe instant and exclude those ending at it.

    Plan: +1/-1 events are summed per distinct instant (with partial
    aggregation, so any number of events at one instant is one row),
    per-``(by, bucket)`` totals give a running carry, running sums go over the
    instants of a bucket, and the probes look their instant up.
    """
    by = list(by)
    n = len(series)
    ev = intervals.select(*by, "series", F.explode(F.array(
        F.struct(F.col("t_in").alias("ts"), F.lit(1).alias("sign")),
        F.struct(F.col("t_out").alias("ts"), F.lit(-1).alias("sign")))).alias("e"))
    ev = ev.select(*by, F.col("e.ts").alias("ts"),
                   *[F.when(F.col("series") == s, F.col("e.sign")).otherwise(F.lit(0)).cast("long").alias(f"d_{i}")
                     for i, s in enumerate(series)],
                   *[F.when((F.col("series") == s) & (F.col("e.sign") > 0), F.col("e.ts")).alias(f"f_{i}")
                     for i, s in enumerate(series)])
    pr = probes.select(*by, "ts", *[F.lit(0).cast("long").alias(f"d_{i}") for i in range(n)],
                       *[F.lit(None).cast(probes.schema["ts"].dataType).alias(f"f_{i}") for i in range(n)])
    instants = ev.unionByName(pr).groupBy(*by, "ts").agg(
        *[F.sum(f"d_{i}").alias(f"d_{i}") for i in range(n)], *[F.min(f"f_{i}").alias(f"f_{i}") for i in range(n)])
    instants = instants.withColumn("bucket", F.date_trunc(bucket, F.col("ts")))

    # Level 1: per-bucket delta totals and first start per series: a small table (groups x buckets).
    per_bucket = instants.groupBy(*by, "bucket").agg(
        *[F.sum(f"d_{i}").alias(f"b_{i}") for i in range(n)], *[F.min(f"f_{i}").alias(f"f_{i}") for i in range(n)])
    before = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    carry = per_bucket.select(
        *by, "bucket",
        *[F.coalesce(F.sum(f"b_{i}").over(before), F.lit(0)).alias(f"c_{i}") for i in range(n)],
        *[F.min(f"f_{i}").over(whole).alias(f"first_{i}") for i in range(n)])

    # Level 2: running sum over the instants of each (group, bucket).
    w_run = (Window.partitionBy(*by, "bucket").orderBy("ts")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = instants.join(carry, [*by, "bucket"]).select(
        *by, "ts", *[(F.sum(f"d_{i}").over(w_run) + F.col(f"c_{i}")).alias(f"n_{i}") for i in range(n)],
        *[F.col(f"first_{i}") for i in range(n)])
    found = run.select(
        *by, "ts", *[F.when(F.col("ts") >= F.col(f"first_{i}"), F.col(f"n_{i}")).alias(s) for i, s in enumerate(series)],
        *[F.col(f"first_{i}").alias(f"__first_{s}") for i, s in enumerate(series)])
    return probes.select(*by, probe_key, "ts").join(found, [*by, "ts"], "left").select(
        *by, probe_key, "ts", *series, *[f"__first_{s}" for s in series])


def counts_at_pushback(flights: DataFrame, timeout_seconds: int = 3600, bucket: str = "hour",
                       infer_times: bool = True, timeout_flights: bool = True) -> DataFrame:
    """Seven surface counts for every departure with a pushback time.

    Returns ``airport_icao, gufi`` plus :data:`COUNT_COLUMNS`.
    """
    iv = surface_intervals(flights, timeout_seconds, infer_times, timeout_flights)
    probes = (flights.where(F.coalesce(F.col("isdeparture"), F.lit(False)) & F.col(CALC_TIME).isNotNull())
              .select("airport_icao", "gufi", F.col(CALC_TIME).alias("ts")))
    c = open_interval_counts(iv, probes, SERIES, ("airport_icao",), bucket, "gufi")

    def total(a, b):
        first = F.least(F.col(f"__first_{a}"), F.col(f"__first_{b}"))
        return F.when(F.col("ts") >= first, F.coalesce(F.col(a), F.lit(0)) + F.coalesce(F.col(b), F.lit(0)))

    out = c.select(
        "airport_icao", "gufi", *SERIES,
        total("arr_runway_AMA_count", "AMA_gate_count").alias("total_arrivals_on_surface"),
        total("dep_stand_AMA_count", "dep_AMA_runway_count").alias("total_departures_on_surface"),
    )
    return out.withColumn("total_flights_on_surface",
                          F.col("total_arrivals_on_surface") + F.col("total_departures_on_surface"))


def add_surface_counts(flights: DataFrame, timeout_seconds: int = 3600, bucket: str = "hour",
                       infer_times: bool = True, timeout_flights: bool = True) -> DataFrame:
    """All seven counts joined back to the flights (arrivals get NULL)."""
    counts = counts_at_pushback(flights, timeout_seconds, bucket, infer_times, timeout_flights)
    return flights.join(counts, ["airport_icao", "gufi"], "left")
