"""Row filters of the feature pipelines.

Statistics that a filter needs (median, quartiles, percentiles) are taken over
the rows present at that step, per airport where the table has one, and joined
back: one row per airport of the job, so the broadcast is bounded by the job's
list of airports.  Nothing goes through the driver.  A step is one lazy plan, or,
with ``settled``, its statistics are written first: steps that follow each other
then read their input once each, where a chain of lazy steps would read it twice
as often with every step.  Quantiles are exact, with linear interpolation like pandas
``quantile``, and no task holds a group's values (see ``quantiles``).
"""

from __future__ import annotations

import logging
from functools import reduce
from typing import Callable, Mapping, Sequence, Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pushback.operators.quantiles import exact_quantiles
from pushback.session import materialize

log = logging.getLogger(__name__)

TARGETS = {
    "ramp": "actual_departure_ramp_taxi_time",
    "full": "actual_departure_full_taxi_time",
    "ama": "actual_departure_ama_taxi_time",
    "AMA": "actual_departure_ama_taxi_time",
}


def _all(conds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def airports_of(df: DataFrame) -> list[str]:
    """The columns that keep airports apart: statistics of one airport never use another's rows."""
    return [c for c in ("airport_icao",) if c in df.columns]


def _with_stats(df: DataFrame, stats: DataFrame, by: Sequence[str]) -> DataFrame:
    """Attach a statistics table of one row per ``by`` (one row in all without it)."""
    if not by:
        return df.crossJoin(F.broadcast(stats))
    names = [c for c in stats.columns if c not in by]
    return df.join(F.broadcast(stats), list(by), "left").select(*df.columns, *names)


def only_departures(df: DataFrame) -> DataFrame:
    return df.where(F.coalesce(F.col("isdeparture"), F.lit(False)))


def non_null(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """Drop rows with a NULL in any listed column; an empty list keeps all rows."""
    cols = list(columns or [])
    return df.dropna(subset=cols) if cols else df


def require_stand_and_runway(df: DataFrame, features_core: Sequence[str],
                             freight_airlines: Sequence[str] | None = None) -> DataFrame:
    """Require a departure stand / runway.

    A core feature is always required.  A non-core one is required unless the
    carrier is on the freight list; with no freight list it is not required.
    """
    freight = list(freight_airlines or [])
    conds = []
    for col in ("departure_stand_actual", "departure_runway_actual"):
        if col in features_core:
            conds.append(F.col(col).isNotNull())
        elif freight:
            conds.append(F.col(col).isNotNull() | F.coalesce(F.col("carrier").isin(freight), F.lit(False)))
    return df.where(_all(conds)) if conds else df


Band = Union[float, int, Sequence[float]]


def _band_limits(band: Band) -> tuple[list[float], Callable[[Column], tuple[Column, Column]]] | None:
    """What a band needs: the quantiles to take, and (low, high) from them.  None: there is no band to apply."""
    if isinstance(band, float):
        def around_median(q: Column) -> tuple[Column, Column]:
            reach = F.lit(band) * (q[2] - q[0])
            return q[1] - reach, q[1] + reach
        return [0.25, 0.5, 0.75], around_median
    if isinstance(band, (list, tuple)) and len(band) == 2:
        return [float(p) for p in band], lambda q: (q[0], q[1])
    return None


def taxi_time_band(df: DataFrame, target: str, niqr: Band, settled: bool = False) -> DataFrame:
    """Positive target, then inside ``median ± niqr·IQR`` or between two percentiles, per airport.

    ``-1`` or a missing target column skips everything.  A float keeps
    ``median - n·IQR < t < median + n·IQR``; a two-element list keeps
    ``p_lo < t < p_hi`` (so ``[0, 1]`` drops the minimum and maximum rows).
    Statistics are taken after the ``> 0`` step.  Any other setting leaves the
    ``> 0`` step alone and is reported.
    """
    if niqr == -1 or target not in df.columns:
        return df
    pos = df.where(F.col(target) > 0.0)
    limits = _band_limits(niqr)
    if limits is None:
        log.error("%s: %r is no band (a float, or low and high percentile); only values above zero are kept", target, niqr)
        return pos
    ps, ends = limits
    by = airports_of(df)
    lo, hi = ends(F.col("_q"))
    stats = exact_quantiles(pos, {"_q": (F.col(target), ps)}, by)
    stats = materialize(stats) if settled else stats
    return _with_stats(pos, stats, by).where((F.col(target) > lo) & (F.col(target) < hi)).drop("_q")


def taxi_time_filter(df: DataFrame, area: str, niqr: Band, settled: bool = False) -> DataFrame:
    """Wrapper per target area: ``ramp``, ``full`` or ``ama``."""
    return taxi_time_band(df, TARGETS[area], niqr, settled)


# The band and the limits are generic: any numeric column.
value_band = taxi_time_band


def surface_count_limits(df: DataFrame, limits: Mapping[str, float] | None, settled: bool = False) -> DataFrame:
    """Upper limits on surface counts, strict ``<``.

    A limit below 1 is a percentile of the column within the airport, otherwise
    an absolute count.  Every percentile is taken on the *unfiltered* input.
    Any limit <= 0 disables the whole filter.  Rows with a NULL count are dropped.
    """
    if not limits or any(v <= 0 for v in limits.values()):
        return df
    pct = {k: v for k, v in limits.items() if v < 1.0}
    out, by = df, airports_of(df)
    if pct:
        stats = exact_quantiles(df, {f"_lim_{k}": (F.col(k), [v]) for k, v in pct.items()}, by)
        out = _with_stats(df, materialize(stats) if settled else stats, by)
    conds = [F.col(k) < (F.col(f"_lim_{k}")[0] if k in pct else F.lit(float(v))) for k, v in limits.items()]
    return out.where(_all(conds)).drop(*[f"_lim_{k}" for k in pct])


def surface_count_filter(df: DataFrame, area: str, upperlimit_counts: Mapping | None, settled: bool = False) -> DataFrame:
    """Per-area wrapper; no-op when the area is not configured."""
    if not upperlimit_counts or not upperlimit_counts.get(area):
        return df
    return surface_count_limits(df, upperlimit_counts[area], settled)


def date_range(df: DataFrame, start: str, end: str, ref: str = "departure_runway_actual_time") -> DataFrame:
    """Keep ``start < ref <= end``; NULL times drop."""
    s = F.lit(start).cast("timestamp_ntz")
    e = F.lit(end).cast("timestamp_ntz")
    return df.where((F.col(ref) > s) & (F.col(ref) <= e))


def coverage_report(df: DataFrame, start: str, end: str, ref: str = "departure_runway_actual_time",
                    by: Sequence[str] = ("airport_icao",)) -> DataFrame:
    """Data range vs requested range: hours short at each end, rows inside.

    ``warn`` is set when more than 12 hours are missing at either end;
    ``rows_in_range = 0`` is the condition under which a job must stop.
    """
    s = F.lit(start).cast("timestamp_ntz")
    e = F.lit(end).cast("timestamp_ntz")
    agg = df.groupBy(*by).agg(
        F.min(ref).alias("data_start"), F.max(ref).alias("data_end"),
        F.count_if((F.col(ref) > s) & (F.col(ref) <= e)).alias("rows_in_range"))
    hrs_start = F.timestamp_diff("MICROSECOND", s, F.col("data_start")) / F.lit(3.6e9)
    hrs_end = F.timestamp_diff("MICROSECOND", F.col("data_end"), e) / F.lit(3.6e9)
    return agg.select(*by, "data_start", "data_end", "rows_in_range",
                      F.round(hrs_start, 6).alias("hours_short_start"),
                      F.round(hrs_end, 6).alias("hours_short_end"),
                      ((hrs_start > 12) | (hrs_end > 12)).alias("warn"))


def unimpeded_flag(df: DataFrame, fraction_gte: float | None,
                   col: str = "fraction_speed_gte_threshold") -> DataFrame:
    """``unimpeded_AMA`` = fraction >= limit; missing fraction gives False.

    Skipped (no column) when the limit is not configured.
    """
    if fraction_gte is None:
        return df
    return df.withColumn("unimpeded_AMA", F.coalesce(F.col(col) >= F.lit(float(fraction_gte)), F.lit(False)))


def join_speed_fraction(df: DataFrame, fractions: DataFrame, mark: str | None = None) -> DataFrame:
    """Left join of the per-flight speed fraction; unmatched flights stay (``mark`` tells the others)."""
    if not mark:
        return df.join(fractions, "gufi", "left")
    joined = df.join(fractions.withColumn("__found", F.lit(True)), "gufi", "left")
    return joined.withColumn(mark, F.col("__found").isNotNull()).drop("__found")


def common_categories(df: DataFrame, columns: Sequence[str], divisor: float = 100.0,
                      by: Sequence[str] = ()) -> DataFrame:
    """Drop rows whose value in any listed column is rarer than top count / ``divisor``.

    Counts are per ``by`` group (e.g. terminal) and all come from the
    unfiltered input; NULL values are dropped.  Each column's kept values are
    found by a ``groupBy`` and applied with a left-semi join, so no vocabulary
    is collected to the driver.
    """
    out = df
    keys = list(by)
    for c in columns:
        counts = df.where(F.col(c).isNotNull()).groupBy(*keys, c).count()
        if keys:
            top = counts.groupBy(*keys).agg(F.max("count").alias("_top"))
            ranked = counts.join(top, keys)
        else:
            ranked = counts.crossJoin(F.broadcast(counts.agg(F.max("count").alias("_top"))))
        keep = ranked.where(F.col("count") >= F.col("_top") / F.lit(divisor)).select(*keys, c)
        out = out.join(keep, keys + [c], "left_semi")
    return out


def busy_values(df: DataFrame, column: str, min_rows: int = 50) -> DataFrame:
    """Keep rows whose ``column`` value has more than ``min_rows`` rows."""
    keep = df.where(F.col(column).isNotNull()).groupBy(column).count().where(F.col("count") > min_rows).select(column)
    return df.join(keep, column, "left_semi")
