"""Composed jobs: the feature tables the reference's pipelines produce.

Step order matters: percentiles are taken on the rows left at that point,
and surface counts are computed *before* the date-range and departure
filters so arrivals and edge flights are still counted.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pushback.operators import clean, filters, occupancy, split
from pushback.operators.quality import StepWatch
from pushback.plans.config import PipelineParams
from pushback.session import deal_by_size, materialize
from pushback.sources import adapter, readers
from pushback.sources import flight_tables as ft

log = logging.getLogger(__name__)


@dataclass
class RawSources:
    """Raw source tables (any reader: Parquet, JDBC, CSV)."""
    flights: DataFrame
    runways: DataFrame
    positions: DataFrame
    estimates: DataFrame


def adapter_sources(spark: SparkSession, sf_dir: str) -> RawSources:
    """Stand-in sources built from the driver's tables (see :mod:`pushback.sources.adapter`)."""
    return RawSources(adapter.flights(spark, sf_dir), adapter.runways(spark, sf_dir),
                      adapter.positions(spark, sf_dir), adapter.estimates(spark, sf_dir))


def parquet_sources(spark: SparkSession, root: str) -> RawSources:
    """Source tables in ``<root>/flights``, ``runways``, ``positions`` and ``estimates``.

    Runway use and estimates may be absent: flights then keep their own
    runways, and have no estimates.
    """
    root = root.rstrip("/")
    return RawSources(spark.read.parquet(f"{root}/flights"),
                      readers.read_or_empty(spark, f"{root}/runways", readers.RAW_RUNWAYS_SCHEMA),
                      spark.read.parquet(f"{root}/positions"),
                      readers.read_or_empty(spark, f"{root}/estimates", readers.ESTIMATES_SCHEMA))


def sources_of(spark: SparkSession, where: str) -> RawSources:
    """``parquet:<folder>`` or ``adapter:<driver table folder>``."""
    kind, _, path = where.partition(":")
    known = {"parquet": parquet_sources, "adapter": adapter_sources}
    if kind not in known:
        raise SystemExit(f"sources: {kind!r} is none of {', '.join(known)}; call run() with your own RawSources otherwise")
    return known[kind](spark, path)


@dataclass
class Ingested:
    flights: DataFrame
    runways: DataFrame
    fractions: DataFrame
    estimates: DataFrame


def ingest(src: RawSources, p: PipelineParams) -> Ingested:
    """The four source queries for the window's airports."""
    w = p.window
    return Ingested(
        ft.flight_summary(src.flights, w),
        ft.runway_actuals(src.runways, w),
        ft.speed_fraction(src.positions, src.flights, w, p.speed_threshold_knots),
        ft.external_estimates(src.estimates, w),
    )


def _watched(watch: StepWatch | None, name: str, df: DataFrame, mark: str | None = None, times: str | None = None) -> DataFrame:
    """Count a step's rows (each ``times`` over), and those with ``mark``; both columns are dropped."""
    work = [c for c in (mark, times) if c]
    if watch is not None:
        df = watch(name, df, F.col(mark) if mark else None, F.col(times) if times else None)
    return df.drop(*work) if work else df


def cleaned_flights(ing: Ingested, with_estimates: bool = True, check_empty_runways: bool = True,
                    watch: StepWatch | None = None) -> DataFrame:
    """Override runways -> (estimates) -> first row per flight.

    A flight keeps the first of its estimates, so only the first of each key
    tuple is joined; a watched ``estimate_join`` counts all of them.  The flights
    are counted first, so that the joins and the sort get enough partitions.
    """
    deal_by_size(ing.flights)
    mark, times = ("__matched", "__times") if watch else (None, None)
    df = _watched(watch, "flight_summary", ing.flights)
    df = _watched(watch, "runway_override", clean.replace_runway_actuals(df, ing.runways, check_empty=check_empty_runways, mark=mark), mark)
    if with_estimates:
        df = clean.merge_estimates(df, clean.first_estimates(ing.estimates, count=times), mark=mark)
        df = _watched(watch, "estimate_join", df, mark, times)
    return _watched(watch, "first_per_flight", clean.keep_first_per_flight(df))


def check_coverage(flights: DataFrame, p: PipelineParams) -> None:
    """Stop if no flight is in the date range; warn per airport if over 12 hours are missing at an end."""
    report = filters.coverage_report(flights, p.window.start, p.window.end).collect()  # one row per airport
    if not sum(r["rows_in_range"] for r in report):
        raise ValueError(f"no flight between {p.window.start} and {p.window.end}")
    for r in report:
        if r["warn"]:
            log.warning("%s: data from %s to %s do not cover %s to %s", r["airport_icao"], r["data_start"],
                        r["data_end"], p.window.start, p.window.end)


def core_table(ing: Ingested, p: PipelineParams, with_estimates: bool = True,
               check_empty_runways: bool = True, checkpoint: bool = True, check_range: bool = False,
               watch: StepWatch | None = None) -> DataFrame:
    """Override runways -> (estimates) -> first per flight -> surface counts ->
    total taxi time -> date range -> train/test split -> departures.

    With ``checkpoint`` the cleaned flights (read three times by the
    occupancy step) and the result are written to the checkpoint folder,
    the same boundaries at which the reference saves tables.  With
    ``check_range`` the run stops when no row is in the date range.  ``watch``
    counts the steps' rows in the jobs that write.
    """
    df = cleaned_flights(ing, with_estimates, check_empty_runways, watch)
    if checkpoint:
        df = materialize(df)
    if check_range:
        check_coverage(df, p)
    df = occupancy.add_surface_counts(df, p.occupancy_timeout_s, p.occupancy_bucket,
                                      p.occupancy_infer_times, p.occupancy_timeout_flights)
    df = clean.add_total_taxi_time(df)
    df = _watched(watch, "date_range", filters.date_range(df, p.window.start, p.window.end))
    df = split.add_train_test_group(df, p.test_size, p.random_seed, {"cross_val": p.cross_val})
    df = _watched(watch, "departures", filters.only_departures(df))
    return materialize(df) if checkpoint else df


def variant_steps(core: DataFrame, p: PipelineParams, variant: str, fractions: DataFrame | None = None,
                  watch: StepWatch | None = None) -> list[tuple[str, DataFrame]]:
    """The named filter steps of one variant's feature table, in order (input first).

    The last entry is the feature table.  The statistics of each step are
    written before the next (``settled``), so every step reads the core table
    once.  ``watch`` counts the steps in the jobs that read them anyway.
    """
    steps: list[tuple[str, DataFrame]] = [("input", core)]

    def add(name, df, mark=None):
        steps.append((name, _watched(watch, name, df, mark)))
        return steps[-1][1]

    def band(df, area):
        return add(f"taxi_time_band_{area}", filters.taxi_time_filter(df, area, p.niqr[area], settled=True))

    df = add("require_stand_runway", filters.require_stand_and_runway(core, p.features_core, p.freight_airlines))
    if variant == "unimp_ramp":
        df = band(df, "ramp")
        df = add("surface_count_limits_ramp", filters.surface_count_filter(df, "ramp", p.upperlimit_counts, settled=True))
        add("non_null_times", filters.non_null(df, p.non_null.get("ramp")))
    elif variant in ("unimp_full", "unimp_ama"):
        area = "full" if variant == "unimp_full" else "ama"
        df = band(df, area)
        df = add("non_null_times", filters.non_null(df, p.non_null.get(area)))
        mark = "__matched" if watch else None
        df = add("speed_fraction_join", filters.join_speed_fraction(df, fractions, mark=mark), mark)
        lim_area = "full" if area == "full" else "AMA"
        df = add(f"surface_count_limits_{area}",
                 filters.surface_count_filter(df, lim_area, p.upperlimit_counts, settled=True))
        add("unimpeded_flag", filters.unimpeded_flag(df, p.unimpeded_fraction_gte))
    elif variant == "imp_full":
        for area in ("ama", "full", "ramp"):
            df = band(df, area)
    elif variant in ("imp_ramp", "imp_ama"):
        band(df, variant.split("_")[1])
    else:
        raise ValueError(f"unknown variant {variant}")
    return steps


def unimp_ramp_table(core: DataFrame, p: PipelineParams) -> DataFrame:
    return variant_steps(core, p, "unimp_ramp")[-1][1]


def unimp_full_table(core: DataFrame, fractions: DataFrame, p: PipelineParams) -> DataFrame:
    return variant_steps(core, p, "unimp_full", fractions)[-1][1]


def unimp_ama_table(core: DataFrame, fractions: DataFrame, p: PipelineParams) -> DataFrame:
    return variant_steps(core, p, "unimp_ama", fractions)[-1][1]


def imp_full_table(core: DataFrame, p: PipelineParams) -> DataFrame:
    return variant_steps(core, p, "imp_full")[-1][1]


def imp_ramp_table(core: DataFrame, p: PipelineParams) -> DataFrame:
    return variant_steps(core, p, "imp_ramp")[-1][1]


def imp_ama_table(core: DataFrame, p: PipelineParams) -> DataFrame:
    return variant_steps(core, p, "imp_ama")[-1][1]
