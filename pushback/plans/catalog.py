"""Named queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

They run the library's operators over the stand-in sources built from the
driver tables at ``sf_dir`` (whole tables, no sampling).  Computed doubles are
rounded to 6 decimals at the very end so results can be compared value by
value with an independent SQL engine.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pushback.functions import codes
from pushback.functions.timecols import hour_bin, minute_of_day_bin
from pushback.operators import baseline as bl
from pushback.operators import clean, filters, metrics, occupancy, rules, split
from pushback.operators import distributions as dist
from pushback.operators import features as fe
from pushback.operators import quality
from pushback.plans import ingest, jobs, pipelines
from pushback.plans.config import METRICS, PipelineParams
from pushback.session import ensure_checkpoint_dir, materialize
from pushback.sources import flight_tables as ft
from pushback.sources import readers, sinks

RAMP = "actual_departure_ramp_taxi_time"
FULL = "actual_departure_full_taxi_time"
AMA = "actual_departure_ama_taxi_time"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (presentation step for value comparison)."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


# ------------------------------------------------------------------ stages

def _params() -> PipelineParams:
    return PipelineParams()


def _ingested(spark: SparkSession, sf: str, p: PipelineParams | None = None) -> jobs.Ingested:
    ensure_checkpoint_dir(spark)
    return jobs.ingest(jobs.adapter_sources(spark, sf), p or _params())


def _cleaned(spark, sf) -> DataFrame:
    return materialize(jobs.cleaned_flights(_ingested(spark, sf)))


def _flights_once(spark, sf) -> DataFrame:
    """The cleaned flights for a single use: not written, so only the columns used are computed."""
    return jobs.cleaned_flights(_ingested(spark, sf))


def _core(spark, sf, p: PipelineParams | None = None, **options) -> DataFrame:
    p = p or _params()
    return jobs.core_table(_ingested(spark, sf, p), p, **options)


def _imp_core(spark, sf, p: PipelineParams | None = None) -> DataFrame:
    """The core table of the impeded variants, which take no external estimates."""
    return _core(spark, sf, p, with_estimates=False)


def _ramp_table(spark, sf) -> DataFrame:
    p = _params()
    return materialize(jobs.unimp_ramp_table(_core(spark, sf, p), p))


def _ramp_baseline_cfg() -> bl.BaselineConfig:
    return bl.BaselineConfig(target=RAMP, group_by=("departure_runway_actual", "terminal"), metric="mean")


# ------------------------------------------------------------------ sources

def q_flight_summary(spark, sf):
    return rounded(_ingested(spark, sf).flights)


def q_runway_actuals(spark, sf):
    return _ingested(spark, sf).runways


def q_speed_fraction(spark, sf):
    return rounded(_ingested(spark, sf).fractions)


def q_external_estimates(spark, sf):
    return rounded(_ingested(spark, sf).estimates)


# ------------------------------------------------------------------ readers and sinks

def _scratch(spark, kind: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def q_csv_roundtrip(spark, sf):
    """The flight summary written as CSV with its columns in reverse order, and read back by name."""
    path = _scratch(spark, "csv")
    flights = _ingested(spark, sf).flights
    flights.select(*reversed(flights.columns)).write.option("header", True).option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    return rounded(readers.read_typed_csv(spark, path, readers.FLIGHT_SUMMARY_SCHEMA))


def q_checked_csv(spark, sf):
    """Orders as CSV with every 97th price spelled out: the others come back, those are set aside, counted here."""
    path, aside = _scratch(spark, "csv"), _scratch(spark, "bad")
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_totalprice", "o_orderpriority")
    price = F.when(F.col("o_orderkey") % 97 == 0, F.lit("none")).otherwise(F.col("o_totalprice").cast("string"))
    orders.withColumn("o_totalprice", price).write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("o_orderpriority", T.StringType()), T.StructField("o_orderkey", T.LongType()),
                           T.StructField("o_totalprice", T.DoubleType())])
    good = readers.read_checked_csv(spark, path, schema, aside, most_bad=0.05)
    bad = spark.read.parquet(aside).agg(F.count(F.lit(1)).alias("n_bad"))
    by = good.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_rows"), F.count("o_totalprice").alias("n_prices"),
                                             F.sum("o_orderkey").alias("sum_keys"))
    return by.crossJoin(F.broadcast(bad))  # one row


def q_resumable_ingest(spark, sf):
    """Flight summary loaded in two-day chunks by two runs: the first stops half-way, the second loads the rest."""
    out, p, src = _scratch(spark, "ingest"), _params(), jobs.adapter_sources(spark, sf)
    parts = ingest.chunks(ingest.FLIGHT_TIMES, p.window.start, p.window.end, 2)
    ingest.load(spark, out, "flights", parts[:2], "q", lambda c: ft.flight_summary(src.flights.where(c.predicate), p.window))
    ingest.load(spark, out, "flights", parts, "q", lambda c: ft.flight_summary(src.flights.where(c.predicate), p.window))
    return rounded(ingest.loaded_table(spark, out, "flights"))


def q_two_airport_write(spark, sf):
    """The summaries of two airports, written one after the other to one table."""
    root = _scratch(spark, "tables")
    for airport in ("KDFW", "KCLT"):
        p = _params()
        path = sinks.write_feature_table(_ingested(spark, sf, replace(
            p, window=replace(p.window, airports=(airport,)))).flights, root, "flights")
    return rounded(spark.read.schema(readers.FLIGHT_SUMMARY_SCHEMA).parquet(path))


def q_chunked_parquet_read(spark, sf):
    """The flight source read in three-day chunks over the four times by which a flight qualifies."""
    path, w = _scratch(spark, "source"), _params().window
    jobs.adapter_sources(spark, sf).flights.write.parquet(path)
    times = ["departure_runway_actual_time", "arrival_stand_actual_time", "arrival_runway_actual_time",
             "arrival_movement_area_actual_time"]
    chunks = readers.read_parquet_chunked(spark, path, times, w.start, w.end, 3)
    return rounded(ft.flight_summary(reduce(DataFrame.unionByName, chunks), w))


# ------------------------------------------------------------------ cleaning

def q_runway_override(spark, sf):
    ing = _ingested(spark, sf)
    return rounded(clean.replace_runway_actuals(ing.flights, ing.runways))


def q_estimate_join(spark, sf):
    ing = _ingested(spark, sf)
    df = clean.merge_estimates(ing.flights, ing.estimates)
    return rounded(df.select("airport_icao", "gufi", "acid", "isarrival", "isdeparture",
                             "departure_stand_initial_time", "gufi_ffs",
                             "undelayed_departure_ramp_transit_time", "undelayed_departure_ama_transit_time",
                             "undelayed_departure_total_transit_time"))


def q_dedup_first(spark, sf):
    return rounded(_flights_once(spark, sf))


# ------------------------------------------------------------------ occupancy

def _counts(spark, sf) -> DataFrame:
    return occupancy.counts_at_pushback(_cleaned(spark, sf))


def q_occupancy_dep_ramp(spark, sf):
    return _counts(spark, sf).select("airport_icao", "gufi", "dep_stand_AMA_count")


def q_occupancy_dep_ama(spark, sf):
    return _counts(spark, sf).select("airport_icao", "gufi", "dep_AMA_runway_count")


def q_occupancy_arr_ramp(spark, sf):
    return _counts(spark, sf).select("airport_icao", "gufi", "AMA_gate_count")


def q_occupancy_arr_ama(spark, sf):
    return _counts(spark, sf).select("airport_icao", "gufi", "arr_runway_AMA_count")


def q_occupancy_totals(spark, sf):
    return _counts(spark, sf).select("airport_icao", "gufi", "total_arrivals_on_surface",
                                     "total_departures_on_surface", "total_flights_on_surface")


def _two_airports() -> PipelineParams:
    """One job for two airports: every key, window and statistic is per ``airport_icao``."""
    p = _params()
    return replace(p, window=replace(p.window, airports=("KDFW", "KCLT")))


def q_occupancy_two_airports(spark, sf):
    p = _two_airports()
    cleaned = materialize(jobs.cleaned_flights(_ingested(spark, sf, p)))
    return occupancy.counts_at_pushback(cleaned).select(
        "airport_icao", "gufi", "dep_stand_AMA_count", "dep_AMA_runway_count", "total_arrivals_on_surface",
        "total_flights_on_surface")


# ------------------------------------------------------------------ filters

_KEYCOLS = ("airport_icao", "gufi")


def q_departures_non_null(spark, sf):
    p = _params()
    df = filters.non_null(filters.only_departures(_flights_once(spark, sf)), p.non_null["ramp"])
    return df.select(*_KEYCOLS)


def q_require_stand_runway(spark, sf):
    df = filters.only_departures(_flights_once(spark, sf))
    out = filters.require_stand_and_runway(df, ["departure_runway_actual"], ["FDX"])
    return out.select(*_KEYCOLS, "carrier", "departure_stand_actual", "departure_runway_actual")


def q_niqr_band(spark, sf):
    return rounded(filters.taxi_time_filter(_core(spark, sf), "ramp", 3.0).select(*_KEYCOLS, RAMP))


def q_percentile_band(spark, sf):
    return rounded(filters.taxi_time_filter(_core(spark, sf), "full", [0, 1]).select(*_KEYCOLS, FULL))


def q_count_limits(spark, sf):
    p = _params()
    out = filters.surface_count_filter(_core(spark, sf), "ramp", p.upperlimit_counts)
    return out.select(*_KEYCOLS, *p.upperlimit_counts["ramp"].keys())


def q_runway_override_two_airports(spark, sf):
    ing = _ingested(spark, sf, _two_airports())
    return rounded(clean.replace_runway_actuals(ing.flights, ing.runways))


def q_niqr_band_two_airports(spark, sf):
    return rounded(filters.taxi_time_filter(_core(spark, sf, _two_airports()), "ramp", 3.0).select(*_KEYCOLS, RAMP))


def q_percentile_band_two_airports(spark, sf):
    return rounded(filters.taxi_time_filter(_core(spark, sf, _two_airports()), "full", [0, 1]).select(*_KEYCOLS, FULL))


def q_count_limits_two_airports(spark, sf):
    p = _two_airports()
    out = filters.surface_count_filter(_core(spark, sf, p), "ramp", p.upperlimit_counts)
    return out.select(*_KEYCOLS, *p.upperlimit_counts["ramp"].keys())


def _baseline_columns(table: DataFrame, cfg: bl.BaselineConfig) -> DataFrame:
    out = bl.predict_baseline(bl.fit_baseline(table, cfg), table)
    return rounded(out.select(*_KEYCOLS, "group", "predicted_baseline", "missing_core_features_baseline"))


def q_baseline_two_airports(spark, sf):
    return _baseline_columns(_core(spark, sf, _two_airports()), bl.BaselineConfig(target=RAMP))


def q_baseline_predict_unimp_ama(spark, sf):
    """Values fitted on unimpeded training rows, vocabulary from all training rows."""
    p = _params()
    ing = _ingested(spark, sf, p)
    table = materialize(jobs.unimp_ama_table(jobs.core_table(ing, p), ing.fractions, p))
    return _baseline_columns(table, bl.BaselineConfig(target=AMA, train_flag="unimpeded_AMA"))


def q_unimp_ama_metrics(spark, sf):
    """Metrics of the baseline on the unimpeded AMA table, over all rows and over the flagged ones."""
    p = _params()
    ing = _ingested(spark, sf, p)
    table = materialize(jobs.unimp_ama_table(jobs.core_table(ing, p), ing.fractions, p))
    cfg = bl.BaselineConfig(target=AMA, train_flag="unimpeded_AMA")
    pred = materialize(bl.predict_baseline(bl.fit_baseline(table, cfg), table)).where(~F.col("missing_core_features_baseline"))
    return rounded(metrics.evaluate_predictions(pred, AMA, "predicted_baseline", metrics.METRIC_NAMES))


def q_total_taxi_time(spark, sf):
    return rounded(_core(spark, sf).select(*_KEYCOLS, "actual_departure_total_taxi_time"))


def q_group_sizes(spark, sf):
    return split.group_sizes(_core(spark, sf))


def q_date_range(spark, sf):
    p = _params()
    out = filters.date_range(_flights_once(spark, sf), p.window.start, p.window.end)
    return out.select(*_KEYCOLS, "departure_runway_actual_time")


def q_coverage_report(spark, sf):
    p = _params()
    return filters.coverage_report(_flights_once(spark, sf), p.window.start, p.window.end)


# ------------------------------------------------------------------ splits

def _departures(spark, sf) -> DataFrame:
    return filters.only_departures(_flights_once(spark, sf)).select(*_KEYCOLS)


def q_hash_split(spark, sf):
    return split.simple_split(_departures(spark, sf), 0.2, 1234)


def q_montecarlo_split(spark, sf):
    return split.add_train_test_group(_departures(spark, sf), 0.2, 1234,
                                      {"cross_val": {"algo": "montecarlo", "n_cv": 10}})


def q_kfold_split(spark, sf):
    return split.add_train_test_group(_departures(spark, sf), 0.2, 1234,
                                      {"cross_val": {"algo": "kfold", "n_cv": 5}})


def q_kfold_exact_split(spark, sf):
    return split.add_train_test_group(_departures(spark, sf), 0.2, 1234,
                                      {"cross_val": {"algo": "kfold", "n_cv": 5, "exact": True}})


# ------------------------------------------------------------------ features

def q_unimpeded_flag(spark, sf):
    p = _params()
    ing = _ingested(spark, sf, p)
    core = jobs.core_table(ing, p)
    out = jobs.unimp_ama_table(core, ing.fractions, p)
    return rounded(out.select(*_KEYCOLS, AMA, "fraction_speed_gte_threshold", "unimpeded_AMA"))


def q_time_bins(spark, sf):
    df = _departures_full(spark, sf)
    return df.select(*_KEYCOLS, minute_of_day_bin("departure_stand_airline_time").alias("stand_time_bin10"),
                     hour_bin("departure_stand_airline_time").alias("stand_time_hour"))


def _departures_full(spark, sf) -> DataFrame:
    return filters.only_departures(_flights_once(spark, sf))


def q_stand_features(spark, sf):
    df = _departures_full(spark, sf)
    s = F.col("departure_stand_actual")
    return df.select(*_KEYCOLS, "departure_stand_actual",
                     codes.terminal_of_stand(s).alias("terminal"),
                     codes.zero_pad_gate(s).alias("stand_padded"),
                     codes.stand_group(s).alias("stand_group"),
                     codes.stand_number(s).alias("stand_number"))


def q_stand_encoding(spark, sf):
    """Stand encoder in long form: one row per (flight, training stand letter)."""
    core = _core(spark, sf)
    letters = fe.stand_letters(core.where(F.col("group") == "train"))
    enc = fe.encode_stands(core, letters)
    arr = F.array(*[F.struct(F.lit(L).alias("stand_letter"), F.col(f"group_{L}").alias("stand_value"))
                    for L in letters])
    return enc.select(*_KEYCOLS, F.explode(arr).alias("e")).select(*_KEYCOLS, "e.stand_letter", "e.stand_value")


def q_quality_rules(spark, sf):
    df = _core(spark, sf)
    cfg_core = ["departure_stand_actual", "departure_runway_actual"]
    train = df.where(F.col("group") == "train")
    vocab = rules.vocabulary(train, ["departure_runway_actual"], {"departure_runway_actual": ["17C"]})
    out = rules.add_rule_columns(df, cfg_core, ["departure_runway_actual"], vocab)
    return out.select(*_KEYCOLS, F.array_join("error_msg", "; ").alias("error_msg"), "missing_core_features")


def q_baseline_predict(spark, sf):
    ramp = _ramp_table(spark, sf)
    m = bl.fit_baseline(ramp, _ramp_baseline_cfg())
    out = bl.predict_baseline(m, ramp)
    return rounded(out.select(*_KEYCOLS, "group", "predicted_baseline", "missing_core_features_baseline"))


def _baseline_metrics(table: DataFrame, cfg: bl.BaselineConfig) -> DataFrame:
    m = bl.fit_baseline(table, cfg)
    pred = bl.predict_baseline(m, table).where(~F.col("missing_core_features_baseline"))
    return rounded(metrics.metrics_by(pred, cfg.target, "predicted_baseline", metrics.METRIC_NAMES, ["group"]))


def ramp_baseline_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: how well does the median ramp time per (runway, terminal) predict it?

    Impeded ramp pipeline (stand and runway required, ramp time inside
    median +/- 3 IQR), baseline = median per (runway, terminal), metrics per
    split group.
    """
    p = _params()
    table = materialize(jobs.imp_ramp_table(_imp_core(spark, sf, p), p))
    cfg = bl.BaselineConfig(target=RAMP, group_by=("departure_runway_actual", "terminal"), metric="quantile", q=0.5)
    return _baseline_metrics(table, cfg)


def q_imp_ramp_metrics(spark, sf):
    return ramp_baseline_metrics(spark, sf)


def q_error_metrics(spark, sf):
    """Unimpeded ramp: mean per (runway, terminal), all registered metrics."""
    return _baseline_metrics(_ramp_table(spark, sf), _ramp_baseline_cfg())


def q_metric_spread(spark, sf):
    ramp = _ramp_table(spark, sf)
    long = bl.baseline_cv_long(ramp, _ramp_baseline_cfg(), n_cv=10)
    groups = ramp.select("group").distinct()
    return rounded(metrics.cv_spread_long(long, METRICS, groups))


def q_residual_histogram(spark, sf):
    ramp = _ramp_table(spark, sf)
    m = bl.fit_baseline(ramp, _ramp_baseline_cfg())
    pred = bl.predict_baseline(m, ramp)
    return metrics.residual_histogram(pred, RAMP, "predicted_baseline", 30.0)


def q_estimate_vs_truth(spark, sf):
    ramp = _ramp_table(spark, sf)
    m = bl.fit_baseline(ramp, _ramp_baseline_cfg())
    pred = bl.predict_baseline(m, ramp)
    return metrics.estimate_vs_truth(pred, RAMP, "predicted_baseline", 60.0)


# ------------------------------------------------------------------ distributions

_DIST_FEATURES = ["departure_stand_actual", "departure_runway_actual", "carrier"]


def _dist_input(spark, sf) -> DataFrame:
    return dist.training_rows_per_terminal(_core(spark, sf), min_flights=50)


def q_category_support(spark, sf):
    df = _dist_input(spark, sf)
    kept = filters.common_categories(df, _DIST_FEATURES, 100.0, by=["terminal"])
    return kept.select(*_KEYCOLS, "terminal")


def q_feature_counts(spark, sf):
    return dist.feature_counts(dist.supported_rows(_dist_input(spark, sf), _DIST_FEATURES), _DIST_FEATURES)


def q_feature_pair_counts(spark, sf):
    return dist.feature_pair_counts(dist.supported_rows(_dist_input(spark, sf), _DIST_FEATURES), _DIST_FEATURES)


def q_count_scale(spark, sf):
    pairs = dist.feature_pair_counts(dist.supported_rows(_dist_input(spark, sf), _DIST_FEATURES), _DIST_FEATURES)
    return dist.count_scale(pairs)


# ------------------------------------------------------------------ composed tables

def q_step_quality(spark, sf):
    p = _params()
    core = _core(spark, sf, p)
    return rounded(quality.ramp_step_quality(core, p))


def q_step_watch(spark, sf):
    """Rows and match rates of all steps of the unimpeded full pipeline, observed while its tables are written."""
    p = _params()
    _, steps = pipelines.feature_table(spark, jobs.adapter_sources(spark, sf), p, pipelines.default_variant("unimp_full"), with_quality=True)
    return rounded(steps)


def q_unimp_full_table(spark, sf):
    p = _params()
    ing = _ingested(spark, sf, p)
    df = jobs.unimp_full_table(jobs.core_table(ing, p), ing.fractions, p)
    return rounded(df.select(*_KEYCOLS, "group", FULL, AMA, RAMP, "fraction_speed_gte_threshold", "unimpeded_AMA"))


def q_unimp_ramp_table(spark, sf):
    df = _ramp_table(spark, sf)
    return rounded(df.select(*_KEYCOLS, "group", RAMP, "departure_stand_actual", "departure_runway_actual",
                             "carrier", *occupancy.COUNT_COLUMNS))


def q_imp_full_table(spark, sf):
    p = _params()
    df = jobs.imp_full_table(_imp_core(spark, sf, p), p)
    return rounded(df.select(*_KEYCOLS, "group", FULL, AMA, RAMP, "total_flights_on_surface"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "flight_summary": q_flight_summary,
    "runway_actuals": q_runway_actuals,
    "speed_fraction": q_speed_fraction,
    "external_estimates": q_external_estimates,
    "csv_roundtrip": q_csv_roundtrip,
    "two_airport_write": q_two_airport_write,
    "chunked_parquet_read": q_chunked_parquet_read,
    "runway_override": q_runway_override,
    "estimate_join": q_estimate_join,
    "dedup_first": q_dedup_first,
    "occupancy_dep_ramp": q_occupancy_dep_ramp,
    "occupancy_dep_ama": q_occupancy_dep_ama,
    "occupancy_arr_ramp": q_occupancy_arr_ramp,
    "occupancy_arr_ama": q_occupancy_arr_ama,
    "occupancy_totals": q_occupancy_totals,
    "occupancy_two_airports": q_occupancy_two_airports,
    "departures_non_null": q_departures_non_null,
    "require_stand_runway": q_require_stand_runway,
    "niqr_band": q_niqr_band,
    "percentile_band": q_percentile_band,
    "count_limits": q_count_limits,
    "runway_override_two_airports": q_runway_override_two_airports,
    "niqr_band_two_airports": q_niqr_band_two_airports,
    "percentile_band_two_airports": q_percentile_band_two_airports,
    "count_limits_two_airports": q_count_limits_two_airports,
    "baseline_two_airports": q_baseline_two_airports,
    "baseline_predict_unimp_ama": q_baseline_predict_unimp_ama,
    "total_taxi_time": q_total_taxi_time,
    "group_sizes": q_group_sizes,
    "date_range": q_date_range,
    "coverage_report": q_coverage_report,
    "hash_split": q_hash_split,
    "montecarlo_split": q_montecarlo_split,
    "kfold_split": q_kfold_split,
    "kfold_exact_split": q_kfold_exact_split,
    "unimpeded_flag": q_unimpeded_flag,
    "time_bins": q_time_bins,
    "stand_features": q_stand_features,
    "stand_encoding": q_stand_encoding,
    "quality_rules": q_quality_rules,
    "baseline_predict": q_baseline_predict,
    "error_metrics": q_error_metrics,
    "imp_ramp_metrics": q_imp_ramp_metrics,
    "metric_spread": q_metric_spread,
    "residual_histogram": q_residual_histogram,
    "estimate_vs_truth": q_estimate_vs_truth,
    "category_support": q_category_support,
    "feature_counts": q_feature_counts,
    "feature_pair_counts": q_feature_pair_counts,
    "count_scale": q_count_scale,
    "step_quality": q_step_quality,
    "unimp_ramp_table": q_unimp_ramp_table,
    "imp_full_table": q_imp_full_table,
    "unimp_full_table": q_unimp_full_table,
    "unimp_ama_metrics": q_unimp_ama_metrics,
    "checked_csv": q_checked_csv,
    "resumable_ingest": q_resumable_ingest,
    "step_watch": q_step_watch,
}
