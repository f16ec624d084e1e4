"""The generic operators run directly on the driver's raw tables.

Open-interval counts (the occupancy operator), per-group fractions, the
group-quantile baseline with its metrics, and the band / limit filters are
not specific to flights; these queries run them on ``events``, ``lineitem``
and ``orders`` columns as they are.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pushback.operators import baseline as bl
from pushback.operators import filters, metrics, occupancy, sketches, split
from pushback.operators.quantiles import exact_quantiles
from pushback.plans.catalog import rounded
from pushback.session import materialize

# The event types of the driver's events table.
EVENT_TYPES = ("click", "view", "purchase", "signup", "error")
RETURN_FLAGS = ("A", "N", "R")


def _t(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _known(series, names):
    """The series, which has to be one that the result has a column for."""
    return F.when(series.isin(list(names)), series).otherwise(F.raise_error(F.concat(F.lit("no column for series "), series.cast("string"))))


def q_events_fraction_ge(spark, sf):
    """Per user: share of events whose value is at least 50 (NULL values ignored)."""
    ev = _t(spark, sf, "events")
    return rounded(ev.groupBy("user_id").agg(
        F.avg((F.col("value") >= 50.0).cast("int").cast("double")).alias("fraction_value_gte")))


def q_events_quantile_states(spark, sf):
    """Per event type: quantile states of each day, merged; count, ends, and whether inner ranks are within 2 %."""
    ev = _t(spark, sf, "events").withColumn("day", F.to_date("ts"))
    daily = materialize(sketches.quantile_states(ev, F.col("value"), ["event_type", "day"]))
    merged = sketches.quantiles_of(sketches.merge_states(daily, ["event_type"]), (0.0, 0.1, 0.5, 0.9, 1.0))
    inner = [F.col("quantiles")[i] for i in (1, 2, 3)]
    known = materialize(merged).withColumnRenamed("event_type", "q_type")
    rows = ev.where("value IS NOT NULL AND NOT isnan(value)")
    # a quantile's rank lies between the rows below it and those up to it
    ranks = [F.sum(cond.cast("int")).alias(f"{name}{i}") for i, q in enumerate(inner)
             for name, cond in (("below", F.col("value") < q), ("upto", F.col("value") <= q))]
    ranked = rows.join(known, F.col("event_type").eqNullSafe(F.col("q_type"))).groupBy("event_type", "n", "quantiles").agg(*ranks)
    ok = F.lit(True)
    for i, p in enumerate((0.1, 0.5, 0.9)):
        ok = ok & (F.col(f"below{i}") <= (p + 0.02) * F.col("n") + 1) & (F.col(f"upto{i}") >= (p - 0.02) * F.col("n") - 1)
    return ranked.select("event_type", "n", F.col("quantiles")[0].alias("least"), F.col("quantiles")[4].alias("greatest"), ok.alias("ranks_ok"))


def q_events_open_intervals(spark, sf):
    """Per user, at each purchase: events of each type still open ([ts, ts + value minutes))."""
    ev = _t(spark, sf, "events")
    iv = ev.select("user_id", _known(F.col("event_type"), EVENT_TYPES).alias("series"), F.col("ts").alias("t_in"),
                   F.timestamp_add("SECOND", F.floor(F.col("value") * 60), F.col("ts")).alias("t_out"))
    iv = iv.where(F.col("t_out") > F.col("t_in"))
    probes = ev.where(F.col("event_type") == "purchase").select("user_id", "event_id", "ts")
    out = occupancy.open_interval_counts(iv, probes, EVENT_TYPES, ("user_id",), "hour", "event_id")
    return out.select("user_id", "event_id", "ts", *EVENT_TYPES)


def q_lineitem_in_transit(spark, sf):
    """At each order date: line items shipped and not yet past ``ship date + quantity days``, per return flag."""
    li = _t(spark, sf, "lineitem")
    iv = li.select(_known(F.col("l_returnflag"), RETURN_FLAGS).alias("series"), F.col("l_shipdate").alias("t_in"),
                   F.timestamp_add("DAY", F.col("l_quantity").cast("int"), F.col("l_shipdate")).alias("t_out"))
    probes = _t(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias("ts"))
    out = occupancy.open_interval_counts(iv.where(F.col("t_out") > F.col("t_in")), probes, RETURN_FLAGS,
                                         (), "day", "o_orderkey")
    return out.select("o_orderkey", "ts", F.col("A").alias("in_transit_A"), F.col("N").alias("in_transit_N"),
                      F.col("R").alias("in_transit_R"))


def q_events_baseline_metrics(spark, sf):
    """Median value per event type learnt on a hash-split training set, scored per split group."""
    ev = split.simple_split(_t(spark, sf, "events"), 0.2, 1234, key="event_id")
    cfg = bl.BaselineConfig(target="value", group_by=("event_type",), metric="quantile", q=0.5,
                            features_core=("event_type",))
    pred = bl.predict_baseline(bl.fit_baseline(ev, cfg), ev).where(~F.col("missing_core_features_baseline"))
    return rounded(metrics.metrics_by(pred, "value", "predicted_baseline", metrics.METRIC_NAMES, ["group"]))


def q_lineitem_price_quantiles(spark, sf):
    """Exact quantiles of a continuous column per return flag."""
    li = _t(spark, sf, "lineitem")
    out = exact_quantiles(li, {"price": (F.col("l_extendedprice"), [0.01, 0.5, 0.99]),
                               "discount": (F.col("l_discount") - 0.05, [0.25])}, ["l_returnflag"])
    return rounded(out.select("l_returnflag", *[F.col("price")[i].alias(n) for i, n in enumerate(("p01", "p50", "p99"))],
                              F.col("discount")[0].alias("discount_p25")))


def q_events_time_quantiles(spark, sf):
    """Quantiles of the time in whole seconds since 1970, per event type: values with a large offset."""
    seconds = F.floor(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")) / F.lit(1e6))
    out = exact_quantiles(_t(spark, sf, "events"), {"t": (seconds, [0.1, 0.5, 0.975])}, ["event_type"])
    return out.select("event_type", *[F.round(F.col("t")[i], 2).alias(n) for i, n in enumerate(("p10", "p50", "p975"))])


def q_lineitem_iqr_band(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return filters.value_band(li, "l_extendedprice", 1.5)


def q_lineitem_percentile_band(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return filters.value_band(li, "l_quantity", [0.05, 0.95])


def q_lineitem_count_limits(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return filters.surface_count_limits(li, {"l_quantity": 0.3, "l_linenumber": 4})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "events_fraction_ge": q_events_fraction_ge,
    "events_quantile_states": q_events_quantile_states,
    "events_open_intervals": q_events_open_intervals,
    "lineitem_in_transit": q_lineitem_in_transit,
    "events_baseline_metrics": q_events_baseline_metrics,
    "lineitem_price_quantiles": q_lineitem_price_quantiles,
    "events_time_quantiles": q_events_time_quantiles,
    "lineitem_iqr_band": q_lineitem_iqr_band,
    "lineitem_percentile_band": q_lineitem_percentile_band,
    "lineitem_count_limits": q_lineitem_count_limits,
}
